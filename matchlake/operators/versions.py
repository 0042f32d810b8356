"""Warehouse tables in versions, switched by one committed pointer.

Rows are written to fresh folders that nobody reads yet.  A pointer file names, for
every table, the folders that hold its rows and the batches that were appended to
it; it is written under a name of its own and renamed to the next free number, which
fails if another writer was first.  That rename is the one commit: all tables
switch together, rows and batch names together, and a job that dies before it
changes nothing.  A frame made before a switch goes on reading the old folders.

The pointer grows with the number of folders (replace a table to start anew), never
with rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from matchlake.operators.load import positional
from matchlake.schemas import TABLES
from matchlake.session import work_dir


class Conflict(RuntimeError):
    """Another writer published a version since this one began."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, list[str]] = field(default_factory=dict)


class _Pointers:
    """Numbered files in a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.fs_of = spark, spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        path = self.fs_of.Path(folder)
        self.fs = path.getFileSystem(conf)
        self.folder = self.fs.makeQualified(path)
        self.context = self.fs_of.FileContext.getFileContext(self.folder.toUri(), conf)

    def _path(self, name: str):
        return self.fs_of.Path(self.folder, name)

    def names(self) -> list[str]:
        if not self.fs.exists(self.folder):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.folder))

    def numbers(self) -> list[int]:
        return [int(n) for n in self.names() if n.isdigit()]

    def read(self, number: int) -> str:
        stream = self.fs.open(self._path(f"{number:012d}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, number: int, text: str) -> None:
        draft = self._path(f".draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self.fs_of, "Options$Rename")
        keep = self.spark.sparkContext._gateway.new_array(rename, 0)  # never overwrite
        try:
            self.context.rename(draft, self._path(f"{number:012d}"), keep)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise Conflict(f"version {number} was published by another writer") from e
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class VersionedWarehouse:
    """The warehouse tables, each read from the folders of the newest version."""

    def __init__(self, spark: SparkSession, location: str | None = None):
        self.spark = spark
        self.location = location or work_dir(spark, "versions")
        self.pointers = _Pointers(spark, f"{self.location}/pointer")

    def version(self, number: int | None = None) -> Version:
        """The newest version, or an older one by its number."""
        if number is None:
            number = max(self.pointers.numbers(), default=0)
        return Version(**json.loads(self.pointers.read(number))) if number else Version()

    def read(self, version: Version, table: str) -> DataFrame:
        schema, folders = TABLES[table].schema, version.folders.get(table, [])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def table(self, table: str, number: int | None = None) -> DataFrame:
        return self.read(self.version(number), table)

    def write(self, df: DataFrame, table: str, base: int, fields: list[str] | None = None) -> str:
        """Rows, by position, in a folder of their own that no version names yet."""
        folder = f"{self.location}/rows/{base:012d}-{table}-{uuid.uuid4().hex[:8]}"
        schema = TABLES[table].schema
        positional(df, schema, fields or schema.fieldNames()).write.parquet(folder)
        return folder

    def begin(self) -> "Refresh":
        return Refresh(self, self.version())

    def append(self, df: DataFrame, table: str, batch: str,
               fields: list[str] | None = None) -> bool:
        """Add the rows of ``batch`` once, however often the job is tried (K7, K8 append).

        False if the batch is in the table already.  Other writers may publish at
        the same time; the rows are written once and the commit is tried again.
        """
        folder = None
        while True:
            now = self.version()
            if batch in now.batches.get(table, []):
                return False
            folder = folder or self.write(df, table, now.number, fields)
            grown = Version(now.number + 1,
                            now.folders | {table: [*now.folders.get(table, []), folder]},
                            now.batches | {table: [*now.batches.get(table, []), batch]})
            try:
                self.pointers.commit(grown.number, json.dumps(asdict(grown)))
                return True
            except Conflict:
                continue

    def vacuum(self, keep: int = 2) -> int:
        """Delete row folders that none of the newest ``keep`` versions names; how many.

        Folders of a refresh that is still under way are newer and stay.
        """
        numbers = self.pointers.numbers()
        kept = numbers[-keep:]
        used = {f.rsplit("/", 1)[1] for n in kept for fs in self.version(n).folders.values()
                for f in fs}
        rows = _Pointers(self.spark, f"{self.location}/rows")
        gone = [n for n in rows.names()
                if kept and n not in used and int(n.split("-")[0]) < kept[0] - 1]
        for name in gone:
            rows.delete(name)
        return len(gone)


class Refresh:
    """A next version under construction; nothing is visible before ``publish``."""

    def __init__(self, warehouse: VersionedWarehouse, base: Version):
        self.warehouse, self.base = warehouse, base
        self.loaded: dict[str, str] = {}

    def load(self, df: DataFrame, table: str, fields: list[str] | None = None) -> None:
        """K7/K8 without append: ``df`` becomes the table, by position."""
        self.loaded[table] = self.warehouse.write(df, table, self.base.number, fields)

    def next(self) -> Version:
        """Loaded tables anew (no batch is in them yet), the others as they are."""
        return Version(self.base.number + 1,
                       self.base.folders | {t: [f] for t, f in self.loaded.items()},
                       {t: b for t, b in self.base.batches.items() if t not in self.loaded})

    def table(self, table: str) -> DataFrame:
        """The table as it will be."""
        return self.warehouse.read(self.next(), table)

    def publish(self) -> int:
        """Switch all tables at once.  ``Conflict`` if another version came in between."""
        new = self.next()
        self.warehouse.pointers.commit(new.number, json.dumps(asdict(new)))
        return new.number
