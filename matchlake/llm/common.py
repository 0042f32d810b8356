"""Shared helpers of the text and vector operators: inputs, saved tables, code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from matchlake.session import work_dir

PACKAGE_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the folder may be a URI that only Spark can read."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_matchlake_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="matchlake-zip-"), "matchlake_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(PACKAGE_DIR):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(PACKAGE_DIR)))
    sc.addPyFile(target)
    sc._matchlake_shipped = True


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder, which a cluster must name."""
    return work_dir(spark, label)


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a folder given as a path or a URI.

    Hadoop's names of the S3 connector mean the same store; a scheme that pyarrow does
    not know is refused.
    """
    for scheme in ("s3a:", "s3n:"):
        if path.startswith(scheme):
            path = "s3:" + path[len(scheme):]
    if path.startswith("file:/"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def save(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 1 modulo 3 (a null id counts as '')."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text) % 3 == 1


def arrow_schema(schema: T.StructType) -> pa.Schema:
    """The Arrow schema that mapInArrow must produce for a Spark schema."""
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])


def distinct_rows(df: DataFrame, key: Column) -> int:
    """About how many different keys a table has (2 %), from sketches that need no shuffle of rows."""
    return df.agg(F.approx_count_distinct(key, 0.02)).first()[0]


def hash_sample(df: DataFrame, key: Column, rows: int, total: int, seed: int = 11) -> DataFrame:
    """About ``rows`` different rows of ``total``, chosen by a hash of the key: deterministic, no sort.

    The key should hash all that tells rows apart, and ``total`` count its
    values (``distinct_rows``).  Equal rows are taken once, so an id or a text
    that fills a third of the table brings no more rows than any other, and
    the result does not depend on how the table is dealt out.  The bound is
    the documented size of a training sample; nothing else is sampled.
    """
    if total > rows:
        # The share of the whole signed 64-bit range, so it holds for any total.
        limit = (rows << 64) // total - (1 << 63)
        df = df.filter(F.xxhash64(key.cast("string"), F.lit(seed)) < F.lit(limit))
    return df.distinct()


def check_sample(taken: int, total: int, what: str) -> None:
    """Training on nothing would give results without a meaning, so it fails."""
    if total and not taken:
        raise ValueError(f"no training row of {what} was sampled out of {total}")
