"""One large delimited file, read by many tasks, with line breaks in its cells.

A reader that allows line breaks in cells reads a file in one task, because nobody in
the middle of a file can tell a line break inside quotes from one at the end of a
record.  The number of quotes before a line tells: it is odd inside a cell.  So

1. every split of the file (a range that one task reads) counts its quotes;
2. prefix sums over the splits of a file, a row per split, say whether a split begins
   inside a cell;
3. every split joins its lines to records, in order and without a shuffle;
4. a record that crosses the end of a split leaves a piece there and pieces in the
   splits after; these few rows are brought together by a window over the splits.

Records go to Spark's own ``from_csv``.  The file is read three times: for quotes (on
the JVM), for the pieces at the ends, and for the records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.rules import quote_name
from matchlake.sources.csv import EXTRACT, Dialect, apply_load_rules, text_schema

WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of one begun before; the beginning of one


def _lines(spark: SparkSession, path: str | list[str], dialect: Dialect) -> DataFrame:
    """(file, split, value, quotes) of every line, in order within a split."""
    if dialect.escape != dialect.quote or dialect.encoding.upper() != "UTF-8":
        raise ValueError("only doubled quotes in UTF-8 text can be counted")
    value, quote = F.col("value"), F.lit(dialect.quote)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), value,
        (F.length(value) - F.length(F.replace(value, quote, F.lit("")))).alias("quotes"))


def open_splits(lines: DataFrame) -> DataFrame:
    """(file, split): the splits that begin inside a cell; at most a row per split."""
    parity = lines.groupBy("file", "split").agg((F.sum("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1)
    return (parity.withColumn("before", F.sum("odd").over(before))
            .where(F.col("before") % 2 == 1).select("file", "split"))


def _records(lines: DataFrame, inside: set[tuple[str, int]], header: bool,
             ends_only: bool) -> DataFrame:
    """(file, split, kind, record) of the joined lines; whole records, or the pieces only.

    A header is one line, so it is the first record of the first split.
    """
    names = ["file", "split", "kind", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, is_open, is_header = None, False, False
        first = WHOLE  # what the next record to end is: the end of one begun before, or whole
        held: list[str] = []
        out: list[tuple[str, int, int, str]] = []

        def give(kind: int) -> None:
            if held and (kind != WHOLE) == ends_only:
                out.append((*at, kind, "\n".join(held)))
            held.clear()

        def batch_out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            return got

        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for file, split, value, quotes in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, split) != at:
                    give(HEAD if first == HEAD else TAIL)  # the split ended inside a cell
                    at, is_open = (file, split), (file, split) in inside
                    first, is_header = HEAD if is_open else WHOLE, header and split == 0
                held.append(value)
                is_open ^= bool(quotes % 2)
                if not is_open:
                    if is_header:
                        held.clear()
                    give(first)
                    first, is_header = WHOLE, False
            if out:
                yield batch_out()
        give(HEAD if first == HEAD else TAIL)
        if out:
            yield batch_out()

    return lines.mapInArrow(run, "file string, split long, kind long, record string")


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Records that cross splits: a beginning and all pieces up to the next beginning."""
    order = Window.partitionBy("file").orderBy("split", "kind")
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("split", "kind", "record")))
    return numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))


def read_split_records(spark: SparkSession, path: str | list[str],
                       dialect: Dialect = EXTRACT) -> DataFrame:
    """(record) of every record of the files, headers and empty lines left out."""
    lines = _lines(spark, path, dialect)
    # Like the file listing, this holds a row per split on the driver, never a line.
    inside = {(r.file, r.split) for r in open_splits(lines).collect()}
    whole, pieces = (_records(lines, inside, dialect.header, ends) for ends in (False, True))
    records = whole.select("record").unionByName(_joined_pieces(pieces).select("record"))
    return records.select(F.regexp_replace("record", "\r$", "").alias("record")) \
        .where(F.col("record") != "")


def read_split_staged(spark: SparkSession, path: str | list[str], schema: T.StructType,
                      dialect: Dialect = EXTRACT,
                      text_lengths: dict[str, int] | None = None) -> DataFrame:
    """``read_staged`` for files too large for one task each."""
    options = {k: v for k, v in dialect.options().items() if k not in ("header", "encoding")}
    names = ", ".join(f"{quote_name(f.name)} string" for f in text_schema(schema).fields)
    cells = F.from_csv("record", names, options | {"mode": "FAILFAST"}).alias("cells")
    raw = read_split_records(spark, path, dialect).select(cells).select("cells.*")
    return apply_load_rules(raw, schema, text_lengths)
