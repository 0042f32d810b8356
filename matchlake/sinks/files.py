"""File sinks (K1-K4, K10, D4).  All distributed writes; nothing is collected.

Spark writes a dataset as a folder of part files committed by its output
committer, so a lost executor's task is simply rerun and a failed job leaves
no half-written result behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.sources.csv import EXTRACT, INDEX_COLUMN, NOTEBOOK, Dialect


FILE_BYTES = 32 << 20


def delimited_files(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` the rows of ``df`` fill as delimited text (one
    aggregate over the lengths of its text cells).

    A reader that allows line breaks in cells gives a file to one task, and a task writes
    one file; so rows that widen a lot on the way from a small source are dealt to this
    many tasks first: ``widen(source.repartition(delimited_files(widen(source))))``.
    """
    cell = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")).cast("bigint"), F.lit(0))
            for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    other = 20 * len(df.columns)  # separators, and numbers at their longest
    size = df.agg(F.sum(sum(cell, F.lit(other).cast("bigint")))).first()[0] or 0
    return max(1, -(-size // file_bytes))


def write_delimited(df: DataFrame, path: str, dialect: Dialect = EXTRACT,
                    mode: str = "overwrite") -> None:
    """K1: ';' text with a header and no index.  A NULL is written as an empty
    cell, an empty string as "" (both load back as NULL)."""
    df.write.mode(mode).options(**dialect.options()).csv(path)


def write_indexed(df: DataFrame, path: str, order_by: str | list[str] = "id",
                  dialect: Dialect = NOTEBOOK, mode: str = "overwrite",
                  index: DataFrame | None = None) -> None:
    """K2: ',' text with a leading row index counted from 0 in ``order_by`` order.

    Pass an already indexed frame as ``index`` (column ``_index``) to keep an
    index numbered before rows were dropped: it then keeps its gaps.
    """
    from matchlake.operators.indexing import with_row_index

    indexed = index if index is not None else with_row_index(df, order_by, INDEX_COLUMN)
    cols = [INDEX_COLUMN] + [c for c in indexed.columns if c != INDEX_COLUMN]
    indexed.select(*cols).write.mode(mode).options(**dialect.options()).csv(path)


def _clustered(df: DataFrame, partition_by: list[str] | None, cluster: bool) -> DataFrame:
    """With ``cluster``, rows of one partition folder go to one task, so each
    folder gets one file instead of one per task.  Meant for aggregated
    outputs, whose folders are bounded in size; a raw fact table keeps its
    own partitioning (a hot folder would otherwise land on one task)."""
    return df.repartition(*partition_by) if cluster and partition_by else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, cluster: bool = False) -> None:
    """Parquet, optionally laid out in folders per partition value
    (``season=2008%2F2009/``) so filters on those columns prune whole folders."""
    w = _clustered(df, partition_by, cluster).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str],
                         cluster: bool = False) -> None:
    """Replace only the partitions present in ``df``; all others stay.

    Dynamic partition overwrite, set on this write only (the session setting
    is left alone).
    """
    (_clustered(df, partition_by, cluster).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by)
     .parquet(path))
