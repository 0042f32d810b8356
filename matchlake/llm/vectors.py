"""Vector tables for the searches: valid rows, query blocks and candidate shards.

The candidates are shuffled once, into shards.  The queries are written to the shared
folder; the task of a shard reads them block by block and hands on the k best of its
shard for each, so neither side is copied once per part of the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import open_folder, shared_path

QUERY_BLOCK = 4_096  # queries that a task holds at once
SHARD_CELLS = 1 << 20  # components of the candidates of one shard, about (8 MB as doubles)


def finite_vector(name: str) -> tuple[Column, Column]:
    """The vector as doubles, and whether it is not null and has only finite components."""
    vec = F.col(name).cast("array<double>")
    return vec, vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vec) of rows whose vector is not null and has only finite components."""
    vec, finite = finite_vector("embedding")
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")) \
        .filter(F.col("vec_id").isNotNull() & finite)


def matrix(vectors: pd.Series, width: int = 0) -> np.ndarray:
    """Rows as a float64 matrix; shorter vectors are filled up with zeros."""
    width = max([width, *map(len, vectors)])
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def dealt(count: int, size: int, *key: Column) -> Column:
    """Which of ceil(count / size) parts a row goes to."""
    return F.pmod(F.xxhash64(*key), F.lit(max(1, -(-count // size)))).cast("int")


def shard_size(width: int) -> int:
    """Candidates of one shard, about."""
    return max(1, SHARD_CELLS // max(1, width))


def write_queries(queries: DataFrame, label: str, by: str | None = None) -> str:
    """(vec_id, vec) written to the shared folder, in folders of ``by`` if given."""
    path = shared_path(queries.sparkSession, label)
    open_folder(path)  # refuses a folder that tasks could not read, before any work
    (queries.write.partitionBy(by) if by else queries.write).parquet(path)
    return path


def query_blocks(path: str, width: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the written queries, at most ``rows`` at once; none if there is no folder."""
    system, folder = open_folder(path)
    for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.base_name.endswith(".parquet"):
            with system.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(rows, columns=["vec_id", "vec"]):
                    asked = batch.to_pandas()
                    if len(asked):
                        yield asked["vec_id"].to_numpy(np.int64), matrix(asked["vec"], width)


def merge_top(found: DataFrame, k: int) -> DataFrame:
    """The k best of (query_id, vec_id, score) of every query, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
