"""Exact top-k by inner product of integer vectors with MaxScore.

A dimension is a term, its posting the column of that dimension in a shard of
candidates.  For one query a term can add at most ``gain`` above its smallest
contribution in the shard.  Terms are taken by falling gain.  A few candidates
that are best in the strongest term give a first threshold; the terms whose
gains together cannot lift a candidate from the base to the threshold are not
essential.  Essential postings are traversed whole; the others are probed only
for candidates that can still reach the threshold.  A task takes its candidates
in slices, and the k-th score of the earlier slices raises the threshold of the
later ones.  Shards are merged by a window.

The candidates are shuffled once, into shards; each task reads the written queries
block by block, so it holds no more than a block and a shard, whatever the size of
the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import read_table
from matchlake.llm.vectors import (QUERY_BLOCK, dealt, matrix, merge_top, query_blocks,
                                   shard_size, valid_vectors, write_queries)

SCALE = 1024
TOP = 10
EVERY = 100
LONG = 2**63
SLICE = 8_192  # candidates with postings of their own


class Shard:
    """Postings of one slice of a shard, candidates in order of vec_id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(np.floor(SCALE * rows[order]).T)
        self.low = self.postings.min(axis=1)
        self.high = self.postings.max(axis=1)
        self.largest = np.abs(self.postings).max(axis=1)

    def top(self, query_id: int, vector: np.ndarray, k: int,
            floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates with another id, best first; those below
        ``floor`` may be left out."""
        q = np.floor(SCALE * vector)
        if float(np.abs(q) @ self.largest) >= 2**53:
            return self._wide(query_id, q, k)
        first, second = q * self.low, q * self.high
        least, most = np.minimum(first, second), np.maximum(first, second)
        gain = most - least
        order = np.argsort(-gain, kind="stable")
        other = self.ids != query_id
        count = int(other.sum())
        threshold = floor
        if count > k:
            strongest = q[order[0]] * self.postings[order[0]]
            seeds = np.argpartition(-strongest, min(4 * k, len(strongest) - 1))[:4 * k]
            seeds = seeds[other[seeds]]
            if len(seeds) >= k:
                threshold = max(floor, np.sort(q @ self.postings[:, seeds])[-k])
        reach = least.sum() + np.append(np.cumsum(gain[order][::-1])[::-1], 0.0)
        essential = max(1, int(np.argmax(reach < threshold))) if (reach < threshold).any() \
            else len(order)
        score = np.zeros(len(self.ids))
        for d in order[:essential]:
            score += q[d] * self.postings[d]
        rest = most[order[essential:]].sum()
        alive = np.flatnonzero(other & (score + rest >= threshold))
        score = score[alive]
        for d in order[essential:]:
            if not len(alive):
                break
            score += q[d] * self.postings[d][alive]
            rest -= most[d]
            competitive = score + rest >= threshold
            if not competitive.all():
                alive, score = alive[competitive], score[competitive]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive[best]], score[best].astype(np.int64)

    def _wide(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Components beyond exact doubles: whole-number arithmetic, scores kept within a long."""
        whole = [int(x) for x in q]
        scores = [(max(-LONG, min(LONG - 1, sum(a * int(b) for a, b in zip(whole, column)))), i)
                  for i, column in zip(self.ids.tolist(), self.postings.T) if i != query_id]
        best = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
        return (np.array([i for _, i in best], np.int64), np.array([s for s, _ in best], np.int64))


def best_of_slices(slices: list[Shard], query_id: int, vector: np.ndarray,
                   k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates of all slices, best first."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in slices:
        floor = float(scores[-1]) if len(scores) == k else -np.inf
        found, score = part.top(query_id, vector, k, floor)
        ids, scores = np.append(ids, found), np.append(scores, score)
        best = np.lexsort((ids, ~scores))[:k]  # falls as the score grows, and cannot overflow
        ids, scores = ids[best], scores[best]
    return ids, scores


def search(table: DataFrame, every: int = EVERY, k: int = TOP, query_block: int = QUERY_BLOCK,
           shard_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for every query, a row whose vec_id is divisible by ``every``.

    Rows with a null id or vector or a null or non-finite component take no
    part.  Shorter vectors are filled up with zeros.  A repeated query row is
    answered once; repeated candidates are candidates each.  All rows with the
    query's id count as its own.  Different vectors of one query id are one query:
    its best answers are those of any of its vectors, a candidate once for each.
    Fewer candidates than k: all of them; an empty table gives no rows; other columns
    are ignored.
    """
    rows = valid_vectors(table)
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    path = write_queries(rows.filter(F.col("vec_id") % every == 0).distinct(), "maxscore-queries")
    shard = dealt(n, shard_rows or shard_size(width), F.col("vec_id"),
                  F.monotonically_increasing_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(batches), ignore_index=True)
        slices = []
        for at in range(0, len(held), SLICE):
            few = held.iloc[at:at + SLICE]
            slices.append(Shard(few["vec_id"].to_numpy(np.int64), matrix(few["vec"], width)))
        del held
        for asked, vectors in query_blocks(path, width, query_block):
            out = [(i, best_of_slices(slices, i, vector, k))
                   for i, vector in zip(asked.tolist(), vectors)]
            yield pd.DataFrame({
                "query_id": np.repeat(asked, [len(found) for _, (found, _) in out]),
                "vec_id": np.concatenate([found for _, (found, _) in out]),
                "score": np.concatenate([score for _, (_, score) in out])})

    found = rows.groupBy(shard.alias("shard")).applyInPandas(
        run, "query_id long, vec_id long, score long")
    return merge_top(found, k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
