"""Approximate nearest neighbours by learned partitions.

1. On a sample of about ``SAMPLE_ROWS`` vectors (the documented bound of the
   training data) the graph of nearest neighbours is cut into balanced parts
   of few crossing edges by repeated streaming: a vertex moves to the part with
   most of its neighbours, weighed by the room left there.
2. A small classifier (one hidden layer, numpy) learns the parts.  It gives
   every row of the table its partition.
3. It routes a query to its most probable partitions.  How many is calibrated
   on other rows: the smallest number that finds ``RECALL`` of their true
   neighbours within the sample; partitions are added while they hold too few
   candidates.
4. All candidates of those partitions are ranked by exact cosine.  They are
   shuffled once, into shards of bounded size within the partitions; the queries
   are written to a folder per partition, and the task of a shard reads those of
   its partition block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import check_sample, distinct_rows, hash_sample, read_table
from matchlake.llm.vectors import (QUERY_BLOCK, matrix, merge_top, query_blocks, shard_size,
                                   valid_vectors, write_queries)

SAMPLE_ROWS = 5_000
PARTITIONS = 16
NEIGHBOURS = 10
HIDDEN = 64
EPOCHS = 25
RECALL = 0.95  # aimed at on the calibration rows
LEAST_CANDIDATES = 50  # per result, in the partitions of a query
TOP = 5
EVERY = 50
ASK_ROWS = 64  # queries compared with a shard at once


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(x: np.ndarray, to: np.ndarray, k: int, same: bool) -> np.ndarray:
    """Rows of ``to`` nearest to each row of x, without itself."""
    out = []
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ to.T
        if same:
            s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        out.append(np.argsort(-s, axis=1, kind="stable")[:, :k])
    return np.concatenate(out)


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator,
                   passes: int = 10, slack: float = 1.05) -> np.ndarray:
    """A part for every vertex: many neighbours together, sizes within ``slack`` of equal."""
    n = len(graph)
    room = max(1, int(np.ceil(slack * n / parts)))
    both = [[] for _ in range(n)]
    for v, row in enumerate(graph.tolist()):
        for u in row:
            both[v].append(u)
            both[u].append(v)
    label, size = np.full(n, -1), np.zeros(parts)
    for _ in range(passes):
        for v in rng.permutation(n).tolist():
            if label[v] >= 0:
                size[label[v]] -= 1
            near = label[both[v]]
            count = np.bincount(near[near >= 0], minlength=parts) + 1e-3
            worth = np.where(size < room, count * (1 - size / (room + 1)), -1.0)
            label[v] = int(worth.argmax())
            size[label[v]] += 1
    return label


class Router(NamedTuple):
    """The classifier, and how many partitions a query is sent to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def order(self, x: np.ndarray) -> np.ndarray:
        """Partitions of each row, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def train_router(x: np.ndarray, label: np.ndarray, parts: int, rng: np.random.Generator) -> Router:
    """Softmax classifier with one hidden layer, by stochastic gradients with momentum (Adam)."""
    d = x.shape[1]
    p = [rng.normal(0, np.sqrt(2 / max(1, d)), (d, HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    steps = EPOCHS * -(-len(x) // 64)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            pick = order[at:at + 64]
            h = np.maximum(x[pick] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(pick)), label[pick]] -= 1
            z /= len(pick)
            back = (z @ p[2].T) * (h > 0)
            grads = [x[pick].T @ back, back.sum(axis=0), h.T @ z, z.sum(axis=0)]
            t += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= (0.01 * (1 - t / (steps + 1)) * (first[k] / (1 - 0.9**t))
                         / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8))
    return Router(*p, parts)


def fit(sample: np.ndarray, others: np.ndarray, parts: int = PARTITIONS, k: int = TOP,
        recall: float = RECALL, seed: int = 0) -> Router:
    """Partitions the sample's graph, learns it, and calibrates the probes on the other rows."""
    rng = np.random.default_rng(seed)
    sample = unit(sample)
    parts = max(1, min(parts, len(sample) // (4 * NEIGHBOURS)))
    graph = nearest(sample, sample, min(NEIGHBOURS, max(1, len(sample) - 1)), True)
    router = train_router(sample, balanced_parts(graph, parts, rng), parts, rng)
    if not len(others):
        return router
    asked = unit(others)
    place = router.order(sample)[:, 0]
    rank = np.argsort(router.order(asked), axis=1)  # of each partition, per row
    true = nearest(asked, sample, min(k, len(sample)), False)
    needed = np.sort(np.take_along_axis(rank, place[true], axis=1).ravel()) + 1
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])
    return router._replace(probes=probes)


def _partition_column(vec: Column, router: Router, width: int) -> Column:
    def run(batch: pd.Series) -> pd.Series:
        x = matrix(batch, width)
        return pd.Series(router.order(unit(x[:, :width]))[:, 0].astype(np.int32))

    run.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "int")(vec)


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with rows, summed in the order of the dimensions in every case."""
    big, bigs = np.abs(q).max(), np.abs(x).max(axis=1)
    q, x = q / big, x / bigs[:, None]
    dot, own, others = np.zeros(len(x)), 0.0, np.zeros(len(x))
    for d in range(len(q)):
        dot += q[d] * x[:, d]
        own += q[d] * q[d]
        others += x[:, d] * x[:, d]
    return dot / (np.sqrt(own) * np.sqrt(others))


def nearest_in_shard(asked: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray,
                     units: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest candidates (``ids``, ``x``, and ``units`` of length one) of one shard for
    every query of one block."""
    found, scores, counts = [np.zeros(0, np.int64)], [np.zeros(0)], []
    for at in range(0, len(q), ASK_ROWS):
        near = unit(q[at:at + ASK_ROWS]) @ units.T
        for row, vector, query_id in zip(near, q[at:at + ASK_ROWS],
                                         asked[at:at + ASK_ROWS].tolist()):
            other = ids != query_id
            few = min(k, int(other.sum()))
            counts.append(few)
            if not few:
                continue
            row[~other] = -np.inf
            level = np.partition(row, len(row) - few)[len(row) - few]
            close = np.flatnonzero((row >= level - 1e-9) & other)
            score = cosine(vector, x[close])
            best = np.lexsort((ids[close], -score))[:few]
            found.append(ids[close[best]])
            scores.append(score[best])
    return pd.DataFrame({"query_id": np.repeat(asked, counts), "vec_id": np.concatenate(found),
                         "score": np.concatenate(scores)})


def search(table: DataFrame, every: int = EVERY, k: int = TOP, parts: int = PARTITIONS,
           sample_rows: int = SAMPLE_ROWS, query_block: int = QUERY_BLOCK,
           shard_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for every query, a row whose vec_id is divisible by ``every``.

    Rows with a null id, or a vector that is null, empty, zero or holds a null
    or non-finite component, take no part.  Shorter vectors are filled up with
    zeros.  A repeated query row is answered once; repeated candidates are
    candidates each.  All rows with the query's id count as its own.  Different
    vectors of one query id are one query: its best answers are those of any of its
    vectors, a candidate once for each.  Fewer candidates than k: all of them; an
    empty table gives no rows; other columns are ignored.
    """
    rows = valid_vectors(table).filter(F.exists("vec", lambda v: v != 0))
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0.0).alias("score")).limit(0)
    vectors = rows.select("vec")
    different = distinct_rows(vectors, F.xxhash64("vec"))
    taken = hash_sample(vectors, F.xxhash64("vec"), sample_rows, different).orderBy("vec").toPandas()
    check_sample(len(taken), n, "op5_learned_ann")
    sample = matrix(taken["vec"], width)
    apart = np.arange(len(sample)) % 10 == 0 if len(sample) >= 200 else np.zeros(len(sample), bool)
    router = fit(sample[~apart], sample[apart], parts, k)

    placed = rows.withColumn("part", _partition_column(F.col("vec"), router, width))
    sizes = np.zeros(router.b2.shape[0], np.int64)
    for r in placed.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]
    shards = np.maximum(1, -(-sizes // (shard_rows or shard_size(width))))
    shards_of = F.array(*(F.lit(int(s)) for s in shards))

    def route(batch: pd.Series) -> pd.Series:
        order = router.order(unit(matrix(batch, width)))
        held = np.cumsum(sizes[order], axis=1)
        enough = (held < LEAST_CANDIDATES * k).sum(axis=1) + 1
        return pd.Series([o[:max(router.probes, e)].tolist() for o, e in zip(order, enough)])

    route.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    queries = rows.filter(F.col("vec_id") % every == 0).distinct()
    path = write_queries(queries.withColumn("part", F.explode(F.pandas_udf(route, "array<int>")("vec"))),
                         "ann-queries", by="part")
    salt = F.xxhash64("vec_id", F.monotonically_increasing_id())
    dealt_out = placed.withColumn(
        "shard", F.pmod(salt, F.element_at(shards_of, F.col("part") + 1)).cast("int"))

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(batches), ignore_index=True)
        ids, x = held["vec_id"].to_numpy(np.int64), matrix(held["vec"], width)
        del held
        units = unit(x)
        for asked, q in query_blocks(f"{path}/part={key[0]}", width, query_block):
            yield nearest_in_shard(asked, q, ids, x, units, k)

    found = dealt_out.groupBy("part", "shard").applyInPandas(
        run, "query_id long, vec_id long, score double")
    return merge_top(found, k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))
