"""Quality by weak labels: heuristic labellers, their accuracies by expectation-maximisation,
and a hashed linear scorer trained on the posterior labels.

1. Every document gets the votes of overlapping heuristics: good, bad, in between,
   or abstaining where a heuristic does not apply (too short a text).
2. Only the counts of vote patterns (at most 4 ** labellers rows, a partial
   aggregate) reach the driver.  EM over all documents estimates the share of
   good documents and how each labeller votes on good and on bad ones.
3. The posteriors label a sample of at most about ``TRAINING_ROWS`` documents; a
   logistic scorer over the mean of hashed character n-grams of whole texts
   learns them by stochastic gradient descent and scores every whole text.
   The tasks count the n-grams; a row brings at most 2 ** BUCKET_BITS buckets
   of six bytes to the driver, however long its text is.

No label table is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import check_sample, distinct_rows, hash_sample, read_table
from matchlake.llm.hashed import BUCKET_BITS, bag, mean_rows, packed, unpacked

TRAINING_ROWS = 8_000  # documented bound of the training sample
ORDERS = (2, 3)
EPOCHS = 4
GOOD, BAD, BETWEEN, ABSTAIN = KINDS = "gbm-"

# Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for with on der die das und ist nicht von mit den zu "
    "le la les de et des un une dans pour el los las que en una por con".split())

_SYMBOL_RUN = re.compile(r"[^\w\s]{2,}")


def _vote(bad: bool, good: bool, applies: bool = True) -> str:
    return ABSTAIN if not applies else BAD if bad else GOOD if good else BETWEEN


def votes(text: str | None) -> str:
    """One letter per labeller; a text without words gets bad from the length labeller only."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return BAD + ABSTAIN * 9
    chars = sum(map(len, words))
    distinct = set(words)
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    runs = len(_SYMBOL_RUN.findall(text))
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    repeated = 1 - len(set(lines)) / len(lines)
    known = sum(w in FUNCTION_WORDS for w in map(str.lower, distinct))
    ends = sum(x[-1] in ".!?:;\"'" for x in lines) / len(lines)
    long_words = sum(len(w) > 25 for w in distinct)
    return "".join([
        _vote(n < 4, n >= 20, n < 4 or n >= 20),
        _vote(chars / n < 2.5 or chars / n > 12, 4 <= chars / n <= 7, n >= 10),
        _vote(letters < 0.7 * chars, letters > 0.9 * chars),
        _vote(upper > 0.3 * max(1, letters), upper < 0.06 * max(1, letters), n >= 10),
        _vote(runs > 0.1 * n, runs <= 0.01 * n),
        _vote(repeated > 0.3, repeated == 0, len(lines) > 2),
        _vote(len(distinct) < 0.4 * n, len(distinct) > 0.55 * n, n >= 30),
        _vote(not known, known >= 5, n >= 30),
        _vote(text.count(" | ") > 0.05 * n, " | " not in text),
        _vote(ends < 0.3 or long_words > 0.1 * n, ends > 0.8 and not long_words, n >= 10)])


def votes_column(text: Column) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([votes(t.as_py()) for t in batch], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(text)


class LabelModel(NamedTuple):
    """Share of good documents, and per labeller and vote its probability on bad and good ones.

    Abstaining says nothing about a document, so its column is 1.
    """

    good: float
    table: np.ndarray  # labeller x vote (g, b, m, -) x class (bad, good)

    def posterior(self, pattern: str) -> float:
        at = [KINDS.index(v) for v in pattern]
        odds = np.log(self.good / (1 - self.good))
        for k, v in enumerate(at):
            odds += np.log(self.table[k, v, 1] / self.table[k, v, 0])
        return float(1 / (1 + np.exp(-np.clip(odds, -50, 50))))


def expectation_maximisation(patterns: list[str], counts: np.ndarray, rounds: int = 100,
                             prior: float = 1.0) -> LabelModel:
    """Independent labellers given the class; starts from the majority of the votes."""
    seen = np.array([[KINDS.index(v) for v in p] for p in patterns])
    balance = (seen == 0).sum(axis=1) - 1.5 * (seen == 1).sum(axis=1)
    q = 1 / (1 + np.exp(-np.clip(2.0 * balance, -20, 20)))
    total = counts.sum()
    for _ in range(rounds):
        weight = np.stack([counts * (1 - q), counts * q], axis=1)
        good = (weight[:, 1].sum() + prior) / (total + 2 * prior)
        table = np.full((seen.shape[1], len(KINDS), 2), prior)
        for k in range(seen.shape[1]):
            np.add.at(table[k], seen[:, k], weight)
        table /= table[:, :3].sum(axis=1, keepdims=True)
        table[:, 3] = 1.0
        odds = np.log(good / (1 - good)) + np.log(
            table[np.arange(seen.shape[1]), seen, 1] / table[np.arange(seen.shape[1]), seen, 0]
        ).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return LabelModel(float(good), table)


class Scorer(NamedTuple):
    weights: np.ndarray  # bucket x 1
    base: float

    def score(self, text: str | None) -> float:
        x = mean_rows(self.weights, text or "", False, ORDERS)[0] + self.base
        return float(1 / (1 + np.exp(-np.clip(x, -50, 50))))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, seed: int = 0) -> Scorer:
    """Logistic regression on the n-gram shares of whole texts with soft labels."""
    rng = np.random.default_rng(seed)
    w, base = np.zeros(1 << BUCKET_BITS, np.float64), 0.0
    order, steps, done = np.arange(len(bags)), max(1, EPOCHS * len(bags)), 0
    share = min(0.99, max(0.01, float(target.mean()))) if len(target) else 0.5
    balance = (0.5 / (1 - share), 0.5 / share)  # both classes weigh the same
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for i in order:
            buckets, shares = bags[i]
            p = 1 / (1 + np.exp(-np.clip(w[buckets] @ shares + base, -30, 30)))
            t = target[i]
            step = (t * balance[1] + (1 - t) * balance[0]) * (t - p) * (1 - done / steps)
            w[buckets] += 200.0 * step * shares  # no bucket stands twice in a bag
            base += 0.1 * step
            done += 1
    return Scorer(w[:, None], float(base))


def score_quality(docs: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, votes, posterior, score, predicted) of every row of (doc_id, text).

    Each different text counts once among the about ``rows`` training rows.
    ``posterior`` is the label model's probability that the document is good,
    ``score`` the trained scorer's, ``predicted`` 1 from a score of 0.5.  A null
    text counts as empty; repeated rows repeat; an empty table gives no rows;
    columns beside doc_id and text are ignored.
    """
    base = docs.select("doc_id", "text")
    voted = base.select(votes_column(F.col("text")).alias("votes"))
    found = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    if not found:
        return base.select("doc_id", F.lit("").alias("votes"), F.lit(0.0).alias("posterior"),
                           F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    labels = expectation_maximisation([r.votes for r in found], np.array([r.n for r in found]))
    posterior = {r.votes: labels.posterior(r.votes) for r in found}
    texts = base.select(F.coalesce("text", F.lit("")).alias("text"))
    total = distinct_rows(texts, F.xxhash64("text"))
    sample = hash_sample(texts, F.xxhash64("text"), rows, total)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):  # a row at a time: texts may be long
                text = text.as_py()
                yield pa.RecordBatch.from_pydict(packed([bag(text, False, ORDERS)]) | {
                    "target": pa.array([labels.posterior(votes(text))], pa.float64())})

    got = sample.mapInArrow(count, "buckets binary, shares binary, target double").toArrow()
    check_sample(got.num_rows, total, "op2_quality")
    rows_got = sorted(zip(*(got[c].to_pylist() for c in ("buckets", "shares", "target"))))
    scorer = fit([unpacked(b, s) for b, s, _ in rows_got], np.array([t for _, _, t in rows_got]))

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t.as_py() for t in batch]
            seen = [votes(t) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array(seen, pa.string()),
                 pa.array([posterior[v] if v in posterior else labels.posterior(v) for v in seen],
                          pa.float64()),
                 pa.array([scorer.score(t) for t in texts], pa.float64())],
                ["votes", "posterior", "score"])

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kind = "votes string, posterior double, score double"
    scored = base.select("doc_id", F.arrow_udf(score, kind)("text").alias("q"))
    return scored.select("doc_id", "q.votes", "q.posterior", "q.score",
                         (F.col("q.score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"))
