"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its hashed letter n-grams; a linear
softmax over the mean gives the language.  Embeddings and softmax are trained
together by stochastic gradient descent in numpy on the whole texts of at most
about ``TRAINING_ROWS`` different training documents; the tasks count their
n-grams, so a row brings at most 2 ** BUCKET_BITS buckets of six bytes to the
driver, however long its text is.

A fifth of the sample is kept apart to calibrate, as whole texts and as
stretches of any length.  A temperature makes the probability of the language
honest.  Rejection is calibrated on negatives too: stretches whose letters are
shuffled, and texts of languages that a second model, trained without them,
has never seen.  What tells them from clean texts is the support, the logit
that the n-grams alone give the best language: n-grams of no learned language
cancel out or are unknown.  A logistic function of support and length gives
the probability that the text is in a learned language at all.  A text is
rejected below the level that at most ``REJECT_SHARE`` of the clean ones
miss, or below even odds, whichever is lower.

For scoring, embeddings and softmax are multiplied into one table.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import check_sample, distinct_rows, hash_sample, held_out, read_table
from matchlake.llm.hashed import BUCKET_BITS, bag, mean_rows, packed, unpacked, window

TRAINING_ROWS = 8_000  # documented bound of the training sample
UNSEEN_ROWS = 2_000  # of them, at most so many train each model that lacks some languages
UNSEEN_GROUPS = 4  # so many such models at most; languages are dealt among them
CALIBRATION_SHARE = 5  # one text in so many is kept apart
SHORTEST = 12  # characters of the shortest calibration stretch
ORDERS = (2, 4)
DIM = 16
EPOCHS = 4
BATCH = 32
REJECT_SHARE = 0.001
UNKNOWN = "und"

Bag = tuple[np.ndarray, np.ndarray]
TRAIN, WHOLE, STRETCH, SHUFFLED = "twsn"


class Example(NamedTuple):
    """What one text gives: a bag to train on, or bags to calibrate on."""

    lang: str
    kind: str
    letters: int
    bag: Bag


class Model(NamedTuple):
    langs: list[str]
    table: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    usual: float  # support of a usual clean text
    known: np.ndarray  # logistic weights of 1, support, log letters, and their product
    reject: float


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def shuffled(text: str) -> str:
    """The letters of a text in random order over the places of its letters."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    letters = [c for c in text if c.isalpha()]
    rng.shuffle(letters)
    left = iter(letters)
    return "".join(next(left) if c.isalpha() else c for c in text)


def examples(text: str, lang: str) -> list[Example]:
    """One bag of a whole training text; of a text kept apart (by its crc32) the calibration bags.

    A text without letters gives none.
    """
    def made(kind: str, part: str) -> Example:
        return Example(lang, kind, sum(map(str.isalpha, part)), bag(part, True, ORDERS))

    if not any(map(str.isalpha, text)):
        return []
    if zlib.crc32(text.encode("utf-8", "surrogatepass")) % CALIBRATION_SHARE:
        return [made(TRAIN, text)]
    stretch = window(text, SHORTEST, max(SHORTEST, len(text)))
    parts = [(WHOLE, text), (STRETCH, stretch), (SHUFFLED, shuffled(stretch))]
    return [e for e in (made(*p) for p in parts) if e.letters]


def descend(bags: list[Bag], y: np.ndarray, names: int, rng: np.random.Generator
            ) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times softmax weights, and bias, by stochastic gradient descent."""
    e = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    w, b = rng.normal(0, 0.1, (DIM, names)).astype(np.float32), np.zeros(names, np.float32)
    order, steps, done = np.arange(len(bags)), EPOCHS * -(-len(bags) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            sizes = np.array([len(bags[i][0]) for i in pick])
            index = np.concatenate([bags[i][0] for i in pick])
            share = np.concatenate([bags[i][1] for i in pick])[:, None]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            h = np.add.reduceat(e[index] * share, starts, axis=0)
            p = _softmax(h @ w + b)
            p[np.arange(len(pick)), y[pick]] -= 1.0
            rate = np.float32(1.0 - done / steps)
            back = np.repeat((p @ w.T).astype(np.float32), sizes, axis=0) * share
            by = np.argsort(index, kind="stable")
            first = np.flatnonzero(np.diff(index[by], prepend=-1))
            e[index[by][first]] -= 10.0 * rate * np.add.reduceat(back[by], first, axis=0)
            w -= rate * (h.T @ p) / len(pick) * 4
            b -= rate * p.mean(axis=0)
            done += 1
    return (e @ w).astype(np.float32), b.astype(np.float64)


def _raw(table: np.ndarray, found: list[Example]) -> np.ndarray:
    return np.array([e.bag[1] @ table[e.bag[0]] for e in found]).reshape(-1, table.shape[1])


def _terms(support: np.ndarray, letters: np.ndarray) -> np.ndarray:
    size = np.log(np.maximum(1, letters))
    return np.stack([np.ones(len(size)), support, size, support * size], axis=1)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Maximum likelihood with one more wrong answer than seen, so that it is finite."""
    def loss(t: float) -> float:
        p = _softmax(logits / t)
        return float(-np.log(p[np.arange(len(y)), y] + 1e-300).sum()
                     - np.log((1 - p.max(axis=1)).mean() + 1e-300))

    grid = np.geomspace(0.01, 10, 60)
    while True:
        best = int(np.argmin([loss(t) for t in grid]))
        if 0 < best < len(grid) - 1 or not 1e-6 < grid[best] < 1e6:
            return float(grid[best])
        grid = grid * (0.1 if not best else 10)  # the best value stands at an edge


def _fit_known(x: np.ndarray, clean: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method; both kinds weigh the same."""
    weight = np.where(clean, 0.5 / clean.mean(), 0.5 / (1 - clean.mean()))
    target = np.where(clean, (clean.sum() + 1) / (clean.sum() + 2), 1 / ((~clean).sum() + 2))
    v = np.zeros(x.shape[1])
    for _ in range(50):
        p = _logistic(x @ v)
        grade = x.T @ (weight * (target - p)) - ridge * v
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(v))
        step = np.linalg.solve(curve, grade)
        v += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return v


def fit(found: list[Example], seed: int = 0) -> Model:
    """Trains on the whole texts and calibrates on those kept apart, in any order given.

    With fewer than ten texts to calibrate on, nothing but texts without
    letters is rejected.
    """
    found = sorted(found, key=lambda e: (e.lang, e.kind, *(x.tobytes() for x in e.bag)))
    names = sorted({e.lang for e in found})
    nothing = np.zeros(4)
    if not names:
        return Model([], np.zeros((1, 0)), np.zeros(0), 1.0, 1.0, nothing, 0.0)
    own = [e for e in found if e.kind == TRAIN]
    apart = [e for e in found if e.kind in (WHOLE, STRETCH)]
    if sum(e.kind == WHOLE for e in apart) < 10 or {e.lang for e in own} != set(names):
        own, apart = [e for e in found if e.kind in (TRAIN, WHOLE)], []
    at = {g: i for i, g in enumerate(names)}
    rng = np.random.default_rng(seed)
    table, bias = descend([e.bag for e in own], np.array([at[e.lang] for e in own]), len(names), rng)
    model = Model(names, table, bias, 1.0, 1.0, nothing, 0.0)
    if not apart:
        return model
    y = np.array([at[e.lang] for e in apart])
    raw = _raw(table, apart)
    model = model._replace(temperature=_temperature(raw + bias, y))
    usual = max(1e-9, float(np.median(raw.max(axis=1))))
    noise = [e for e in found if e.kind == SHUFFLED]
    clean_support, other = raw.max(axis=1) / usual, [_raw(table, noise).max(axis=1) / usual]
    letters = [np.array([e.letters for e in noise])]
    groups = min(UNSEEN_GROUPS, len(names)) if len(names) > 2 else 0
    for g in range(groups):
        gone = set(names[g::groups])
        rest = [n for n in names if n not in gone]
        part = [e for e in own if e.lang not in gone]
        part = [part[i] for i in rng.permutation(len(part))[:UNSEEN_ROWS]]
        small, _ = descend([e.bag for e in part], np.array([rest.index(e.lang) for e in part]),
                           len(rest), rng)
        unseen = [e for e in apart if e.lang in gone]
        seen = [e for e in apart if e.lang not in gone]
        scale = max(1e-9, float(np.median(_raw(small, seen).max(axis=1))))
        other.append(_raw(small, unseen).max(axis=1) / scale)
        letters.append(np.array([e.letters for e in unseen]))
    x = np.concatenate([_terms(clean_support, np.array([e.letters for e in apart])),
                        *[_terms(s, n) for s, n in zip(other, letters)]])
    clean = np.arange(len(x)) < len(apart)
    known = _fit_known(x, clean)
    right = np.sort(_logistic(x[clean] @ known)[raw.argmax(axis=1) == y])
    level = right[int(REJECT_SHARE * len(right))] if len(right) else 0.0
    return model._replace(usual=usual, known=known, reject=float(min(0.5, level)))


def train(docs: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Learns from text and lang of rows that are not held out; null langs take no part.

    Rows that differ in doc_id, text or lang count as different; equal ones once.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                        & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    row = F.xxhash64("doc_id", "text", "lang")
    total = distinct_rows(known, row)
    sample = hash_sample(known, row, rows, total).select("text", F.col("lang").cast("string"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                found = examples(text.as_py(), lang.as_py())  # a row at a time: texts may be long
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([e.lang for e in found], pa.string()),
                     "kind": pa.array([e.kind for e in found], pa.string()),
                     "letters": pa.array([e.letters for e in found], pa.int64())}
                    | packed([e.bag for e in found]))

    got = sample.mapInArrow(count, "lang string, kind string, letters long, buckets binary, "
                                   "shares binary").toArrow()
    if not got.num_rows:  # texts without a letter give nothing to learn
        check_sample(sample.count(), total, "op7_language_id")
    return fit([Example(g, k, n, unpacked(b, s))
                for g, k, n, b, s in zip(*(c.to_pylist() for c in got.columns))])


class Recognised(NamedTuple):
    lang: str
    score: float  # calibrated probability of the language, given that it is a learned one
    known: float  # probability that it is a learned one


def recognise(text: str | None, model: Model) -> Recognised:
    """Language of a whole text with its probabilities."""
    letters = sum(map(str.isalpha, text or ""))
    if not model.langs or not letters:
        return Recognised(UNKNOWN, 0.0, 0.0)
    raw = mean_rows(model.table, text, True, ORDERS)
    p = _softmax((raw + model.bias)[None, :] / model.temperature)[0]
    best = int(p.argmax())
    x = _terms(np.array([raw.max() / model.usual]), np.array([letters]))
    return Recognised(model.langs[best], float(p[best]), float(_logistic(x @ model.known)[0]))


def language_column(text: Column, model: Model) -> Column:
    """Struct of lang_pred, score and known of a text column."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = [recognise(t.as_py(), model) for t in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([g.lang for g in got], pa.string()),
                 pa.array([g.score for g in got], pa.float64()),
                 pa.array([g.known for g in got], pa.float64())], ["lang_pred", "score", "known"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "lang_pred string, score double, known double")(text)


def predict_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, known, accepted) of every row of (doc_id, text, lang).

    A null text or one without a letter is 'und' with score 0 and not accepted;
    without any training row every document is.  Other documents always get a
    learned language; ``known`` is the probability that it is in a learned one
    at all, and ``accepted`` is false where that is below the rejection level.
    Repeated rows repeat; an empty table gives no rows; other columns are ignored.
    """
    model = model or train(docs)
    found = docs.select("doc_id", language_column(F.col("text"), model).alias("found"))
    accepted = (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.known") >= model.reject)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred",
                        "found.score", "found.known", accepted.alias("accepted"))


def keep_recognised(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with all their columns as they are."""
    model = train(docs)
    found = language_column(F.col("text"), model)
    return docs.filter((found["lang_pred"] != UNKNOWN) & (found["known"] >= model.reject))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(read_table(spark, sf_dir, "documents"))
