"""Toxicity by noisy-channel deobfuscation.

1. A character language model (4-grams over letters, word borders and a few
   classes) is counted over all documents, whole texts, in numpy per Arrow
   batch; only the bounded table of counts leaves a task.
2. Suspicious spans (letters mixed with look-alike digits or symbols, single
   letters with separators between them, letters repeated three times or more)
   are found by vector operations on the whole text, and so are runs of short
   groups with any separators between them and words with doubled letters, where
   the language model finds them unlikely.  Each becomes a lattice:
   a symbol may stand for itself or for the letters it looks like, a separator
   may be dropped, a run may be shortened.  Viterbi decoding under the language
   model and the channel's costs gives the best restorations.
3. Words and word beginnings of restored texts that mark toxic training
   documents form a lexicon; each weighs -log(1 - share of toxic documents
   among those with it), the share being a lower confidence bound.  A document
   counts with its best word and a part of the next ones, so many weak words do
   not add up to a sure one.  Logistic calibration on the half of the sample
   that a lexicon of the other half has not seen makes it a probability.
   Learning uses a sample of at most about ``TRAINING_ROWS`` labelled training
   rows.

Scores come from the text alone.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import check_sample, distinct_rows, hash_sample, held_out, read_table, save

TRAINING_ROWS = 16_000  # documented bound of the labelled training sample
THRESHOLD = 0.7
ORDER = 4
SYMBOLS = 32  # 0-25 letters, 26 other letter, 27 digit, 28 word border, 29 other symbol
OTHER, DIGIT, BORDER, SYMBOL = 26, 27, 28, 29
BEST = 3  # restorations kept per span
WORD_STARTS = (3, 4, 5, 6, 8)  # lengths of word beginnings used as features
SURE = 1.3  # standard errors below the seen share of toxic documents that a feature keeps
LEAST_RATE = 0.65  # of that lower bound: four sightings, all of them toxic
FEW_TOXIC, FEW_RATE = 100, 0.5  # with fewer toxic training documents two sightings must do
TOP_WORDS, REST = 3, 0.25  # words of a document that count, and the weight of all but the best

# Characters and the letters they are written for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
              "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
              "£": "l", "¡": "i"}
WEAK = "!|+¡"  # look-alikes that are punctuation when no letter follows
SEPARATORS = " .-_*·~"

GROUP = 4  # runs of equal characters in a short group
UNLIKELY = math.log(SYMBOLS)  # mean cost of a symbol above which even chance does better

COST_SWAP, COST_DROP, COST_RUN, COST_KEEP_SYMBOL = 1.0, 0.5, 1.0, 3.0

_WORD = re.compile(r"[^\W\d_]+")


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: language-model symbol, and kind (1 letter, 2 look-alike,
    4 separator of the plain spacing, 8 look-alike also at a word end, 16 any separator)."""
    symbol = np.full(0x110000, BORDER, np.uint8)
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            symbol[c] = ord(low) - 97 if len(low) == 1 and "a" <= low <= "z" else OTHER
            kind[c] = 1
        elif ch.isdigit():
            symbol[c] = DIGIT
        elif not ch.isspace():
            symbol[c] = SYMBOL
        if not ch.isalnum() and ch not in LOOKALIKES and (
                ch.isspace() or unicodedata.category(ch)[0] in "PSZ"
                or unicodedata.category(ch) == "Cf"):
            kind[c] |= 16
    for ch in LOOKALIKES:
        kind[ord(ch)] |= 2 if ch in WEAK else 2 | 8
    for ch in SEPARATORS:
        kind[ord(ch)] |= 4
    return symbol, kind


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Index of the ORDER-gram that ends at each symbol; three borders stand before."""
    s = np.concatenate([np.full(ORDER - 1, BORDER, np.int64), symbols])
    out = np.zeros(len(symbols), np.int64)
    for k in range(ORDER):
        out = out * SYMBOLS + s[k:k + len(symbols)]
    return out


def count_grams(docs: DataFrame) -> np.ndarray:
    """4-gram counts of all texts; at most SYMBOLS ** ORDER numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, _ = _tables()
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text := text.as_py():
                    at = _grams(symbol[_codes(text)])
                    if len(at) > 100_000:
                        total += np.bincount(at, minlength=len(total))
                    else:
                        index, n = np.unique(at, return_counts=True)
                        total[index] += n
        index = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(index.astype(np.int32), pa.int32()),
                                          "n": pa.array(total[index], pa.int64())})

    rows = (docs.select("text").mapInArrow(run, "gram int, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros(SYMBOLS ** ORDER, np.int64)
    total[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return total


def language_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Negative log probability of a symbol after three others, backing off to shorter contexts."""
    cube = counts.reshape((SYMBOLS,) * ORDER).astype(np.float64)
    p = (cube.sum(axis=(0, 1, 2)) + 1.0)
    p /= p.sum()
    for axes in ((0, 1), (0,), ()):
        n = cube.sum(axis=axes) if axes else cube
        p = (n + weight * p) / (n.sum(axis=-1, keepdims=True) + weight)
    return -np.log(p).astype(np.float32).reshape(-1)


def options(ch: str, count: int, gaps: bool = False) -> list[tuple[str, float]]:
    """What a run of one character may stand for, with the channel's cost; with ``gaps``
    a separator may as well be one."""
    out = []
    separator = bool(_tables()[1][ord(ch)] & 20)
    free = ch.isalpha() or (gaps and separator)
    for c, cost in [(ch, 0.0 if free else COST_KEEP_SYMBOL * count),
                    *((c, COST_SWAP) for c in LOOKALIKES.get(ch, ""))]:
        out.append((c * count, cost * (1 if ch.isalpha() else max(1, count / 2))))
        if count > 1 and c.isalpha():  # a double letter is mostly meant
            out.append((c, cost + COST_RUN * (2.5 if count == 2 else 1)))
        if count > 2 and c.isalpha():
            out.append((c * 2, cost + COST_RUN))
    if separator:
        out.append(("", COST_DROP))
    return out


class Path(NamedTuple):
    """A way through the lattice: its cost, a hash of its text, its last piece and the way before."""

    cost: float
    key: int
    piece: str
    before: "Path | None"

    def text(self) -> str:
        pieces, at = [], self
        while at is not None:
            pieces.append(at.piece)
            at = at.before
        return "".join(reversed(pieces))


class Piece(NamedTuple):
    """What a run of one character may stand for."""

    text: str
    cost: float
    symbols: tuple[int, ...]
    shift: int  # of the hash of what stands before
    key: int


_KEY_BASE, _KEY_PRIME = 0x1F3D5B799B7D5F31, 2 ** 127 - 1
# (cost, order found, the way so far, the next piece): ties never compare further than the order
Candidate = tuple[float, int, Path, Piece]


def _pieces(run: str, gaps: bool) -> list[Piece]:
    symbol, out = _tables()[0], []
    for text, cost in options(run[0], len(run), gaps):
        key = 0
        for c in text:
            key = (key * _KEY_BASE + ord(c)) % _KEY_PRIME
        out.append(Piece(text, cost, tuple(int(symbol[ord(c)]) for c in text),
                         pow(_KEY_BASE, len(text), _KEY_PRIME), key))
    return out


def _cheapest(found: list[Candidate], best: int) -> list[Path]:
    """The cheapest paths with different texts; of equal costs the one found first."""
    found.sort()
    kept: dict[int, Path] = {}
    for cost, _, path, piece in found:
        key = (path.key * piece.shift + piece.key) % _KEY_PRIME
        if key not in kept:
            kept[key] = Path(cost, key, piece.text, path)
            if len(kept) == best:
                break
    return list(kept.values())


def decode(span: str, model: np.ndarray, best: int = BEST, gaps: bool = False) -> list[str]:
    """The ``best`` restorations of a lower-cased span, cheapest first.

    Paths share their beginnings, so a step costs the same at any length; texts
    are read out once, at the end.
    """
    mask = SYMBOLS ** (ORDER - 1)
    start = (BORDER * SYMBOLS + BORDER) * SYMBOLS + BORDER
    states: dict[int, list[Path]] = {start: [Path(0.0, 0, "", None)]}
    pieces: dict[str, list[Piece]] = {}
    steps: dict[tuple[int, tuple[int, ...]], tuple[int, float]] = {}

    def step(state: int, symbols: tuple[int, ...]) -> tuple[int, float]:
        cost = 0.0
        for c in symbols:
            at = state * SYMBOLS + c
            cost += float(model[at])
            state = at % mask
        return state, cost

    for run in re.finditer(r"(.)\1*", span, re.S):
        ways = pieces.get(run.group())
        if ways is None:
            ways = pieces[run.group()] = _pieces(run.group(), gaps)
        after: dict[int, list[Candidate]] = {}
        order = 0
        for state, paths in states.items():
            for piece in ways:
                known = steps.get((state, piece.symbols))
                if known is None:
                    known = steps[state, piece.symbols] = step(state, piece.symbols)
                end, spent = known
                into = after.setdefault(end, [])
                for p in paths:
                    order += 1
                    into.append((p.cost + piece.cost + spent, order, p, piece))
        # k-best Viterbi: of the paths that meet in a state only the cheapest go on
        states = {s: _cheapest(found, best) for s, found in after.items()}
    nothing = Piece("", 0.0, (), 1, 0)
    ends = [(p.cost + step(state, (BORDER,))[1], i, p, nothing)
            for i, (state, p) in enumerate((s, p) for s, paths in states.items() for p in paths)]
    return [text for _, text in sorted((p.cost, p.text()) for p in _cheapest(ends, best))]


def suspicious_spans(text: str) -> list[tuple[int, int]]:
    """Disjoint places to decode, found by vector operations over the whole lower-cased text."""
    codes = _codes(text)
    n = len(codes)
    if n < 3:
        return []
    kinds = _tables()[1][codes]
    letter, alike, strong, sep = (kinds & bit > 0 for bit in (1, 2, 8, 4))
    glyph = letter | alike
    spaced = []
    if n > 4:  # a lone glyph, separator, glyph, same separator, glyph
        first = (glyph[:-4] & sep[1:-3] & glyph[2:-2] & sep[3:-1] & glyph[4:]
                 & (codes[1:-3] == codes[3:-1]) & (letter[:-4] | letter[2:-2] | letter[4:]))
        first[1:] &= ~glyph[:-5]
        for a in np.flatnonzero(first).tolist():
            if spaced and a < spaced[-1][1]:
                continue  # inside the last one, whose end is known
            b = a + 1
            while b + 1 < n and text[b] == text[a + 1] and glyph[b + 1] \
                    and not (b + 2 < n and glyph[b + 2]):
                b += 2
            if b - a >= 5:
                spaced.append((a, b))
    mixed = np.flatnonzero((letter[:-1] & strong[1:]) | (alike[:-1] & letter[1:]))
    triple = np.flatnonzero(letter[2:] & (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]))
    out, covered = list(spaced), np.zeros(n, bool)
    for a, b in spaced:
        covered[a:b] = True
    for at in np.union1d(mixed, triple).tolist():
        if covered[at]:
            continue
        a = b = at
        while a > 0 and glyph[a - 1] and not covered[a - 1]:
            a -= 1
        while b < n and glyph[b] and not covered[b]:
            b += 1
        covered[a:b] = True
        while b > a and not (letter[b - 1] or strong[b - 1]):
            b -= 1  # an exclamation mark at the end is punctuation
        out.append((a, b))
    return sorted(out)


def unlikely_spans(text: str, model: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint runs of short glyph groups with any separators between them, and words with
    doubled letters, that the language model finds unlikely; each of whole glyph groups."""
    codes = _codes(text)
    n = len(codes)
    if n < 3:
        return []
    symbol, kind = _tables()
    kinds = kind[codes]
    glyph, letter = kinds & 3 > 0, kinds & 1 > 0
    edge = np.diff(np.concatenate([[0], glyph.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return []

    def summed(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x, dtype=np.float64 if x.dtype.kind == "f"
                                               else np.int64)])
        return total[b] - total[a]

    same = np.concatenate([[False], codes[1:] == codes[:-1]])
    after = np.minimum(last + 1, n)
    odd = summed(model[_grams(symbol[codes])], first, after) > UNLIKELY * (after - first)
    short = summed(glyph & ~same, first, last) <= GROUP
    letters = summed(letter, first, last)
    doubled = summed(letter & same, first, last) > 0
    gap = summed(kinds & 16 > 0, last[:-1], first[1:]) == first[1:] - last[:-1]
    link = short[:-1] & short[1:] & (odd[:-1] | odd[1:]) & gap
    joined = np.diff(np.concatenate([[0], link.view(np.int8), [0]]))
    out, alone = [], odd & doubled
    for a, b in zip(np.flatnonzero(joined == 1).tolist(), np.flatnonzero(joined == -1).tolist()):
        if letters[a:b + 1].any():
            out.append((int(first[a]), int(last[b])))
            alone[a:b + 1] = False
    out += [(int(first[k]), int(last[k])) for k in np.flatnonzero(alone)]
    return sorted(out)


class Restorer:
    """Restores whole texts; decoded spans are remembered up to a bound."""

    def __init__(self, model: np.ndarray):
        self.model, self.memo = model, {}

    def ways(self, span: str, gaps: bool = False) -> list[str]:
        found = self.memo.get((span, gaps))
        if found is None:
            if len(self.memo) > 50_000:
                self.memo.clear()
            found = decode(span, self.model, gaps=gaps)
            if len(span) < 100:
                self.memo[span, gaps] = found
        return found

    def restore(self, text: str) -> tuple[str, list[str]]:
        """The lower-cased text with every span exchanged for its best restoration, and the others."""
        low = text.lower()
        wide = unlikely_spans(low, self.model)
        starts = [a for a, _ in wide]
        spans = [(a, b, True) for a, b in wide]
        for a, b in suspicious_spans(low):  # those inside a wider span are a part of it
            k = bisect.bisect_right(starts, a) - 1
            if k < 0 or wide[k][1] <= a:
                spans.append((a, b, False))
        if not spans:
            return low, []
        parts, others, at = [], [], 0
        for a, b, gaps in sorted(spans):
            best, *more = self.ways(low[a:b], gaps)
            parts += [low[at:a], best]
            at = b
            if not gaps:
                others += more
            elif best != low[a:b]:  # else the lattice found it clean
                others += [*more, low[a:b]]
        return "".join([*parts, low[at:]]), others


def features(word: str) -> list[str]:
    """A word as a whole ('=') and its beginnings ('^')."""
    return [f"={word}", *(f"^{word[:k]}" for k in WORD_STARTS if len(word) >= k)]


class Model(NamedTuple):
    """What scoring needs: the language model, feature weights and the calibration line."""

    grams: np.ndarray
    weights: dict[str, float]
    slope: float
    base: float


class Scorer:
    """Toxicity of restored texts under a Model."""

    def __init__(self, model: Model):
        self.model, self.restorer = model, Restorer(model.grams)
        self.find = ahocorasick.Automaton()
        for stem in {f[1:] for f in model.weights}:
            self.find.add_word(stem, stem)
        if model.weights:
            self.find.make_automaton()

    def evidence(self, text: str) -> tuple[float, str]:
        """Weight of the best word and a part of the next ones', and the restored text."""
        restored, others = self.restorer.restore(text)
        weights, best = self.model.weights, {}
        if not weights:
            return 0.0, restored
        for line in (restored, " ".join(others)):
            for end, stem in self.find.iter(line):
                a, b = end - len(stem) + 1, end + 1
                if a and line[a - 1].isalpha():
                    continue
                while b < len(line) and line[b].isalpha():
                    b += 1
                whole = weights.get(f"={stem}", 0.0) if b == end + 1 else 0.0
                weight = max(whole, weights.get(f"^{stem}", 0.0))
                word = line[a:b]
                best[word] = max(best.get(word, 0.0), weight)
        *rest, most = [0.0, *sorted(best.values())[-TOP_WORDS:]]
        return most + REST * sum(rest), restored

    def score(self, text: str | None) -> tuple[float, str]:
        found, restored = self.evidence(text or "")
        x = max(-700.0, min(700.0, self.model.slope * found + self.model.base))
        return 1 / (1 + math.exp(-x)), restored


def _training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .filter(~held_out(F.col("doc_id"))))
    total = marked.count()
    sample = save(hash_sample(marked, F.col("doc_id"), rows, total), "toxic-ids")
    check_sample(sample.count(), total, "op1_toxicity")
    # About ``rows`` ids at most, so they go to the texts and not the texts to them.
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id") \
        .select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Learns from all texts (language model) and a sample of labelled training rows.

    Without labelled rows of both kinds no word counts as toxic and every score
    is the base rate.
    """
    grams = language_model(count_grams(docs))
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")
    sample = save(_training_rows(docs, labels, rows).select(
        "text", (F.col("toxic") > 0).cast("int").alias("toxic"), half.alias("half")),
        "toxic-sample")
    if sample.count() > 2 * rows:  # ids that many rows share
        row = F.xxhash64("text", "toxic")
        sample = save(hash_sample(sample, row, rows, distinct_rows(sample, row)), "toxic-rows")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, seen = Restorer(grams), {(y, h): Counter() for y in (0, 1) for h in (0, 1)}
        for batch in batches:
            for text, toxic, h in zip(*(c.to_pylist() for c in batch.columns)):
                words = set(_WORD.findall(restorer.restore(text or "")[0]))
                seen[toxic, h].update({f for w in words for f in features(w)})
        names = [*set().union(*seen.values())]
        yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string())} | {
            f"{kind}{h}": pa.array([seen[y, h][f] for f in names], pa.int64())
            for y, kind in enumerate(("clean", "toxic")) for h in (0, 1)})

    totals = {(r.toxic, r.half): r.n for r in
              sample.groupBy("toxic", "half").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = (sum(totals.get((y, h), 0) for h in (0, 1)) for y in (0, 1))
    if not clean or not toxic:
        share = min(0.99, max(0.01, (toxic + 1) / (clean + toxic + 2)))
        return Model(grams, {}, 0.0, math.log(share / (1 - share)))

    counts = [f"{kind}{h}" for kind in ("clean", "toxic") for h in (0, 1)]
    seen = sample.mapInArrow(count, "feature string, clean0 long, clean1 long, toxic0 long, "
                                    "toxic1 long") \
        .groupBy("feature").agg(*[F.sum(c).alias(c) for c in counts])
    both = _lower_share(F.col("toxic0") + F.col("toxic1"), F.col("clean0") + F.col("clean1"))
    first = _lower_share(F.col("toxic0"), F.col("clean0"))
    least = LEAST_RATE if toxic >= FEW_TOXIC else FEW_RATE
    found = (seen.select("feature", both.alias("both"), first.alias("first"))
             .filter((F.col("both") >= least) | (F.col("first") >= least)).collect())
    weights, apart = ({r.feature: -math.log(1 - r[c]) for r in found
                       if r[c] is not None and r[c] >= least} for c in ("both", "first"))
    # The calibration sees a lexicon only on texts that did not choose it.
    whole = min(totals.get((y, h), 0) for y in (0, 1) for h in (0, 1)) == 0
    scorer_model = Model(grams, weights if whole else apart, 1.0, 0.0)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(scorer_model)
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"found": pa.array([scorer.evidence(t.as_py() or "")[0] for t in batch.column(0)],
                                   pa.float64()),
                 "toxic": batch.column(1)})

    rest = (sample if whole else sample.filter(F.col("half") == 1)).select("text", "toxic")
    pairs = rest.mapInArrow(weigh, "found double, toxic int").toArrow()
    slope, base = calibrate(pairs["found"].to_numpy(), pairs["toxic"].to_numpy() > 0)
    return Model(grams, weights, slope, base)


def _lower_share(toxic: Column, clean: Column) -> Column:
    """Wilson's lower bound of the share of toxic documents: few sightings count for less."""
    n, z2 = F.nullif(toxic + clean, F.lit(0)), SURE * SURE
    share = toxic / n
    margin = SURE * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))
    return (share + z2 / (2 * n) - margin) / (1 + z2 / n)


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic line through evidence and label by damped Newton steps with a weak ridge.

    The ridge draws to a slope of one: a half too small to hold a word of the other half's
    lexicon says nothing about it, and evidence then still ranks.
    """
    a = np.stack([x, np.ones_like(x)], axis=1)
    prior, ridge = np.array([1.0, 0.0]), np.diag([1e-2, 1e-3])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge @ (w - prior)
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge
        w -= np.clip(np.linalg.solve(hess, grad), -2.0, 2.0)
    return float(w[0]), float(w[1])


def score_column(text: Column, model: Model, restored: bool = False) -> Column:
    """Toxicity in 0..1 of a text column (null counts as empty); with ``restored`` a struct
    of the score and the restored text."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            got = [scorer.score(t.as_py()) for t in batch]
            scores = pa.array([g[0] for g in got], pa.float64())
            if restored:
                yield pa.StructArray.from_arrays(
                    [scores, pa.array([g[1] for g in got], pa.string())], ["score", "restored"])
            else:
                yield scores

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "score double, restored string" if restored else "double")(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of (doc_id, text).

    Null, empty and very long texts are scored like any other (no words: the
    base rate).  Repeated rows repeat; an empty table gives no rows; columns
    beside doc_id and text are ignored.
    """
    model = train(docs, labels)
    scored = docs.select("doc_id", score_column(F.col("text"), model).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with all their columns as they are."""
    return docs.filter(score_column(F.col("text"), train(docs, labels)) < THRESHOLD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"),
                           read_table(spark, sf_dir, "labels"))
