"""SimHash near-duplicates with pivot distance tables.

1. A document's fingerprint holds, bit by bit, the majority over the XXH64
   hashes of its word shingles.  Equal fingerprints are one class, so exact
   copies cost one row from here on.
2. Candidates: with 64 bits in ``blocks`` parts and at most ``max_bits``
   differing bits, at least ``blocks - max_bits`` parts of two linked
   fingerprints are equal (pigeonhole), so every class goes to the cells of all
   combinations of that many parts.  No link is lost, no cell is dropped.
3. A cell with more than ``cell_rows`` classes is split into slices and every
   pair of slices becomes a cell of its own.
4. Within a cell a table of Hamming distances to many reference fingerprints
   (pivots) is computed; by the triangle inequality a pair whose coordinates
   differ by more than ``max_bits`` anywhere cannot be linked.  Cells are
   sorted by the first coordinate, so a row is compared only with a window;
   the survivors of all coordinates are verified by their exact distance.
5. Each task hands on a spanning star per connected set, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import read_table, save
from matchlake.llm.components import connected_components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
BLOCKS = 6
PIVOTS = 16
CELL_ROWS = 2_000
PENDING = 400_000  # links held in a task before they are reduced to stars


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint; a text without words (or null) has 0."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in
                       zip(starts[:n].tolist(), ends[len(words) - n:].tolist())], "<u8")
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """``fingerprint`` of a text column, in Arrow batches."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in batch], pa.int64())

    # Typed here: annotations are text in this module.
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(text)


def pivots(count: int) -> np.ndarray:
    """Reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(bytes([k]), SEED) for k in range(count)], np.uint64)


def cells(classes: DataFrame, max_bits: int, blocks: int, cell_rows: int) -> DataFrame:
    """(fp) -> (key, cell, fp, first): each class once per combination of equal parts."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned("fp", a).bitwiseAND((1 << (b - a)) - 1)
            for a, b in zip(edges, edges[1:])]
    keys = [F.xxhash64(F.lit(n), *(part[i] for i in chosen)) for n, chosen in
            enumerate(combinations(range(blocks), blocks - max_bits))]
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(pivots(1).view(np.int64)[0]))))
    rows = classes.select("fp", first.cast("int").alias("first"),
                          F.explode(F.array(*keys)).alias("key"))
    large = (rows.groupBy("key").count().filter(F.col("count") > cell_rows)
             .select("key", F.ceil(F.col("count") / cell_rows).cast("long").alias("slices")))
    own = F.pmod(F.xxhash64("fp"), F.col("slices"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1), lambda s: s != own)
    pairs = F.transform(others, lambda s: F.least(s, own) * (1 << 31) + F.greatest(s, own))
    return (rows.join(large, "key", "left")
            .withColumn("cell", F.explode(F.when(F.col("slices").isNull(),
                                                 F.array(F.lit(-1).cast("long")))
                                          .otherwise(pairs)))
            .select("key", "cell", "fp", "first"))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> (node, root) of each connected set, without the roots themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


class PivotLinker:
    """Links of whole cells, given as rows sorted by (key, cell, first coordinate)."""

    def __init__(self, max_bits: int, count: int):
        self.max_bits, self.refs = max_bits, pivots(count)
        self.a, self.b, self.held = [], [], 0

    def _hold(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > PENDING:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = stars(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.held = [a], [b], 0
        return a, b

    def link(self, group: np.ndarray, fp: np.ndarray, first: np.ndarray) -> None:
        table = np.stack([np.bitwise_count(fp.view(np.uint64) ^ r) for r in self.refs],
                         axis=1).astype(np.int8)
        i = np.arange(len(fp) - 1)
        step = 1
        while len(i):
            i = i[i + step < len(fp)]
            j = i + step
            near = (group[i] == group[j]) & (first[j] - first[i] <= self.max_bits)
            i, j = i[near], j[near]
            keep = np.abs(table[i] - table[j]).max(axis=1, initial=0) <= self.max_bits
            x, y = fp[i[keep]], fp[j[keep]]
            linked = np.bitwise_count((x ^ y).view(np.uint64)) <= self.max_bits
            self._hold(x[linked], y[linked])
            step += 1


def links(classes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
          count: int = PIVOTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that span every connected set."""
    rows = (cells(classes, max_bits, blocks, cell_rows).repartition("key", "cell")
            .sortWithinPartitions("key", "cell", "first", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = PivotLinker(max_bits, count)
        rest = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            rows = [np.concatenate([r, c.to_numpy().astype(np.int64)])
                    for r, c in zip(rest, batch.columns)]
            new = np.append(True, (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0))
            group = np.cumsum(new)
            end = int(np.flatnonzero(new)[-1])  # the last cell may go on in the next batch
            linker.link(group[:end], rows[2][:end], rows[3][:end])
            rest = [r[end:] for r in rows]
        linker.link(np.zeros(len(rest[2]), np.int64), rest[2], rest[3])
        a, b = linker.reduce()
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()),
                                          "b": pa.array(b, pa.int64())})

    return rows.mapInArrow(run, "a long, b long")


def components_of(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp) -> (fp, component_id): the smallest id that links reach, per fingerprint."""
    classes = save(prints.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    labels = connected_components(links(classes.select("fp"), max_bits))
    linked = classes.join(labels.withColumnRenamed("node", "fp"), "fp")
    lowest = linked.groupBy("label").agg(F.min("low").alias("component_id"))
    moved = linked.join(lowest, "label").select("fp", "component_id")
    return classes.join(moved, "fp", "left").select(
        "fp", F.coalesce("component_id", "low").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of (doc_id, text).

    A null or empty text and one without words has fingerprint zero and is
    linked like any other.  Rows with a null doc_id take part in links but never
    name a component unless all its ids are null.  Repeated rows repeat; an
    empty table gives no rows; other columns are ignored.
    """
    prints = save(docs.select(F.col("doc_id").alias("id"),
                              fingerprint_column(F.col("text"), shingle).alias("fp")), "prints")
    # Written first: a join of two tables is one whose hot fingerprint can be split.
    components = save(components_of(prints, max_bits), "components")
    return prints.join(components, "fp").select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each component: that with the smallest doc_id.

    All columns are kept as they are.  Of rows with the same id, or without
    any, one stays.  The rows are numbered in a written copy, so that a retry
    sees the same numbers.
    """
    rows = save(docs.select(F.struct("*").alias("row"),
                            F.monotonically_increasing_id().alias("n")), "numbered")
    prints = save(rows.select(F.col("row.doc_id").alias("id"), "n",
                              fingerprint_column(F.col("row.text"), shingle).alias("fp")),
                  "prints")
    number = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"),
                      F.col("n").alias("n"))
    order = prints.select("fp", number.alias("id"))
    keep = (components_of(order, max_bits).select("component_id.n").distinct())
    return rows.join(keep, "n", "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
