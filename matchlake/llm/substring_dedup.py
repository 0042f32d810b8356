"""Removal of passages that occur earlier, by relative Lempel-Ziv parsing.

The reference is the corpus itself.  A factor of a document is a longest stretch
whose every window of ``WINDOW`` words starts earlier in the reference too.

1. Texts are written once as blocks of about ``BLOCK_BYTES``, in a table bucketed
   by block, so later passes over the texts need no shuffle.
2. Every block is indexed.  In each window the gram of ``GRAM`` words with the
   smallest hash is its anchor, so equal windows have equal anchors, wherever they
   stand.  Consecutive windows with one anchor make a phrase; its entry is
   (anchor, hash of the whole phrase, place).
3. Phrases meet by anchor in a partial aggregate, so a passage held by a third of
   all documents costs one row per task.  Where all phrases of an anchor are equal
   the first place has the original and all others are copied whole.
4. Elsewhere a factor may begin or end inside a phrase.  The windows of these
   phrases, and only these, are compared one by one, with hashes of 128 bits and
   a partial aggregate again.
5. Each document is parsed greedily: from left to right the longest stretches in
   which no window is an original become factors, and their words go.

Places order by doc_id first.  What travels is one small row per phrase (about
seven words); texts are never shuffled.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import arrow_schema, read_table, save, shared_path

WINDOW = 20
GRAM = 8
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20  # texts hashed at once
SEQUENCE_BITS, OFFSET_BITS = 11, 31  # blocks of a task; places in a block
PLACE_BITS = 62
NO_ID = -2 ** 63
MULTIPLIER = 0x9E3779B97F4A7C15


# --- hashes of word ranges ---------------------------------------------------------

@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    inverse = pow(MULTIPLIER, -1, 2 ** 64)
    out = []
    for base in (MULTIPLIER, inverse):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of some texts, one after another, with hashes of any range of them."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]  # bytes split at \\x20 and \\x09-\\x0D
        self.counts = np.array([len(s) for s in split], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.total = int(self.first[-1])
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64,
                            self.total)
        size = 1 << max(18, self.total.bit_length())
        self.power, self.back = _powers(size)
        self.prefix = np.concatenate([np.zeros(1, np.uint64),
                                      np.cumsum(words * self.power[:self.total], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, length: np.ndarray | int, salt: int = 0) -> np.ndarray:
        h = (self.prefix[start + length] - self.prefix[start]) * self.back[start]
        return _mixed(h + np.asarray(length, np.uint64) + np.uint64(salt))

    def windows(self) -> np.ndarray:
        """Starts of all windows that lie in one text."""
        start = np.arange(max(0, self.total - WINDOW + 1))
        return start[start + WINDOW <= np.repeat(self.first[1:], self.counts)[:len(start)]]

    def phrases(self) -> tuple[np.ndarray, ...]:
        """(anchor, hash, first window, number of windows) of every phrase."""
        start = self.windows()
        if not len(start):
            return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
        grams = self.hashes(np.arange(self.total - GRAM + 1), GRAM)
        span = WINDOW - GRAM + 1
        anchor = start + np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)[start]
        new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
        count = np.diff(np.append(new, len(start)))
        start, anchor = start[new], anchor[new]
        whole = self.hashes(start, count + WINDOW - 1)
        return grams[anchor], _mixed(whole + (anchor - start).astype(np.uint64)), start, count


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _places(doc_id: np.ndarray, location: np.ndarray) -> pa.Array:
    """doc_id * 2**62 + location, 128 bits wide, so a smaller place stands earlier."""
    low = (doc_id & 3).astype(np.uint64) << np.uint64(PLACE_BITS) | location.astype(np.uint64)
    words = np.stack([low, (doc_id >> 2).view(np.uint64)], axis=1)
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(words),
                                 [None, pa.py_buffer(np.ascontiguousarray(words).tobytes())])


def _chunks(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """(doc_id, location of the first word, words) of texts, about ``CHUNK_BYTES`` at a time."""
    block, base, ids = (batch.column(c).to_numpy() for c in ("block", "base", "doc_id"))
    texts = batch.column("data").to_pylist()
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK_BYTES):
            size, end = size + len(texts[end]), end + 1
        yield ids[at:end], (block[at:end] << OFFSET_BITS) + base[at:end], Words(texts[at:end])
        at = end


# --- passes ------------------------------------------------------------------------

def write_blocks(docs: DataFrame) -> DataFrame:
    """(block, base, doc_id, data) of all texts, bucketed by block.

    ``base`` is where a text begins in its block, counted in bytes, so the words of
    a block have different places.  A null id is -2**63, a null text empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(4 * spark.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, base = TaskContext.get().partitionId() << SEQUENCE_BITS, 0
        for batch in batches:
            blocks, bases = [], []
            for size in pa.compute.binary_length(batch.column("data")).to_pylist():
                if base and base + size > BLOCK_BYTES:
                    block, base = block + 1, 0
                    if not block % (1 << SEQUENCE_BITS):
                        raise ValueError("too much text in one partition; repartition the documents")
                blocks.append(block)
                bases.append(base)
                base += size + 1
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()),
                                              pa.array(bases, pa.int64()), *batch.columns],
                                             names=["block", "base", "doc_id", "data"])

    cut_rows = rows.mapInArrow(cut, "block long, base long, doc_id long, data binary")
    name = f"text_blocks_{uuid.uuid4().hex}"
    (cut_rows.write.bucketBy(int(buckets), "block").format("parquet")
     .option("compression", "zstd").option("path", shared_path(spark, "text-blocks"))
     .saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name; the frame reads the files, by bucket
    return table


def _phrase_rows(blocks: DataFrame, schema: str) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, location, words in _chunks(batch):
                anchor, whole, start, count = words.phrases()
                doc = np.searchsorted(words.first, start, "right") - 1
                place = location[doc] + start - words.first[doc]
                made = {"anchor": lambda: _signed(anchor), "phrase": lambda: _signed(whole),
                        "place": lambda: _places(ids[doc], place),
                        "location": lambda: pa.array(place),
                        "windows": lambda: pa.array(count.astype(np.int32))}
                yield pa.RecordBatch.from_arrays([made[n]() for n in names], names=names)

    return blocks.mapInArrow(run, schema)


def _location(place) -> F.Column:
    return F.pmod(place, F.lit(2 ** PLACE_BITS).cast("decimal(38,0)")).cast("long")


def _by_block(marks: DataFrame) -> DataFrame:
    """(block, offset, windows) of (location, windows)."""
    return marks.select(F.shiftright("location", OFFSET_BITS).alias("block"),
                        F.col("location").bitwiseAND((1 << OFFSET_BITS) - 1).alias("offset"),
                        "windows")


def first_places(blocks: DataFrame) -> DataFrame:
    """(anchor, location, windows) per anchor of the corpus: where its phrase stands first, or,
    with the anchor not null, that its phrases differ."""
    phrases = _phrase_rows(blocks, "anchor long, phrase long, place decimal(38,0), windows int")
    found = phrases.groupBy("anchor").agg(
        F.min("place").alias("place"), F.min("phrase").alias("low"), F.max("phrase").alias("high"),
        F.min("windows").alias("windows"))
    differ = F.col("low") != F.col("high")
    return save(found.select(F.when(differ, F.col("anchor")).alias("anchor"),
                             F.when(~differ, _location(F.col("place"))).alias("location"),
                             "windows"), "first-phrases")


def first_windows(blocks: DataFrame, firsts: DataFrame) -> DataFrame:
    """(location, windows = 1): first places of the windows whose anchor has phrases that differ."""
    differ = firsts.filter(F.col("anchor").isNotNull()).select("anchor")
    runs = _by_block(_phrase_rows(blocks, "anchor long, location long, windows int")
                     .join(differ, "anchor", "left_semi"))

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        parts = []
        if texts.num_rows and wanted.num_rows:
            offsets = np.repeat(wanted["offset"].to_numpy(), wanted["windows"].to_numpy())
            offsets += np.concatenate([np.arange(n) for n in wanted["windows"].to_pylist()])
            offsets.sort()
            for ids, location, words in _chunks(texts.sort_by("base").combine_chunks()):
                base = location & (1 << OFFSET_BITS) - 1
                doc = np.repeat(np.arange(len(ids)), words.counts)
                at = base[doc] + np.arange(words.total) - words.first[doc]
                start = np.flatnonzero(np.isin(at, offsets, assume_unique=True))
                parts.append(pa.table([
                    _signed(words.hashes(start, WINDOW)), _signed(words.hashes(start, WINDOW - 1, 1)),
                    _places(ids[doc[start]], location[doc[start]] + start - words.first[doc[start]])],
                    names=["one", "two", "place"]))
        return pa.concat_tables(parts) if parts else arrow_schema(empty).empty_table()

    schema = "one long, two long, place decimal(38,0)"
    empty = blocks.sparkSession.createDataFrame([], schema).schema
    windows = blocks.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(run, schema)
    return windows.groupBy("one", "two").agg(F.min("place").alias("place")) \
        .select(_location(F.col("place")).alias("location"), F.lit(1).alias("windows"))


# --- parsing -----------------------------------------------------------------------

def factors(originals: np.ndarray) -> list[tuple[int, int]]:
    """(start, length in words) of the longest stretches whose windows are all copied."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], ~originals, [0]]).astype(np.int8)))
    return [(int(a), int(b - a) + WINDOW - 1) for a, b in edges.reshape(-1, 2)]


PARSED = ("doc_id long, n_words long, n_removed long, kept string, "
          "spans array<struct<start:int,length:int>>")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans) of every document.

    Words are runs of other characters than space and \\\\x09-\\\\x0D.  A window of 20
    words of one document that starts earlier too (smaller doc_id, or the same and
    earlier in it) is copied; every word of a copied window goes.  ``kept`` holds the
    others joined by one space, ``spans`` the factors (start and length in words,
    neighbours may overlap).

    Null texts count as empty; null ids stand before all others.  Documents that share
    an id stand in order of their place in the table, so a repeated row is a copy of
    the first.  Other columns are ignored; an empty table gives no rows.
    """
    blocks = write_blocks(docs)
    firsts = first_places(blocks)
    marks = _by_block(firsts.filter(F.col("anchor").isNull()).select("location", "windows")
                      .unionByName(first_windows(blocks, firsts)))

    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        texts = texts.sort_by("base")
        offset, windows = marks["offset"].to_numpy(), marks["windows"].to_numpy()
        order = np.argsort(offset)
        offset, windows = offset[order], windows[order]
        out = []
        for doc_id, base, data in zip(*(texts[c].to_pylist() for c in ("doc_id", "base", "data"))):
            words = data.split()
            lo, hi = np.searchsorted(offset, [base, base + len(data) + 1])
            edge = np.zeros(max(0, len(words) - WINDOW + 1) + 1, np.int64)
            np.add.at(edge, offset[lo:hi] - base, 1)
            np.add.at(edge, offset[lo:hi] - base + windows[lo:hi], -1)
            copied = factors(np.cumsum(edge[:-1]) > 0)
            kept, end = [], 0
            for start, length in copied:
                kept += words[end:start]
                end = start + length
            kept += words[end:]
            out.append((None if doc_id == NO_ID else doc_id, len(words), len(words) - len(kept),
                        b" ".join(kept), [{"start": a, "length": n} for a, n in copied]))
        columns = zip(*out) if out else [[]] * len(schema)
        return pa.Table.from_arrays([pa.array(list(c), pa.binary()).cast(pa.string())
                                     if f.name == "kept" else pa.array(list(c), f.type)
                                     for c, f in zip(columns, schema)], schema=schema)

    schema = arrow_schema(docs.sparkSession.createDataFrame([], PARSED).schema)
    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(run, PARSED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), s AS (
  SELECT doc_id, ws, unnest(range(0, len(ws) - 19)) AS s FROM d WHERE len(ws) >= 20
), r AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(ws[s + 1:s + 20], ' ')
                                       ORDER BY doc_id, s) AS k FROM s
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + 1, s + 21)) AS i FROM r WHERE k > 1
), w AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
