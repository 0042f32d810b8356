"""BPE encoding and decoding by forced-boundary splitting.

A merge can only ever form a vocabulary token, so two neighbouring bytes that
stand side by side in no token are never merged: between them the cut is
certain.  Inside each piece of the split pattern the text is cut at all such
byte pairs, the fragments are encoded on their own and their ids concatenated.  The
result equals encoding the piece as a whole.  Cuts are only made inside
pieces: across pieces the split pattern looks ahead over white space.  The ids
of what stands between two spaces are remembered up to a bound.
"""

from __future__ import annotations

import functools
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm import codec
from matchlake.llm.common import arrow_schema, read_table

MEMO_ENTRIES = 400_000  # remembered chunks of a worker; the memo is emptied beyond that
ROWS_PER_BATCH = 1_000

# A space that is the first of a piece only if no white space follows: texts with other
# spaces are split by the pattern as a whole.
_ODD_SPACE = re.compile(r" (?:\s|\Z)|\A ")


def forced_pairs(tokens: Iterator[bytes]) -> np.ndarray:
    """256 x 256: True where the byte pair stands side by side in no token."""
    forced = np.ones((256, 256), bool)
    for t in tokens:
        raw = np.frombuffer(t, np.uint8)
        forced[raw[:-1], raw[1:]] = False
    return forced


class ChunkMemo(dict):
    """Ids of chunks, each a space and what follows it up to the next one (keys lack the space)."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(" " + chunk)
        if len(chunk) < 64:
            self[chunk] = ids
        return ids


class ForcedSplitBpe:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str):
        self.bpe = codec.byte_bpe(path)
        self.forced = forced_pairs(self.bpe.ranks)
        self.cut_after = [row.tobytes() for row in self.forced]  # by first byte, then second
        self.pieces = regex.compile(codec.BYTE_PATTERN)
        self.special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in self.bpe.specials) + ")")
        self.chunks = ChunkMemo(self._pieces)
        self.merge = self.bpe.core._core_bpe.encode_single_piece
        self.unmerge = self.bpe.core._core_bpe.decode_bytes

    def fragments(self, raw: bytes) -> list[bytes]:
        """The piece cut at every forced boundary."""
        if len(raw) > 64:
            codes = np.frombuffer(raw, np.uint8)
            cuts = (np.flatnonzero(self.forced[codes[:-1], codes[1:]]) + 1).tolist()
        else:
            cut_after = self.cut_after
            cuts = [i for i in range(1, len(raw)) if cut_after[raw[i - 1]][raw[i]]]
        if not cuts:
            return [raw]
        edges = [0, *cuts, len(raw)]
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def _pieces(self, text: str) -> bytes:
        ids = array("I")
        for piece in self.pieces.findall(text):
            for fragment in self.fragments(piece.encode()):
                ids.extend(self.merge(fragment))
        return ids.tobytes()

    def _plain(self, text: str) -> bytes:
        """A text without special tokens.

        A space before anything but white space begins a piece of the pattern,
        so what lies between two such spaces is encoded on its own.
        """
        if _ODD_SPACE.search(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.chunks.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > MEMO_ENTRIES:
            self.chunks.clear()
        out = []
        for k, part in enumerate(self.special.split(text) if "<|" in text else [text]):
            out.append(array("I", [self.bpe.specials[part]]).tobytes() if k % 2
                       else self._plain(part))
        ids = b"".join(out)
        return ids if sys.byteorder == "little" else np.frombuffer(ids, ">u4").astype("<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        return self.unmerge(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def splitter(path: str) -> ForcedSplitBpe:
    return ForcedSplitBpe(path)


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) of every document of (doc_id, text).

    ``ids`` is binary (little-endian unsigned 32-bit), ``decoded`` the text that
    the ids give back.  A null or empty text gives no ids and an empty text;
    repeated rows repeat; extra columns are ignored.
    """
    source = docs.select("doc_id", "text")
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType),
                           T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = splitter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                ids = [bpe.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(out.field(0).type), pa.array(ids, pa.binary()),
                     pa.array(map(bpe.decode, ids), pa.string())], schema=out)

    return source.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(read_table(spark, sf_dir, "documents"),
                          codec.tokenizer_path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
