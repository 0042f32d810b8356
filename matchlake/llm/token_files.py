"""Token ids in flat binary files.

Format, one set of files per shard, shards in ascending document order:

* ``shard-N.bin``: the ids of all its documents, one after another, as
  little-endian unsigned integers (16 bits if every id fits, else 32);
* ``shard-N.idx``: little-endian 64-bit offsets into the shard, one more than
  documents; ``shard-N.doc``: the 64-bit document ids (a null id is -2**63);
* ``manifest.json``: per shard its documents, ids and base.  The bases are
  prefix sums of the shards' ids, so base + offset is a global position.

A task writes under a name of its own attempt and renames when complete, so a
retried or speculative task leaves whole files.  The driver only handles one
row per shard.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import codec
from matchlake.llm.common import open_folder, read_table, shared_path

END_ID = 2
NO_ID = -2**63
READ_ROWS = 10_000


def map_array(system: fs.FileSystem, name: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where it is a local or mounted file."""
    if system.get_file_info(name).size == 0:
        return np.zeros(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r")
    with system.open_input_file(name) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> dict:
    """Encodes (doc_id, text) and writes the files in ascending doc_id order; returns the manifest.

    Null texts count as empty (only the end id), null ids come first, rows with
    the same id are ordered by their text's hash.  An empty table gives a
    manifest without shards.  doc_id must be an integer.
    """
    open_folder(path)  # refuses a folder that tasks could not write, before any work
    dtype = "<u2" if max(codec.load(tokenizer)["model"]["vocab"].values()) < 2**16 - 256 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "tie", "row")]
    ordered = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
               .select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = codec.word_bpe(tokenizer), TaskContext.get()
        system, folder = open_folder(path)
        system.create_dir(folder, recursive=True)
        name = f"{folder}/shard-{task.partitionId():06d}"
        mine = f"{folder}/attempt-{task.partitionId():06d}-{task.taskAttemptId()}"
        lengths, ids = [np.zeros(1, np.int64)], []
        with system.open_output_stream(f"{mine}.bin") as out:
            for batch in batches:
                counts = np.zeros(batch.num_rows, np.int64)
                for i, text in enumerate(batch.column(1)):
                    tokens = np.append(bpe.ids(text.as_py() or ""), np.uint32(end_id))
                    out.write(tokens.astype(dtype).tobytes())
                    counts[i] = len(tokens)
                lengths.append(counts)
                ids.append(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False))
        offsets = np.cumsum(np.concatenate(lengths))
        for end, data in (("idx", offsets), ("doc", np.concatenate([np.zeros(0, np.int64), *ids]))):
            with system.open_output_stream(f"{mine}.{end}") as out:
                out.write(data.astype("<i8").tobytes())
        for end in ("bin", "idx", "doc"):
            system.move(f"{mine}.{end}", f"{name}.{end}")
        if len(offsets) > 1:
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([task.partitionId()], pa.int64()),
                 "docs": pa.array([len(offsets) - 1], pa.int64()),
                 "tokens": pa.array([offsets[-1]], pa.int64())})

    written = ordered.mapInArrow(write, "shard long, docs long, tokens long").collect()
    shards = [r.asDict() for r in sorted(written)]
    bases = accumulate((s["tokens"] for s in shards), initial=0)
    manifest = {"dtype": dtype, "shards": [s | {"base": b} for s, b in zip(shards, bases)]}
    system, folder = open_folder(path)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) per document; ``ids`` is binary, little-endian unsigned 32-bit."""
    return _read(spark, path, "doc_id long, start long, ids binary",
                 lambda ids: pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()))


def read_token_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files."""
    def sums(ids: list[np.ndarray]) -> tuple[pa.Array, ...]:
        return (pa.array([len(i) for i in ids], pa.int64()),
                pa.array([zlib.crc32(i.astype("<u4")) for i in ids], pa.int64()))
    return _read(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", sums)


def _read(spark: SparkSession, path: str, schema: str, columns) -> DataFrame:
    system, folder = open_folder(path)
    with system.open_input_file(f"{folder}/manifest.json") as f:
        manifest = json.loads(f.read())
    dtype = manifest["dtype"]
    todo = [(s["shard"], s["base"]) for s in manifest["shards"]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(path)
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            for shard, base in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"{folder}/shard-{shard:06d}"
                data, offsets, docs = (map_array(system, f"{name}.{end}", kind) for end, kind in
                                       (("bin", dtype), ("idx", "<i8"), ("doc", "<i8")))
                for at in range(0, len(docs), READ_ROWS):
                    part = docs[at:at + READ_ROWS]
                    edges = offsets[at:at + len(part) + 1]
                    got = columns([data[a:b] for a, b in zip(edges, edges[1:])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.int64(), mask=np.asarray(part) == NO_ID),
                         pa.array(edges[:-1] + base, pa.int64()),
                         *(got if isinstance(got, tuple) else (got,))], names=names)

    shards = spark.createDataFrame(todo, "shard long, base long")
    return shards.repartition(max(1, len(todo))).mapInArrow(read, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path,
                      codec.tokenizer_path("word_bpe_49k.json"))
    return read_token_checksums(spark, path)
