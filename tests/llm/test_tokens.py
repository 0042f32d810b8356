"""Operators 4, 6 and 9 against the tokenizers library, an exact round trip and file reads."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import DOCS, ODD_TEXTS, SF, clashing, docs_frame, texts_of
from matchlake.llm import codec, forced_bpe, packing, token_files
from matchlake.llm.common import shared_path

BYTE, WORD = (codec.tokenizer_path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)


def mixed_texts(n=1500):
    rng = random.Random(3)
    parts = ["the", "Stadt", "ÉTÉ", "niño", "<|endoftext|>", "<|startoftext|>", "'s", "  ", "...",
             "\n\n", " ", "12", "´", "ß", "ÿ", "中", "á", " ", "!?", "'", "^", "\t", "\xa0", "\u2003", "\x1c", "\x85", " 'll", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_codecs_equal_the_library(spark, libraries):
    byte, word, forced = codec.ByteBpe(BYTE), codec.WordBpe(WORD), forced_bpe.ForcedSplitBpe(BYTE)
    for t in [*texts_of(spark), *filter(None, ODD_TEXTS), *mixed_texts()]:
        want = libraries[0].encode(t, add_special_tokens=False).ids
        assert byte.ids(t).tolist() == want
        ids = forced.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert forced.decode(ids) == libraries[0].decode(want, skip_special_tokens=False)
        assert word.ids(t).tolist() == libraries[1].encode(t, add_special_tokens=False).ids


def test_forced_pairs_stand_in_no_token():
    forced = forced_bpe.ForcedSplitBpe(BYTE)
    assert forced.forced.any()
    raw = "thndqxzjévqwk".encode()
    parts = forced.fragments(raw)
    assert b"".join(parts) == raw and len(parts) > 1
    for a, b in zip(parts, parts[1:]):
        assert not any(bytes([a[-1], b[0]]) in t for t in forced.bpe.ranks)


def test_op6_query(spark, libraries):
    got = {r.doc_id: r for r in forced_bpe.query(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = libraries[0].encode(d.text, add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_op6_odd_rows(spark):
    df = forced_bpe.encode_decode(clashing(docs_frame(spark, ODD_TEXTS)), BYTE)
    assert [r.decoded for r in df.orderBy("doc_id").collect()] == [t or "" for t in ODD_TEXTS]
    assert forced_bpe.encode_decode(docs_frame(spark, []), BYTE).count() == 0


def check_packing(rows, lengths_of, capacity):
    """Every document whole and in order, every sequence gapless and within capacity."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == lengths_of.keys()
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        at = 0
        for k, p in enumerate(parts):
            assert p.start == at and 0 < p.length <= capacity
            assert k == 0 or p.length == capacity
            at += p.length
        assert at == lengths_of[doc]
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_seq)


def test_op4_query(spark, libraries):
    rows = packing.query(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {d.doc_id: [*libraries[0].encode(d.text, add_special_tokens=False).ids, 2] for d in docs}
    used = check_packing(rows, {k: len(v) for k, v in ids.items()}, 1024)
    total = sum(map(len, ids.values()))
    assert used <= 1.03 * -(-total // 1024) + 1
    for r in rows:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)


def test_op4_beats_best_fit_over_many_shards(spark):
    rng = random.Random(5)
    lengths = [rng.choice([rng.randint(1, 63), rng.randint(20, 40)]) for _ in range(3000)]
    df = spark.createDataFrame([(i, 0, 0, n) for i, n in enumerate(lengths)],
                               "doc_id long, piece int, start long, length long")
    rows = packing.pack(df, capacity=64, shard_items=500, islands=3).collect()
    used = check_packing(rows, dict(enumerate(lengths)), 64)
    alone = len(packing.Packer(lengths, 64).greedy())
    assert used <= alone + 3


def test_crossover_keeps_every_piece_once():
    rng = random.Random(1)
    lengths = [rng.randint(1, 60) for _ in range(400)]
    p = packing.Packer(lengths, 64)
    a, b = p.greedy(), p.greedy(rng, 0.5)
    for child in (p.cross(a, b, rng, 0.2), p.mutate(b, rng, 0.1), p.evolve([a, b], rng, 6, 4)):
        assert sorted(i for c in child for i in c) == list(range(400))
        assert all(sum(lengths[i] for i in c) <= 64 for c in child)
    assert len(p.evolve([a, b], rng, 10, 4)) <= len(b)


def test_op4_odd_rows(spark):
    df = clashing(docs_frame(spark, [*ODD_TEXTS, "same", "same"]))
    rows = packing.pack_documents(df.unionAll(df.filter("doc_id = 4").withColumn("doc_id", df.doc_id + 900))).collect()
    byte = codec.ByteBpe(BYTE)
    want = {i: len(byte.ids(t or "")) + 1 for i, t in enumerate([*ODD_TEXTS, "same", "same"])}
    check_packing(rows, want | {904: want[4]}, 1024)
    assert packing.pack_documents(docs_frame(spark, [])).count() == 0
    extra = spark.createDataFrame([(5, "u")], "length long, uid string")
    assert packing.pack(extra).columns == ["length", "uid", "sequence_id", "offset"]


def test_op9_query_and_files(spark, libraries):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda d: d.doc_id)
    got = {r.doc_id: r for r in token_files.query(spark, SF).collect()}
    at = 0
    for d in docs:
        ids = [*libraries[1].encode(d.text, add_special_tokens=False).ids, 2]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_op9_odd_rows(spark, libraries):
    path = shared_path(spark, "odd")
    df = clashing(docs_frame(spark, ODD_TEXTS)).repartition(3)
    df = df.unionAll(clashing(spark.createDataFrame([(None, "null id", None, None, None)], DOCS)))
    manifest = token_files.write_token_files(df, path, WORD)
    assert manifest["dtype"] == "<u2"
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, *range(len(ODD_TEXTS))]
    for r, t in zip(rows, ["null id", *ODD_TEXTS]):
        assert np.frombuffer(r.ids, "<u4").tolist() == [
            *libraries[1].encode(t or "", add_special_tokens=False).ids, 2]
    empty = shared_path(spark, "empty")
    assert token_files.write_token_files(docs_frame(spark, []), empty, WORD)["shards"] == []
    assert token_files.read_token_checksums(spark, empty).count() == 0


def test_op9_folder_schemes():
    from matchlake.llm.token_files import open_folder

    assert open_folder("file:/tmp/x")[1] == open_folder("/tmp/x")[1] == "/tmp/x"
    system, path = open_folder("s3a://bucket/ids?region=us-east-1&endpoint_override=127.0.0.1")
    assert system.type_name == "s3" and path == "bucket/ids"
    with pytest.raises(Exception, match="scheme|Unrecognized"):
        open_folder("nosuch://bucket/ids")
