"""Operator 10 against fingerprints by plain Python and all pairs by brute force."""

import random

import pytest
import xxhash

from helpers import ODD_TEXTS, SF, clashing, docs_frame, texts_of
from matchlake.llm import simhash
from matchlake.llm.components import connected_components


def plain_fingerprint(text, shingle=4):
    words, cur = [], ""
    for ch in (text or ""):
        if ch in " \t\n\x0b\x0c\r":
            words, cur = words + [cur] if cur else words, ""
        else:
            cur += ch.lower() if "A" <= ch <= "Z" else ch
    words = words + [cur] if cur else words
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] \
        if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64)
               if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, bits=4):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def signed(u):
    return u - (1 << 64) if u >> 63 else u


def test_query(spark):
    texts = texts_of(spark)
    got = {r.doc_id: r for r in simhash.query(spark, SF).collect()}
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    prints = [plain_fingerprint(texts[k]) for k in order]
    comps = brute_components(prints)
    for k, p, c in zip(order, prints, comps):
        assert got[ids[k]].fingerprint == f"{p:016x}"
        assert got[ids[k]].component_id == ids[order[c]]


@pytest.mark.parametrize("cell_rows", [3, 2000])
def test_links_against_all_pairs(spark, cell_rows):
    rng = random.Random(7)
    prints = [0, (1 << 64) - 1]
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.append(p)
        for _ in range(rng.choice([0, 1, 5, 12])):  # near ones, chains included
            for b in rng.sample(range(64), rng.randint(1, 6)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long").repartition(5)
    edges = simhash.links(df, cell_rows=cell_rows).collect()
    for e in edges:
        assert ((e.a ^ e.b) & (1 << 64) - 1).bit_count() <= 64
    comps = brute_components(prints)
    labels = {r.node: r.label for r in connected_components(
        spark.createDataFrame([(e.a, e.b) for e in edges], "a long, b long")).collect()}
    groups, want = {}, {}
    for p, c in zip(prints, comps):
        want.setdefault(c, set()).add(p)
        groups.setdefault(labels.get(signed(p), signed(p)), set()).add(p)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in want.values()}


def test_components_of_a_path_and_no_edges(spark):
    n = 60
    path = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    rows = connected_components(path).collect()
    assert len(rows) == n + 1 and len({r.label for r in rows}) == 1
    assert connected_components(path.limit(0)).count() == 0


def test_odd_rows(spark):
    texts = [*ODD_TEXTS, "word " * 3000, "WORD  word\tword word word"]
    df = clashing(docs_frame(spark, texts))
    df = df.unionAll(df.filter("doc_id = 11"))
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == len(texts) + 1
    comps = {r.doc_id: r.component_id for r in rows}
    assert comps[1] == comps[2] == comps[13] == 0  # null, empty, blank: fingerprint zero
    assert comps[15] == comps[16] == 11
    assert simhash.near_duplicates(docs_frame(spark, [])).count() == 0
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comps.values()))
    assert simhash.deduplicate(docs_frame(spark, [])).count() == 0
