"""Operator 12 against SQL and a plain scan over all windows."""

import random
import re

from helpers import DOCS, ODD_TEXTS, SF, clashing, docs_frame
from matchlake.llm import substring_dedup as S
from oracle_compare import duck, same


def plain(rows):
    """rows: (doc_id, text) in order of their places."""
    rows = [(-2 ** 63 if i is None else i, at, i, re.findall(r"[^\x20\x09-\x0D]+", t or ""))
            for at, (i, t) in enumerate(rows)]
    seen, out = set(), []
    for _, _, doc_id, words in sorted(rows, key=lambda r: r[:2]):
        gone = set()
        for s in range(len(words) - 19):
            window = tuple(words[s:s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    for r in rows:
        covered = set()
        for a, n in r.spans:
            covered |= set(range(a, a + n))
        assert len(covered) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=repr)


def test_op12_oracle(spark):
    con = duck(SF)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    ok, why = same(S.query(spark, SF), con, S.ORACLE_SQL)
    assert ok, why


def test_op12_copies_edits_and_few_words(spark, monkeypatch):
    """Small alphabets give anchors whose phrases differ nearly everywhere."""
    rng = random.Random(1)
    passage = [rng.choice("abcdefgh") for _ in range(60)]
    texts = []
    for i in range(150):
        words = [rng.choice(["a", "b"] if i % 3 else ["x", "y", "z", "é", "中"])
                 for _ in range(rng.choice([0, 5, 19, 20, 21, 45, 200]))]
        if i % 4 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[rng.randrange(30):rng.randrange(30, 61)]
        if i % 5 == 0 and texts:
            words = (texts[rng.randrange(len(texts))] or "").split()
            if words:
                words[rng.randrange(len(words))] = "edit"
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    df = docs_frame(spark, texts, first=-70)
    monkeypatch.setattr(S, "BLOCK_BYTES", 700)
    monkeypatch.setattr(S, "CHUNK_BYTES", 300)
    assert found(S.remove_repeats(df.coalesce(1))) == plain([(i - 70, t) for i, t in enumerate(texts)])
    assert found(S.remove_repeats(df.repartition(4))) == plain([(i - 70, t) for i, t in enumerate(texts)])


def test_op12_odd_rows(spark):
    long = " ".join(str(i % 977) for i in range(60_000))
    texts = ODD_TEXTS + ["v " * 25, "v " * 19, "one " * 20, "one " * 21, long, "w " + long[5000:9000]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a b " * 20), (None, "q " * 30), (None, "q " * 25),
                                                   (7, texts[11]), (-4, long[:3000])]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    assert found(S.remove_repeats(clashing(df).withColumn("block", df.doc_id).coalesce(1))) == plain(rows)


def test_op12_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    out = found(S.remove_repeats(docs_frame(spark, [text] * 3).selectExpr("5L AS doc_id", "text")))
    assert sorted(r[2] for r in out) == [0, 40, 40]
    assert S.remove_repeats(docs_frame(spark, [])).count() == 0


def test_op12_texts_are_not_shuffled(spark):
    from conftest import plan_text
    blocks = S.write_blocks(docs_frame(spark, ["a " * 30, "b " * 30]))
    marks = spark.createDataFrame([(0, 1)], "location long, windows int")
    joined = blocks.groupBy("block").cogroup(S._by_block(marks).groupBy("block")).applyInArrow(
        lambda a, b: a.select(["block"]), "block long")
    plan = plan_text(joined, "simple")
    assert plan.count("Exchange hashpartitioning(block") == 1
