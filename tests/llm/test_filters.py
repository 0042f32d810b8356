"""Operators 1, 2 and 7: held-out accuracy, decoding, odd rows; and the pipeline."""

import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import ODD_TEXTS, SF, clashing, docs_frame
from matchlake.llm import langid, learned_ann, packing, quality, simhash, toxicity
from matchlake.llm.common import distinct_rows, hash_sample, held_out
from matchlake.llm.hashed import bag, edged, gram_hashes, packed, unpacked

MID = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    ones = label.sum()
    return (order[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def joined(spark, df, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return df.join(labels, "doc_id").toPandas()


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{MID}/documents.parquet"),
            spark.read.parquet(f"{MID}/labels.parquet"))


@pytest.fixture(scope="module")
def toxic_model(tables):
    return toxicity.train(*tables)


def test_held_out_rows(spark):
    rows = docs_frame(spark, ["x"] * 50).select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_sample_of_a_huge_table_is_not_empty(spark):
    """A share of 8e-7, the ids of a part of such a table."""
    ids = spark.range(20_000_000)
    assert 4 <= hash_sample(ids, F.col("id"), 8_000, 10**10).count() <= 40
    assert 900 <= hash_sample(spark.range(10_000), F.col("id"), 1_000, 10_000).count() <= 1_100


def test_an_empty_sample_fails(spark, tables, monkeypatch):
    for module in (langid, quality, learned_ann, toxicity):
        monkeypatch.setattr(module, "hash_sample", lambda df, *a, **k: df.limit(0))
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    for run in (lambda: langid.train(tables[0]), lambda: quality.score_quality(tables[0]),
                lambda: learned_ann.search(vectors), lambda: toxicity.train(*tables)):
        with pytest.raises(ValueError, match="no training row"):
            run()


def test_op1_held_out_quality(spark):
    d = joined(spark, toxicity.query(spark, MID), MID)
    assert set(d.columns) >= {"doc_id", "held_out", "score", "predicted"}
    assert d.score.between(0, 1).all()
    assert ((d.score >= 0.7).astype(int) == d.predicted).all()
    apart = d[d.held_out]
    assert auc(apart.score.to_numpy(), apart.toxic.to_numpy()) >= 0.85
    assert apart[apart.predicted == 1].toxic.mean() >= 0.9


def test_op1_ranks_held_out_rows_after_few_toxic_training_rows(spark):
    """Six toxic training rows, of which no word has four; equal scores share their rank."""
    d = joined(spark, toxicity.query(spark, SF), SF)
    apart = d[d.held_out]
    assert d[~d.held_out].toxic.sum() < 10
    ones, rank = apart.toxic.sum(), apart.score.rank()
    area = (rank[apart.toxic == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(apart) - ones))
    assert area >= 0.65


@pytest.mark.parametrize("written, meant", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("s.c.u.m", "scum"),
    ("idiiiiot", "idiot"), ("tr@$h", "trash"), ("l0ser", "loser"), ("cl0wn", "clown")])
def test_op1_deobfuscation(toxic_model, written, meant):
    scorer = toxicity.Scorer(toxic_model)
    low, ways = written.lower(), []
    for a, b in toxicity.suspicious_spans(low):
        ways += [low[:a] + w + low[b:] for w in scorer.restorer.ways(low[a:b])]
    assert meant in ways
    plain, hidden = scorer.score(f"The {meant} of the")[0], scorer.score(f"The {written} of the")[0]
    assert hidden >= 0.9 * plain > scorer.score("The house of the")[0]


@pytest.mark.parametrize("written", [
    "i  d  i  o  t", "i-d.i-o-t", "i - d - i - o - t", "ii dd ii oo tt", "iii ddd iii ooo ttt",
    "iiddiioott", "i,d,i,o,t", "i/d/i/o/t", "i\td\ti\to\tt", "i\nd\ni\no\nt",
    "i\u200bd\u200bi\u200bo\u200bt", "id io t", "idi ot", "1 d, 1 0 t"])
def test_op1_combined_deobfuscation(toxic_model, written):
    scorer = toxicity.Scorer(toxic_model)
    restored = scorer.restorer.restore(f"The {written} of the house")
    assert "idiot" in re.findall(r"\w+", " ".join([restored[0], *restored[1]]))
    plain = scorer.score("The idiot of the house")[0]
    assert scorer.score(f"The {written} of the house")[0] >= 0.9 * plain


def test_op1_clean_texts_keep_their_scores(tables, toxic_model, monkeypatch):
    """The wider spans do not raise the score of a clean document over the threshold."""
    scorer = toxicity.Scorer(toxic_model)
    clean = [r.text for r in tables[0].join(tables[1].filter("toxic = 0"), "doc_id").collect()]
    wide = np.array([scorer.score(t)[0] for t in clean])
    monkeypatch.setattr(toxicity, "unlikely_spans", lambda text, model: [])
    narrow = np.array([toxicity.Scorer(toxic_model).score(t)[0] for t in clean])
    assert (wide >= toxicity.THRESHOLD).sum() <= (narrow >= toxicity.THRESHOLD).sum()
    assert np.mean(np.abs(wide - narrow) < 0.01) >= 0.99


def test_op1_language_model_counts_everything(spark):
    texts = ["abc", "abc abd", None, "", "É1!"]
    counts = toxicity.count_grams(docs_frame(spark, texts))
    assert counts.sum() == sum(len(t or "") for t in texts)
    a, b = 0, 1
    B = toxicity.BORDER
    assert counts[((B * 32 + B) * 32 + a) * 32 + b] == 2
    model = toxicity.language_model(counts).reshape(-1, 32)
    assert np.allclose(np.exp(-model.astype(float)).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize("gaps", [False, True])
def test_op1_decode_is_the_best_path(gaps):
    """k-best Viterbi against every way through the lattice."""
    rng = np.random.default_rng(0)
    model = toxicity.language_model(rng.integers(0, 9, 32**4))
    symbol = toxicity._tables()[0]
    for span in ["1d10t", "a$$", "s.c", "4b1", "xx3x", "a b--c", "ii d"]:
        paths = [("", 0.0)]
        for run in re.finditer(r"(.)\1*", span):
            paths = [(t + o, c + k) for t, c in paths
                     for o, k in toxicity.options(run.group(1), len(run.group()), gaps)]
        best = {}
        for text, cost in paths:
            state = [toxicity.BORDER] * 3
            for s in [*(int(symbol[ord(x)]) for x in text), toxicity.BORDER]:
                cost += float(model[((state[0] * 32 + state[1]) * 32 + state[2]) * 32 + s])
                state = [*state[1:], s]
            best[text] = min(cost, best.get(text, 1e9))
        want = sorted(best, key=lambda t: (best[t], t))[:toxicity.BEST]
        got = toxicity.decode(span, model, gaps=gaps)
        assert got[0] == want[0] and set(got) <= set(best)


def test_op1_long_texts_take_time_in_proportion():
    """Spaced letters, short cells and a chess score; the long text repeats the short one's result."""
    rng = np.random.default_rng(0)
    restorer = toxicity.Restorer(toxicity.language_model(rng.integers(0, 9, 32**4)))
    for unit in ("i d i o t ", "a 1 b 2 c 3 ", "e4 e5 nf3 nc6 bb5 a6 "):
        seconds = []
        for n in (300, 1200):
            begun = time.process_time()
            restorer.restore(unit * n)
            seconds.append(time.process_time() - begun)
        assert seconds[1] < 9 * seconds[0] + 0.5


def test_op1_sample_of_one_repeated_id_is_bounded(spark, monkeypatch):
    """Three quarters of the rows under one id, which is not held out: drawn again by text."""
    taken, draw = [], toxicity.hash_sample

    def counted(df, *args, **kwargs):
        taken.append(draw(df, *args, **kwargs))
        return taken[-1]

    monkeypatch.setattr(toxicity, "hash_sample", counted)
    texts = [f"the house number {i} is {'scum' if i % 4 == 0 else 'good'}" for i in range(600)]
    hot = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [(hot if i % 4 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.col("text").contains("scum").cast("int").alias("toxic")).distinct()
    model = toxicity.train(docs, labels, rows=160)
    assert len(taken) == 2 and 110 <= taken[1].count() <= 210
    assert 0 <= toxicity.Scorer(model).score("scum")[0] <= 1


def test_op1_odd_rows(spark, tables):
    df = clashing(docs_frame(spark, [*ODD_TEXTS, "You idiot scum, you 1d1ot"]))
    got = toxicity.score_documents(df.unionAll(df), tables[1]).collect()
    assert len(got) == 2 * (len(ODD_TEXTS) + 1)
    assert all(0 <= r.score <= 1 for r in got)
    empty = docs_frame(spark, [])
    assert toxicity.score_documents(empty, tables[1]).count() == 0
    none = toxicity.score_documents(df, tables[1].limit(0)).collect()
    assert len({r.score for r in none}) == 1
    kept = toxicity.drop_toxic(df, tables[1])
    assert kept.columns == df.columns


def test_op7_held_out_accuracy(spark, tables):
    d = langid.query(spark, MID).join(tables[0].select("doc_id", "lang"), "doc_id").toPandas()
    apart = d[d.held_out]
    assert (apart.lang_pred == apart.lang).mean() >= 0.97
    assert apart.accepted.mean() >= 0.98
    assert d.score.between(0, 1).all()


def learning_rows(tables):
    """(texts and languages to learn from, held-out ones), as the contract divides them."""
    rows = [(zlib.crc32(str(r.doc_id).encode()) % 3 == 1, r.text, r.lang)
            for r in tables[0].orderBy("doc_id").collect() if r.text and r.lang]
    return [(t, g) for h, t, g in rows if not h], [(t, g) for h, t, g in rows if h]


@pytest.fixture(scope="module")
def language_model(tables):
    return langid.fit([e for t, g in learning_rows(tables)[0] for e in langid.examples(t, g)])


OTHER_LANGUAGES = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
    "Все люди рождаются свободными и равными в своем достоинстве и правах",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar",
    "人人生而自由,在尊严和权利上一律平等", "xkq zvbw pfjq wtrx qqpl mnbv cxzl kjhg"]


def test_op7_probabilities_are_calibrated_and_noise_is_rejected(tables, language_model):
    model, apart = language_model, learning_rows(tables)[1]
    cut = [(langid.window(t, 20, 300), g) for t, g in apart]
    for rows in (apart, cut):
        got = [langid.recognise(t, model) for t, _ in rows]
        right = np.array([r.lang == g for r, (_, g) in zip(got, rows)])
        assert right.mean() >= 0.97
        assert abs(np.mean([r.score for r in got]) - right.mean()) < 0.05
        assert np.mean([r.known >= model.reject for r in got]) >= 0.98
    for rows, share in ((apart, 0.95), (cut, 0.7)):
        noise = [langid.recognise(langid.shuffled(t), model) for t, _ in rows]
        assert np.mean([r.known < model.reject for r in noise]) >= share
    assert all(langid.recognise(t, model).known < model.reject for t in OTHER_LANGUAGES)


def test_op7_learned_language_left_out_is_rejected(tables):
    learn, apart = learning_rows(tables)
    model = langid.fit([e for t, g in learn if g != "de" for e in langid.examples(t, g)])
    got = [langid.recognise(t, model) for t, g in apart if g == "de"]
    assert np.mean([r.known < model.reject for r in got]) >= 0.8
    kept = [langid.recognise(t, model) for t, g in apart if g != "de"]
    assert np.mean([r.known >= model.reject for r in kept]) >= 0.98


def test_op7_query_against_a_plain_run(spark, tables, language_model):
    """The whole result from the definition: plain n-gram means, one text after the other."""
    model = language_model
    got = {r.doc_id: r for r in langid.query(spark, MID).collect()}
    rows = tables[0].collect()
    assert len(got) == len(rows)
    for r in rows:
        found = got[r.doc_id]
        assert found.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if not any(map(str.isalpha, r.text or "")):
            assert (found.lang_pred, found.score, found.accepted) == ("und", 0.0, False)
            continue
        buckets, shares = bag(r.text, True, langid.ORDERS)
        z = (shares.astype(float) @ model.table[buckets].astype(float) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert found.lang_pred == model.langs[int(p.argmax())] or np.sort(p)[-1] - np.sort(p)[-2] < 1e-5
        assert found.score == pytest.approx(p.max(), abs=1e-4)


def test_training_sample_of_one_repeated_id_is_bounded(spark):
    """A third of the rows under one id, of them half one text: rows of different text count alike."""
    rows = [(i if i % 3 else 0, f"text {i if i % 6 else 0}") for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = F.xxhash64("doc_id", "text")
    total = distinct_rows(df, key)
    assert total == pytest.approx(len(set(rows)), rel=0.06)
    got = [tuple(r) for r in hash_sample(df, key, 500, total).collect()]
    assert len(got) == len(set(got)) and 400 <= len(got) <= 600
    assert 100 <= sum(i == 0 for i, _ in got) <= 150  # its share of the different rows
    again = hash_sample(df.repartition(7), key, 500, distinct_rows(df.repartition(7), key))
    assert sorted(map(tuple, again.collect())) == sorted(got)


def test_bags_hold_whole_texts():
    """Every n-gram counts, also across the blocks."""
    rng = np.random.default_rng(0)
    text = "".join(rng.choice(list("abcdé .7"), 3_000))
    for letters_only in (True, False):
        want = np.concatenate([gram_hashes(edged(text, letters_only), n) for n in (2, 4)])
        buckets, counts = np.unique(want, return_counts=True)
        for block in (100, 200_000):
            got = bag(text, letters_only, (2, 4), block)
            assert (got[0] == buckets).all()
            assert np.allclose(got[1] * len(want), counts)
        assert (unpacked(*(packed([got])[c][0].as_py() for c in ("buckets", "shares")))[0] == buckets).all()


def test_op7_odd_rows(spark):
    df = clashing(docs_frame(spark, [*ODD_TEXTS, "the cat"]))
    got = {r.doc_id: r for r in langid.predict_languages(df).collect()}
    for i, t in enumerate([*ODD_TEXTS, "the cat"]):
        letters = any(map(str.isalpha, t or ""))
        assert got[i].lang_pred == ("en" if letters else "und")
        assert letters or (got[i].score == 0 and not got[i].accepted)
    assert langid.predict_languages(docs_frame(spark, [])).count() == 0
    assert langid.keep_recognised(df).columns == df.columns
    nothing = langid.predict_languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_op2_against_labels(spark):
    d = joined(spark, quality.query(spark, MID), MID)
    label = d.quality.to_numpy()
    assert auc(d.posterior.to_numpy(), label) >= 0.95
    assert auc(d.score.to_numpy(), label) >= 0.9
    assert d[d.quality == 1].predicted.mean() >= 0.95


def test_op2_em_finds_the_accuracies():
    """Votes made with known accuracies."""
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.8
    right = [0.9, 0.8, 0.75, 0.85, 0.7]
    votes = ["".join("g" if (t == (rng.random() < a)) else "b" for a in right) for t in truth]
    patterns = sorted(set(votes))
    model = quality.expectation_maximisation(patterns, np.array([votes.count(p) for p in patterns]))
    assert model.good == pytest.approx(0.8, abs=0.03)
    for k, a in enumerate(right):
        assert model.table[k, 0, 1] == pytest.approx(a, abs=0.03)
        assert model.table[k, 1, 0] == pytest.approx(a, abs=0.06)


def test_op2_query_against_a_plain_run(spark, tables):
    """The whole result from the definition, one text after the other."""
    texts = {r.doc_id: r.text or "" for r in tables[0].collect()}
    seen = {i: quality.votes(t) for i, t in texts.items()}
    patterns = sorted(set(seen.values()))
    every = list(seen.values())
    labels = quality.expectation_maximisation(patterns, np.array([every.count(p) for p in patterns]))
    learn = sorted((*(x.tobytes() for x in bag(t, False, quality.ORDERS)),
                    labels.posterior(quality.votes(t))) for t in set(texts.values()))
    scorer = quality.fit([unpacked(b, s) for b, s, _ in learn], np.array([t for *_, t in learn]))
    got = {r.doc_id: r for r in quality.query(spark, MID).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        grams = np.concatenate([gram_hashes(edged(t, False), n) for n in quality.ORDERS])
        x = (scorer.weights[grams, 0].mean() if len(grams) else 0.0) + scorer.base
        assert got[i].votes == seen[i]
        assert got[i].posterior == pytest.approx(labels.posterior(seen[i]), abs=1e-9)
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-x)), abs=1e-6)
        assert got[i].predicted == int(got[i].score >= 0.5)


def test_op2_odd_rows(spark):
    df = clashing(docs_frame(spark, ODD_TEXTS))
    got = quality.score_quality(df.unionAll(df)).collect()
    assert len(got) == 2 * len(ODD_TEXTS)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    assert quality.score_quality(docs_frame(spark, [])).count() == 0


def test_pipeline_against_its_parts(spark):
    """Every stage on what its predecessor kept, by plain Python with the same models."""
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    scorer = toxicity.Scorer(toxicity.train(docs, labels))
    rows = [r for r in docs.collect() if scorer.score(r.text)[0] < 0.7]
    after = spark.createDataFrame(rows, docs.schema)
    model = langid.train(after)
    rows = [r for r in rows if langid.recognise(r.text, model).known >= model.reject]
    rows.sort(key=lambda r: r.doc_id)
    prints = [simhash.fingerprint(r.text) for r in rows]
    first = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 4:
                a, b = sorted((first[i], first[j]))
                first = [a if f == b else f for f in first]
    kept = {rows[f].doc_id for f in first}
    out = corpus_pipeline.run(spark, MID).collect()
    assert {r.doc_id for r in out} == kept
    lengths = {}
    for r in out:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    total, used = sum(lengths.values()), len({r.sequence_id for r in out})
    assert used <= 1.02 * -(-total // packing.CAPACITY) + 1


def test_pipeline_stages_keep_columns(spark):
    df = clashing(docs_frame(spark, [*ODD_TEXTS, "The house of the man is a good house."]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, MID).columns == df.columns
        assert stage(spark, df.limit(0), MID).count() == 0
