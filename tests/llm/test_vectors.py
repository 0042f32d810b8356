"""Operators 3 and 5 against brute force."""

import numpy as np
import pytest

from helpers import SF as SF_SMALL, clashing
from matchlake.llm import learned_ann, maxscore
from oracle_compare import duck, same

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def valid(rows):
    return [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]


def brute(rows, every, k, score):
    out = {}
    for q, a in rows:
        if q % every == 0:
            out[q] = sorted(((score(a, b), -i) for i, b in rows if i != q), reverse=True)[:k]
    return {q: [(s, -i) for s, i in r] for q, r in out.items()}


def inner(a, b):
    n = max(len(a), len(b))
    x, y = (np.pad(np.floor(1024 * v), (0, n - len(v))) for v in (a, b))
    return max(-2**63, min(2**63 - 1, sum(int(p) * int(q) for p, q in zip(x, y))))


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert len(out[r.query_id]) == r["rank"]
    return out


def made(n, d=8, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d).astype(np.float32).tolist()) for i in range(n)]
    for i in range(copies):  # a hot vector
        rows[-1 - i] = (rows[-1 - i][0], rows[3][1])
    return rows


def test_op3_oracle(spark):
    ok, why = same(maxscore.query(spark, SF_SMALL), _with_embeddings(), maxscore.ORACLE_SQL)
    assert ok, why


def _with_embeddings():
    con = duck(SF_SMALL)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    return con


@pytest.mark.parametrize("copies", [0, 150])
def test_op3_blocks_and_shards(spark, copies):
    rows = made(400, copies=copies)
    got = maxscore.search(table(spark, rows).repartition(4), every=20, k=7, query_block=6,
                          shard_rows=90)
    assert answers(got) == brute(valid(rows), 20, 7, inner)


ODD = [(0, [1.0, 2.0]), (100, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, None), (3, []),
       (4, [float("nan"), 1.0]), (5, [float("inf")]), (6, [0.5, None]), (7, [0.0, 0.0]),
       (None, [1.0]), (8, [3e38, -3e38]), (9, [-1.0, 0.25]), (200, [2e30, 1.0])]


def test_op3_odd_rows(spark):
    got = answers(maxscore.search(clashing(table(spark, ODD))))
    assert got == brute(valid(ODD), 100, 10, inner)
    twice = [*ODD[:3], *ODD[:3]]
    got = answers(maxscore.search(table(spark, twice)))
    assert [i for _, i in got[0]] == [1, 1, 100, 100]
    assert maxscore.search(table(spark, [])).count() == 0


def cos(a, b):
    n = max(len(a), len(b))
    x, y = (np.pad(v, (0, n - len(v))) for v in (a, b))
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float(x @ y / np.sqrt((x @ x) * (y @ y)))


def recall(got, want):
    hit = sum(len({i for _, i in got[q]} & {i for _, i in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def test_op5_query_recall(spark):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pydict()
    rows = valid(zip(t["vec_id"], t["embedding"]))
    got, want = answers(learned_ann.query(spark, SF_SMALL)), brute(rows, 50, 5, cos)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.9
    by = dict(rows)
    for q, found in got.items():
        for s, i in found:
            assert s == pytest.approx(cos(by[q], by[i]), abs=1e-12)


@pytest.mark.parametrize("copies", [0, 900])
def test_op5_partitions_shards_blocks(spark, copies):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=16)).astype(np.float32).tolist())
            for i in range(2500)]
    for i in range(copies):
        rows[2499 - i] = (rows[2499 - i][0], rows[7][1])
    rows.append((2600, rows[7][1]))
    got = answers(learned_ann.search(table(spark, rows).repartition(3), parts=8, sample_rows=900,
                                     query_block=20, shard_rows=150))
    want = brute(valid(rows), 50, 5, cos)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    if copies:  # all copies tie: the smallest ids
        assert [i for _, i in got[2600]] == [7, *range(1600, 1604)]


def test_router_looks_at_a_part():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20, 16))[rng.integers(0, 20, 2000)] * 4 + rng.normal(size=(2000, 16))
    router = learned_ann.fit(x[:1800], x[1800:], 16)
    assert router.probes <= 6
    label = learned_ann.balanced_parts(learned_ann.nearest(learned_ann.unit(x), learned_ann.unit(x),
                                                           10, True), 16, rng)
    assert np.bincount(label, minlength=16).max() <= 1.06 * 2000 / 16 + 1


def test_op5_odd_rows(spark):
    rows = [r for r in ODD if r[1] is None or any(r[1])]
    got = answers(learned_ann.search(clashing(table(spark, [*ODD]))))
    want = brute(valid(rows), 50, 5, cos)
    assert {q: [i for _, i in v] for q, v in got.items()} == \
        {q: [i for _, i in v] for q, v in want.items()}
    assert learned_ann.search(table(spark, [])).count() == 0
    assert learned_ann.search(table(spark, [(0, [1.0])])).count() == 0


def test_op3_threshold_of_earlier_slices():
    """Slices after the first are searched under the k-th score so far; ties go to small ids."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6))
    x[::7] = x[5]  # ties over all slices
    ids = rng.permutation(600)
    slices = [maxscore.Shard(ids[at:at + 90], x[at:at + 90]) for at in range(0, 600, 90)]
    for q, k in ((5, 10), (8, 1), (9, 700)):
        got = maxscore.best_of_slices(slices, int(ids[q]), x[q], k)
        whole = sorted(((inner(x[q], v), -int(i)) for i, v in zip(ids, x) if i != ids[q]),
                       reverse=True)[:k]
        assert list(zip(got[1].tolist(), (-got[0]).tolist())) == whole


@pytest.mark.parametrize("search,score", [(maxscore.search, inner), (learned_ann.search, cos)])
def test_different_vectors_of_one_query_id(spark, search, score):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (3, [2.0, 0.5]), (4, [0.25, 3.0])]
    got = [(r.vec_id, r.score) for r in search(table(spark, rows)).orderBy("rank").collect()]
    pairs = sorted(((score(np.array(a), np.array(b)), -i) for q, a in rows if q == 0
                    for i, b in rows if i), reverse=True)
    assert [i for i, _ in got] == [-i for _, i in pairs]
    assert [s for _, s in got] == pytest.approx([s for s, _ in pairs])
