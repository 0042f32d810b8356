"""Operator 11 against a full eigendecomposition."""

import math
from decimal import Decimal

import numpy as np

from helpers import SF
from matchlake.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def integers(rows):
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in kept)
    x = [[math.floor(1024 * c) + 100_000 for c in np.pad(v, (0, width - len(v)))] for _, v in kept]
    return [i for i, _ in kept], x


def check(df, rows, components=8):
    ids, x = integers(rows)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    c = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, len(sums))
    out = df.collect()
    assert len(out) == n * k
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.component), []).append(r)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    for r in out:
        assert r.n == n
        if r.whitened is not None:
            assert abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-12
            assert r.identity_error < 1e-9
    for at in range(n):
        for j in range(1, k + 1):
            assert any(int(r.deviation) == deviation[at] for r in by[ids[at], j])
    white = c @ vectors[:, :k] / np.sqrt(np.maximum(values[:k], 1e-300))
    for j in range(k):
        near = values[j] * 1e-6
        if any(abs(values[j] - values[i]) < near for i in range(len(values)) if i != j):
            continue
        got = np.array([sorted([r.whitened for r in by[i, j + 1]], key=abs)[0] for i in ids])
        want = white[:, j]
        if len(set(ids)) == len(ids):
            sign = np.sign(got @ want)
            assert np.abs(got * sign - want).max() < 1e-8 * max(1, np.abs(want).max())
    return values


def test_op11_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(W.query(spark, SF), rows)


def test_op11_ties_nulls_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=6) * [9, 3, 3, 1, 1, .1]).tolist()) for i in range(80)]
    rows += [rows[4]] * 30 + [(None, [1.0] * 6), (200, [1.0, 2.0]), (201, []), (-5, [0.5] * 5)]
    bad = [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6)]
    df = table(spark, rows + bad)
    for c in ("x", "i", "n", "component", "whitened"):
        df = df.selectExpr("*", f"'x' AS {c}")
    out = W.whiten(df.repartition(3))
    assert set(out.columns) == {"vec_id", "component", "n", "deviation", "whitened", "explained",
                                "identity_error"}
    check(out, rows)


def test_op11_huge_numbers_are_exact(spark):
    rows = [(0, [3e8, 1.0]), (1, [-3e8, 2.0]), (2, [1e8, 4.0]), (3, [7.0, -2e8])]
    check(W.whiten(table(spark, rows)), rows)
    wide = W.whiten(table(spark, [(0, [3e38]), (1, [-3e38]), (2, [1.0])])).collect()
    assert len(wide) == 3 and all(r.deviation > Decimal(10) ** 30 or r.vec_id == 2 for r in wide)


def test_op11_no_variance_and_empty(spark):
    same = W.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(4)])).collect()
    assert len(same) == 8
    assert all(r.whitened is None and r.explained is None and r.deviation == 0
               and r.identity_error is None for r in same)
    flat = W.whiten(table(spark, [(i, [float(i), 2.0]) for i in range(5)])).collect()
    assert {r.component: r.explained for r in flat}[2] == 0.0
    assert all((r.whitened is None) == (r.component == 2) for r in flat)
    for rows in ([], [(1, None)], [(1, [])]):
        assert W.whiten(table(spark, rows)).count() == 0


def matrix(values, seed=1):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    return (q * values) @ q.T


def test_jacobi_davidson_restarts_and_clusters():
    """Spaces far smaller than the matrix, close and repeated eigenvalues, wide spectra."""
    for values, space, kept in [
            (1 / np.arange(1.0, 301), 40, 20),
            (np.concatenate([np.full(12, 5.0), np.linspace(0, 4, 188)]), 48, 24),
            (10.0 ** -np.linspace(0, 12, 150), 32, 16),
            (np.concatenate([[3, 3, 3 - 1e-9], np.linspace(0, 2.9, 97)]), 96, 32)]:
        a = matrix(values)
        found, vectors = W.leading_pairs(lambda b: a @ b, len(a), 8, space, kept)
        want = np.sort(values)[::-1][:8]
        assert np.abs(found - want).max() < 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13
        assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-12 * want[0]


def test_minres_has_the_least_residual_in_the_krylov_space():
    a = matrix(np.linspace(-3, 9, 40))
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(40, 3)))[0]
    p = np.eye(40) - q @ q.T
    right, shifts = p @ rng.normal(size=(40, 2)), np.array([1.5, 4.0])
    got = W.minres(lambda b: a @ b, shifts, q, right, 5)
    for j in range(2):
        m = p @ (a - shifts[j] * np.eye(40)) @ p
        krylov = np.stack([np.linalg.matrix_power(m, k) @ right[:, j] for k in range(5)], axis=1)
        space = np.linalg.qr(krylov)[0]
        best = space @ np.linalg.lstsq(m @ space, right[:, j], rcond=None)[0]
        assert np.linalg.norm(got[:, j] - best) < 1e-8 * np.linalg.norm(best)
