"""Whitening of integer embeddings by a block Jacobi-Davidson eigensolver.

The covariance matrix is never formed.  It is known only through distributed
products: one pass over the rows centres each row, multiplies it with a few
vectors and adds up what comes back (one row per dimension and task reaches the
shuffle, one row per dimension the driver).

1. A search space starts from random vectors.  Rayleigh-Ritz on its product gives
   the leading Ritz pairs and their residuals.
2. For each wanted pair that has not converged, MINRES solves the correction
   equation ``(I - QQ')(V - theta)(I - QQ') t = -r``, Q being the locked vectors
   and the current Ritz vectors.  All equations take a step at once, with one
   distributed product.
3. The corrections widen the search space, which is cut back to its best Ritz
   vectors when it is full.
4. Leading pairs are locked when their residual is down to the rounding of a
   product in double precision; locked vectors are checked with a fresh product.

The driver holds dimensions x ``SPACE`` numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import arrow_schema, read_table, save
from matchlake.llm.vectors import finite_vector

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
START_VECTORS = 16
SPACE = 96  # vectors of the search space before it is cut back
KEPT = 32  # what is left of it then
INNER_STEPS = 4  # MINRES steps, each one distributed product
PRECISION = 2.0 ** -46  # residual of a locked pair, relative to the largest eigenvalue,
                        # for up to 64 dimensions; it grows with their square root
ROUNDS = 400
LARGEST = 2 ** 52  # 1024 c beyond it, on either side, counts as this
HALF = 26


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that remain: x holds floor(1024 c) + 100000 as longs.

    Vectors shorter than the longest are filled up with c = 0.
    """
    vec, finite = finite_vector("embedding")
    rows = table.filter(finite).select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("c"))
    most = F.lit(float(LARGEST))
    x = F.transform("c", lambda c: F.floor(F.least(F.greatest(c * SCALE, -most), most)) + SHIFT)
    rows = save(rows.select("vec_id", x.alias("x")), "whitening")
    width = rows.agg(F.max(F.size("x")).alias("w"), F.min(F.size("x")).alias("v")).first()
    if width.w == width.v:
        return rows
    fill = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width.w) - F.size("x"))
    return rows.select("vec_id", F.concat("x", fill).alias("x"))


def _rows(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten()
    return flat.to_numpy().reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, made: Callable[[np.ndarray], np.ndarray], columns: int,
            kind: str = "double") -> np.ndarray:
    """The sum over all rows of ``made`` (batch matrix -> dimensions x columns), from one pass."""
    names = [f"y{j}" for j in range(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = made(_rows(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)))] + [pa.array(c) for c in total.T],
                names=["i", *names])

    schema = ", ".join(["i long", *(f"{n} {kind}" for n in names)])
    got = (rows.select("x").mapInArrow(run, schema).groupBy("i")
           .agg(*[F.sum(n).alias(n) for n in names]).toArrow().sort_by("i"))
    return np.stack([got[n].to_numpy() for n in names], axis=1)


def _halves(x: np.ndarray) -> np.ndarray:
    """Sums of the high and low halves and the number of rows, exact in 64 bits."""
    return np.stack([(x >> HALF).sum(axis=0), (x & (1 << HALF) - 1).sum(axis=0),
                     np.full(x.shape[1], len(x))], axis=1)


class Fit:
    """Counts, exact sums and centred products of the rows."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        sums = _summed(rows, _halves, 3, "long")
        self.n = int(sums[0, 2]) if len(sums) else 0
        self.sums = [(int(a) << HALF) + int(b) for a, b, _ in sums]
        # x - S/n as an exact difference of integers less a fraction below one
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.float64) / max(1, self.n)
        self.passes = 0

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        whole, rest = self.whole, self.rest
        return lambda x: (x - whole).astype(np.float64) - rest

    def trace(self) -> float:
        centred = self.centred()
        squares = _summed(self.rows, lambda x: (centred(x) ** 2).sum(axis=0)[:, None], 1)
        return float(squares.sum()) / self.n

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """V @ vectors."""
        centred = self.centred()

        def made(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ vectors)

        self.passes += 1
        return _summed(self.rows, made, vectors.shape[1]) / self.n


def _orthonormal(new: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``spaces``."""
    against = np.concatenate(spaces, axis=1)
    out = np.zeros((len(new), 0))
    for v in new.T:
        size = np.linalg.norm(v)
        if not size or not np.isfinite(size):
            continue
        v = v / size
        for _ in range(3):
            for q in (against, out):
                v = v - q @ (q.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            out = np.concatenate([out, v[:, None]], axis=1)
    return out


def minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, q: np.ndarray,
           right: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` steps of MINRES on every column of (I - QQ')(V - shift)(I - QQ') t = right.

    The columns are systems of their own that share the distributed products.
    Lanczos vectors are made by the three-term recurrence, Givens rotations keep
    the small triangular system.
    """
    def project(v: np.ndarray) -> np.ndarray:
        v = v - q @ (q.T @ v)
        return v - q @ (q.T @ v)

    def divide(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros_like(a), where=b != 0)

    v = project(right)
    beta = np.linalg.norm(v, axis=0)
    v, before = divide(v, np.broadcast_to(beta, v.shape)), np.zeros_like(v)
    left, t = beta.copy(), np.zeros_like(v)  # what is left of the right side; the solution
    d1, d2 = np.zeros_like(v), np.zeros_like(v)
    c1, s1, c2, s2 = (np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta),
                      np.zeros_like(beta))
    last = np.zeros_like(beta)
    for _ in range(steps):
        if not beta.any():
            break
        w = project(product(v) - v * shifts)
        alpha = (v * w).sum(axis=0)
        w = w - v * alpha - before * last
        after = np.linalg.norm(w, axis=0)
        after[after < 1e-14 * np.abs(shifts)] = 0
        r3, tail = s2 * last, c2 * last  # the column of the tridiagonal matrix, rotated
        r2, r1 = c1 * tail + s1 * alpha, c1 * alpha - s1 * tail
        size = np.hypot(r1, after)
        direction = divide(v - d1 * r2 - d2 * r3, np.broadcast_to(size, v.shape))
        c, s = divide(r1, size), divide(after, size)
        t = t + direction * (c * left)
        left = -s * left
        d2, d1 = d1, direction
        c2, s2, c1, s1 = c1, s1, c, s
        before, v = v, divide(w, np.broadcast_to(after, w.shape))
        last = after
        beta = np.abs(left) * (after > 0)
    return project(t)


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int,
                  space: int = SPACE, kept: int = KEPT, start: int = START_VECTORS,
                  seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns) of the symmetric matrix behind
    ``product``, at most ``wanted`` and at most ``dims`` of them."""
    wanted = min(wanted, dims)
    random = np.random.default_rng(seed)
    precision = PRECISION * max(1.0, (dims / 64) ** 0.5)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    basis = _orthonormal(random.normal(size=(dims, min(dims, max(start, wanted)))), locked)
    image = product(basis)
    for _ in range(ROUNDS):
        small, turn = np.linalg.eigh(basis.T @ image)
        theta, turn = small[::-1], turn[:, ::-1]
        ritz, across = basis @ turn, image @ turn
        scale = max(theta[0] if len(theta) else 0.0, values[0] if len(values) else 0.0, 0.0)
        need = wanted - len(values)
        residual = across[:, :need] - ritz[:, :need] * theta[:need]
        sizes = np.linalg.norm(residual, axis=0)
        good = sizes <= precision * scale
        whole = basis.shape[1] + locked.shape[1] == dims  # nothing is left to search
        ready = need if whole else int(np.argmin(good)) if not good.all() else need
        if ready:  # lock leading pairs, in order
            locked = np.concatenate([locked, ritz[:, :ready]], axis=1)
            values = np.concatenate([values, theta[:ready]])
            basis, image = ritz[:, ready:], across[:, ready:]
            theta, ritz, across = theta[ready:], basis, image
            residual, need = residual[:, ready:], need - ready
        if not need and len(theta) and theta[0] > values.min() + precision * scale:
            # A larger eigenvalue came up late: the locked vectors join the search again
            basis, locked, values = np.concatenate([locked, basis], axis=1), locked[:, :0], values[:0]
            image = product(basis)
            continue
        if not need:
            # A fresh product of the locked vectors, and a last Rayleigh-Ritz over them
            fresh = product(locked)
            values, turn = np.linalg.eigh(locked.T @ fresh)
            locked = locked @ turn[:, ::-1]
            return np.maximum(values[::-1], 0.0), locked
        if basis.shape[1] > space:
            basis, image = ritz[:, :kept], across[:, :kept]
        todo = min(need, ritz.shape[1])
        guess = minres(product, theta[:todo], np.concatenate([locked, ritz[:, :todo]], axis=1),
                       -residual[:, :todo], INNER_STEPS)
        new = _orthonormal(guess, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(random.normal(size=(dims, wanted)), locked, basis)
        new = new[:, :dims - locked.shape[1] - basis.shape[1]]
        basis = np.concatenate([basis, new], axis=1)
        image = np.concatenate([image, product(new)], axis=1)
    raise ValueError(f"no convergence of {wanted} eigenpairs in {ROUNDS} rounds")


SCHEMA = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
          "explained double")


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per remaining
    row and component.

    Rows whose vector is null or holds null or non-finite entries are dropped; a
    null or repeated vec_id stays as it is.  Shorter vectors are filled up with
    zeros, 1024 c beyond 2**52 on either side counts as that.  Fewer dimensions than components:
    as many components as dimensions.  A component without variance (eigenvalue
    within rounding of zero) has a null ``whitened`` and explains 0; without any
    variance ``explained`` is null; without a whitened component so is
    ``identity_error``.  A deviation over 38 digits is null.  No row: no rows.
    Other columns are ignored.
    """
    spark = table.sparkSession
    rows = integer_vectors(table)
    fit = Fit(rows)
    empty = SCHEMA + ", identity_error double"
    if not fit.n or not len(fit.sums):
        return spark.createDataFrame([], empty)
    dims, n = len(fit.sums), fit.n
    trace = fit.trace()
    values, vectors = leading_pairs(fit.product, dims, components)
    live = values > max(trace, 0.0) * dims * 2.0 ** -50
    factors = vectors[:, live] / np.sqrt(values[live])
    error = _identity_error(rows, fit.centred(), factors, n) if live.any() else None
    centred, whole, sums = fit.centred(), fit.whole, fit.sums
    rests = np.array([s % n for s in sums], np.int64)
    count = len(values)
    explained = [float(e / trace) if ok else 0.0 for e, ok in zip(values, live)] if trace > 0 \
        else [None] * count
    schema = arrow_schema(spark.createDataFrame([], SCHEMA).schema)

    def deviations(x: np.ndarray) -> pa.Array:
        apart = x - whole
        largest = int(np.abs(apart).max(initial=0)) + 1
        if dims * (n * largest) ** 2 < 2 ** 63:
            d = n * apart - rests
            return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = [sum((n * a - r) ** 2 for a, r in zip(row, rests.tolist()))
                 for row in apart.tolist()]
        return pa.array([str(e) if e < 10 ** 38 else None for e in exact], pa.string()) \
            .cast(pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _rows(batch), batch.num_rows
            white = np.full((m, count), np.nan)
            white[:, live] = centred(x) @ factors
            each = np.repeat(np.arange(m), count)
            flat = white.reshape(-1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                pa.array(np.full(m * count, n)),
                deviations(x).take(pa.array(each)),
                pa.array(flat, mask=np.isnan(flat)),
                pa.array(explained * m, pa.float64())], schema=schema)

    return rows.select("vec_id", "x").mapInArrow(run, SCHEMA) \
        .withColumn("identity_error", F.lit(error).cast("double"))


def _identity_error(rows: DataFrame, centred, factors: np.ndarray, n: int) -> float:
    """Largest entry of the covariance of the whitened rows less the identity."""
    k = factors.shape[1]
    mean = _summed(rows, lambda x: (centred(x) @ factors).sum(axis=0)[:, None], 1)[:, 0] / n

    def made(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ factors - mean
        return w.T @ w

    return float(np.abs(_summed(rows, made, k) / n - np.eye(k)).max())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened table; ``deviation`` as a long (null beyond one), and exact besides."""
    out = whiten(read_table(spark, sf_dir, "embeddings"))
    exact = F.col("deviation")
    return out.select("vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)")
                      .alias("deviation"), "whitened", "explained", "identity_error",
                      exact.alias("deviation_exact"))
