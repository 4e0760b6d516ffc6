"""Embedding whitening by Jacobi-Davidson.

The covariance matrix is never formed: a product with it is one pass over the
distinct vectors, for a block of columns at once. The search space grows by
solutions of the projected correction equations (inner MINRES, one pass a
step for all columns); Rayleigh-Ritz in the space, locking of what has
converged, until every wanted pair has a residual of rounding size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize

COMPONENTS = 16
#: a vector entry c becomes floor(SCALE * c) + OFFSET
SCALE, OFFSET = 64, 1_000_000
INNER_STEPS = 8
INNER_RTOL = 0.05
OUTER_STEPS = 300
#: residuals, times dimension and rounding unit, relative to the largest eigenvalue
TOLERANCE = 4 * np.finfo(float).eps
#: entries beyond this don't fit a long after scaling
LARGEST = 2.0 ** 56

RESULT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
                 "identity_error double")


def _orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the part of the columns outside ``against``."""
    out = np.zeros((len(columns), 0))
    for c in columns.T:
        size = np.linalg.norm(c)
        if not size or not np.isfinite(size):
            continue
        c = c / size
        for _ in range(3):
            for space in (against, out):
                c = c - space @ (space.T @ c)
            length = np.linalg.norm(c)
            if length < 1e-10:
                break
            c = c / length
        else:
            out = np.column_stack((out, c))
    return out


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, rtol: float) -> np.ndarray:
    """Minimal residual solutions of symmetric systems, a column each, in
    lockstep; ``apply`` takes and gives a block."""
    size = np.linalg.norm(rhs, axis=0)
    beta = np.where(size > 0, size, 1.0)
    v, v_old = rhs / beta, np.zeros_like(rhs)
    w, w_old, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    eta, c, c_old = size.copy(), np.ones(len(size)), np.ones(len(size))
    s, s_old, beta = np.zeros(len(size)), np.zeros(len(size)), np.zeros(len(size))
    live = size > 0
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, beta_new)
        r2, r3 = s * alpha + c_old * c * beta, s_old * beta
        live &= r1 > 0
        safe = np.where(live, r1, 1.0)
        c_old, s_old, c, s = c, s, np.where(live, delta / safe, 1.0), np.where(live, beta_new / safe, 0.0)
        w, w_old = (v - r3 * w_old - r2 * w) / safe, w
        x = x + np.where(live, c * eta, 0.0) * w
        eta = -s * eta
        live &= (np.abs(eta) > rtol * size) & (beta_new > 0)
        if not live.any():
            break
        v, v_old = p / np.where(beta_new > 0, beta_new, 1.0), v
        beta = beta_new
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 1) \
        -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive matrix,
    falling, and their unit vectors as columns. ``product`` multiplies the
    matrix with a block of columns."""
    wanted = min(wanted, dim)
    most, keep = max(4 * wanted, 24), wanted + wanted // 2 + 4
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + 4))), locked)
    image = product(basis)
    for _ in range(OUTER_STEPS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        left = wanted - len(values)
        target, theta_now = basis[:, :left], theta[:left]
        residual = image[:, :left] - target * theta_now
        residual = residual - locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        bound = TOLERANCE * dim * max([0.0, *np.abs(theta[:1]), *values[:1]])
        whole = basis.shape[1] + locked.shape[1] >= dim  # Rayleigh-Ritz in the whole space is exact
        done = int(np.argmin(np.append(size <= bound, False))) if not whole else left
        if done:
            locked = np.column_stack((locked, _orthonormal(basis[:, :done], locked)))
            values = np.append(values, theta[:done])
            basis, image, theta = basis[:, done:], image[:, done:], theta[done:]
            if len(values) >= wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
        target, theta_now, residual = target[:, done:], theta_now[done:], residual[:, done:]
        if basis.shape[1] + residual.shape[1] > most:
            basis, image = basis[:, :keep], image[:, :keep]
        around = np.column_stack((locked, target))

        def outside(z):
            return z - around @ (around.T @ z)

        correction = minres(lambda z: outside(product(outside(z)) - z * theta_now), -outside(residual),
                            INNER_STEPS, INNER_RTOL)
        more = _orthonormal(correction, np.column_stack((locked, basis)))
        if not more.shape[1]:  # no direction is left: a random one, at rounding size
            more = _orthonormal(np.random.default_rng(seed + len(values)).standard_normal((dim, 1)),
                                np.column_stack((locked, basis)))
        basis, image = np.column_stack((basis, more)), np.column_stack((image, product(more)))
    raise ArithmeticError(f"{wanted - len(values)} pairs have not converged in {OUTER_STEPS} steps")


class _Centre:
    """Sums of the fit list, and exact distances from its mean: with
    ``base = S div n`` and ``rest = S mod n``, ``n*x - S = n*(x - base) - rest``."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dim = n, len(sums)
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(-1, self.dim) - self.base

    def centred(self, column: pa.Array) -> np.ndarray:
        """x - S/n, in doubles."""
        return self.rows(column).astype(np.float64) - self.rest / self.n

    def deviation(self, column: pa.Array) -> pa.Array:
        """Sum over dimensions of (n*x - S)**2; null where no long holds it."""
        rows = self.rows(column)
        most = int(np.abs(rows).max(initial=0)) + 1
        if self.dim * (self.n * most) ** 2 < 1 << 62:
            return pa.array(((self.n * rows - self.rest) ** 2).sum(axis=1))
        exact = ((self.n * rows.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([int(x) if x < 1 << 63 else None for x in exact], pa.int64())


def _column_sums(batches):
    """Sums of the two halves of the numbers, by dimension: no half overflows."""
    for batch in batches:
        if batch.num_rows:
            rows = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            high = rows >> 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows.shape[1], dtype=np.int32)), pa.array(high.sum(axis=0)),
                 pa.array((rows - (high << 32)).sum(axis=0))], names=["at", "high", "low"])


def _summed(fit: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray], centre: _Centre) -> np.ndarray:
    """The sum of ``part(centred rows)``, flattened, over the fit list: one
    partial sum a task, added up by Spark, ``size`` numbers to the driver."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(centre.centred(batch.column(0))).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)],
                                         names=["at", "x"])

    out = np.zeros(size)
    for r in fit.mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r["x"]
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)`` for each row and component (at most the dimension).

    Rows whose vector is null or empty or holds null or non-finite entries go, as do
    those with entries beyond 2**56, which no long holds after scaling, and
    those whose length is not the most frequent one (the larger of equals).
    Entries become ``floor(64 * c) + 1000000``; the fit list has each distinct
    vector once. Repeated rows and ids stay. A component without variance
    (eigenvalue of rounding size: fewer distinct vectors than components) has
    a null ``whitened`` and counts in no ``identity_error``; a ``deviation``
    that no long holds is null. An empty table gives no rows.

    The fit list is written once and read by every product; the driver holds
    dimension x search space numbers, whatever the number of rows.
    """
    spark = vectors.sparkSession
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")) \
        .filter(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST)))
    widths = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("held")).filter("dim > 0")
    width = widths.orderBy(F.desc("held"), F.desc("dim")).first()
    if width is None:
        return spark.createDataFrame([], RESULT_SCHEMA)
    dim = width["dim"]
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    rows = materialize(rows.filter(F.size("v") == dim).select("vec_id", x.alias("x")), "rows", "zstd")
    fit = materialize(rows.select("x").distinct(), "fit", "zstd")
    n = fit.count()
    halves = fit.mapInArrow(_column_sums, "at int, high long, low long").groupBy("at").agg(
        *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]).orderBy("at").collect()
    centre = _Centre(n, [(int(r["high"]) << 32) + int(r["low"]) for r in halves])
    trace = _summed(fit, 1, lambda y: np.array([(y * y).sum()]), centre)[0] / n

    def product(columns: np.ndarray) -> np.ndarray:
        block = np.ascontiguousarray(columns)
        return _summed(fit, block.size, lambda y: y.T @ (y @ block), centre).reshape(block.shape) / n

    values, axes = jacobi_davidson(product, dim, components)
    k = len(values)
    lead = np.abs(axes).argmax(axis=0)
    axes = axes * np.sign(axes[lead, np.arange(k)])  # the largest entry is positive
    sound = values > 8 * dim * np.finfo(float).eps * max(values[0], 0)
    scale = np.where(sound, 1 / np.sqrt(np.where(sound, values, 1)), 0.0)
    # whitened in the same way for every use below
    mean = _summed(fit, k, lambda y: (y @ axes * scale).sum(axis=0), centre) / n
    spread = _summed(fit, k * k, lambda y: (lambda z: z.T @ z)(y @ axes * scale - mean), centre).reshape(k, k) / n
    off = np.abs(spread - np.eye(k))[np.ix_(sound, sound)]
    error = float(off.max()) if off.size else None
    explained = values / trace if trace > 0 else None

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            z = centre.centred(batch.column(1)) @ axes * scale
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n, np.int64)), centre.deviation(batch.column(1)).take(each),
                 pa.array(z.ravel(), mask=np.tile(~sound, m)),
                 pa.nulls(m * k, pa.float64()) if explained is None else pa.array(np.tile(explained, m)),
                 pa.array([error] * (m * k), pa.float64())],
                names=[c.split()[0] for c in RESULT_SCHEMA.split(", ")])

    return rows.mapInArrow(run, RESULT_SCHEMA)
