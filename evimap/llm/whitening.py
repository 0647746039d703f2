"""Whitening of vectors by Chebyshev-filtered subspace iteration.

A vector c is taken on a grid, x = floor(64 c) + 1,000,000 (long).  The fit list
holds each distinct x once, so copies do not pull the axes; with n of them and
sums S, all of V = sum (x - S/n)(x - S/n)' / n is worked with through products
V Q alone: a pass over the fit list in which every task centres its rows (exact
integers n x - S before the one division), multiplies, and sends one matrix as
large as Q.  The largest eigenpairs of V are found by rounds over a block of
``2 * COMPONENTS`` columns: the three-term recurrence of a Chebyshev polynomial
of ``DEGREE``, small on the interval of the unwanted eigenvalues and growing fast
above it, then QR, then Rayleigh-Ritz.  The interval ends at the smallest Ritz
value of the block and starts below the least eigenvalue, as a few Lanczos steps
bound it.  Rounds end when each residual |V u - e u| is certified to be at most
``TOLERANCE`` of the largest eigenvalue (eigenvalues are then as near, vectors as
near as that over the gap to the next), or where rounding keeps them from falling
below ``FLOOR`` of it.  Nothing but matrices of the size of Q reaches the driver.

Rows take no part whose vector is null, empty, of another length than most
distinct vectors (of equally many lengths the greatest counts), or holds a null,
a NaN, an infinite entry or one of 2^46 and more.  Rows that repeat are given
each, also those with a null key.  Components with an eigenvalue of at most
``RANK`` of the trace have no scale and are left out, so a table of equal
vectors, or an empty one, gives no rows.  A deviation beyond a long is null.
Columns other than the two named are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evimap.llm.components import shared_folder

COMPONENTS, DEGREE, LANCZOS, SEED = 16, 10, 12, 20100411
TOLERANCE, FLOOR, RANK, ROUNDS = 1e-13, 1e-11, 1e-12, 200
GRID, SHIFT = 64, 1_000_000
#: Matrices that the driver adds up at most; above that many tasks they are added in tasks first.
PARTIALS = 64


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """k and v (doubles) of the rows that can take part, of any length."""
    v, bad = F.col("v"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(1 << 46))
    return df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, as whole numbers."""
    if len(x) and max(int(np.abs(x).max()) * n, max(map(abs, sums))) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class FitList:
    """Distinct grid vectors of one length, in the shared folder, and sums over them."""

    def __init__(self, rows: DataFrame) -> None:
        spark, folder = rows.sparkSession, f"{shared_folder(rows.sparkSession)}/grid-{uuid.uuid4()}"
        rows.select(F.transform("v", lambda c: F.floor(c * GRID) + SHIFT).alias("x")).groupBy("x").agg(F.size("x").alias("dim")).write.parquet(folder)
        stored = spark.read.parquet(folder)
        top = stored.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
        self.dim, self.n = (top["dim"], top["count"]) if top else (0, 0)
        self.rows = stored.where(F.col("dim") == self.dim).select("x")
        self.tasks = self.rows.rdd.getNumPartitions() if top else 0

        def add(batches):
            for batch in batches:
                x = matrix(batch.column(0))
                for lo in range(0, len(x), 256):  # 256 entries below 2^53 stay in a long
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1])), pa.array(x[lo : lo + 256].sum(0))], ["place", "part"])

        parts = self.rows.mapInArrow(add, "place long, part long").groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
        self.sums = [int(r.s) for r in sorted(parts.collect())] if top else []  # one number for each dimension

    def total(self, of) -> np.ndarray:
        """Sum over all rows of ``of(centred rows)``, an array of one shape."""
        n, sums = self.n, self.sums

        def part(batches):
            out = None
            for batch in batches:
                if batch.num_rows:
                    own = of(centred(matrix(batch.column(0)), n, sums).astype(np.float64) / n)
                    out = own if out is None else out + own
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], ["part"])

        def added(table: pa.Table) -> pa.Table:
            return pa.table({"part": [sum(np.frombuffer(b) for b in table["part"].to_pylist()).tobytes()]})

        parts = self.rows.mapInArrow(part, "part binary")
        if self.tasks > PARTIALS:
            parts = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(PARTIALS))).applyInArrow(added, "part binary")
        return sum(np.frombuffer(r.part) for r in parts.collect())

    def product(self, q: np.ndarray) -> tuple[np.ndarray, float]:
        """V q and the trace of V."""
        out = self.total(lambda c: np.append((c.T @ (c @ q)).ravel(), np.vdot(c, c)))
        return out[:-1].reshape(q.shape) / self.n, float(out[-1]) / self.n


def least_eigenvalue(product, dim: int, steps: int, rng: np.random.Generator) -> float:
    """A value that the least eigenvalue is hardly below: least Ritz value of a Lanczos run less its residual, and at least 0."""
    q = rng.standard_normal((dim, 1))
    basis, diagonal, side = [q / np.linalg.norm(q)], [], []
    for _ in range(steps):
        w = product(basis[-1])
        diagonal.append(float(basis[-1][:, 0] @ w[:, 0]))
        for _ in range(2):  # twice is enough
            for b in basis:
                w = w - b * float(b[:, 0] @ w[:, 0])
        side.append(float(np.linalg.norm(w)))
        if side[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(w / side[-1])
    t = np.diag(diagonal) + np.diag(side[: len(diagonal) - 1], 1) + np.diag(side[: len(diagonal) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - side[-1])


def filtered(product, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """Chebyshev polynomial of V on q: at most 1 on [low, high], scaled to 1 at ``top``; ``vq`` is V q."""
    middle, half = (low + high) / 2, (high - low) / 2
    first = step = half / (top - middle)
    before, now = q, (vq - middle * q) * (step / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - step)
        before, now = now, (product(now) - middle * now) * (2 * new / half) - before * (step * new)
        step = new
    return now


def eigenpairs(product, dim: int, k: int, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest eigenvalues (falling), unit eigenvectors as columns, and residual norms."""
    rng = np.random.default_rng(SEED)
    size = min(dim, 2 * k)
    low = least_eigenvalue(product, dim, min(LANCZOS, dim), rng) if size < dim else 0.0
    q = np.linalg.qr(rng.standard_normal((dim, size)))[0]
    last = []
    for _ in range(ROUNDS):
        w = product(q)
        t = q.T @ w
        e, z = np.linalg.eigh((t + t.T) / 2)
        e, z = e[::-1], z[:, ::-1]
        u, vu = q @ z, w @ z
        away = np.linalg.norm(vu[:, :k] - u[:, :k] * e[:k], axis=0)
        worst = float(away.max()) / e[0] if e[0] > 0 else 0.0
        stuck = len(last) > 2 and worst > 0.5 * min(last[:-2])
        if size == dim or worst <= TOLERANCE or worst <= FLOOR and stuck:
            return e[:k], u[:, :k], away
        last.append(worst)
        if e[-1] <= low:  # vectors below the interval grow as well
            low = 0.0
        q = np.linalg.qr(filtered(product, u, vu, low, max(e[-1], low + 1e-9 * e[0]), e[0], degree))[0]
    raise RuntimeError(f"residual {worst:.3g} after {ROUNDS} rounds")


def whitened(df: DataFrame, key: str, vector: str, k: int = COMPONENTS) -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows, kind = usable(df, key, vector), df.schema[key].dataType.simpleString()
    shape = f"k {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit, size = FitList(rows), 0
    if fit.n:
        trace = fit.product(np.zeros((fit.dim, 1)))[1]
        e, u, _ = eigenpairs(lambda q: fit.product(q)[0], fit.dim, min(k, fit.dim)) if trace > 0 else (np.zeros(0), np.zeros((fit.dim, 0)), None)
        size = int((e > RANK * trace).sum())
    if not size:
        return rows.limit(0).selectExpr("k", *(f"cast(null as {c.split()[1]}) {c.split()[0]}" for c in shape.split(", ")[1:])).withColumnRenamed("k", key)
    axes, share, n, sums, dim = u[:, :size] / np.sqrt(e[:size]), e[:size] / trace, fit.n, fit.sums, fit.dim

    def moments(c: np.ndarray) -> np.ndarray:
        w = c @ axes
        return np.vstack([w.T @ w, w.sum(0)])

    found = fit.total(lambda c: moments(c).ravel()).reshape(size + 1, size) / n
    error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(size)).max())

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                own = batch.slice(lo, 4096)
                x = np.floor(matrix(own.column(1)) * GRID).astype(np.int64) + SHIFT
                c = centred(x, n, sums)
                exact = c.astype(object) if len(c) and float(np.abs(c).max()) ** 2 * dim >= 1 << 62 else c
                far = [v if v < 1 << 63 else None for v in (exact * exact).sum(1).tolist()]
                w, m = (c.astype(np.float64) / n) @ axes, len(c)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0).take(pa.array(np.repeat(np.arange(m), size))), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)), pa.array(np.full(m * size, n)), pa.array(np.repeat(np.array(far, dtype=object), size), pa.int64()),
                     pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * size, error))],
                    ["k", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.where(F.size("v") == dim).mapInArrow(run, shape).withColumnRenamed("k", key)
