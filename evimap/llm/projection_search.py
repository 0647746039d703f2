"""Nearest neighbours through low-dimensional stable projections and kd-trees.

Largest inner product is turned into least distance: candidates get one more
coordinate that brings all to the greatest norm, queries are scaled to it.
Each block of candidates is projected with a fixed Gaussian matrix to ``DIMS``
dimensions and indexed by a kd-tree.  The tree gives a query its candidates one
after the other by projected distance; each is verified by its true inner
product.  The search of a block stops before a candidate whose squared
projected distance, over the squared distance of the k-th best so far, passes
the ``SURE`` quantile of the chi-square distribution with ``DIMS`` degrees: a
nearer vector would have come up before with that probability.  So about
``SURE`` of the true neighbours are found, and more of the nearest ones.

Every row is indexed and every query meets every block; a block keeps its best
k, and the best k of all blocks remain.  Blocks and batches of queries are
bounded in bytes, and a candidate is sent once for each batch of ``QUERY_ROWS``
queries, a query once for each block.  Equal vectors are searched as one and
expanded to their smallest keys, which is exact.  Rows with a null key take no
part, nor vectors that are null, empty, zero or hold null or non-finite
components.  Keys are whole numbers; vectors of doubles are searched and scored as such.  Vectors of different lengths have no inner product: each length is
searched by itself.  A key that repeats counts once, with its least vector (a
shorter one before a longer one).  An empty table gives no rows, and only the
two columns named are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMS, SURE, SEED, LEAF = 24, 0.9, 20140901, 64
#: Bytes of the candidate vectors of a block, at most; rows of a block below which it is not split for more tasks.
BLOCK_BYTES, SMALL_BLOCK = 32_000_000, 32768
#: Queries of a batch, at most.
QUERY_ROWS = 65536


def chi_square_cut(dims: int, sure: float) -> float:
    """x with P(chi-square of ``dims`` (even) degrees <= x) = ``sure``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
        low, high = (x, high) if below < sure else (low, x)
    return high


def tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """kd-tree by median splits of the widest side: order of the points, starts of the leaves, and their boxes."""
    order, starts, stack = np.arange(len(points)), [], [(0, len(points))]
    while stack:
        a, b = stack.pop()
        if b - a <= leaf:
            starts.append(a)
            continue
        own = points[order[a:b]]
        side, mid = int(np.argmax(own.max(0) - own.min(0))), (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(own[:, side], mid)]
        stack += [(a, a + mid), (a + mid, b)]
    starts = np.sort(np.array(starts))
    return order, starts, np.minimum.reduceat(points[order], starts), np.maximum.reduceat(points[order], starts)


class Index:
    """A block of distinct candidate vectors in the order of its tree."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, k: int, norm: float, unit: float = 1.0) -> None:
        raw = np.ascontiguousarray(vectors).view([("", vectors.dtype)] * vectors.shape[1]).ravel()
        sort = np.lexsort((keys, np.unique(raw, return_inverse=True)[1]))
        keys, vectors = keys[sort], vectors[sort].astype(np.float64)
        first = np.flatnonzero(np.concatenate([[True], (vectors[1:] != vectors[:-1]).any(1)]))
        members, distinct = np.split(keys, first[1:]), vectors[first]
        self.unit, scaled = unit, distinct / unit
        lift = np.sqrt(np.maximum(0, norm**2 - (scaled**2).sum(1)))
        self.matrix = np.random.default_rng(SEED).standard_normal((distinct.shape[1] + 1, DIMS))
        points = np.column_stack([scaled, lift]) @ self.matrix
        order, self.starts, self.low, self.high = tree(points)
        self.ends = np.append(self.starts[1:], len(order))
        self.points, self.vectors, self.members, self.norm = points[order], distinct[order], [members[i][: k + 1] for i in order], norm
        self.squares = (self.points * self.points).sum(1)

    def candidates(self, at: np.ndarray):
        """Rows and squared projected distances from ``at``, in ascending runs: no later run has a smaller distance."""
        gap = np.maximum(0, np.maximum(self.low - at, at - self.high))
        bound = (gap * gap).sum(1)
        leaves = np.argsort(bound, kind="stable")
        rows, far, done, step = np.zeros(0, np.int64), np.zeros(0), 0, 48
        while done < len(leaves) or len(rows):
            took = leaves[done : done + step]
            done, step = done + len(took), min(2 * step, 384)
            sizes = self.ends[took] - self.starts[took]
            new = np.repeat(self.starts[took] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            rows, far = np.concatenate([rows, new]), np.concatenate([far, np.maximum(0, self.squares[new] + at @ at - 2 * (self.points[new] @ at))])
            ready = far <= (bound[leaves[done]] if done < len(leaves) else np.inf)
            order = np.argsort(far[ready])
            yield rows[ready][order], far[ready][order]
            rows, far = rows[~ready], far[~ready]

    def nearest(self, key: int, q: np.ndarray, k: int, cut: float) -> tuple[list[tuple[float, int]], int]:
        """(-score, key) of the best k but ``key`` itself, and how many vectors were verified."""
        exact_q, q = q, q / np.abs(q).max() if self.unit != 1.0 else q
        scale = self.norm / math.sqrt(float(q @ q))
        rows, scores, worst, n, size, stop = [], [], -np.inf, 0, 128, False
        for own, far in self.candidates((q * scale) @ self.matrix[:-1]):
            a = 0
            while a < len(own):
                limit = cut * max(2 * self.norm**2 - 2 * scale * worst, 0.0) + 1e-9 if worst > -np.inf else np.inf
                if far[a] >= limit:
                    stop = True
                    break
                took = own[a : a + size]
                a, size = a + size, min(2 * size, 2048)
                rows.append(took), scores.append(self.vectors[took] @ q if self.unit == 1.0 else (self.vectors[took] / self.unit) @ q)
                n += len(took)
                every = np.concatenate(scores)
                if len(every) > k:
                    best = np.argpartition(every, len(every) - k - 1)[len(every) - k - 1 :]
                    worst = float(every[best].min())
                    keep = every >= worst - 1e-9
                    rows, scores = [np.concatenate(rows)[keep]], [every[keep]]
            if stop:
                break
        own = np.concatenate(rows)
        with np.errstate(over="ignore"):
            exact = (self.vectors[own] * exact_q).sum(1)
        return sorted((-s, int(i)) for s, r in zip(exact.tolist(), own.tolist()) for i in self.members[r] if i != key)[:k], n


def search_block(keys: np.ndarray, vectors: np.ndarray, query_keys: np.ndarray, queries: np.ndarray, k: int, norm: float, sure: float = SURE, unit: float = 1.0) -> tuple[list[tuple[int, int, float]], int]:
    """(query, key, score) of the best k in this block for each query, and how many vectors were verified in all."""
    index, cut, out, verified = Index(keys, vectors, k, norm, unit), chi_square_cut(DIMS, sure), [], 0
    for key, q in zip(query_keys.tolist(), queries.astype(np.float64)):
        found, n = index.nearest(key, q, k, cut)
        out += [(key, i, -s) for s, i in found]
        verified += n
    return out, verified


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    v, kind = F.col("v"), "float" if df.schema[vector].dataType.simpleString() == "array<float>" else "double"
    fine = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    return fine.groupBy("id").agg(F.min(F.struct(F.size("v").alias("dim"), "v")).alias("x")).select("id", "x.dim", "x.v")


def nearest(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id and score of the k largest inner products of each query row.

    ``is_query`` is a condition on column ``id`` (the key).  A query is no
    neighbour of itself; ties go to the smaller key.
    """
    rows = usable(df, key, vector)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    facts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(square).alias("m"), F.max(F.array_max(F.transform("v", F.abs))).cast("double").alias("u")).collect()  # one row for each length
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    # where squares pass the range of a double (or vanish), lengths are measured in the greatest entry
    units = {r.dim: 1.0 if 1e-280 < r.m < 1e280 else r.u for r in facts}
    norms, sizes = {r.dim: math.sqrt(r.m) if units[r.dim] == 1.0 else math.sqrt(r.dim) for r in facts}, {}
    for r in facts:
        most = max(1, BLOCK_BYTES // (8 * r.dim))
        blocks = max(-(-r.n // most), min(tasks, -(-r.n // SMALL_BLOCK)))
        sizes[r.dim] = (blocks, max(1, -(-r.q // QUERY_ROWS), min(-(-tasks // blocks), -(-r.q // 512))))
    shape = F.create_map(*(F.lit(x) for d, (c, q) in (sizes or {0: (1, 1)}).items() for x in (d, f"{c},{q}")))[F.col("dim")]
    of = lambda i: F.split(shape, ",")[i].cast("int")
    dealt = rows.withColumns({"cs": of(0), "qs": of(1), "h": F.xxhash64("id")})
    left = dealt.withColumn("c", F.pmod("h", "cs").cast("int")).select("dim", "c", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"), "id", "v")
    right = dealt.where(is_query).withColumn("q", F.pmod("h", "qs").cast("int")).select("dim", F.explode(F.sequence(F.lit(0), F.col("cs") - 1)).alias("c"), "q", "id", "v")

    def block(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        got = []
        if candidates.num_rows and queries.num_rows:
            sides = [(t["id"].to_numpy(), t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)) for t in (candidates, queries)]
            dim = candidates["dim"][0].as_py()
            got, _ = search_block(*sides[0], *sides[1], k, norms[dim], sure, units[dim])
        return pa.table({"query_id": pa.array([x[0] for x in got], pa.int64()), "vec_id": pa.array([x[1] for x in got], pa.int64()), "score": pa.array([x[2] for x in got], pa.float64())})

    best = left.groupBy("dim", "c", "q").cogroup(right.groupBy("dim", "c", "q")).applyInArrow(block, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
