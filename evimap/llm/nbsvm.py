"""Naive Bayes support vectors for a two-class text score.

Features are indicators of byte n-grams, hashed into ``2**bits`` places.  Each
is scaled by its class log-count ratio, rows are brought to about unit length
(``damping`` keeps short texts near the prior), and a linear model with the
hinge loss is fitted by dual coordinate descent.  Besides byte n-grams there is one
n-gram of words for each length: that many equal words in a row.  A logistic
curve turns margins into scores.  The fit uses a bounded sample of labelled
rows (``sample_rows``, in the order of a hash of the key); every row is scored.

Null and empty texts have no features and get the score of margin ``bias``.
Rows without a label are scored only; where labels of one key disagree, the
lowest counts.  With labels of one class, or none, every score is that class's
share (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H

GRAM_BYTES, BITS, SAMPLE_ROWS = 3, 18, 8000
THRESHOLD = 0.7
#: Share of the median squared length that is added to every squared length.
DAMPING = 0.2


@dataclass
class Model:
    weight: np.ndarray  # ratio times model weight, by place
    ratio: np.ndarray
    damping: float
    bias: float
    slope: float
    shift: float


def features(column, k: int = GRAM_BYTES, bits: int = BITS):
    """Rows ``lo:hi`` of a column with their distinct places end to end, and offsets."""
    for lo, hi, data, offsets in H.slabs(column, 1_000_000):
        n = len(data) - k + 1
        if n <= 0:
            yield lo, hi, np.zeros(0, np.int64), np.zeros(hi - lo + 1, np.int64)
            continue
        code = np.zeros(n, np.uint64)
        for j in range(k):
            code = (code << np.uint64(8)) | data[j : j + n]
        place = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        row = np.repeat(np.arange(hi - lo), np.diff(offsets))[:n]
        key = ((row.astype(np.uint64) << np.uint64(bits)) | place)[np.arange(n) + k <= offsets[row + 1]]
        key = np.concatenate([key, repeats(data, offsets, bits)])
        key.sort()
        if len(key):
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        yield lo, hi, (key & np.uint64((1 << bits) - 1)).astype(np.int64), np.searchsorted(key >> np.uint64(bits), np.arange(hi - lo + 1, dtype=np.uint64))


def repeats(data: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    """Keys (row and place) of runs of 2, 3 and 4 equal words."""
    hashes, first = H.word_hashes(data, offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    same, out = np.ones(len(hashes), bool), []
    for length in (2, 3, 4):
        same = same[:-1] & (hashes[length - 2 : -1] == hashes[length - 1 :]) & (row[length - 2 : -1] == row[length - 1 :]) if len(hashes) >= length else same[:0]
        place = np.uint64((length * 0xC2B2AE3D27D4EB4F % 2**64) >> (64 - bits))
        out.append((row[: len(same)][same].astype(np.uint64) << np.uint64(bits)) | place)
    return np.concatenate(out)


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, damping: float, cost: float = 1.0, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss, each multiplier between 0 and ``cost``; the bias is one more constant feature."""
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = [ratio[x] / float(np.sqrt(damping + np.sum(ratio[x] ** 2))) for x in rows]
    sign, rng = np.where(labels > 0, 1.0, -1.0), np.random.default_rng(seed)
    square = np.array([float(v @ v) for v in values]) + 1.0
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x, v, y = rows[i], values[i], sign[i]
            slope = y * (float(w[x] @ v) + bias) - 1
            new = min(cost, max(0.0, alpha[i] - slope / square[i]))
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                w[x] += step * v
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the score curve, by Newton steps with smoothed targets."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x, beta = np.stack([margins, np.ones(len(margins))], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (target - p) - 1e-6 * beta)
        beta += np.clip(step, -5, 5)
    return float(beta[0]), float(beta[1])


def fit(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, where: Column, sample_rows: int = SAMPLE_ROWS, k: int = GRAM_BYTES, bits: int = BITS, folds: int = 2) -> Model:
    """Fit on at most ``sample_rows`` labelled rows that satisfy ``where`` (a condition on ``key``).

    The score curve is fitted on margins of rows that a fold's own fit has not
    seen (``folds`` of them), as margins of training rows are too good.
    """
    H.small_batches(df.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & where).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_y"))
    chosen = known.orderBy(F.xxhash64("_key"), "_key").limit(sample_rows)
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")  # at most ``sample_rows`` labels
    # a key that repeats counts with its least text, so keys bound the rows too
    sample = texts.groupBy("_key", "_y").agg(F.min("_text").alias("_text")).select("_y", "_text")

    def run(batches):
        for batch in batches:
            found = []
            for _, _, places, offsets in features(batch.column(1), k, bits):
                found += [places[a:b].astype(np.int32) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())], ["y", "places"])

    got = sorted((r.places, r.y) for r in sample.mapInArrow(run, "y int, places binary").collect())
    rows, y = [np.frombuffer(p, np.int32) for p, _ in got], np.array([int(v > 0) for _, v in got])
    if not len(y) or y.min() == y.max():
        share = min(0.999, max(0.001, float(y.mean()))) if len(y) else 0.5
        return Model(np.zeros(1 << bits), np.zeros(1 << bits), 1.0, 0.0, 0.0, float(np.log(share / (1 - share))))
    def model(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        some, marks = [rows[i] for i in own], y[own]
        counts = [np.bincount(np.concatenate([x for x, v in zip(some, marks) if v == c]), minlength=1 << bits) + 1.0 for c in (0, 1)]
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        ratio[(counts[0] + counts[1]) < 2.5] = 0.0
        damping = max(1e-9, DAMPING * float(np.median([np.sum(ratio[x] ** 2) for x in some])))
        return *descend(some, marks, ratio, damping), ratio, damping

    def margin(x: np.ndarray, w: np.ndarray, bias: float, ratio: np.ndarray, damping: float) -> float:
        return float(w[x] @ ratio[x]) / float(np.sqrt(damping + np.sum(ratio[x] ** 2))) + bias

    w, bias, ratio, damping = model(np.arange(len(rows)))
    fold, margins = np.arange(len(rows)) % folds, np.zeros(len(rows))
    for f in range(folds):
        other, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        whole = len(other) and 0 < y[other].sum() < len(other)
        parts = model(other) if whole else (w, bias, ratio, damping)
        margins[own] = [margin(rows[i], *parts) for i in own]
    slope, shift = logistic(margins, y)
    return Model(w * ratio, ratio, damping, bias, max(slope, 0.0), shift)


def score(df: DataFrame, text: str, model: Model, k: int = GRAM_BYTES, bits: int = BITS) -> DataFrame:
    """Adds ``score double`` to all rows and columns, in place of a column so named; narrow."""
    df = H.without(df, "score")
    H.small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), (model.ratio**2).astype(np.float32), model.damping, model.bias, model.slope, model.shift))
    place, columns = df.columns.index(text), df.columns

    def run(batches):
        weight, square, damping, bias, slope, shift = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, places, offsets in features(batch.column(place), k, bits):
                sums = [np.concatenate([[0.0], np.cumsum(v[places], dtype=np.float64)]) for v in (weight, square)]
                own, norm = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
                out[lo:hi] = own / np.sqrt(damping + np.maximum(0, norm)) + bias
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(slope * out + shift, -500, 500))))], [*columns, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, score double")
