"""Vectorised text primitives that run inside Arrow tasks.

Text reaches a task as one contiguous byte buffer plus row offsets.  Words and
byte k-grams are hashed by differences of a running polynomial sum modulo
2**64, so the cost is a few array passes per byte and no Python loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one round of array work takes at most (a longer row is a round of its own).
SLAB_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLAB_BYTES + 2), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = have = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all of them."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole, offsets


def slabs(column: pa.Array | pa.ChunkedArray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` with their bytes and offsets from 0, about ``limit`` bytes at a time."""
    data, offsets = buffers(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def running(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; entry i covers the first i bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _power("up", _BASE, len(data)), out=out[1:])
    return out


def gram_hashes(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes that start at each position where so many are left."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[k:] - sums[:n]) * _power("down", _INVERSE, n))


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _power("down", _INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row the index of its first word.

    A word is a run of bytes other than the six ASCII white-space bytes; rows
    bound words.  The last array has one entry more than there are rows.
    """
    solid = ~_SPACE[data]
    if not solid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    finishes[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[inner]
    finishes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and for each row the index of its first word."""
    data = lower(data)
    starts, ends, first = words(data, offsets)
    return span_hashes(running(data), starts, ends), first


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every k-word shingle; a row of fewer words gives one of them all."""
    n, counts = len(hashes), np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    whole = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        whole = whole * np.uint64(_BASE) + hashes[j : j + len(whole)]
    left = np.repeat(first[1:], counts) - np.arange(n)
    full = np.flatnonzero(left[: len(whole)] >= k)
    out, of = [mix(whole[full] + np.uint64(k))], [rows[full]]
    for size in range(1, k):
        short = np.flatnonzero(counts == size)
        value = np.zeros(len(short), np.uint64)
        for j in range(size):
            value = value * np.uint64(_BASE) + hashes[first[short] + j]
        out.append(mix(value + np.uint64(size)))
        of.append(short)
    return np.concatenate(out), np.concatenate(of)


def distinct_by_row(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, laid end to end, and the offsets of the rows."""
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[keep], np.searchsorted(rows[keep], np.arange(n_rows + 1))


def small_batches(spark, rows: int = 2000) -> None:
    """Bound the rows of one Arrow batch, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def without(df, *names: str):
    """``df`` less the columns that an operator is about to add (names compare without case)."""
    return df.drop(*(c for c in df.columns if c.lower() in names))
