"""Threshold-scaled sketches: keep every shingle hash below a fixed fraction of the hash range.

Sketches of any two texts are comparable, a union of sketches is the sketch of
the union, and containment is estimated without bias however unequal the sizes.
Shingles are runs of ``k`` bytes of the text with A-Z lower-cased; a text with
fewer bytes is one shingle.  A short text may have no hash below the fraction:
its sketch is empty.  For a *fingerprint*, which has to tell such texts apart,
the least hash stands in then; it never enters a sketch or a union.  Null counts
as empty, and only empty texts have empty fingerprints.  Equal texts have equal
sketches; rows keep their number and order of ids does not matter to a sketch.
Only the columns named are read, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H

SHINGLE_BYTES = 12
FRACTION = 1 / 16
#: Text of a range of neighbouring rows, on average, and how many ranges there are at most: the driver knows only their bounds.
RANGE_BYTES, RANGES = 12_000_000, 20_000


def sketch_column(column, k: int = SHINGLE_BYTES, fraction: float = FRACTION, least: bool = False) -> list[np.ndarray]:
    """Sorted distinct hashes (below 2**52) of each row of an Arrow string column; with ``least``, fingerprints."""
    limit = np.uint64(min(1.0, fraction) * 2.0**64 * (1 - 2.0**-53))
    out: list[np.ndarray] = []
    for lo, hi, data, offsets in H.slabs(column):
        grams = H.gram_hashes(sums := H.running(H.lower(data)), k)
        lengths = np.diff(offsets)
        at = np.flatnonzero(grams <= limit)
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + k <= offsets[row + 1]
        values, of = H.distinct_by_row(grams[at[inside]] >> np.uint64(12), row[inside], hi - lo)
        for r in range(hi - lo):
            own = values[of[r] : of[r + 1]]
            begin, end = offsets[r], offsets[r + 1]
            if 0 < lengths[r] < k:
                whole = H.span_hashes(sums, np.array([begin]), np.array([end]))
                own = whole[(whole <= limit) | least] >> np.uint64(12)
            elif least and lengths[r] and not len(own):
                own = grams[begin : end - k + 1].min(keepdims=True) >> np.uint64(12)
            out.append(own)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated containment of the smaller shingle set in the larger; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def as_hex(sketch: np.ndarray) -> str:
    """13 hexadecimal digits for each hash, ascending."""
    digits = sketch.astype(">u8").tobytes().hex()
    return "".join(digits[i + 3 : i + 16] for i in range(0, len(digits), 16))


def fingerprints(df: DataFrame, key: str, text: str, k: int = SHINGLE_BYTES, fraction: float = FRACTION) -> DataFrame:
    """``key`` and ``sketch array<bigint>`` of every row; narrow, without a shuffle."""
    H.small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            found = [x.astype(np.int64) for x in sketch_column(batch.column(1), k, fraction)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["key", "sketch"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, sketch array<bigint>").withColumnRenamed("key", key)


def merge(sketches: DataFrame, by: str) -> DataFrame:
    """Sketch of the union of each group's texts."""
    parts = sketches.select(by, F.explode("sketch").alias("h")).distinct()
    return parts.groupBy(by).agg(F.array_sort(F.collect_list("h")).alias("sketch"))


def half_edits(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE_BYTES, fraction: float = FRACTION) -> DataFrame:
    """Fingerprint each text, and its edit that ends with the start of the next text by ``key``.

    The last floor(n/2) code points give way to the first as many (or all) of
    the next text; after the last comes the first.  A null key sorts first,
    repeated keys by text.  Rows are dealt into ranges of the key and sorted
    there; the first row of each range also ends the range before it.  A task
    reads its ranges as a stream and holds one batch of rows.
    """
    spark = df.sparkSession
    H.small_batches(spark, 500)
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(RANGES, max(1, -(-size // RANGE_BYTES)))
    bounds = sorted(set(rows.approxQuantile("place", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    starts = np.array(bounds, dtype=np.float64)

    def range_of(batches):
        for batch in batches:
            own = np.searchsorted(starts, batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own), *batch.columns], ["bucket", *batch.schema.names])

    narrow = rows.select("place").mapInArrow(range_of, "bucket int, place long")
    heads = sorted((r[0], r[1]) for r in narrow.groupBy("bucket").agg(F.min("place")).collect())  # one row a range
    before = {place: heads[i - 1][0] for i, (_, place) in enumerate(heads)}

    def deal(batches):
        for batch in range_of(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.zeros(batch.num_rows, bool)), *batch.columns[1:]], ["bucket", "head", "place", "doc_id", "text"])
            at = [i for i, v in enumerate(batch.column(1).to_pylist()) if v in before]
            if at:
                own = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array([before[v] for v in own.column(1).to_pylist()], pa.int32()), pa.array(np.ones(len(at), bool)), *own.columns[1:]], ["bucket", "head", "place", "doc_id", "text"])

    def walk(batches):
        held: list[tuple[bool, int | None, str]] = []  # the last row, until its successor is known
        for batch in batches:
            rows = held + list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            pairs = [i for i in range(len(rows) - 1) if not rows[i][0]]
            held = rows[-1:]
            if not pairs:
                continue
            texts = [r[2] for r in rows]
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in pairs]
            a, b = (sketch_column(pa.array(x, pa.large_string()), k, fraction, least=True) for x in (texts, edited))
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][1] for i in pairs], pa.int64()), pa.array([len(texts[i]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array([as_hex(a[i]) for i in pairs]), pa.array([as_hex(x) for x in b]),
                pa.array([likeness(a[i], x) for i, x in zip(pairs, b)], pa.float64()), pa.array([likeness(a[i], a[i + 1]) for i in pairs], pa.float64()),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    dealt = rows.select("place", "doc_id", "text").mapInArrow(deal, "bucket int, head boolean, place long, doc_id long, text string")
    sorted_rows = dealt.repartitionByRange(n, "bucket").sortWithinPartitions("bucket", "head", "place", "text").select("head", "doc_id", "text")
    shape = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_rows.mapInArrow(walk, shape).withColumnRenamed("doc_id", key)
