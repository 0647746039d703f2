"""Conflict-constrained best-fit packing of tokenized texts into sequences of a fixed size.

Longest first, each piece goes to the tightest bin that has room for it and
holds neither its source nor any of its duplicate clusters yet; a bin carries
both as bitmaps.  Bins stand in the order of their residual, and the search goes
on from successor to successor until one is compatible.  Texts longer than a
bin are cut into pieces of the full size and a rest.  A text's tokens are those of
a byte-level BPE, and one for its end.

Duplicate clusters come with the texts, or from ``sized``: a text is in those of
the ``CLUSTERS`` smallest hashes of its 5-word shingles, and two texts are
duplicates if they share one of these.  Equal texts always do; of near copies with
a similarity of 0.8 all but about 3 in a million do (each hash of one that is
no longer among the other's is a chance of 0.2).  This is a pass over each text
alone, where joining all near copies would cost ten times the packing.

Rows are dealt into groups of about ``GROUP`` pieces by a hash of key, text, piece
and copy, each packed by itself, so memory and time of a task do not grow with the
table, whatever repeats; bins do not mix groups.  Null and empty sources conflict
with nothing, nor do texts without words; null or negative lengths count as 0 and
take a place of no tokens.  Rows that repeat are placed each.  Only the columns
named are read, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evimap.llm import hashing as H
from evimap.llm.components import shared_folder
from evimap.llm.token_alignment import ByteLevel

CAPACITY, GROUP, WORDS, CLUSTERS = 2048, 2000, 5, 8
_KNOWN: dict[str, ByteLevel] = {}


def best_fit(items: list[tuple[int, str | None, Sequence[int]]], capacity: int) -> list[tuple[int, int]]:
    """Bin and start of each item (length, source, clusters), taken in the given order."""
    bits: dict = {}
    shared = Counter(c for _, _, own in items for c in set(own))  # a cluster of one item conflicts with nothing
    levels: list[int] = []  # residuals of the open bins, ascending
    at_level: dict[int, dict[int, None]] = {}
    residual, sources, clusters, out = [], [], [], []
    for length, source, own in items:
        s = 1 << bits.setdefault(("s", source), len(bits)) if source else 0
        c = 0
        for x in own:
            if shared[x] > 1:
                c |= 1 << bits.setdefault(("c", x), len(bits))
        found, i = -1, bisect_left(levels, length)
        while i < len(levels) and found < 0:
            found = next((b for b in at_level[levels[i]] if not (sources[b] & s or clusters[b] & c)), -1)
            i += 1
        if found < 0:
            found = len(residual)
            residual.append(capacity), sources.append(0), clusters.append(0)
        else:
            level = residual[found]
            del at_level[level][found]
            if not at_level[level]:
                del at_level[level], levels[bisect_left(levels, level)]
        out.append((found, capacity - residual[found]))
        residual[found] -= length
        sources[found] |= s
        clusters[found] |= c
        level = residual[found]
        if level not in at_level:
            at_level[level] = {}
            insort(levels, level)
        at_level[level][found] = None
    return out


def clusters_of(column: pa.Array, words: int = WORDS, most: int = CLUSTERS) -> list[np.ndarray]:
    """The smallest shingle hashes of each text, in order."""
    out = []
    for lo, hi, data, offsets in H.slabs(column):
        hashes, first = H.distinct_by_row(*H.shingle_hashes(*H.word_hashes(data, offsets), words), hi - lo)
        out += [hashes[a : min(a + most, b)].view(np.int64) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return out


def sized(df: DataFrame, key: str, text: str, source: str, bpe: bytes, with_ids: bool = False) -> DataFrame:
    """``key``, n_tokens, ``source``, clusters, row_hash and, on demand, ids of each row; kept in the shared folder."""
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    H.small_batches(spark)
    file = spark.sparkContext.broadcast((hashlib.sha256(bpe).hexdigest(), bpe))
    more, fields = ({"ids": pa.list_(pa.int32())}, ", ids array<int>") if with_ids else ({}, "")

    def run(batches):
        name, content = file.value
        coder = _KNOWN.get(name) or _KNOWN.setdefault(name, ByteLevel(content))
        for batch in batches:
            ids = [coder.encode(t) if t else [] for t in batch.column(1).to_pylist()]
            counts = pa.array([len(x) + 1 for x in ids], pa.int64())
            own = [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, batch.column(2), pa.array(clusters_of(batch.column(1)), pa.list_(pa.int64())), batch.column(3), *own], ["k", "n_tokens", "s", "clusters", "row_hash", *more])

    folder = f"{shared_folder(spark)}/sized-{uuid.uuid4()}"
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(source).cast("string").alias("s"), F.xxhash64(text).alias("h"))
    rows.mapInArrow(run, f"k {kind}, n_tokens long, s string, clusters array<long>, row_hash long{fields}").write.parquet(folder)
    return spark.read.parquet(folder).withColumnsRenamed({"k": key, "s": source})


def pack(df: DataFrame, key: str, length: str, source: str, clusters: str, row_hash: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: ``key``, row_hash, copy, piece, n_tokens, bin_id, start (its first place in the bin).

    ``clusters`` is an array, or one cluster; ``row_hash`` tells rows of one key apart.
    """
    size = F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long")
    many = df.schema[clusters].dataType.typeName() == "array"
    own = F.coalesce(F.col(clusters), F.array()) if many else F.array_compact(F.array(F.col(clusters).cast("long")))
    rows = df.select(F.col(key).alias("k"), size.alias("size"), F.col(source).cast("string").alias("s"), own.cast("array<long>").alias("c"), (F.col(row_hash) if row_hash else F.xxhash64(clusters)).alias("h"))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("k", "h").orderBy("size", "s")))
    total = rows.agg(F.sum(F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)))).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("int"))))
    pieces = pieces.withColumn("n", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece") * capacity))
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("k", "h", "piece", "copy"), F.lit(groups)).cast("int")).select("group", "k", "h", "copy", "piece", "n", "s", "c")

    def one(table: pa.Table) -> pa.Table:
        table = table.append_column("null", [pa.array([x is None for x in table["k"].to_pylist()])])
        table = table.sort_by([("n", "descending"), ("null", "ascending"), ("k", "ascending"), ("piece", "ascending"), ("h", "ascending"), ("copy", "ascending")])
        placed = best_fit(list(zip(table["n"].to_pylist(), table["s"].to_pylist(), table["c"].to_pylist())), capacity)
        first = table["group"][0].as_py() << 32
        return pa.table({"k": table["k"], "row_hash": table["h"], "copy": table["copy"], "piece": table["piece"], "n_tokens": table["n"], "bin_id": pa.array([first + b for b, _ in placed], pa.int64()), "start": pa.array([x for _, x in placed], pa.int64())})

    kind = df.schema[key].dataType.simpleString()
    return pieces.groupBy("group").applyInArrow(one, f"k {kind}, row_hash long, copy int, piece int, n_tokens long, bin_id long, start long").withColumnRenamed("k", key)


def sequences(df: DataFrame, key: str, text: str, source: str, bpe: bytes, end: int, capacity: int = CAPACITY) -> DataFrame:
    """bin_id, ids (tokens of the whole sequence, ``end`` behind each text) and segments (key, piece, start, n_tokens) of each bin."""
    rows = sized(df, key, text, source, bpe, with_ids=True)
    placed = pack(rows.drop("ids"), key, "n_tokens", source, "clusters", "row_hash", capacity)
    texts = rows.select(F.col(key).alias("k_"), F.col("row_hash").alias("h_"), F.array_append("ids", F.lit(end)).alias("ids")).dropDuplicates(["k_", "h_"])
    cut = placed.join(texts, placed[key].eqNullSafe(texts["k_"]) & (placed["row_hash"] == texts["h_"]))
    piece = F.struct("start", F.col(key).alias("key"), "piece", "n_tokens", F.slice("ids", F.col("piece") * capacity + 1, F.col("n_tokens").cast("int")).alias("ids"))
    bins = cut.select("bin_id", piece.alias("x")).groupBy("bin_id").agg(F.array_sort(F.collect_list("x")).alias("x"))  # a bin holds ``capacity`` tokens
    return bins.select("bin_id", F.flatten("x.ids").alias("ids"), F.transform("x", lambda x: x.dropFields("ids")).alias("segments"))
