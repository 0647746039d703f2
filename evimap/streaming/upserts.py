"""Landed increments as a stream: each micro-batch is merged into a table that is versioned by bucket of the key.

Buckets are prefixes of the bits of a hash of the key, and together they cover
all hashes (extendible hashing): the table begins as one bucket, and a bucket
that a batch lets grow above ``BUCKET_ROWS`` is written as those below it
instead.  So a batch of m keys rewrites at most m buckets of bounded size, however
large the table is.  A batch writes files of a version with its own number, and
then names that version, with the rows of each bucket, in the directory.  A
batch that is run again after a failure writes the same files and names the same
version.  Versions that no reader needs any more go with ``vacuum``.

The directory has one small row for each bucket, which the driver holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from evimap.operators.incremental import keyed, upsert
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Rows of a bucket above which it is split.
BUCKET_ROWS = 2_000_000
_NAMES = "batch long, bucket string, rows long"
#: What a directory calls the bucket of all keys, and the rows of a bucket that was split.
ROOT, SPLIT = "all", -1


def bits(keys: Sequence[str]) -> Column:
    """64 binary digits of the hash of a key."""
    return F.lpad(F.bin(F.xxhash64(*(F.col(k).cast("string") for k in keys))), 64, "0")


def _files(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def names(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """batch, bucket, rows of every version named (before a batch)."""
    files, path = _files(spark, f"{table}/_versions")
    if not files.exists(path):
        return spark.createDataFrame([], _NAMES)
    out = spark.read.schema(_NAMES).json(f"{table}/_versions").distinct()
    return out if before is None else out.where(F.col("batch") < before)


def directory(spark: SparkSession, table: str, before: int | None = None) -> list[tuple[str, int, int]]:
    """(bucket, version, rows) of the files that make up the table (before a batch)."""
    last = names(spark, table, before).groupBy("bucket").agg(F.max(F.struct("batch", "rows")).alias("x"))
    return sorted((r.bucket, r.batch, r.rows) for r in last.select("bucket", "x.*").where(F.col("rows") != SPLIT).collect())


def _prefix(bucket: str) -> str:
    return "" if bucket == ROOT else bucket


def _read(spark: SparkSession, table: str, schema: str, entries: list[tuple[str, int, int]]) -> DataFrame:
    own = [f"{table}/version={v}/bucket={b}" for b, v, rows in entries if rows > 0]
    return spark.read.schema(schema).parquet(*own) if own else spark.createDataFrame([], schema)


def current(spark: SparkSession, table: str, schema: str, before: int | None = None) -> DataFrame:
    """The table (before a batch)."""
    return _read(spark, table, schema, directory(spark, table, before))


def bucketed(rows: DataFrame, keys: Sequence[str], buckets: Sequence[str]) -> DataFrame:
    """Rows with the one of ``buckets`` (prefixes that cover all hashes) that each falls into."""
    depths = sorted({len(_prefix(b)) for b in buckets})
    known = rows.sparkSession.createDataFrame([(_prefix(b), b) for b in buckets], "_prefix string, bucket string")
    tried = rows.withColumn("_prefix", F.explode(F.array(*(F.substring(bits(keys), 1, d) for d in depths))))
    return tried.join(known, "_prefix").drop("_prefix")


def lookup(spark: SparkSession, table: str, schema: str, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Rows of the keys in ``wanted``; only the files of their buckets are read."""
    entries = directory(spark, table)
    if not entries:
        return spark.createDataFrame([], schema)
    touched = {r.bucket for r in bucketed(wanted.select(*keys), keys, [b for b, _, _ in entries]).select("bucket").distinct().collect()}  # at most all buckets
    return _read(spark, table, schema, [e for e in entries if e[0] in touched]).join(wanted.select(*keys).distinct(), list(keys), "left_semi")


def merge(batch: DataFrame, number: int, table: str, schema: str, keys: list[str], order: list[str], most: int = BUCKET_ROWS) -> None:
    """Upsert one batch: rewrite the buckets of its keys, split those that grow above ``most`` rows, and name the new version."""
    spark = batch.sparkSession
    entries = directory(spark, table, number) or [(ROOT, number, 0)]
    delta = bucketed(keyed(batch, keys), keys, [b for b, _, _ in entries])
    touched = {r.bucket for r in delta.select("bucket").distinct().collect()}  # at most all buckets, and at most the keys of the batch
    if not touched:
        return
    old = [e for e in entries if e[0] in touched]
    merged = bucketed(upsert(_read(spark, table, schema, old), delta.drop("bucket"), keys, order), keys, [b for b, _, _ in old])
    # Depths by the sizes that the buckets will have; a split goes on below a child that is still too large.
    into, sizes = {}, {r.bucket: r["count"] for r in merged.groupBy("bucket").count().collect()}
    open_ = {b: (b, n) for b, n in sizes.items()}
    while open_:
        large = {p: b for p, (b, n) in open_.items() if n > most and len(_prefix(p)) < 64}
        into |= {p: b for p, (b, n) in open_.items() if p not in large}
        if not large:
            break
        inside = bucketed(merged.drop("bucket"), keys, list(dict.fromkeys([*large, *into]))).where(F.col("bucket").isin(list(large)))
        child = F.substring(bits(keys), 1, F.when(F.col("bucket") == ROOT, 0).otherwise(F.length("bucket")) + 1)
        counted = {(r.bucket, r.child): r["count"] for r in inside.groupBy("bucket", child.alias("child")).count().collect()}
        open_ = {_prefix(p) + bit: (b, counted.get((p, _prefix(p) + bit), 0)) for p, b in large.items() for bit in "01"}
        sizes |= {p: n for p, (_, n) in open_.items()}
    placed = bucketed(merged.drop("bucket"), keys, list(into))
    placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/version={number}")
    rows = [(number, p, sizes[p]) for p in into] + [(number, b, SPLIT) for b in set(into.values()) - set(into)]
    spark.createDataFrame(rows, _NAMES).coalesce(1).write.mode("append").json(f"{table}/_versions")


def merge_stream(source: DataFrame, table: str, schema: str, keys: list[str], order: list[str], checkpoint: str, most: int = BUCKET_ROWS) -> StreamingQuery:
    """Upsert all files that have landed so far, then stop."""
    return source.writeStream.foreachBatch(lambda batch, number: merge(batch, number, table, schema, keys, order, most)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def vacuum(spark: SparkSession, table: str, keep: int = 1) -> int:
    """Remove the files of all but the last ``keep`` versions of each bucket, and of buckets that were split; not while readers or a batch run.  Returns how many went."""
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("batch")))
    gone = F.max(F.when(F.col("rows") == SPLIT, F.col("batch"))).over(Window.partitionBy("bucket"))
    named = names(spark, table).withColumns({"place": place, "gone": gone})
    old = named.where((F.col("rows") != SPLIT) & ((F.col("place") > keep) | (F.col("batch") < F.col("gone")))).collect()  # as many as were rewritten since the last call
    files, _ = _files(spark, table)
    return sum(bool(files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/version={r.batch}/bucket={r.bucket}"), True)) for r in old)


def landed(spark: SparkSession, path: str, schema: str, stamp: str | None = None, keys: list[str] | None = None, delay: str = "1 day") -> DataFrame:
    """File stream of JSON documents; with ``stamp`` and ``keys``, replayed rows are dropped within the delay."""
    rows = spark.readStream.schema(schema).json(path)
    return rows.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(keys) if stamp and keys else rows
