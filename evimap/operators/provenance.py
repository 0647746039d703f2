"""Content hashes, drift between runs, the badge and the run record."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from evimap.functions import text as T
from evimap.operators.lineage import settle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bytes that a task holds of a file that it streams.
BLOCK = 8 << 20


def file_manifest(spark, path: str, extensions: Sequence[str] = (), largest: int = 1 << 28) -> DataFrame:
    """path, sha256, bytes and modification time of the files under a folder, of the given extensions or all.

    Files up to ``largest`` bytes are hashed as rows.  Larger ones, which no row
    could hold, are streamed through the digest ``BLOCK`` bytes at a time, a file
    a task; their store has to be one that Arrow opens (local, HDFS, S3, GCS).
    Empty files are not listed, as Spark's file scan leaves them out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if extensions:
        files = files.where(F.lower("path").rlike(r"\.(?:" + "|".join(re.escape(e.lower().lstrip(".")) for e in extensions) + ")$"))
    facts = ["path", "length", "modificationTime"]

    def digests(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([streamed_sha256(p.as_py()) for p in batch.column(0)], pa.string())], [*facts, "sha256"])

    small = files.where(F.col("length") <= largest).select(*facts, F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > largest).select(*facts)
    large = large.repartition(F.col("path")).mapInArrow(digests, "path string, length long, modificationTime timestamp, sha256 string")
    return small.unionByName(large).select("path", "sha256", F.col("length").alias("bytes"), "modificationTime")


def streamed_sha256(path: str) -> str:
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    store, name = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)
    digest = hashlib.sha256()
    with store.open_input_stream(name) as stream:
        while block := stream.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def table_hash(df: DataFrame) -> DataFrame:
    """Row count and a hash that does not depend on row order."""
    return df.select(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("rows"), F.sum("h").cast("string").alias("hash"))


def hash_tree(df: DataFrame, keys: Sequence[str], depth: int = 3, row: Column | None = None) -> DataFrame:
    """level, node, rows, hash: a table's contents as a tree of 16 branches a level over buckets of its key.

    A row falls into the leaf that the first ``depth`` hex digits of the MD5 of
    its key name, and counts with 60 bits of the MD5 of ``row`` (all columns as
    JSON by default).  A node holds the sums of what is below it, so neither
    row order nor partitions matter, and rows that repeat count each.  The root
    is the node '' of level 0.  Keys are told apart from their neighbours and
    from nulls.
    """
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}) if row is None else row
    named = F.md5(F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys)))
    rows = df.select(F.substring(named, 1, depth).alias("node"), F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)").alias("h"))
    leaves = rows.groupBy("node").agg(F.count("*").alias("rows"), F.sum("h").alias("hash"))
    nodes = leaves.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), F.col("node").alias("leaf"), "rows", "hash")
    return nodes.groupBy("level", F.expr("substring(leaf, 1, level)").alias("node")).agg(F.sum("rows").alias("rows"), F.sum("hash").cast("decimal(38,0)").alias("hash"))


def changed_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes of two trees that differ: level, node, old_rows, new_rows (0 where a side has none), from the root down.

    Only the branches of a node that differs are looked at, so equal trees cost
    their roots; the driver sees one flag a level.
    """
    side = lambda t, n: t.select("level", "node", F.col("rows").alias(f"{n}_rows"), F.col("hash").alias(f"{n}_hash"))
    out, parents, level, deepest = None, None, 0, max(t.agg(F.max("level")).first()[0] or 0 for t in (old, new))
    while level <= deepest:
        one, two = (side(t.where(F.col("level") == level), n) for t, n in ((old, "old"), (new, "new")))
        if parents is not None:
            one, two = (x.join(parents, F.substring("node", 1, level - 1) == parents["parent"], "left_semi") for x in (one, two))
        both = one.join(two, ["level", "node"], "full").where(~F.col("old_hash").eqNullSafe(F.col("new_hash")) | ~F.col("old_rows").eqNullSafe(F.col("new_rows")))
        found = settle(both.select("level", "node", F.coalesce("old_rows", F.lit(0)).alias("old_rows"), F.coalesce("new_rows", F.lit(0)).alias("new_rows")))
        out = found if out is None else out.unionByName(found)
        if found.isEmpty():
            break
        parents, level = found.select(F.col("node").alias("parent")), level + 1
    return out


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], depth: int = 3) -> DataFrame:
    """Rows of the leaves that differ, in one of the tables and not, or not so often, in the other; ``side`` is old or new."""
    leaves = changed_nodes(hash_tree(old, keys, depth), hash_tree(new, keys, depth)).where(F.col("level") == depth).select(F.col("node").alias("_leaf"))
    named = F.substring(F.md5(F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys))), 1, depth)
    a, b = (t.withColumn("_leaf", named).join(leaves, "_leaf", "left_semi").drop("_leaf") for t in (old, new))
    return a.exceptAll(b).withColumn("side", F.lit("old")).unionByName(b.exceptAll(a).withColumn("side", F.lit("new")))


def rule_version(rules: object) -> str:
    return hashlib.sha256(json.dumps(rules, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def changes(runs: DataFrame, label: str, order: str, measures: list[str]) -> DataFrame:
    """label, order, measure, old, new, pct and severity of each run against the one before it."""
    w = Window.partitionBy(label).orderBy(order)
    long = runs.select(label, order, *(F.struct(F.lag(m).over(w).cast("double").alias("old"), F.col(m).cast("double").alias("new")).alias(m) for m in measures))
    rows = long.select(label, order, F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"{m}.old").alias("old"), F.col(f"{m}.new").alias("new")) for m in measures))).alias("x")).select(label, order, "x.*")
    pct = T.pct_change(F.col("old"), F.col("new"))
    return rows.withColumn("pct", F.round(pct, 4)).withColumn("severity", F.when(F.col("old").isNull(), "none").otherwise(T.drift_severity(pct)))


def share_drift(runs: DataFrame, label: str, order: str, share: str, least: float = 2.0, major: float = 5.0) -> DataFrame:
    """Change of a share in percentage points."""
    w = Window.partitionBy(label).orderBy(order)
    moved = F.abs(F.col("points"))
    out = runs.select(label, order, (F.col(share) * 100 - F.lag(share).over(w) * 100).alias("points"))
    return out.withColumn("severity", F.when(moved >= major, "major").when(moved > least, "minor").otherwise("none")).withColumn("points", F.round("points", 4))


def rule_drift(runs: DataFrame, label: str, order: str, version: str) -> DataFrame:
    """A change of the rule set is always major."""
    w = Window.partitionBy(label).orderBy(order)
    before = F.lag(version).over(w)
    return runs.select(label, order, F.when(before != F.col(version), "major").otherwise("none").alias("severity"))


def badges(runs: DataFrame, label: str, order: str, failed: str, major: str) -> DataFrame:
    """bronze with a failed P0 or P1 rule; gold after two good runs and without major drift; else silver."""
    w = Window.partitionBy(label).orderBy(order)
    good = F.col(failed) == 0
    last_two = F.coalesce(F.lag(good, 1).over(w) & F.lag(good, 2).over(w), F.lit(False))
    return runs.select(label, order, F.when(~good, "bronze").when(last_two & (F.col(major) == 0), "gold").otherwise("silver").alias("badge"))


def abstentions(keywords: DataFrame, keyword: str, known: list[DataFrame]) -> DataFrame:
    """Keywords that no known list (one column each) has, compared without case."""
    out = keywords.select(keyword).distinct().withColumn("_k", F.lower(F.trim(keyword)))
    for df in known:
        out = out.join(df.select(F.lower(F.trim(df.columns[0])).alias("_k")).distinct(), "_k", "left_anti")
    return out.select(keyword)


def run_records(runs: DataFrame, label: str, order: str, run_id: str, totals: list[str], strategy: Mapping[str, object] | None = None) -> DataFrame:
    """Runs as records with their totals, the id of the run before and, as one JSON text, the search strategy (queries, filters, dates)."""
    more = [] if strategy is None else [F.lit(json.dumps(strategy, sort_keys=True, ensure_ascii=False)).alias("strategy")]
    w = Window.partitionBy(label).orderBy(order)
    return runs.select(label, order, run_id, F.to_json(F.struct(*totals)).alias("totals"), F.lag(run_id).over(w).alias("previous"), *more)


def read_records(spark, path: str, schema: str, required: list[str]) -> DataFrame:
    """Run records from JSON; malformed ones and those without required fields are dropped."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    for c in required:
        df = df.where(F.col(c).isNotNull())
    return df
