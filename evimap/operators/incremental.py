"""Increments: upserts, retention, cursors and run records."""

from __future__ import annotations

from evimap.operators.dedup import last_per_key, top_per_key
from evimap.operators.greedy import first_by_keys, placed
from evimap.operators.lineage import settle, stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _aligned(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Base rows, then delta rows in the columns of the base (missing ones null, others dropped)."""
    own = [F.col(c) if c in delta.columns else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns]
    return base.unionByName(delta.select(own))


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all there."""
    for k in keys:
        df = df.where(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != ""))
    return df


def upsert(base: DataFrame | None, delta: DataFrame | None, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Delta rows replace base rows of their key; the last of a repeated delta key wins (by ``order``, or by its values)."""
    if base is None or delta is None:
        return base if delta is None else delta
    new = last_per_key(keyed(delta, keys), keys, *(order or sorted(c for c in delta.columns if c not in keys)))
    return _aligned(base.join(new.select(keys), keys, "left_anti").select(base.columns), new)


def replace_children(base: DataFrame | None, delta: DataFrame | None, parents: DataFrame, key: str) -> DataFrame:
    """All children of the parents in the increment go, the increment's children come."""
    if base is None or delta is None:
        return base if delta is None else delta
    return _aligned(base.join(parents.select(key).distinct(), key, "left_anti").select(base.columns), keyed(delta, [key]))


def insert_ignore(base: DataFrame, delta: DataFrame, unique: list[list[str]], order: list[str]) -> DataFrame:
    """Base rows, then the delta rows that insertion one after the other in ``order`` keeps.

    A row is ignored if the base or a row kept before it has its value of any
    unique key; an ignored row stands in nobody's way, and a null in a key never
    collides.  Rows that tie in ``order`` come in the order of their values.
    """
    return _aligned(base, inserted(base, delta, unique, order))


def inserted(base: DataFrame, delta: DataFrame, unique: list[list[str]], order: list[str]) -> DataFrame:
    """The delta rows that ``insert_ignore`` keeps.

    A row whose keys no other new row has is kept as it is; only those that
    meet another are put in order.  Hashes tell them apart, and what a hash
    takes for one that meets another costs time alone.
    """
    new = delta
    for k in unique:
        new = new.join(base.where(_whole(k)).select(k), k, "left_anti").select(delta.columns)
    new, hashes = settle(new), [F.when(_whole(k), F.xxhash64(F.lit(i), *k)) for i, k in enumerate(unique)]
    met = stored(new.select(F.explode(F.array(*hashes)).alias("_h")).where("_h is not null").groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h"))
    marked, meets = new, F.lit(False)
    for i, h in enumerate(hashes):
        own = met.select(F.col("_h").alias(f"_h{i}"), F.lit(True).alias(f"_m{i}"))
        marked = marked.withColumn(f"_h{i}", F.coalesce(h, F.xxhash64(*delta.columns))).join(own, f"_h{i}", "left")  # no null, which would bring rows together
        meets |= F.coalesce(f"_m{i}", F.lit(False))
    alone, rest = (marked.where(x).select(delta.columns) for x in (~meets, meets))
    rest = placed(settle(rest), [*(F.col(c) for c in order), *(F.col(c) for c in sorted(delta.columns) if c not in order)], "_place")
    keys = {f"_key{i}": F.when(_whole(k), F.struct(*k)) for i, k in enumerate(unique)}
    kept = first_by_keys(rest.withColumns(keys).select("_place", *keys), "_place", list(keys))
    return alone.unionByName(rest.join(kept, "_place", "left_semi").select(delta.columns))


def _whole(keys: list[str]) -> Column:
    there = F.lit(True)
    for k in keys:
        there &= F.col(k).isNotNull()
    return there


def cursor(log: DataFrame, completed: str, sequence: str, status: str = "status") -> DataFrame:
    """Date of the last successful run."""
    return log.where(F.col(status) == "success").agg(F.substring(F.max_by(F.col(completed).cast("string"), F.struct(completed, sequence)), 1, 10).alias("since"))


def updated_since(rows: DataFrame, column: str, since) -> DataFrame:
    return rows.where(F.col(column) >= F.lit(since))


def run_status(steps: DataFrame, run: str, ok: str) -> DataFrame:
    """success, partial_failure or failure of each run by its steps."""
    per = steps.groupBy(run).agg(F.count_if(ok).alias("good"), F.count("*").alias("n"))
    return per.select(run, F.when(F.col("good") == F.col("n"), "success").when(F.col("good") > 0, "partial_failure").otherwise("failure").alias("status"))


def newest(log: DataFrame, label: list[str], n: int, *order: Column) -> DataFrame:
    """The newest n records of each label."""
    return top_per_key(log, label, n, *order)


def append(rows: DataFrame, path: str, fmt: str = "json") -> None:
    rows.write.mode("append").format(fmt).save(path)
