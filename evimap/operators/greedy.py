"""What a loop over rows in order would keep, found in rounds over all rows at once.

A row is kept unless an earlier kept row rules it out.  In each round the rows
that no undecided earlier row can rule out any more are kept, and those that
they rule out go; the result is that of the loop, whatever the partitions.  A
round is a few joins of the undecided rows; their number is the longest chain
of rows that wait for one another (logarithmic for keys that meet at random).
State is kept in the shared folder after each round.
"""

from __future__ import annotations

from evimap.operators.lineage import settle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def placed(rows: DataFrame, order: list[Column], column: str) -> DataFrame:
    """Rows with a number in ``column`` that rises along ``order``, from a range-partitioned sort; kept in the shared folder, so it stays."""
    return settle(rows.sort(*order).withColumn(column, F.monotonically_increasing_id()))


def first_by_keys(rows: DataFrame, place: str, keys: list[str]) -> DataFrame:
    """``place`` of the rows that insertion in the order of ``place`` keeps: a row goes if a kept one before it has an equal value in any of ``keys``.

    Nulls meet nothing.  Rows equal in all keys are reduced to their first before any join.
    """
    free = rows.where(~_any(keys))
    undecided = settle(rows.where(_any(keys)).groupBy(*keys).agg(F.min(place).alias(place)))
    kept = [free.select(place)]
    while not undecided.isEmpty():
        marked = undecided
        for i, k in enumerate(keys):
            least = undecided.where(F.col(k).isNotNull()).groupBy(k).agg(F.min(place).alias(f"least{i}"))
            marked = marked.join(least, k, "left")
        leads = settle(marked.withColumn("leads", F.least(*(F.coalesce(F.col(f"least{i}"), F.col(place)) for i in range(len(keys))), F.col(place)) == F.col(place)).select(place, *keys, "leads"))
        first, rest = leads.where("leads"), leads.where("not leads").drop("leads")
        for k in keys:
            rest = rest.join(first.where(F.col(k).isNotNull()).select(k).distinct(), k, "left_anti")
        kept.append(first.select(place))
        undecided = settle(rest.select(place, *keys))
    return _union(kept)


def first_by_links(links: DataFrame) -> DataFrame:
    """(node, stays) for every node of ``links`` (later, earlier): a node stays unless an earlier one that it is linked to stays."""
    links, decided = settle(links.select("later", "earlier").distinct()), []
    while not links.isEmpty():
        stays = settle(links.select(F.col("earlier").alias("node")).distinct().join(links.select(F.col("later").alias("node")), "node", "left_anti"))
        goes = settle(links.join(stays.withColumnRenamed("node", "earlier"), "earlier", "left_semi").select(F.col("later").alias("node")).distinct())
        decided += [stays.withColumn("stays", F.lit(True)), goes.withColumn("stays", F.lit(False))]
        left = links.join(stays.withColumnRenamed("node", "earlier"), "earlier", "left_anti")
        for side in ("later", "earlier"):
            left = left.join(goes.withColumnRenamed("node", side), side, "left_anti")
        # a node whose links are all gone has lost to nobody
        alone = links.select(F.col("later").alias("node")).distinct().join(goes, "node", "left_anti").join(left.select(F.col("later").alias("node")), "node", "left_anti").join(left.select(F.col("earlier").alias("node")), "node", "left_anti")
        decided.append(settle(alone).withColumn("stays", F.lit(True)))
        links = settle(left)
    return _union(decided) if decided else links.select(F.col("later").alias("node"), F.lit(True).alias("stays"))


def _any(keys: list[str]) -> Column:
    there = F.lit(False)
    for k in keys:
        there |= F.col(k).isNotNull()
    return there


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
