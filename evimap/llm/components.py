"""Connected components by alternating large and small stars."""

from __future__ import annotations

from evimap.operators.lineage import settle, shared_folder  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of the component) of every node in ``links`` (a, b bigint).

    Self-links and repeats are allowed.  Rounds grow with the logarithm of the
    longest path; each ends in a checkpoint, and only counts reach the driver.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = settle(small.where("u <> v").distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
