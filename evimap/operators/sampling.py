"""Seeded review samples and classification metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, least: int = 2, seed: str = "1") -> DataFrame:
    """``least`` rows of each class, then rows of any class, up to ``n``, in the order of a seeded hash."""
    h = seeded(key, seed)
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key))
    ranked = rows.withColumn("_h", h).withColumn("_first", place <= least)
    return ranked.orderBy(F.desc("_first"), "_h", key).limit(n).drop("_h", "_first")


def classification_metrics(rows: DataFrame, predicted: str, truth: str) -> DataFrame:
    """class, tp, fp, fn, ppv and sensitivity; null where the denominator is 0."""
    long = rows.select(F.explode(F.array(F.struct(F.col(predicted).alias("class"), F.when(F.col(predicted) == F.col(truth), "tp").otherwise("fp").alias("kind")), F.when(~F.col(predicted).eqNullSafe(F.col(truth)), F.struct(F.col(truth).alias("class"), F.lit("fn").alias("kind"))))).alias("x")).where("x is not null and x.class is not null")
    n = {k: F.count_if(F.col("x.kind") == k) for k in ("tp", "fp", "fn")}
    per = long.groupBy("x.class").agg(*(v.alias(k) for k, v in n.items()))
    return per.select("class", "tp", "fp", "fn", F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 6).alias("ppv"), F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6).alias("sensitivity"))


def accuracy(rows: DataFrame, predicted: str, truth: str, nothing: str) -> DataFrame:
    """Share of right rows, and of rows that should have had no class."""
    return rows.agg(F.count("*").alias("n"), F.round(F.try_divide(F.count_if(F.col(predicted) == F.col(truth)), F.count("*")), 6).alias("accuracy"), F.round(F.try_divide(F.count_if(F.col(truth) == nothing), F.count("*")), 6).alias("false_positive_rate"))


def review_sheet(rows: DataFrame, number: str, columns: list[str], blanks: list[str], *order: Column) -> DataFrame:
    """Numbered rows of a bounded sample with empty columns to fill in."""
    return rows.select(F.row_number().over(Window.orderBy(*order)).alias(number), *columns, *(F.lit("").alias(b) for b in blanks))
