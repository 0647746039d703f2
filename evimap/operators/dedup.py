"""First, last and latest rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in ``order``; by partial aggregation, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(ranked).alias("x")).select(*keys, *(F.col(f"x.row.{c}").alias(c) for c in rest)).select(df.columns)


def last_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, F.struct(*rest).alias("row"))).alias("x")).select(*keys, *(F.col(f"x.row.{c}").alias(c) for c in rest)).select(df.columns)


def top_per_key(df: DataFrame, keys: list[str], n: int, *order: Column, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def with_most_values(df: DataFrame, key: str, attribute: str, more_than: int = 1) -> DataFrame:
    """Keys with more than so many distinct values of an attribute."""
    return df.groupBy(key).agg(F.count_distinct(attribute).alias("n_values")).where(F.col("n_values") > more_than)
