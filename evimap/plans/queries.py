"""Queries of the library on the driver's tables, each with equivalent SQL where SQL can say it.

Mentions are ``lineitem`` and studies ``orders`` unless a query says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from evimap.plans import facet_queries, landed_queries, map_queries, pipeline_queries, text_queries  # noqa: E402, F401


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["facet_stats"](spark, sf_dir)
