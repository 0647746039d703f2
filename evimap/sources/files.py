"""Readers and writers of the map's own files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from evimap.functions import text as T
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, columns: list[str], newlines: bool = True) -> DataFrame:
    """Header, doubled quotes, UTF-8 with or without BOM; blank is null.

    Quoted newlines make a file one task; ``newlines=False`` says there are none and lets large files be split.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("multiLine", newlines).option("quote", '"').option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The given columns as text, null as blank, formulas made safe; other columns are left out."""
    safe = [T.formula_safe(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in columns]
    df.select(safe).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_map(df: DataFrame, path: str, label: str, facts: Mapping[str, Column] | None = None) -> dict[str, object]:
    """Parquet, one partition for each label; other labels stay.

    ``facts`` are aggregates of the rows (none of them distinct), gathered by the
    tasks that write them and given back: no second pass reads what was written.
    """
    watch = Observation() if facts else None
    rows = df.observe(watch, *(c.alias(n) for n, c in facts.items())) if watch and facts else df
    rows.withColumn("label", F.lit(label)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("label").parquet(path)
    return dict(watch.get) if watch else {}


def read_map(spark: SparkSession, path: str, label: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("label") == label)


def write_summary(one_row: DataFrame, path: str) -> None:
    one_row.write.mode("overwrite").json(path)


def load_trials(df: DataFrame, key: str, interventions: list[str], limit: int | None = None) -> DataFrame:
    """Upper-cased trial ids of the known form, with the first non-blank intervention column."""
    rows = df.select(F.upper(F.trim(key)).alias(key), F.coalesce(*(T.blank_to_null(F.col(c)) for c in interventions), F.lit("")).alias("intervention_names"))
    rows = rows.where(T.is_nct_id(F.col(key))).groupBy(key).agg(F.min("intervention_names").alias("intervention_names"))
    return rows.orderBy(key).limit(limit) if limit else rows


def header(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """Column names of a CSV file from its first line; no row is parsed."""
    return spark.read.option("header", True).option("sep", separator).option("enforceSchema", False).csv(path).limit(0).columns


def sampled_column(df: DataFrame, column: str, n: int) -> DataFrame:
    """The first ``n`` values of one column; only that column is read."""
    return df.select(column).limit(n)


def missing_columns(found: Iterable[str], needed: Iterable[str]) -> list[str]:
    return sorted(set(needed) - set(found))


def suffixed(name: str, label: str, default: str = "broad") -> str:
    """File name of a label: the default label has the plain name, others end in _label."""
    stem, dot, end = name.rpartition(".")
    return name if label in ("", default) else f"{stem}_{label}.{end}" if dot else f"{name}_{label}"


class Registry:
    """Datasets by label: the files of each kind, kept as one small JSON table beside the data."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def add(self, label: str, kind: str, file: str) -> None:
        self.spark.range(1).select(F.lit(label).alias("label"), F.lit(kind).alias("kind"), F.lit(file).alias("file"), F.current_timestamp().alias("added")).write.mode("append").json(self.path)

    def files(self) -> DataFrame:
        """label, kind, file: the last one added counts."""
        rows = self.spark.read.schema("label string, kind string, file string, added timestamp").json(self.path)
        return rows.groupBy("label", "kind").agg(F.max_by("file", "added").alias("file"))

    def labels(self) -> list[str]:
        return sorted(r.label for r in self.files().select("label").distinct().collect())  # a handful of labels

    def file(self, label: str, kind: str) -> str:
        found = self.files().where((F.col("label") == label) & (F.col("kind") == kind)).first()
        if found is None:
            raise KeyError(f"no {kind} of {label}")
        return found.file


def page(path_column: Column) -> Column:
    return F.element_at(F.split(path_column, "/"), -1)
