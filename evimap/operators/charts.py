"""Chart-shaped aggregates: matrices, signals, flows, profiles, timelines."""

from __future__ import annotations

from evimap.functions import text as T
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_values(rows: DataFrame, value: str, k: int, measure: Column | None = None) -> DataFrame:
    m = F.count("*") if measure is None else measure
    return rows.where(F.col(value).isNotNull()).groupBy(value).agg(m.alias("_m")).orderBy(F.desc("_m"), value).limit(k).select(value)


def matrix(rows: DataFrame, across: str, down: str, k: int, m: int) -> DataFrame:
    """Counts of the top k x top m values; zeros filled."""
    a, d = top_values(rows, across, k), top_values(rows, down, m)
    grid = a.crossJoin(F.broadcast(d))  # k x m cells
    cells = rows.groupBy(across, down).agg(F.count("*").alias("n"))
    return grid.join(cells, [across, down], "left").na.fill(0, ["n"])


def distinct_matrix(rows: DataFrame, across: str, down: str, study: str, flag: Column, k: int, m: int) -> DataFrame:
    """Distinct studies and flagged share by cell, for the values with the most studies."""
    per = rows.groupBy(across, down, study).agg(F.max(flag).alias("flag"))
    a, d = top_values(per, across, k, F.count_distinct(study)), top_values(per, down, m, F.count_distinct(study))
    cells = per.join(F.broadcast(a), across, "left_semi").join(F.broadcast(d), down, "left_semi")
    return cells.groupBy(across, down).agg(F.count("*").alias("studies"), F.round(F.count_if("flag") / F.count("*"), 6).alias("placebo_ratio"))


def signals(rows: DataFrame, category: str, study: str, flag: Column, least: int = 2, top: int = 20) -> DataFrame:
    """Studies, placebo studies, mentions, density and its band by category; upper median of the studies."""
    per = rows.groupBy(category, study).agg(F.count("*").alias("n"), F.max(flag).alias("flag"))
    stats = per.groupBy(category).agg(F.count(study).alias("studies"), F.count_if("flag").alias("placebo"), F.sum("n").alias("mentions")).where(F.col("studies") >= least)
    best = stats.orderBy(F.desc("studies"), category).limit(top).withColumn("density", F.col("mentions") / F.col("studies"))
    every = Window.partitionBy(F.lit(0))  # at most ``top`` rows
    share = F.col("density") / F.max("density").over(every)
    middle = F.array_sort(F.collect_list("studies").over(every))
    return best.withColumn("band", F.when(share < 0.33, "low").when(share < 0.67, "medium").otherwise("high")).withColumn("median_studies", F.element_at(middle, (F.floor(F.size(middle) / 2) + 1).cast("int"))).withColumn("density", F.round("density", 6))


def flows(rows: DataFrame, study: str, source: str, phase: str, category: str, order: str, top: int = 10) -> DataFrame:
    """Links source -> phase (distinct studies) and phase -> category (distinct study, phase and category); the first phase of a study counts."""
    best = top_values(rows, category, top, F.count_distinct(study))
    first = rows.groupBy(study).agg(F.min_by(F.struct(F.col(source).alias("s"), T.clean_phase(F.col(phase)).alias("p")), order).alias("x")).select(study, "x.s", "x.p")
    a = first.groupBy(F.col("s").alias("from"), F.col("p").alias("to")).agg(F.count("*").alias("n"))
    links = rows.select(study, category).distinct().join(F.broadcast(best), category, "left_semi").join(first.select(study, "p"), study)
    b = links.groupBy(F.col("p").alias("from"), F.col(category).alias("to")).agg(F.count("*").alias("n"))
    return a.select(F.lit("source").alias("link"), "from", "to", "n").unionByName(b.select(F.lit("phase").alias("link"), "from", "to", "n"))


def profiles(rows: DataFrame, category: str, study: str, flag: Column, year: str, variety: str, this_year: int, k: int = 5, recent: int = 5) -> DataFrame:
    """Normalised study and mention counts, placebo share, share of the last years and variety of the top categories."""
    new = F.col(year) > this_year - recent
    own = rows.groupBy(category, F.col(study).alias("_s")).agg(F.count("*").alias("m"), F.max(F.coalesce(flag, F.lit(False))).alias("p"), F.max(F.coalesce(new, F.lit(False))).alias("r"))
    there = F.col("_s").isNotNull()
    kinds = rows.select(F.col(category).alias("_c"), variety).distinct().groupBy("_c").agg(F.count(variety).alias("v"))
    per = own.groupBy(category).agg(F.count("_s").alias("s"), F.sum("m").alias("m"), F.count_if(F.col("p") & there).alias("p"), F.count_if(F.col("r") & there).alias("r"))
    per = per.join(kinds, F.col(category).eqNullSafe(F.col("_c"))).drop("_c")
    best, every = per.orderBy(F.desc("s"), category).limit(k), Window.partitionBy(F.lit(0))  # at most k rows
    of = lambda x: F.round(F.least(F.lit(1.0), F.col(x) / F.max(x).over(every)), 6)
    return best.select(category, of("s").alias("studies"), of("m").alias("mentions"), F.round(F.col("p") / F.col("s"), 6).alias("placebo"), F.round(F.col("r") / F.col("s"), 6).alias("recency"), of("v").alias("diversity"))


def timeline(rows: DataFrame, study: str, year: Column, flag: Column) -> DataFrame:
    """Studies by the year they were first seen, all and flagged, with running totals (one row a year)."""
    first = rows.select(F.col(study).alias("study"), year.alias("year"), flag.alias("flag")).where("year is not null").groupBy("study").agg(F.min("year").alias("year"), F.max("flag").alias("flag"))
    per = first.groupBy("year").agg(F.count("*").alias("n"), F.count_if("flag").alias("placebo"))
    run = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumns({"n_total": F.sum("n").over(run), "placebo_total": F.sum("placebo").over(run)})


def decades(rows: DataFrame, year: Column, before: int = 1990) -> DataFrame:
    """Rows by decade, earlier ones together, with their share."""
    label = F.when(year < before, F.lit(f"pre-{before}")).otherwise(F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s")))
    per = rows.where(year.isNotNull()).groupBy(label.alias("decade")).agg(F.count("*").alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 6))


def top_shares(rows: DataFrame, study: str, value: Column, name: str, k: int = 15) -> DataFrame:
    """Top values by distinct studies, with their percentage of all studies."""
    total = rows.agg(F.count_distinct(study).alias("t"))
    per = rows.select(F.col(study).alias("study"), F.explode(value).alias(name)).distinct().groupBy(name).agg(F.count("*").alias("n"))
    return per.orderBy(F.desc("n"), name).limit(k).crossJoin(F.broadcast(total)).select(name, "n", F.round(F.col("n") * 100 / F.col("t"), 4).alias("pct"))


def bands(stats: DataFrame, studies: str, placebo: str, high: float = 0.3, some: float = 0.1) -> DataFrame:
    ratio = F.coalesce(F.try_divide(F.col(placebo), F.col(studies)), F.lit(0.0))
    return stats.withColumn("placebo_ratio", F.round(ratio, 6)).withColumn("band", F.when(ratio > high, "high").when(ratio > some, "some").otherwise("low"))


def signal_map(stats: DataFrame, category: str, studies: str, placebo: str, top: int = 7, few: int = 4) -> DataFrame:
    """Total against placebo studies, the pooled ratio, and which categories are labelled (a table of categories)."""
    every = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(Window.orderBy(F.desc(studies), category))
    pooled = F.round(F.sum(placebo).over(every) / F.sum(studies).over(every), 6)
    return stats.select(category, studies, placebo, pooled.alias("pooled_ratio"), ((rank <= top) | (F.col(placebo) <= few)).alias("labelled"))
