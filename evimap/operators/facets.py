"""Facet counts, totals, distributions, funnel and co-occurrence."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet_stats(rows: DataFrame, facets: Mapping[str, Column], study: str, flag: Column) -> DataFrame:
    """facet, value, mentions, studies, flagged studies for all facets in one pass.

    A facet may be an array column; its items count each.  Distinct studies are
    found by a first aggregation on (facet, value, study), which keeps one hot
    value from landing in one task.
    """
    return state_stats(facet_state(rows, facets, study, flag))


def facet_state(rows: DataFrame, facets: Mapping[str, Column], study: str, flag: Column) -> DataFrame:
    """facet, value, study, n (mentions), flagged (those of them with the flag): what the statistics of facets are kept as."""
    def pair(name: str):
        return lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value"))

    pairs = [F.transform(c if _is_list(rows, c) else F.array(c), pair(name)) for name, c in facets.items()]
    long = rows.select(F.col(study).alias("study"), F.coalesce(flag, F.lit(False)).alias("flag"), F.explode(F.concat(*pairs)).alias("f")).select("f.facet", "f.value", "study", "flag")
    return long.groupBy("facet", "value", "study").agg(F.count("*").alias("n"), F.count_if("flag").alias("flagged"))


def state_changes(old: DataFrame, new: DataFrame, facets: Mapping[str, Column], study: str, flag: Column) -> DataFrame:
    """What an increment does to the state: ``old`` are the rows that it takes away or replaces, as they were, ``new`` those that it brings."""
    minus = facet_state(old, facets, study, flag).withColumns({"n": -F.col("n"), "flagged": -F.col("flagged")})
    return added(minus, facet_state(new, facets, study, flag))


def added(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State and signed changes added up; supports that fall to 0 are gone."""
    both = state.unionByName(changes).groupBy("facet", "value", "study").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged"))
    return both.where((F.col("n") != 0) | (F.col("flagged") != 0))


def state_stats(state: DataFrame) -> DataFrame:
    """``facet_stats`` of a state."""
    there = F.col("study").isNotNull()
    return state.groupBy("facet", "value").agg(F.sum("n").alias("mention_count"), F.count("study").alias("study_count"), F.count_if((F.col("flagged") > 0) & there).alias("placebo_study_count"))


def touched_stats(stats: DataFrame, changes: DataFrame, state: DataFrame) -> DataFrame:
    """Statistics after an increment: those of values that ``changes`` names are made anew from ``state`` (with the changes in), the others stay."""
    names = changes.select(F.col("facet").alias("f_"), F.col("value").alias("v_")).distinct()
    same = lambda x: x["facet"].eqNullSafe(names["f_"]) & x["value"].eqNullSafe(names["v_"])
    return stats.join(names, same(stats), "left_anti").unionByName(state_stats(state.join(names, same(state), "left_semi")))


def _is_list(rows: DataFrame, c: Column) -> bool:
    return rows.select(c.alias("c")).schema["c"].dataType.typeName() == "array"


def counts(rows: DataFrame, by: Column, name: str, blank: str | None = None) -> DataFrame:
    """Rows by value (items of a list count each); ``blank`` stands for missing values."""
    value = F.explode(by) if _is_list(rows, by) else by
    out = rows.select(value.alias(name))
    if blank is not None:
        out = out.withColumn(name, F.coalesce(F.when(F.trim(name) != "", F.col(name)), F.lit(blank)))
    return out.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))


def distinct_counts(rows: DataFrame, study: str, by: Column, name: str) -> DataFrame:
    """Distinct studies by value."""
    value = F.explode(by) if _is_list(rows, by) else by
    return rows.select(F.col(study).alias("study"), value.alias(name)).distinct().groupBy(name).agg(F.count("study").alias("n"))


def totals(found: DataFrame, study: str, keyword: str, category: str, flag: Column, adjuncts: list[str], known: Column, outcome: str) -> DataFrame:
    """One row of totals over the mentions.

    Studies are aggregated first and then summed; the distinct values of the
    three small dimensions come from one aggregation on (dimension, value).
    """
    adjunct = F.col(category).isin(adjuncts)
    per_study = found.groupBy(F.col(study).alias("s")).agg(
        F.count("*").alias("n"), F.count_if(adjunct).alias("a"), F.count_if(~adjunct).alias("c"), F.max(F.coalesce(flag, F.lit(False))).alias("f"), F.count_if(~known).alias("o"),
    )
    there = F.col("s").isNotNull()
    sums = per_study.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_mentions"), F.count("s").alias("total_studies"), F.count_if(F.col("f") & there).alias("placebo_studies"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("core_mentions"), F.coalesce(F.sum("a"), F.lit(0)).alias("adjunct_mentions"),
        F.count_if((F.col("c") > 0) & there).alias("core_studies"), F.count_if((F.col("a") > 0) & there).alias("adjunct_studies"), F.coalesce(F.sum("o"), F.lit(0)).alias("orphan_mentions"),
    )
    return sums.crossJoin(F.broadcast(distinct_values(found, {"keywords": keyword, "categories": category, "outcome_types": outcome})))


def distinct_values(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row with the number of distinct non-null values of each column; one aggregation for all of them."""
    names = list(columns)
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(columns[n]).cast("string").alias("v")) for i, n in enumerate(names)))).alias("x")).select("x.i", "x.v")
    each = long.where("v is not null").distinct()
    return each.agg(*(F.count_if(F.col("i") == i).alias(n) for i, n in enumerate(names)))


def table_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, rows: the size of each fetched table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def fetch_summary(studies: DataFrame, arms: DataFrame, found: DataFrame, keyword: str, placebo_arm: Column) -> DataFrame:
    """One row: rows of the three fetched tables, placebo arms and distinct keywords."""
    a = arms.agg(F.count("*").alias("arms"), F.count_if(placebo_arm).alias("placebo_arms"))
    m = found.groupBy(keyword).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("mentions"), F.count(keyword).alias("keywords"))
    return studies.agg(F.count("*").alias("studies")).crossJoin(F.broadcast(a)).crossJoin(F.broadcast(m))  # one row each


def funnel(per_source: DataFrame, merged: DataFrame, study: str, source: str, has_outcome: Column, has_placebo: Column) -> DataFrame:
    """stage, n, pct of the deduplicated total; both ways to count the excluded."""
    total = merged.agg(F.count_distinct(study).alias("after_dedup"), F.count_if(has_outcome).alias("with_outcome"), F.count_if(has_placebo).alias("with_placebo"), F.count_if(has_outcome & has_placebo).alias("with_both"))
    retrieved = per_source.agg(F.count(source).alias("retrieved"))
    one = total.crossJoin(F.broadcast(retrieved)).withColumns({"duplicates_removed": F.col("retrieved") - F.col("after_dedup"), "excluded": F.col("after_dedup") - F.col("with_outcome")})
    stages = ["retrieved", "duplicates_removed", "after_dedup", "with_outcome", "with_placebo", "with_both", "excluded"]
    return one.unpivot("after_dedup", [c for c in stages if c != "after_dedup"], "stage", "n").unionByName(one.select("after_dedup", F.lit("after_dedup").alias("stage"), F.col("after_dedup").alias("n"))).select("stage", "n", F.round(F.try_divide(F.col("n") * 100.0, "after_dedup"), 4).alias("pct"))


def co_occurrence(rows: DataFrame, study: str, category: str, top: int | None = None, exclude: str | None = "Unmapped") -> DataFrame:
    """Unordered pairs of categories by the studies that have both.

    Pairs are made inside a study's sorted set of categories, so a study of k
    categories gives k(k-1)/2 rows and none is shuffled before the count.
    """
    own = rows.where(F.col(category) != exclude) if exclude is not None else rows
    sets = own.groupBy(study).agg(F.array_sort(F.collect_set(category)).alias("c"))
    pairs = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice(F.col("c"), i + 2, F.size("c")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    out = sets.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "a", "b").limit(top) if top else out


def network(pairs: DataFrame, sizes: DataFrame, name: str, size: str) -> DataFrame:
    """Nodes and edges of a pair list (a, b, n), nodes with their size."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias(name)).distinct().join(sizes, name, "left")
    nodes = nodes.select(F.lit("node").alias("kind"), F.col(name).alias("a"), F.lit(None).cast("string").alias("b"), F.col(size).cast("long").alias("n"))
    return nodes.unionByName(pairs.select(F.lit("edge").alias("kind"), "a", "b", F.col("n").cast("long").alias("n")))


def active_sources(rows: DataFrame, sources: Column) -> DataFrame:
    return rows.select(F.explode(sources).alias("s")).agg(F.array_join(F.array_sort(F.collect_set("s")), ";").alias("active_sources"))


def coverage(rows: DataFrame, study: str, sources: Column) -> DataFrame:
    """Studies by source and with any source, as shares of all studies."""
    per_study = rows.select(F.col(study).alias("study"), F.array_distinct(sources).alias("s"))
    total = per_study.agg(F.count_distinct("study").alias("total"), F.count_distinct(F.when(F.size("s") > 0, F.col("study"))).alias("n"))
    each = per_study.select("study", F.explode("s").alias("source")).distinct().groupBy("source").agg(F.count("*").alias("n"))
    every = each.crossJoin(F.broadcast(total.select("total"))).unionByName(total.select(F.lit("(any)").alias("source"), "n", "total"))
    return every.select("source", "n", F.round(F.try_divide(F.col("n") * 100.0, "total"), 4).alias("pct"))


def status_counts(log: DataFrame, source: str, status: str, statuses: list[str]) -> DataFrame:
    """Sources by status, one column for each status."""
    return log.groupBy(source).pivot(status, statuses).count().na.fill(0)


def shares_and_quartiles(rows: DataFrame, value: str, flags: Mapping[str, tuple[Column, Column]], accuracy: int | None = None) -> DataFrame:
    """Median, quartiles and sum of a number, and shares of flags among the rows of their own denominator.

    Quartiles are interpolated and exact: ``exact_quantiles`` finds them in a few
    passes of bounded size.  With ``accuracy`` they take one pass and are off by
    at most 1 / accuracy of the rows.
    """
    at = [0.25, 0.5, 0.75]
    shares = [F.try_divide(F.count_if(of & flag), F.count_if(of)).alias(name) for name, (flag, of) in flags.items()]
    sums = rows.agg(F.sum(value).alias("total"), *shares)
    if accuracy:
        q = rows.agg(F.approx_percentile(F.col(value).cast("double"), F.array(*map(F.lit, at)), accuracy).alias("q"))
    else:
        found = exact_quantiles(rows, value, at)
        q = rows.sparkSession.range(1).select(F.array(*(F.lit(x).cast("double") for x in found)).alias("q"))
    return q.crossJoin(F.broadcast(sums)).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "total", *flags)  # one row each


#: Cells that a pass cuts the range around a quantile into; values of a cell below which they are fetched themselves.
CELLS, FEW = 1024, 1024


def exact_quantiles(rows: DataFrame, value: str, at: list[float], cells: int = CELLS, few: int = FEW) -> list[float | None]:
    """Exact interpolated quantiles of a numeric column, as ``percentile`` gives them, without all values in one task.

    The ranks that matter are closed in by histograms: a pass counts the values
    of ``cells`` cells of the range around each rank, with the least and
    the greatest value of each cell, and the cell that holds the rank is the next
    range, until it holds one value or at most ``few``, which are then fetched.
    Values are counted as they are, so many equal ones make no difference.
    Nulls do not count; NaN is above infinity.  Without values all are null.
    """
    v = F.col("v")
    rows = rows.select(F.col(value).cast("double").alias("v")).where("v is not null")
    fine = ~F.isnan(v) & (F.abs(v) < float("inf"))
    facts = rows.agg(F.count("*").alias("n"), F.count_if(v == float("-inf")).alias("below"), F.count_if(fine).alias("fine"), F.count_if(v == float("inf")).alias("above"), F.min(F.when(fine, v)).alias("lo"), F.max(F.when(fine, v)).alias("hi")).first()
    if not facts.n:
        return [None] * len(at)
    places = [(facts.n - 1) * p for p in at]
    found: dict[int, float] = {}
    ranges: dict[int, tuple[float, float, int, int]] = {}  # rank -> least and greatest value, values below, values in it
    for rank in {f(x) for x in places for f in (math.floor, math.ceil)}:
        if rank < facts.below:
            found[rank] = -math.inf
        elif rank < facts.below + facts.fine:
            ranges[rank] = (facts.lo, facts.hi, facts.below, facts.fine)
        else:
            found[rank] = math.inf if rank < facts.below + facts.fine + facts.above else math.nan
    while ranges:
        found |= {r: lo for r, (lo, hi, _, _) in ranges.items() if lo == hi}
        ranges = {r: x for r, x in ranges.items() if r not in found}
        for lo, hi, before in {(x[0], x[1], x[2]) for x in ranges.values() if x[3] <= few}:
            own = sorted(r.v for r in rows.where(v.between(lo, hi)).collect())  # at most ``few``
            found |= {r: own[r - before] for r, x in ranges.items() if x[:2] == (lo, hi)}
        ranges = {r: x for r, x in ranges.items() if r not in found}
        spans = sorted({x[:3] for x in ranges.values()})
        if not spans:
            break
        # halves before the difference, which could pass the range of a double
        cell = lambda lo, hi: F.least(F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * cells), F.lit(cells - 1)).cast("int") if hi / 2 > lo / 2 else (v > lo).cast("int")
        into = F.array_compact(F.array(*(F.when(v.between(lo, hi), F.struct(F.lit(i).alias("span"), cell(lo, hi).alias("cell"))) for i, (lo, hi, _) in enumerate(spans))))
        counted = rows.select("v", F.explode(into).alias("x")).groupBy("x.span", "x.cell").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        cells_of: dict[int, list] = {}
        for r in sorted(counted.collect()):  # at most ``cells`` for each span
            cells_of.setdefault(r.span, []).append(r)
        for rank, x in ranges.items():
            before = x[2]
            for r in cells_of[spans.index(x[:3])]:
                if rank < before + r.n:
                    ranges[rank] = (r.lo, r.hi, before, r.n)
                    break
                before += r.n
    out = []
    for x in places:
        low, high = math.floor(x), math.ceil(x)
        out.append(found[low] if low == high or found[low] == found[high] else (high - x) * found[low] + (x - low) * found[high])
    return out


def supported(stats: DataFrame, count: str, least: int = 2) -> DataFrame:
    return stats.where(F.col(count) >= least)


def evidence_gaps(stats: DataFrame, category: str, placebo: str, adjuncts: list[str], most: int = 4) -> DataFrame:
    """Core categories with few placebo studies."""
    return stats.where((F.col(placebo) <= most) & ~F.col(category).isin(adjuncts))
