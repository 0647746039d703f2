"""Data-quality rules as rows: rule_id, severity, passed, message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from evimap.operators.facets import distinct_values
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A condition over one row of aggregates; ``value`` is shown in the message."""

    rule_id: str
    severity: str
    passed: Column
    value: Column
    text: str


def ratio(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def rounded(value: Column) -> Column:
    """To four digits, as the comparison engine rounds: a number just below a half goes down, whatever its shortest digits are."""
    return F.round(value * 10000) / 10000


def shown(facts: DataFrame, value: Column) -> Column:
    """A value as text; numbers with a fraction in plain digits, small and large ones too."""
    text = value.cast("string")
    if facts.select(value.alias("v")).schema["v"].dataType.typeName() not in ("double", "float"):
        return text
    return F.coalesce(F.regexp_replace(value.try_cast("decimal(38,6)").cast("string"), r"(\.\d+?)0+$", "$1"), text)


def run_checks(facts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks over one row of facts, which is computed once."""
    rows = F.array(*(F.struct(F.lit(c.rule_id).alias("rule_id"), F.lit(c.severity).alias("severity"), F.coalesce(c.passed, F.lit(False)).alias("passed"), F.concat(F.lit(c.text + ": "), F.coalesce(shown(facts, c.value), F.lit("none"))).alias("message")) for c in checks))
    return facts.select(F.explode(rows).alias("r")).select("r.*")


def schema_check(df: DataFrame, rule_id: str, columns: Sequence[str]) -> DataFrame:
    """P0: all columns of the contract are there."""
    missing = sorted(set(columns) - set(df.columns))
    return df.sparkSession.createDataFrame([(rule_id, "P0", not missing, "missing columns: " + (", ".join(missing) or "none"))], "rule_id string, severity string, passed boolean, message string")


def all_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def map_facts(living_map: DataFrame, studies: DataFrame, key: str, category: str, unit: str, flag: Column, id_ok: Column, adjuncts: Sequence[str], enrollment: str, kind: str, sections: Mapping[str, str] | None = None) -> DataFrame:
    """One row of all aggregates that the map rules need; studies are aggregated first and then summed.

    ``sections`` names further facet columns of the map; each must have a value (rule ``facets_present``).
    """
    adjunct = F.col(category).isin(*adjuncts)
    on = F.coalesce(flag, F.lit(False))
    per = living_map.groupBy(F.col(key).alias("s")).agg(
        F.count("*").alias("n"), F.count_if(F.col(category) == "Unmapped").alias("unmapped"), F.count_if(F.coalesce(F.trim(unit), F.lit("")) == "").alias("unitless"), F.count_if(~id_ok).alias("bad_ids"),
        F.max(on).alias("placebo"), F.max(~on).alias("other"), F.count_if(adjunct).alias("adjunct"), F.count_if(~adjunct).alias("core"),
    )
    there, zero = F.col("s").isNotNull(), F.lit(0)
    a = per.agg(
        *(F.coalesce(F.sum(c), zero).alias(n) for c, n in (("n", "mentions"), ("unmapped", "unmapped"), ("unitless", "unitless"), ("bad_ids", "bad_ids"), ("adjunct", "adjunct"), ("core", "core"))),
        F.count("s").alias("total"), F.count_if(F.col("placebo") & there).alias("placebo"), F.count_if(F.col("other") & there).alias("non_placebo"),
        F.count_if((F.col("adjunct") > 0) & there).alias("adjunct_studies"), F.count_if((F.col("core") > 0) & there).alias("core_studies"),
    )
    a = a.crossJoin(F.broadcast(distinct_values(living_map, {"categories": category} | dict(sections or {}))))  # one row
    a = a.withColumn("empty_sections", reduce(lambda x, y: x + y, (F.when(F.col(s) > 0, 0).otherwise(1) for s in ["categories", *(sections or {})])))
    n = F.col(enrollment).try_cast("long")
    b = studies.agg(F.count_if((n > 50000) | ((n == 0) & (F.upper(kind) == "ACTUAL"))).alias("implausible"), F.count("*").alias("studies"))
    return a.crossJoin(F.broadcast(b))


def state_facts(state: DataFrame, studies: DataFrame, key: str, category: str, unit: str, id_ok: Column, adjuncts: Sequence[str], enrollment: str, kind: str, sections: Sequence[str] = ()) -> DataFrame:
    """The facts of ``map_facts`` from ``facets.facet_state`` of the map, so that the rules do not read mentions again.

    ``category`` and ``unit`` name facets of the state, as do ``sections``; a
    section needs a value that is not blank.
    """
    adjunct, n, mine = F.col("value").isin(*adjuncts), F.col("n"), F.col("facet") == category
    on = lambda c, x: F.sum(F.when(c, x).otherwise(0))
    per = state.groupBy(F.col("study").alias(key)).agg(
        on(mine, n).alias("n"), on(mine & (F.col("value") == "Unmapped"), n).alias("unmapped"), on((F.col("facet") == unit) & (F.coalesce(F.trim("value"), F.lit("")) == ""), n).alias("unitless"),
        on(mine, F.col("flagged")).alias("flagged"), on(mine & adjunct, n).alias("adjunct"), on(mine & ~adjunct, n).alias("core"),
    )
    there, zero = F.col(key).isNotNull(), F.lit(0)
    a = per.agg(
        *(F.coalesce(F.sum(c), zero).alias(c if c != "n" else "mentions") for c in ("n", "unmapped", "unitless", "adjunct", "core")), F.coalesce(F.sum(F.when(~id_ok, F.col("n"))), zero).alias("bad_ids"),
        F.count_if((F.col("n") > 0) & there).alias("total"), F.count_if((F.col("flagged") > 0) & there).alias("placebo"), F.count_if((F.col("n") > F.col("flagged")) & there).alias("non_placebo"),
        F.count_if((F.col("adjunct") > 0) & there).alias("adjunct_studies"), F.count_if((F.col("core") > 0) & there).alias("core_studies"),
    )
    named = [category, *(x for x in sections if x != category)]
    values = state.where(F.trim("value") != "").select("facet", "value").distinct()
    seen = values.agg(F.count_if(F.col("facet") == category).alias("categories"), *(F.count_if(F.col("facet") == x).alias(f"_{i}") for i, x in enumerate(named)))
    empty = reduce(lambda x, y: x + y, (F.when(F.col(f"_{i}") > 0, 0).otherwise(1) for i in range(len(named))))
    number = F.col(enrollment).try_cast("long")
    b = studies.agg(F.count_if((number > 50000) | ((number == 0) & (F.upper(kind) == "ACTUAL"))).alias("implausible"), F.count("*").alias("studies"))
    return a.crossJoin(F.broadcast(seen.select("categories", empty.alias("empty_sections")))).crossJoin(F.broadcast(b))  # one row each


#: Totals of ``map_facts`` that a summary states.
TOTALS = ("mentions", "unmapped", "unitless", "total", "placebo", "non_placebo", "adjunct", "core", "adjunct_studies", "core_studies", "categories")


def bad_totals(names: Sequence[str] = TOTALS) -> Column:
    """How many totals are missing, no whole number or below zero; a summary read back from a file may have any of these."""
    return reduce(lambda a, b: a + b, (F.when(F.coalesce(F.col(n).cast("string").rlike("^[0-9]+$"), F.lit(False)), 0).otherwise(1) for n in names))


def totals_check(summary: DataFrame, names: Sequence[str] = TOTALS) -> DataFrame:
    """P0 over one row of totals as they were written."""
    return single_fact(summary, Check("totals_non_negative", "P0", bad_totals(names) == 0, bad_totals(names), "totals that are no whole number of at least zero"))


def map_checks() -> list[Check]:
    c, r = F.col, ratio
    return [
        Check("totals_non_negative", "P0", bad_totals() == 0, c("mentions"), "mentions"),
        Check("id_format", "P0", c("bad_ids") == 0, c("bad_ids"), "ids of unknown form"),
        Check("totals_add_up", "P0", (c("total") == c("placebo") + c("non_placebo")) & (c("mentions") == c("core") + c("adjunct")), c("total"), "studies"),
        Check("unmapped", "P1", r("unmapped", "mentions") <= 0.05, rounded(r("unmapped", "mentions")), "share of unmapped mentions"),
        Check("unit_gap", "P1", r("unitless", "mentions") <= 0.40, rounded(r("unitless", "mentions")), "share of mentions without unit"),
        Check("facets_present", "P1", c("empty_sections") == 0, c("categories"), "categories"),
        Check("enrollment", "P1", c("implausible") == 0, c("implausible"), "implausible enrolments"),
    ]


#: Rules of ``map_checks`` that rows decide one by one, without a count of studies.
ROW_RULES = ("id_format", "unmapped", "unit_gap")


def row_facts(category: str, unit: str, id_ok: Column, adjuncts: Sequence[str]) -> dict[str, Column]:
    """Facts of ``map_facts`` that need no grouping, for ``files.write_map`` to gather with the write."""
    adjunct = F.col(category).isin(*adjuncts)
    return {
        "mentions": F.count(F.lit(1)), "unmapped": F.count_if(F.col(category) == "Unmapped"), "unitless": F.count_if(F.coalesce(F.trim(unit), F.lit("")) == ""),
        "bad_ids": F.count_if(~id_ok), "adjunct": F.count_if(adjunct), "core": F.count_if(~adjunct),
    }


def row_checks(spark: SparkSession, facts: Mapping[str, object]) -> DataFrame:
    """The rules ``ROW_RULES`` over facts as the write gave them."""
    one = spark.range(1).select(*(F.lit(facts[n]).cast("long").alias(n) for n in ("mentions", "unmapped", "unitless", "bad_ids")))
    return run_checks(one, [c for c in map_checks() if c.rule_id in ROW_RULES])


def single_fact(df: DataFrame, check: Check) -> DataFrame:
    return run_checks(df, [check])


def no_orphans(orphan_counts: DataFrame) -> DataFrame:
    return single_fact(orphan_counts, Check("orphans", "P1", F.col("orphan_mentions") == 0, F.col("orphan_mentions"), "orphan mentions"))


def membership(found: DataFrame, expected: DataFrame, key: str, rule_id: str, severity: str, least: float) -> DataFrame:
    """Share of the expected values that were found, against a lower limit."""
    hit = expected.select(key).distinct().join(found.select(key).distinct().withColumn("_there", F.lit(1)), key, "left")
    facts = hit.agg(F.count("*").alias("n"), F.count("_there").alias("hit"))
    return single_fact(facts, Check(rule_id, severity, ratio("hit", "n") >= least, rounded(ratio("hit", "n")), "share of expected values found"))


def expected_categories(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    return membership(found, expected, key, "expected_categories", "P1", 0.80)


def reference_recall(found: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    return membership(found, reference, key, "reference_recall", "P2", 0.50)


def sources_active(counts: DataFrame, source: str, n: str, needed: Sequence[str]) -> DataFrame:
    facts = counts.agg(*(F.max(F.when(F.col(source) == s, F.col(n))).alias(f"s{i}") for i, s in enumerate(needed)))
    there = reduce(lambda a, b: a & b, (F.coalesce(F.col(f"s{i}"), F.lit(0)) > 0 for i in range(len(needed))))
    return single_fact(facts, Check("sources_active", "P1", there, there, "all primary sources active"))


def dedup_integrity(inconsistent: DataFrame) -> DataFrame:
    return single_fact(inconsistent.agg(F.count("*").alias("n")), Check("dedup_integrity", "P1", F.col("n") == 0, F.col("n"), "ids with more than one source"))


def registry_diversity(counts: DataFrame) -> DataFrame:
    return single_fact(counts.agg(F.count("*").alias("n")), Check("registry_diversity", "P2", F.lit(True), F.col("n"), "registries"))


def enrichment_checks(facts: DataFrame) -> DataFrame:
    """Facts: trials, enriched, age_days, sources, hashes, tables."""
    c, share = F.col, F.least(F.lit(1.0), ratio("enriched", "trials"))
    return run_checks(facts, [
        Check("enrichment_coverage", "P1", share >= 0.30, rounded(share), "share of trials enriched"),
        Check("enrichment_staleness", "P1", c("age_days") < 60, rounded(c("age_days")), "days since the oldest source"),
        Check("enrichment_sources", "P1", c("sources") >= 3, c("sources"), "sources that contributed"),
        Check("enrichment_store", "P2", c("tables") > 0, c("tables"), "enrichment tables"),
        Check("source_hashes", "P2", c("hashes") >= 1, c("hashes"), "source hashes"),
    ])


def provenance_checks(record: DataFrame) -> DataFrame:
    """Record: ontology_version, input_hashes map, parquet_written."""
    return run_checks(record, [
        Check("ontology_version", "P2", F.coalesce(F.trim("ontology_version"), F.lit("")) != "", F.col("ontology_version"), "ontology version"),
        Check("input_hashes", "P2", F.size("input_hashes") > 0, F.size("input_hashes"), "input hashes"),
        Check("parquet_written", "P2", F.col("parquet_written"), F.col("parquet_written"), "parquet written"),
    ])
