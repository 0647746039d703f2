"""The wide evidence map: mentions with the attributes of their studies."""

from __future__ import annotations

from collections.abc import Mapping

from evimap.functions import rules as R
from evimap.functions import text as T
from evimap.operators.dedup import last_per_key
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mentions(texts: DataFrame, text: Column, keywords=None, vetoes=None) -> DataFrame:
    """One row for each keyword found in the text of a row."""
    options = {k: v for k, v in (("keywords", keywords), ("vetoes", vetoes)) if v is not None}
    return texts.withColumn("keyword", F.explode(R.matches(text, **options)))


def derived_mentions(texts: DataFrame, text: Column, rules: R.RuleSet | None = None) -> DataFrame:
    """``mentions`` with normalized_keyword and ``unit`` (raw, normal); the unit of a text is found once, before its keywords are exploded."""
    rules = rules or R.RuleSet()
    own = texts.withColumns({"_text": text, "_keywords": R.matches(text, rules.keywords, rules.vetoes)}).where(F.size("_keywords") > 0)
    rows = own.withColumn("unit", R.unit(F.col("_text"), rules.units, rules.change)).withColumn("keyword", F.explode("_keywords")).drop("_keywords")
    return rows.withColumn("normalized_keyword", R.category(F.col("keyword"), F.col("_text"), rules.categories, rules.vetoes)).drop("_text")


def with_studies(found: DataFrame, studies: DataFrame, key: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left join to the last row of each study; ``defaults`` fill the columns of unknown studies."""
    known = last_per_key(studies.where(F.trim(F.col(key).cast("string")) != ""), [key])
    out = found.join(known, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def orphans(found: DataFrame, studies: DataFrame, key: str) -> DataFrame:
    return found.join(studies.select(key), key, "left_anti")


def orphan_counts(found: DataFrame, studies: DataFrame, key: str) -> DataFrame:
    return orphans(found, studies, key).agg(F.count("*").alias("orphan_mentions"), F.count_distinct(key).alias("orphan_studies"))


def living_map(found: DataFrame, studies: DataFrame, key: str = "nct_id", whole: str | None = None, rules: R.RuleSet | None = None) -> DataFrame:
    """Mentions (key, outcome_type, measure, keyword, matched_text) as the wide map with category and unit.

    Category and unit come from measure and matched_text, or from the column
    ``whole`` where these two are cut for display; ``whole`` is not kept.  Rows
    of ``derived_mentions`` bring both along.
    """
    rules = rules or R.RuleSet()
    text = F.col(whole) if whole else F.concat_ws(" ", "measure", "matched_text")
    placebo = F.coalesce(F.col("placebo_arm_count"), F.lit(0)) > 0
    derived = found
    if not {"normalized_keyword", "unit"} <= set(found.columns):
        derived = found.withColumn("normalized_keyword", R.category(F.col("keyword"), text, rules.categories, rules.vetoes)).withColumn("unit", R.unit(text, rules.units, rules.change))
    wide = with_studies(derived.drop(whole) if whole else derived, studies, key)
    names = [c for c in wide.columns if c not in ("normalized_keyword", "unit")]
    wide = wide.withColumns({"unit_raw": F.col("unit.raw"), "normalized_unit": R.fallback_unit(F.col("unit.normal"), F.col("normalized_keyword"), rules.category_units), "has_placebo_arm": placebo})
    return wide.select(*names, "normalized_keyword", "unit_raw", "normalized_unit", "has_placebo_arm")


def encoded_lists(df: DataFrame, lists: Mapping[str, str], records: Mapping[str, list[str]]) -> DataFrame:
    """Lists as text with their separator, arrays of structs as field::field joined by ;;, delimiters made safe."""
    def item(separator: str):
        return lambda x: T.escape(x.cast("string"), separator)

    def record(fields: list[str]):
        return lambda x: F.concat_ws("::", *(T.escape(x[n].cast("string"), "::", ";;") for n in fields))

    flat = {c: F.array_join(F.transform(c, item(sep)), sep) for c, sep in lists.items()}
    flat |= {c: F.array_join(F.transform(c, record(fields)), ";;") for c, fields in records.items()}
    return df.withColumns(flat)


def detail_index(rows: DataFrame, key: str, attributes: list[str], outcome: list[str], order: str) -> DataFrame:
    """One row for each study: attributes of its first row, and its distinct outcomes."""
    first = [F.min_by(F.col(c), F.col(order)).alias(c) for c in attributes]
    return rows.groupBy(key).agg(*first, F.array_sort(F.collect_set(F.struct(*outcome))).alias("outcomes"))


def arms_map(arms: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return arms.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("arms"))


def detail_view(index: DataFrame, arms: DataFrame, enrichment: DataFrame, key: str, slices: Mapping[str, int]) -> DataFrame:
    """Study detail with its arms and the first items of its enrichment lists."""
    short = enrichment.withColumns({c: F.slice(c, 1, n) for c, n in slices.items()})
    return index.join(arms, key, "left").join(short, key, "left")


def arm_counts(study_arrays: DataFrame, arms: str, outcomes: str, is_placebo, hits) -> DataFrame:
    """Counts per study from its arrays, before they are exploded."""
    return study_arrays.withColumns({
        "arm_count": F.size(arms), "placebo_arm_count": F.size(F.filter(arms, is_placebo)), "outcome_count": F.size(outcomes),
        "hemo_outcome_count": F.aggregate(F.transform(outcomes, hits), F.lit(0), lambda a, x: a + x),
    })
