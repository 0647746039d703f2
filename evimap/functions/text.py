"""Text, list, number and date expressions; all of them build JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evimap.functions import defaults as D

DELIMITERS = "/()-,;[]"


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def normal_space(c: Column) -> Column:
    """White space (Unicode) collapsed and trimmed; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def ascii_quotes(c: Column) -> Column:
    return F.translate(c, "‘’′", "'''")


def formula_safe(c: Column) -> Column:
    """Prefix a quote where a spreadsheet would read a formula."""
    risky = c.rlike(r"^[=+@\t\r]") | c.rlike(r"[\n\r][=+@]")
    return F.when(risky, F.concat(F.lit("'"), c)).otherwise(c)


def split_list(c: Column, separator: str = ";") -> Column:
    """Trimmed, non-blank items; null gives an empty list."""
    items = F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def lenient_int(c: Column) -> Column:
    """A whole number of up to 64 bits, else 0."""
    return F.coalesce(F.trim(c.cast("string")).try_cast("long"), F.lit(0).cast("long"))


def title_words(c: Column, least: int = 4) -> Column:
    words = F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\W+")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= least))


def word_jaccard(a: Column, b: Column) -> Column:
    """Of two word arrays; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 1 where both are empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(1.0))


def drug_name(c: Column, dosage: str = D.DOSAGE) -> Column:
    plain = F.regexp_replace(F.trim(c), "(?iU)" + dosage, "")
    plain = F.lower(F.trim(F.regexp_replace(plain, r"(?U)\s+", " ")))
    return F.replace(F.btrim(plain, F.lit(".,;:-")), F.lit('"'), F.lit(""))


def is_nct_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^NCT[0-9]{8}$"), F.lit(False))


def is_trial_id(c: Column) -> Column:
    return F.coalesce(c.rlike(D.TRIAL_ID), F.lit(False))


def partial_year(c: Column) -> Column:
    """Year of a date known in part; null unless it starts with four ASCII digits."""
    head = F.substring(c, 1, 4)
    return F.when(head.rlike("^[0-9]{4}$"), head.cast("int"))


def partial_date(year: Column, month: Column, day: Column, other: Column) -> Column:
    """YYYY[-MM[-DD]] from parts (months as numbers or English names), else ``other``."""
    names = F.create_map(*(F.lit(x) for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1) for x in (m, f"{i:02d}")))
    number = F.when(month.rlike("^[0-9]{1,2}$"), F.lpad(month, 2, "0")).otherwise(names[F.lower(F.substring(month, 1, 3))])
    full = F.when(number.isNull(), year).when(blank_to_null(day).isNull(), F.concat_ws("-", year, number)).otherwise(F.concat_ws("-", year, number, F.lpad(day, 2, "0")))
    return F.when(blank_to_null(year).isNotNull(), full).otherwise(F.coalesce(other, F.lit("")))


def clean_phase(c: Column) -> Column:
    """PHASE2 to Phase2; NA alone, blank and null to Not Stated."""
    return F.when(F.coalesce(F.trim(c), F.lit("")).isin("", "NA", "N/A"), "Not Stated").otherwise(F.regexp_replace(c, "PHASE", "Phase"))


def age_days(stamp: Column, now: Column) -> Column:
    """Days between an ISO-8601 text and ``now``; null where it does not parse."""
    return F.timestamp_diff("SECOND", F.try_to_timestamp(stamp), now) / 86400


def freshness(days: Column) -> Column:
    """Age as text."""
    whole = F.floor(days).cast("string")
    return F.when(days.isNull(), "unknown").when(days < 1, "today").when(days < 2, "1 day ago").otherwise(F.concat(whole, F.lit(" days ago")))


def pct_change(old: Column, new: Column) -> Column:
    """Percent change; from zero to more is 100, from zero to zero 0, null without an old value."""
    grown = F.when(new == 0, 0.0).otherwise(100.0)
    return F.when(old.isNull(), F.lit(None)).when(old == 0, grown).otherwise((new - old) / old * 100)


def drift_severity(pct: Column, minor: float = 5.0, major: float = 20.0) -> Column:
    size = F.abs(pct)
    return F.when(size >= major, "major").when(size >= minor, "minor").otherwise("none")


def escape(c: Column, *delimiters: str) -> Column:
    """Make delimiters safe inside a joined list."""
    for d in delimiters:
        c = F.replace(c, F.lit(d), F.lit(" "))
    return c


def canonical_hash(*columns: str) -> Column:
    """SHA-256 of the columns as one JSON document with sorted names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
