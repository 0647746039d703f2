"""Enrichment of studies from secondary tables, and the log that gates it."""

from __future__ import annotations

from collections.abc import Callable

from evimap.functions import text as T
from evimap.operators.dedup import last_per_key, top_per_key
from evimap.operators.quality import rounded
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def study_dois(publications: DataFrame, study: str = "nct_id") -> DataFrame:
    return publications.where(T.blank_to_null(F.col("doi")).isNotNull()).select(study, "doi").distinct()


def citation_totals(dois: DataFrame, citations: DataFrame, study: str = "nct_id") -> DataFrame:
    """Citations of each study: over its DOIs, the largest count of any source."""
    best = citations.groupBy("doi").agg(F.max("cited_by_count").alias("n"))
    return dois.join(best, "doi").groupBy(study).agg(F.sum("n").alias("cited_by_total"))


def open_access_status(dois: DataFrame, access: DataFrame, study: str = "nct_id") -> DataFrame:
    return dois.join(access, "doi").groupBy(study).agg(F.bool_or(F.col("is_oa") == 1).alias("is_oa"), F.min_by("oa_status", "doi").alias("oa_status"))


def top_reactions(signals: DataFrame, study: str = "nct_id", n: int = 10) -> DataFrame:
    best = top_per_key(signals, [study], n, F.desc("total_count"), F.col("drug_name"), F.col("reaction"))
    item = F.struct("rank", F.struct(F.col("drug_name").alias("drug"), "reaction", F.col("total_count").alias("count")).alias("x"))
    return best.groupBy(study).agg(F.transform(F.array_sort(F.collect_list(item)), lambda r: r["x"]).alias("faers_top_reactions"))


def publication_lists(publications: DataFrame, mesh: DataFrame, study: str = "nct_id") -> DataFrame:
    """pub_count and the sorted pmid, doi and mesh lists of each study."""
    lists = publications.groupBy(study).agg(
        F.count("*").alias("pub_count"), F.array_sort(F.collect_set(T.blank_to_null(F.col("pmid")))).alias("pmid_list"), F.array_sort(F.collect_set(T.blank_to_null(F.col("doi")))).alias("doi_list"),
    )
    terms = publications.select(study, "pmid").distinct().join(mesh.select("pmid", "descriptor_name").distinct(), "pmid")
    return lists.join(terms.groupBy(study).agg(F.array_sort(F.collect_set("descriptor_name")).alias("mesh_terms")), study, "left")


def enrichment_sources(log: DataFrame, study: str = "nct_id") -> DataFrame:
    return log.where("status = 'ok'").groupBy(study).agg(F.array_sort(F.collect_set("source")).alias("enrichment_sources"))


def gather(trials: DataFrame, publications: DataFrame, mesh: DataFrame, citations: DataFrame, access: DataFrame, signals: DataFrame, log: DataFrame, study: str = "nct_id") -> DataFrame:
    """All enrichment columns of all studies as one plan."""
    dois = study_dois(publications, study)
    parts = [publication_lists(publications, mesh, study), citation_totals(dois, citations, study), open_access_status(dois, access, study), top_reactions(signals, study), enrichment_sources(log, study)]
    out = trials.select(study).distinct()
    for p in parts:
        out = out.join(p, study, "left")
    return out.na.fill(0, ["pub_count", "cited_by_total"])


def latest_log(log: DataFrame, keys: list[str], stamp: str, sequence: str) -> DataFrame:
    return last_per_key(log, keys, stamp, sequence)


def needs_refetch(work: DataFrame, log: DataFrame, keys: list[str], stamp: str, status: str, now: Column, max_age_days: float, good: tuple[str, ...] = ("ok", "empty")) -> DataFrame:
    """Work items without a good log row that is at most ``max_age_days`` old; an error after a good row does not undo it."""
    fresh = log.where(F.col(status).isin(*good) & (F.timestamp_diff("MICROSECOND", F.col(stamp), now) <= max_age_days * 86_400_000_000))
    return work.join(fresh.select(*keys).distinct(), keys, "left_anti")


def fetch_cycle(work: DataFrame, log: DataFrame, keys: list[str], fetch: Callable[[DataFrame], DataFrame], stamp: str, status: str, now: Column, max_age_days: float, failed: Column, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One gated cycle: fresh items are skipped, the rest fetched, and every fetched item is logged.

    ``fetch`` turns the work list (``keys``) into result rows that carry
    ``keys``; ``failed`` tells its rows that report an error.  Returns the rows
    to store and the log rows to append: keys, stamp (``at``, else the current
    time), status (ok, empty or error) and the number of rows stored.
    """
    due = needs_refetch(work, log, keys, stamp, status, now, max_age_days).select(*keys).distinct()
    rows = fetch(due)
    bad = F.coalesce(failed, F.lit(False))
    per = rows.groupBy(*keys).agg(F.count_if(~bad).alias("rows"), F.count_if(bad).alias("_failed"))
    state = F.when(F.col("_failed") > 0, "error").when(F.col("rows") > 0, "ok").otherwise("empty")
    return rows.where(~bad), due.join(per, keys, "left").select(*keys, (F.current_timestamp() if at is None else at).alias(stamp), state.alias(status), F.coalesce("rows", F.lit(0)).alias("rows"))


def staleness(log: DataFrame, key: str, stamp: str, now: Column | None = None) -> DataFrame:
    """Age in days, at ``now`` or else at the newest fetch, of the source that was fetched least recently."""
    ends = log.groupBy(key).agg(F.max(stamp).alias("last")).agg(F.min("last").alias("oldest"), F.max("last").alias("newest"))
    return ends.select("oldest", rounded(F.timestamp_diff("SECOND", F.col("oldest"), F.col("newest") if now is None else now) / 86400).alias("age_days"))


def first_drugs(names: Column, n: int = 10) -> Column:
    """The first distinct drugs of a separated list, in order."""
    return F.slice(F.array_distinct(F.filter(F.transform(T.split_list(names), lambda x: T.drug_name(x)), lambda x: x != "")), 1, n)
