"""The whole build: two sources of studies and mentions become one map with its facets, quality rules and run record."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from evimap.functions import rules as R
from evimap.operators import evidence, facets, provenance, quality, resolve
from evimap.operators.lineage import settle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Names:
    """Columns of the sources that the build relies on."""

    key: str = "nct_id"
    title: str = "brief_title"
    sources: str = "data_sources"
    fill: tuple[str, ...] = ("countries",)
    facets: tuple[str, ...] = ("outcome_type", "normalized_keyword", "normalized_unit")
    enrollment: str = "enrollment_count"
    enrollment_type: str = "enrollment_type"


class Build:
    """Merge the studies, put the new source's mentions under the ids they got, and derive everything else from the map.

    Mentions are rows of ``evidence.derived_mentions``.  Each part is made when
    it is asked for; the map is kept in the shared folder, so the parts that
    rest on it do not search the texts again.
    """

    def __init__(self, base: DataFrame, new: DataFrame, base_mentions: DataFrame, new_mentions: DataFrame, id_ok: Column, label: str = "broad", names: Names | None = None, rules: R.RuleSet | None = None, strategy: Mapping[str, object] | None = None) -> None:
        self.names, self.rules, self.label, self.strategy, self.id_ok = names or Names(), rules or R.RuleSet(), label, strategy or {}, id_ok
        n = self.names
        self.studies, self.crosswalk = resolve.merge_sources(base, new, n.key, n.title, n.sources, list(n.fill))
        self._mentions = base_mentions, new_mentions
        self._placebo = F.col("has_placebo_arm")

    @cached_property
    def map(self) -> DataFrame:
        old, new = self._mentions
        found = old.unionByName(resolve.remap(new, self.names.key, self.crosswalk))
        return settle(evidence.living_map(found, self.studies, self.names.key, rules=self.rules))

    @cached_property
    def state(self) -> DataFrame:
        """Support counts of all facets: the one pass over the map that facets and rules share, and what increments add to."""
        return settle(facets.facet_state(self.map, {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self.names.facets}, self.names.key, self._placebo))

    @property
    def facets(self) -> DataFrame:
        return facets.state_stats(self.state)

    @property
    def totals(self) -> DataFrame:
        return facets.totals(self.map, self.names.key, "keyword", "normalized_keyword", self._placebo, list(self.rules.adjuncts), F.col(self.names.sources).isNotNull(), "outcome_type")

    @property
    def quality(self) -> DataFrame:
        n = self.names
        facts = quality.state_facts(self.state, self.studies, n.key, "normalized_keyword", "normalized_unit", self.id_ok, self.rules.adjuncts, n.enrollment, n.enrollment_type, n.facets)
        orphans = quality.no_orphans(evidence.orphan_counts(self.map, self.studies, n.key))
        return quality.all_checks([quality.run_checks(facts, quality.map_checks()), orphans])

    @property
    def record(self) -> DataFrame:
        r, totals = self.rules, self.totals
        version = provenance.rule_version([list(map(list, r.categories)), list(r.keywords), dict(r.vetoes), list(map(list, r.units))])
        runs = totals.select(F.lit(self.label).alias("label"), F.current_timestamp().alias("completed"), "*").withColumn("run_id", F.expr("uuid()"))
        return provenance.run_records(runs, "label", "completed", "run_id", totals.columns, self.strategy).withColumn("ontology_version", F.lit(version))
