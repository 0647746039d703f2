"""The wide map and the whole build, on documents as studies."""

from __future__ import annotations

import re

from evimap.functions import defaults as D
from evimap.functions import rules as R
from evimap.operators import build, evidence
from evimap.plans.queries import query, table
from evimap.plans.text_queries import _CHAIN, _HEADS, _SHARED, _SIM, _SPLIT, CATEGORIES, VETO, WORDS, heads
from pyspark.sql import functions as F

#: The default rules, with words, contexts and units that these documents have as well.
RULES = R.RuleSet(
    keywords=[*D.KEYWORDS, *WORDS], vetoes={**D.VETOES, **VETO}, categories=[*D.CATEGORIES, *CATEGORIES], units=[*D.UNITS, (r"\bversion \d", "release")], category_units={**D.CATEGORY_UNITS, "Licence text": "licence"}
)
_EDGE = r"[^\pL\pN\pM_]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _found(token: str, text: str) -> str:
    token = token.lower()
    if len(token) <= 3:
        parts = rf"string_split_regex(translate({text}, '/()-,;[]', '        '), '\s+')"
        found = f"list_contains({parts}, {_text(token)})"
    else:
        found = f"regexp_matches({text}, {_text(f'(^|{_EDGE}){re.escape(token)}($|{_EDGE})')})"
    veto = RULES.vetoes.get(token)
    if veto:
        # no look-ahead here: the excepted phrase is taken out first
        found += f" and not regexp_matches(regexp_replace({text}, 'cerebral\\s+perfusion\\s+pressure', '', 'g'), {_text(veto.replace('(?!' + chr(92) + 's+pressure)', ''))})"
    return f"({found})"


def _category(text: str) -> str:
    return "case " + " ".join(f"when {' or '.join(_found(t, text) for t in tokens)} then {_text(name)}" for name, tokens in RULES.categories) + " end"


def _unit(text: str, pick: int) -> str:
    """The first unit pattern as raw text (pick 0) or name (1)."""
    out = []
    for p, name in RULES.units:
        if "(?<=" in p:
            p, group = r"\d\s?(sec(?:onds)?)(?:$|[^\pL\pN\pM_])", 1
        else:
            group = 0
        out.append(f"when regexp_matches({text}, {_text(p)}) then " + (_text(name) if pick else f"regexp_extract({text}, {_text(p)}, {group})"))
    percent = f"when ({text} like '%!%%' escape '!' or {text} like '%percent%') and not regexp_matches({text}, {_text(RULES.change)}) then '%'"
    return "case " + " ".join(out) + f" {percent} else '' end"


def _map_sql(mentions: str) -> str:
    """Columns unit_raw, normalized_keyword and normalized_unit of mentions (keyword, low, raw, name)."""
    alone = _category("lower(keyword)")
    units = "case normalized_keyword " + " ".join(f"when {_text(k)} then {_text(v)}" for k, v in RULES.category_units.items()) + " else '' end"
    return f"c as (select *, coalesce({alone}, {_category('lower(keyword) || ' + chr(39) + ' ' + chr(39) + ' || low')}, 'Unmapped') normalized_keyword from {mentions}), m as (select *, raw unit_raw, coalesce(nullif(name, ''), {units}) normalized_unit from c)"


_LOW = "translate(lower(text), '‘’′', '''''''')"
_MENTIONS = f"""d as (select doc_id, text, lang, source, {_LOW} low from documents), k as (select *, unnest([{', '.join(f"case when {_found(w, 'low')} then {_text(w)} end" for w in RULES.keywords)}]) keyword from d),
u as (select k.*, {_unit('lower(text)', 0)} raw, {_unit('lower(text)', 1)} as name from k where keyword is not null)"""


def texts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("nct_id"), "text", "lang", "source")


def found(docs):
    columns = [c for c in docs.columns if c == "nct_id"]
    rows = docs.select(*columns, "text", F.lit("inferred").alias("outcome_type"), F.substring("text", 1, 200).alias("measure"), F.substring("text", 1, 500).alias("matched_text"))
    return evidence.derived_mentions(rows, F.col("text"), RULES).drop("text")


@query(f"""with {_MENTIONS}, {_map_sql('u')} select cast(doc_id as varchar) nct_id, 'inferred' outcome_type, left(text, 200) measure, keyword, left(text, 500) matched_text, lang, source, case when lang = 'en' then 1 else 0 end placebo_arm_count, normalized_keyword, unit_raw, normalized_unit, lang = 'en' has_placebo_arm from m""")
def living_map(spark, d):
    """Documents as studies, their texts searched with the default dictionary and more, and the wide map of the hits."""
    docs = texts(spark, d)
    studies = docs.select("nct_id", "lang", "source", (F.col("lang") == "en").cast("int").alias("placebo_arm_count"))
    return evidence.living_map(found(docs), studies, rules=RULES)


# Sources src1 and src10 to src19 are the registry; the others are articles, and some studies come in both.
_MERGE = f"""{_HEADS}, base as (select doc_id id, t, 'registry' s, case when doc_id % 2 = 0 then '' else source end c from h where source like 'src1%'),
fresh as (select doc_id id, t, 'article' s, source c from h where source not like 'src1%' union all select id, 'update of ' || t, 'article', 'zz' from base where id % 4 = 0),
x1 as (select distinct id l, id r from fresh where id in (select id from base)), r1 as (select * from fresh where id not in (select l from x1)),
x2 as (select f.id l, min(b.id) r from r1 f join base b on b.t = f.t and f.t <> '' group by 1), r2 as (select * from r1 where id not in (select l from x2)),
x as (select t, min(id) id, {_SPLIT} w from r2 group by t), y as (select t, min(id) id, {_SPLIT} w from base group by t), {_SHARED}, q as (select tl, ir, {_SIM} sim from p where s >= greatest(2, n // 2) and s / (n + m - s) >= 0.5),
z as (select tl, arg_max(ir, (sim, -ir)) r from q where sim >= 0.85 group by 1), x3 as (select r2.id l, z.r from r2 join z on z.tl = r2.t), r3 as (select * from r2 where id not in (select l from x3)),
{_CHAIN}, stays as (select * from r3 where id not in (select l from links)),
tags as (select r id, min(nullif(c, '')) c from (select * from x1 union all select * from x2 union all select * from x3) a join fresh on fresh.id = l group by 1), more as (select r id, min(nullif(c, '')) c from links join r3 on r3.id = l group by 1),
studies as (select b.id, case when tags.id is null then 'registry' else 'article;registry' end s, coalesce(nullif(b.c, ''), tags.c) c from base b left join tags on tags.id = b.id union all select k.id, 'article', coalesce(nullif(k.c, ''), more.c) from stays k left join more on more.id = k.id),
cross_ as (select * from (select * from x2 union all select * from x3 union all select * from links) where l <> r)"""


def whole_build(spark, d):
    docs = heads(spark, d).select(F.col("doc_id"), "source", F.col("t").alias("brief_title")).join(table(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id")
    docs = docs.select(F.col("doc_id").alias("nct_id"), "brief_title", "text", "source", F.when(F.col("lang") == "en", 1).otherwise(0).alias("placebo_arm_count"))
    one, k = F.col("source").startswith("src1"), F.col("nct_id")
    columns = ["nct_id", "brief_title", "data_sources", "countries", "placebo_arm_count", "enrollment_count", "enrollment_type"]
    more = {"enrollment_count": k, "enrollment_type": F.lit("ACTUAL")}
    base = docs.where(one).withColumns({"data_sources": F.lit("registry"), "countries": F.when(k % 2 == 0, "").otherwise(F.col("source")), **more}).select(columns)
    new = docs.where(~one).withColumns({"data_sources": F.lit("article"), "countries": F.col("source"), **more}).select(columns)
    again = base.where("nct_id % 4 = 0").withColumns({"brief_title": F.concat(F.lit("update of "), "brief_title"), "data_sources": F.lit("article"), "countries": F.lit("zz")})
    return build.Build(base, new.unionByName(again), found(docs.where(one).select("nct_id", "text")), found(docs.where(~one).select("nct_id", "text")), F.col("nct_id") >= 0, rules=RULES)


@query(f"with recursive {_MERGE} select id nct_id, s data_sources, c countries from studies")
def merged_studies(spark, d):
    return whole_build(spark, d).studies.select("nct_id", "data_sources", "countries")


@query(f"with recursive {_MERGE} select l left_id, r right_id from cross_")
def merge_crosswalk(spark, d):
    return whole_build(spark, d).crosswalk


_BUILT = f"{_MERGE}, {_MENTIONS}, {_map_sql('u')}, b as (select coalesce(cross_.r, m.doc_id) id, m.keyword, m.normalized_keyword, m.unit_raw, m.normalized_unit, m.doc_id own from m left join cross_ on cross_.l = m.doc_id), w as (select b.*, studies.s, studies.c, e.lang = 'en' placebo from b join studies on studies.id = b.id join documents e on e.doc_id = b.id)"


@query(f"with recursive {_BUILT} select id nct_id, keyword, normalized_keyword, unit_raw, normalized_unit, placebo has_placebo_arm, s data_sources, c countries, count(*) n from w group by all")
def built_map(spark, d):
    wide = whole_build(spark, d).map
    return wide.groupBy("nct_id", "keyword", "normalized_keyword", "unit_raw", "normalized_unit", "has_placebo_arm", "data_sources", "countries").agg(F.count("*").alias("n"))


@query(f"""with recursive {_BUILT}, f as (select unnest(['outcome_type', 'normalized_keyword', 'normalized_unit']) facet, unnest(['inferred', normalized_keyword, normalized_unit]) as value, id, placebo from w) select facet, value, count(*) mention_count, count(distinct id) study_count, count(distinct case when placebo then id end) placebo_study_count from f group by 1, 2""")
def built_facets(spark, d):
    return whole_build(spark, d).facets


@query(f"""with recursive {_BUILT}, f as (select count(*) mentions, count(distinct id) total, count(distinct normalized_keyword) categories, count(*) filter (normalized_keyword = 'Unmapped') / count(*) unmapped, count(*) filter (normalized_unit = '') / count(*) unitless, (select count(*) from studies where id > 50000 or id = 0) bad from w)
select 'totals_non_negative' rule_id, true passed from f union all select 'id_format', true from f union all select 'totals_add_up', true from f union all select 'unmapped', unmapped <= 0.05 from f union all select 'unit_gap', unitless <= 0.4 from f
union all select 'facets_present', categories > 0 from f union all select 'enrollment', bad = 0 from f union all select 'orphans', true from f""")
def built_quality(spark, d):
    return whole_build(spark, d).quality.select("rule_id", "passed")


@query(f"with recursive {_BUILT} select 'broad' as label, count(*) total_mentions, count(distinct id) total_studies, count(distinct case when placebo then id end) placebo_studies, count(distinct keyword) keywords, true versioned from w")
def built_record(spark, d):
    record = whole_build(spark, d).record
    total = lambda n: F.get_json_object("totals", f"$.{n}").cast("long").alias(n)
    return record.select("label", *(total(n) for n in ("total_mentions", "total_studies", "placebo_studies", "keywords")), (F.length("ontology_version") == 64).alias("versioned"))
