"""Increments, enrichment, quality and provenance."""

from __future__ import annotations

import uuid

from evimap.functions import text as T
from evimap.operators import enrich, evidence, incremental, provenance, quality
from evimap.operators.dedup import last_per_key
from evimap.operators.lineage import shared_folder, tasks_for
from evimap.plans.facet_queries import late_orders, rows
from evimap.plans.queries import query, table
from evimap.sources import landing
from evimap.streaming import gating
from pyspark.sql import functions as F

_CUT = "timestamp '1999-01-01'"


def increments(spark, d):
    """Orders before 1999 as base; changed and new ones as increment, some of them twice."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    old = table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")).select("o_orderkey")
    base = o.join(old, "o_orderkey", "left_semi")
    new = o.where("o_orderkey % 5 = 0").unionByName(o.join(old, "o_orderkey", "left_anti")).withColumn("o_orderstatus", F.lit("X"))
    again = new.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return base, new.unionByName(again), old


_INC = f"""base as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate < {_CUT}),
delta as (select o_orderkey, o_custkey, 'X' o_orderstatus, o_totalprice + case when o_orderkey % 10 = 0 then 1 else 0 end o_totalprice from orders where o_orderkey % 5 = 0 or o_orderdate >= {_CUT})"""


@query(f"with {_INC} select * from base where o_orderkey not in (select o_orderkey from delta) union all select * from delta")
def upsert(spark, d):
    base, delta, _ = increments(spark, d)
    return incremental.upsert(base, delta, ["o_orderkey"])


@query(f"""with {_INC} select l_orderkey, l_linenumber, l_returnflag, count(*) n from lineitem where l_orderkey in (select o_orderkey from base) and l_orderkey not in (select o_orderkey from delta) group by all
union all select l_orderkey, l_linenumber, 'X', count(*) from lineitem where l_orderkey in (select o_orderkey from delta) and l_linenumber > 1 group by all""")
def replace_children(spark, d):
    base, delta, _ = increments(spark, d)
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    n = tasks_for(lines)
    dealt = lambda x: x.repartition(n, "l_orderkey")
    lines, parents = dealt(lines), dealt(delta.select(F.col("o_orderkey").alias("l_orderkey")))
    old = lines.join(dealt(base.select(F.col("o_orderkey").alias("l_orderkey"))), "l_orderkey", "left_semi")
    new = lines.where("l_linenumber > 1").join(parents, "l_orderkey", "left_semi").withColumn("l_returnflag", F.lit("X"))
    return dealt(incremental.replace_children(old, new, parents, "l_orderkey")).groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(F.count("*").alias("n"))


@query(f"""with b as (select o_custkey, min(o_orderkey) o_orderkey from orders where o_orderdate < {_CUT} group by 1),
n as (select o_custkey, min(o_orderkey) o_orderkey from orders where o_orderdate >= {_CUT} group by 1) select * from b union all select * from n where o_custkey not in (select o_custkey from b)""")
def insert_ignore(spark, d):
    o = table(spark, d, "orders")
    old = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")
    base = o.where(old).groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    return incremental.insert_ignore(base, o.where(~old).select("o_custkey", "o_orderkey"), [["o_custkey"], ["o_orderkey"]], ["o_orderkey"])


@query("""with recursive n as (select o_custkey c, o_orderkey k, o_orderpriority p, month(o_orderdate) % 5 m, row_number() over (partition by o_custkey order by o_orderkey) i from orders),
s as (select c, i, k, p, m, [p] ps, [m] ms, true ok from n where i = 1 union all select n.c, n.i, n.k, n.p, n.m, case when x then list_append(ps, n.p) else ps end, case when x then list_append(ms, n.m) else ms end, x
from (select n.*, s.ps, s.ms, not list_contains(ps, n.p) and not list_contains(ms, n.m) x from s join n on n.c = s.c and n.i = s.i + 1) n) select k o_orderkey, c o_custkey, p o_orderpriority, m from s where ok""")
def insert_ignore_crosswise(spark, d):
    """One order of a priority and one of a month class for each customer; an order that one key keeps out must not keep others out by the other key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", (F.month("o_orderdate") % 5).cast("long").alias("m"))
    base = o.groupBy("o_custkey").agg(F.min(F.struct(*o.columns)).alias("x")).select("x.*")
    return incremental.insert_ignore(base, o, [["o_custkey", "o_orderpriority"], ["o_custkey", "m"]], ["o_orderkey"])


@query("select o_custkey, max(o_orderkey) o_orderkey from orders group by 1")
def last_wins(spark, d):
    return last_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query(f"select o_orderkey, o_orderstatus from orders where o_orderdate >= {_CUT}")
def updated_since(spark, d):
    return incremental.updated_since(table(spark, d, "orders"), "o_orderdate", F.lit("1999-01-01").cast("timestamp")).select("o_orderkey", "o_orderstatus")


_LOG = "log as (select *, case event_type when 'click' then 'ok' when 'view' then 'empty' else 'error' end status, user_id % 9 source from events)"


def logged(events):
    status = F.when(F.col("event_type") == "click", "ok").when(F.col("event_type") == "view", "empty").otherwise("error")
    return events.select("event_id", "ts", "user_id", "event_type", "value", status.alias("status"), (F.col("user_id") % 9).alias("source"))


def log(spark, d):
    return logged(table(spark, d, "events"))


@query("with r as (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) k from events) select user_id, event_type, event_id from r where k = 1")
def latest_log(spark, d):
    return enrich.latest_log(table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


_NOW = "(select max(ts) from events)"


@query(f"with {_LOG} select distinct user_id from events where user_id not in (select user_id from log where status in ('ok', 'empty') and ts >= {_NOW} - interval 1 day)")
def needs_refetch(spark, d):
    now = table(spark, d, "events").agg(F.max("ts").alias("now"))
    work = table(spark, d, "events").select("user_id").distinct()
    return enrich.needs_refetch(work, log(spark, d).crossJoin(F.broadcast(now)), ["user_id"], "ts", "status", F.col("now"), 1.0)  # one row


@query(f"""with {_LOG}, n as (select epoch_us(max(ts)) // 1000 now from log), g as (select user_id, source, min(epoch_us(ts) // 1000) filter (event_type = 'signup') asked, max(epoch_us(ts) // 1000) filter (status in ('ok', 'empty')) good from log group by 1, 2)
select user_id, source, strftime(make_timestamp(1000 * case when good is null then asked else greatest(asked, good + 86400000) end), '%Y-%m-%d %H:%M:%S.%g') since from g, n where asked is not null and (good is null or good + 86400000 < now)""")
def fetch_gate(spark, d):
    """The log as a stream: what is due at its end, from state and timers instead of a pass over the log."""
    own = f"{shared_folder(spark)}/gate-{uuid.uuid4()}"
    landed = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")  # one file or a folder of them
    rows = logged(landed).withColumn("asks", F.col("event_type") == "signup")
    gating.start(gating.changes(rows, ["user_id", "source"], "ts", "status", "asks", 1.0, clock="ts"), own, "ts").awaitTermination()
    sent = spark.read.schema("user_id long, source long, number long, due boolean, since long").parquet(f"{own}/changes")
    return gating.work_list(sent, ["user_id", "source"]).withColumn("since", F.date_format(F.timestamp_millis("since"), "yyyy-MM-dd HH:mm:ss.SSS"))


@query(f"with {_LOG}, s as (select source, max(ts) t from log group by 1) select strftime(min(t), '%Y-%m-%d') oldest, round(date_sub('second', min(t), (select max(ts) from events)) / 86400, 4) age_days from s")
def staleness(spark, d):
    return enrich.staleness(log(spark, d), "source", "ts").withColumn("oldest", F.date_format("oldest", "yyyy-MM-dd"))


@query(f"with {_LOG} select strftime(max(ts) filter (status = 'ok'), '%Y-%m-%d') since from log")
def run_cursor(spark, d):
    done = log(spark, d).withColumn("status", F.when(F.col("status") == "ok", "success").otherwise("failure"))
    return incremental.cursor(done, "ts", "event_id")


@query(f"with {_LOG} select user_id, case when bool_and(status = 'ok') then 'success' when bool_or(status = 'ok') then 'partial_failure' else 'failure' end status from log group by 1")
def run_status(spark, d):
    return incremental.run_status(log(spark, d).withColumn("ok", F.col("status") == "ok"), "user_id", "ok")


_RUNS = """runs as (select event_type as label, strftime(ts, '%Y-%m-%d') as run, count(*) mentions, count(distinct user_id) studies, count(*) filter (value > 50) / count(*) share, count(*) filter (value < 1) failed, count(*) filter (value > 99.9) major from events group by 1, 2)"""


def runs(spark, d):
    by = table(spark, d, "events").groupBy(F.col("event_type").alias("label"), F.date_format("ts", "yyyy-MM-dd").alias("run"))
    return by.agg(F.count("*").alias("mentions"), F.count_distinct("user_id").alias("studies"), (F.count_if(F.col("value") > 50) / F.count("*")).alias("share"), F.count_if(F.col("value") < 1).alias("failed"), F.count_if(F.col("value") > 99.9).alias("major"))


@query(f"""with {_RUNS}, l as (select label, run, 'mentions' measure, lag(mentions) over w as old, mentions as new from runs window w as (partition by label order by run) union all select label, run, 'studies', lag(studies) over w, studies from runs window w as (partition by label order by run)),
p as (select *, case when old = 0 then case when new = 0 then 0 else 100 end else (new - old) / old * 100 end p from l)
select label, run, measure, cast(old as double) as old, cast(new as double) as new, round(p, 4) pct, case when abs(p) >= 20 then 'major' when abs(p) >= 5 then 'minor' else 'none' end severity from p""")
def drift(spark, d):
    return provenance.changes(runs(spark, d), "label", "run", ["mentions", "studies"])


@query(f"with {_RUNS}, p as (select label, run, share * 100 - lag(share) over (partition by label order by run) * 100 p from runs) select label, run, round(p, 4) points, case when abs(p) >= 5 then 'major' when abs(p) > 2 then 'minor' else 'none' end severity from p")
def share_drift(spark, d):
    return provenance.share_drift(runs(spark, d), "label", "run", "share")


@query(f"""with {_RUNS}, b as (select *, lag(failed, 1) over w = 0 and lag(failed, 2) over w = 0 good from runs window w as (partition by label order by run))
select label, run, case when failed > 0 then 'bronze' when coalesce(good, false) and major = 0 then 'gold' else 'silver' end badge from b""")
def badges(spark, d):
    return provenance.badges(runs(spark, d), "label", "run", "failed", "major")


@query(f"with {_RUNS} select label, run, label || run as run_id, lag(label || run) over (partition by label order by run) previous from runs")
def run_links(spark, d):
    with_id = runs(spark, d).withColumn("run_id", F.concat("label", "run"))
    return provenance.run_records(with_id, "label", "run", "run_id", ["mentions", "studies"]).drop("totals")


@query(f"with {_RUNS}, k as (select label, run, cast(row_number() over (partition by label order by run desc) as int) rank from runs) select * from k where rank <= 3")
def newest_runs(spark, d):
    return incremental.newest(runs(spark, d), ["label"], 3, F.desc("run")).select("label", "run", "rank")


@query("select p_brand from part where lower(p_brand) not in (select lower(p_brand) from part where p_size < 2) and lower(p_brand) not in ('brand#11', 'brand#12') group by 1")
def abstentions(spark, d):
    p = table(spark, d, "part")
    return provenance.abstentions(p, "p_brand", [p.where("p_size < 2").select("p_brand"), spark.createDataFrame([("BRAND#11",), ("Brand#12 ",)], "k string")])


def _rule(rule: str, severity: str, passed: str, value: str, text: str) -> str:
    return f"select '{rule}' rule_id, '{severity}' severity, {passed} passed, '{text}: ' || {value} as message from f"


def _one(sql: str) -> str:
    return f"case when {sql} = cast({sql} as bigint) then cast({sql} as bigint) || '.0' else cast({sql} as varchar) end"


@query("""with m as (select l.*, o_orderstatus = 'P' flag, case when l_linenumber = 7 then 'Unmapped' else p_type end category, case when l_returnflag = 'A' then '' else 'u' end unit from lineitem l join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey),
f as (select count(*) mentions, count(*) filter (category = 'Unmapped') / count(*) unmapped, count(*) filter (unit = '') / count(*) unitless, count(distinct l_orderkey) total, count(distinct category) categories from m),
""" + "r as (" + " union all ".join([
    _rule("totals_non_negative", "P0", "true", "mentions", "mentions"), _rule("id_format", "P0", "true", "0", "ids of unknown form"), _rule("totals_add_up", "P0", "true", "total", "studies"),
    _rule("unmapped", "P1", "unmapped <= 0.05", _one("round(unmapped, 4)"), "share of unmapped mentions"), _rule("unit_gap", "P1", "unitless <= 0.4", _one("round(unitless, 4)"), "share of mentions without unit"),
    _rule("facets_present", "P1", "true", "categories", "categories"), _rule("enrollment", "P1", "(select count(*) from orders where o_totalprice > 50000) = 0", "(select count(*) from orders where o_totalprice > 50000)", "implausible enrolments"),
]) + ") select * from r")
def quality_rules(spark, d):
    m = rows(spark, d).withColumn("category", F.when(F.col("l_linenumber") == 7, "Unmapped").otherwise(F.col("p_type"))).withColumn("unit", F.when(F.col("l_returnflag") == "A", "").otherwise("u"))
    studies = table(spark, d, "orders").withColumn("kind", F.lit("ESTIMATED"))
    facts = quality.map_facts(m, studies.withColumn("n", F.ceil("o_totalprice")), "l_orderkey", "category", "unit", F.col("flag"), F.col("l_orderkey") >= 0, ["PROMO"], "n", "kind", {"brands": "p_brand", "outcomes": "l_returnflag", "statuses": "l_linestatus", "priorities": "o_orderpriority"})
    return quality.run_checks(facts, quality.map_checks())


@query("with f as (select count(distinct l_orderkey) * 1.0 x, (select count(*) from orders) n from lineitem) select 'reference_recall' rule_id, 'P2' severity, x / n >= 0.5 passed, 'share of expected values found: ' || " + _one("round(x / n, 4)") + " as message from f")
def reference_recall(spark, d):
    return quality.reference_recall(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), "k")


@query("select 'orphans' rule_id, 'P1' severity, count(*) = 0 passed, 'orphan mentions: ' || count(*) as message from lineitem where l_orderkey not in (select o_orderkey from orders where year(o_orderdate) >= 1996)")
def orphan_rule(spark, d):
    return quality.no_orphans(evidence.orphan_counts(table(spark, d, "lineitem"), late_orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey"))


@query("with b as (select o_custkey from orders group by 1 having count(distinct o_orderstatus) > 1) select 'dedup_integrity' rule_id, 'P1' severity, count(*) = 0 passed, 'ids with more than one source: ' || count(*) as message from b")
def dedup_rule(spark, d):
    from evimap.operators.dedup import with_most_values

    return quality.dedup_integrity(with_most_values(table(spark, d, "orders"), "o_custkey", "o_orderstatus"))


@query("select user_id nct_id, event_type drug_name, 'k' reaction, cast(json_extract(props, '$.k') as bigint) total_count, 'openfda' source from events")
def landed_signals(spark, d):
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    docs = e.select(F.col("user_id").alias("nct_id"), F.col("event_type").alias("drug_name"), F.array(F.struct(F.lit("k").alias("term"), F.col("k").alias("count"))).alias("results"))
    return landing.openfda_signals(docs).drop("serious_count")


def enrichment(spark, d):
    """Orders as trials, lines as publications, suppliers' lines as citations, lines as signals."""
    lines = table(spark, d, "lineitem")
    pubs = lines.select(F.col("l_orderkey").alias("nct_id"), F.col("l_partkey").cast("string").alias("pmid"), F.when(F.col("l_linenumber") > 1, F.concat(F.lit("10.1/"), F.col("l_partkey").cast("string"))).otherwise("").alias("doi"))
    part = table(spark, d, "part")
    doi = F.concat(F.lit("10.1/"), F.col("p_partkey").cast("string")).alias("doi")
    mesh = part.select(F.col("p_partkey").cast("string").alias("pmid"), F.col("p_brand").alias("descriptor_name"))
    citations = part.select(doi, F.col("p_size").cast("long").alias("cited_by_count")).unionByName(part.select(doi, F.lit(25).cast("long").alias("cited_by_count")))
    access = part.select(doi, (F.col("p_size") % 2).alias("is_oa"), F.col("p_type").alias("oa_status"))
    signals = lines.select(F.col("l_orderkey").alias("nct_id"), F.col("l_partkey").cast("string").alias("drug_name"), F.col("l_returnflag").alias("reaction"), F.col("l_linenumber").cast("long").alias("total_count"))
    logs = lines.select(F.col("l_orderkey").alias("nct_id"), F.col("l_linestatus").alias("source"), F.when(F.col("l_returnflag") == "R", "ok").otherwise("error").alias("status"))
    trials = table(spark, d, "orders").select(F.col("o_orderkey").alias("nct_id"))
    return trials, pubs, mesh, citations, access, signals, logs


@query("""
with p as (select l_orderkey id, cast(l_partkey as varchar) pmid, case when l_linenumber > 1 then '10.1/' || l_partkey else '' end doi, l_partkey k from lineitem),
a as (select id, count(*) pub_count, string_agg(distinct pmid, ';' order by pmid) pmid_list, coalesce(string_agg(distinct doi, ';' order by doi) filter (doi <> ''), '') doi_list from p group by 1),
m as (select id, string_agg(distinct p_brand, ';' order by p_brand) mesh_terms from p join part on p_partkey = k group by 1),
q as (select distinct id, doi, k from p where doi <> ''), c as (select id, sum(greatest(p_size, 25)) cited_by_total, bool_or(p_size % 2 = 1) is_oa, arg_min(p_type, doi) oa_status from q join part on p_partkey = k group by 1),
r as (select l_orderkey id, l_partkey || ':' || l_returnflag || ':' || l_linenumber s, row_number() over (partition by l_orderkey order by l_linenumber desc, cast(l_partkey as varchar), l_returnflag) n from lineitem),
t as (select id, string_agg(s, ';' order by n) reactions from r where n <= 10 group by 1), g as (select l_orderkey id, string_agg(distinct l_linestatus, ';' order by l_linestatus) enrichment_sources from lineitem where l_returnflag = 'R' group by 1)
select o_orderkey nct_id, coalesce(pub_count, 0) pub_count, pmid_list, doi_list, mesh_terms, coalesce(cited_by_total, 0) cited_by_total, cast(is_oa as varchar) is_oa, oa_status, reactions, enrichment_sources
from orders left join a on a.id = o_orderkey left join m on m.id = o_orderkey left join c on c.id = o_orderkey left join t on t.id = o_orderkey left join g on g.id = o_orderkey""")
def gathered_enrichment(spark, d):
    out = enrich.gather(*enrichment(spark, d))
    reactions = F.array_join(F.transform("faers_top_reactions", lambda x: F.concat_ws(":", x["drug"], x["reaction"], x["count"].cast("string"))), ";")
    return out.select("nct_id", "pub_count", *(F.array_join(c, ";").alias(c) for c in ("pmid_list", "doi_list", "mesh_terms")), "cited_by_total", F.col("is_oa").cast("string").alias("is_oa"), "oa_status", reactions.alias("reactions"), F.array_join("enrichment_sources", ";").alias("enrichment_sources"))


@query("with t as (select p_brand, lower(p_type) t, min(p_partkey) k from part group by 1, 2), r as (select *, row_number() over (partition by p_brand order by k) n from t) select p_brand, string_agg(t, '|' order by n) drugs from r where n <= 3 group by 1")
def first_drugs(spark, d):
    lists = table(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_type"))).alias("x"))
    names = F.array_join(F.transform("x", lambda x: F.concat(x["p_type"], F.lit(" 50 mg (oral)"))), "; ")
    return lists.select("p_brand", F.array_join(enrich.first_drugs(names, 3), "|").alias("drugs"))


@query("select n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}') hash from nation")
def canonical_hashes(spark, d):
    return table(spark, d, "nation").select("n_nationkey", T.canonical_hash("n_regionkey", "n_name").alias("hash"))


@query()
def table_hash(spark, d):
    return provenance.table_hash(table(spark, d, "lineitem"))


_TREE = """n as (select md5('=' || l_orderkey || '|=' || l_linenumber) k, ('0x' || left(md5(l_orderkey || '|' || l_linenumber || '|' || l_returnflag), 15))::bigint h from lineitem)"""


@query(f"with {_TREE} select cast(l as int) as level, left(k, l) node, count(*) as rows, cast(sum(h) as varchar) hash from n, range(0, 3) t(l) group by 1, 2")
def table_tree(spark, d):
    """The contents of a table as a tree of hashes over buckets of its key."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return provenance.hash_tree(lines, ["l_orderkey", "l_linenumber"], 2, F.concat_ws("|", *lines.columns)).withColumn("hash", F.col("hash").cast("string"))


@query("""select o_orderkey, o_orderstatus, 'old' side from orders where o_orderkey % 500 in (3, 7) union all select o_orderkey, 'changed', 'new' from orders where o_orderkey % 500 = 7 union all select -o_orderkey, 'added', 'new' from orders where o_orderkey % 500 = 9""")
def traced_changes(spark, d):
    """Rows that were changed, removed or added between two states of a table, found through their trees."""
    old, k = table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderkey") % 500
    new = old.where(k != 3).withColumn("o_orderstatus", F.when(k == 7, "changed").otherwise(F.col("o_orderstatus"))).unionByName(old.where(k == 9).select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("added").alias("o_orderstatus")))
    return provenance.changed_rows(old, new, ["o_orderkey"])
