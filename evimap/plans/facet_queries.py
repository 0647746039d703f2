"""Facets, distributions, charts, explorer."""

from __future__ import annotations

from evimap.functions import text as T
from evimap.operators import charts, evidence, explore, facets, lineage, sampling, search_index
from evimap.operators.dedup import top_per_key, with_most_values
from evimap.operators.lineage import settle, tasks_for
from evimap.plans.queries import query, table
from evimap.plans.staging import staged
from pyspark.sql import functions as F

_ROWS = "rows_ as (select l.*, o.o_orderstatus, o.o_orderpriority, o.o_custkey, o.o_orderdate, o.o_orderstatus = 'P' flag, p.p_brand, p.p_type from lineitem l join orders o on o.o_orderkey = l.l_orderkey join part p on p.p_partkey = l.l_partkey)"


def rows(spark, d):
    """Lines with their part and order, dealt by order to tasks of so many rows; what is grouped by order (and more) stays where it is.

    Parts that are more than the rows of a task are dealt like lines: their file is small, but not what a task holds of it.
    """
    lines, o, p = table(spark, d, "lineitem"), table(spark, d, "orders").drop("o_totalprice"), table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    n = tasks_for(lines)
    if p.count() > lineage.TASK_ROWS:
        mentions, p = lines.repartition(n, "l_partkey"), p.repartition(n, "p_partkey").hint("merge")
    else:
        mentions = lines
    out = mentions.join(p, F.col("l_partkey") == F.col("p_partkey")).repartition(n, "l_orderkey").join(o.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return out.select(*lines.columns, *o.columns, *p.columns, (F.col("o_orderstatus") == "P").alias("flag"))


def line_order():
    return F.col("l_linenumber") * F.lit(10**12) + F.col("l_partkey") * 10**6 + F.col("l_suppkey")


def late_orders(spark, d):
    return table(spark, d, "orders").where(F.year("o_orderdate") >= 1996)


@query("""
with m as (select l.l_orderkey, l_returnflag, l_linestatus, o_orderpriority, o_orderstatus = 'P' flag from lineitem l left join orders o on l_orderkey = o_orderkey),
f as (select 'flag' facet, l_returnflag v, l_orderkey, flag from m union all select 'status', l_linestatus, l_orderkey, flag from m union all select 'priority', o_orderpriority, l_orderkey, flag from m)
select facet, v as value, count(*) mention_count, count(distinct l_orderkey) study_count, count(distinct case when flag then l_orderkey end) placebo_study_count from f group by 1, 2""")
def facet_stats(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    orders, n = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus"), tasks_for(lines)
    mentions = lines.repartition(n, "l_orderkey").join(orders.repartition(n, "l_orderkey"), "l_orderkey", "left")
    return facets.facet_stats(mentions, {"flag": F.col("l_returnflag"), "status": F.col("l_linestatus"), "priority": F.col("o_orderpriority")}, "l_orderkey", F.col("o_orderstatus") == "P")


@query("select l_orderkey, l_linenumber, coalesce(o_orderstatus, 'Unknown') o_orderstatus from lineitem left join (select * from orders where year(o_orderdate) >= 1996) on l_orderkey = o_orderkey")
def study_lookup(spark, d):
    studies = late_orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return evidence.with_studies(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), studies, "l_orderkey", {"o_orderstatus": "Unknown"})


@query("select count(*) orphan_mentions, count(distinct l_orderkey) orphan_studies from lineitem where l_orderkey not in (select o_orderkey from orders where year(o_orderdate) >= 1996)")
def orphan_counts(spark, d):
    return evidence.orphan_counts(table(spark, d, "lineitem"), late_orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@query(f"""with {_ROWS} select count(*) total_mentions, count(distinct l_orderkey) total_studies, count(distinct case when flag then l_orderkey end) placebo_studies,
count(*) filter (p_type not in ('PROMO', 'ECONOMY')) core_mentions, count(*) filter (p_type in ('PROMO', 'ECONOMY')) adjunct_mentions,
count(distinct case when p_type not in ('PROMO', 'ECONOMY') then l_orderkey end) core_studies, count(distinct case when p_type in ('PROMO', 'ECONOMY') then l_orderkey end) adjunct_studies,
count(distinct p_brand) keywords, count(distinct p_type) categories, count(distinct l_returnflag) outcome_types, count(*) filter (year(o_orderdate) < 1996) orphan_mentions from rows_""")
def totals(spark, d):
    return facets.totals(rows(spark, d), "l_orderkey", "p_brand", "p_type", F.col("flag"), ["PROMO", "ECONOMY"], F.year("o_orderdate") >= 1996, "l_returnflag")


@query("select year(o_orderdate) as year, count(*) n from orders group by 1")
def year_counts(spark, d):
    return facets.counts(table(spark, d, "orders"), T.partial_year(F.date_format("o_orderdate", "yyyy-MM-dd")), "year")


@query("with b as (select l_orderkey, string_agg(distinct p_brand, ';') s from lineitem join part on p_partkey = l_partkey group by 1) select unnest(string_split(s, ';')) brand, count(*) n from b group by 1")
def list_counts(spark, d):
    lists = rows(spark, d).groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ";").alias("s"))
    return facets.counts(lists, T.split_list(F.col("s")), "brand")


@query("select coalesce(nullif(o_orderstatus, 'P'), 'Unknown') status, count(*) n from orders group by 1")
def status_counts(spark, d):
    blank = table(spark, d, "orders").withColumn("s", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")))
    return facets.counts(blank, F.col("s"), "status", "Unknown")


@query("select c_mktsegment source, count(distinct o_orderkey) n from orders join customer on c_custkey = o_custkey group by 1")
def source_counts(spark, d):
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return facets.distinct_counts(joined, "o_orderkey", F.col("c_mktsegment"), "source")


@query("""
with m as (select o_custkey, bool_or(o_orderstatus = 'F') a, bool_or(o_orderstatus = 'P') b from orders group by 1),
s as (select count(*) d, count(*) filter (a) a, count(*) filter (b) b, count(*) filter (a and b) c from m), r as (select count(*) n from orders),
x as (select d, unnest(['retrieved', 'duplicates_removed', 'after_dedup', 'with_outcome', 'with_placebo', 'with_both', 'excluded']) stage, unnest([n, n - d, d, a, b, c, d - a]) n from s, r)
select stage, n, round(n * 100.0 / d, 4) pct from x""")
def funnel(spark, d):
    orders = table(spark, d, "orders")
    merged = orders.groupBy("o_custkey").agg(F.max(F.col("o_orderstatus") == "F").alias("a"), F.max(F.col("o_orderstatus") == "P").alias("b"))
    return facets.funnel(orders, merged, "o_custkey", "o_orderkey", F.col("a"), F.col("b"))


_PAIRS = "b as (select distinct l_orderkey k, p_brand v from lineitem join part on p_partkey = l_partkey where p_brand <> 'Brand#11'), p as (select x.v a, y.v b, count(*) n from b x join b y on x.k = y.k and x.v < y.v group by 1, 2 order by 3 desc, 1, 2 limit 20)"


@query(f"with {_PAIRS} select * from p")
def co_occurrence(spark, d):
    return facets.co_occurrence(rows(spark, d), "l_orderkey", "p_brand", 20, exclude="Brand#11")


@query(f"with {_PAIRS}, s as (select p_brand v, count(*) n from lineitem join part on p_partkey = l_partkey group by 1) select 'edge' kind, a, b, n from p union all select 'node', v, null, s.n from s where v in (select a from p union select b from p)")
def co_occurrence_network(spark, d):
    sizes = rows(spark, d).groupBy("p_brand").agg(F.count("*").alias("size"))
    return facets.network(co_occurrence(spark, d), sizes, "p_brand", "size")


@query("select string_agg(s, ';' order by s) active_sources from (select distinct event_type s from events)")
def active_sources(spark, d):
    return facets.active_sources(table(spark, d, "events"), F.array("event_type"))


@query("""
with t as (select user_id, list(distinct event_type) filter (value > 50) s from events group by 1), n as (select count(*) total from t),
e as (select source, count(*) n from (select user_id, unnest(s) source from t) group by 1 union all select '(any)', count(*) from t where len(coalesce(s, [])) > 0)
select source, e.n, round(e.n * 100.0 / total, 4) pct from e, n""")
def coverage(spark, d):
    lists = table(spark, d, "events").groupBy("user_id").agg(F.collect_set(F.when(F.col("value") > 50, F.col("event_type"))).alias("s"))
    return facets.coverage(lists, "user_id", F.col("s"))


@query("select user_id % 7 source, count(*) filter (event_type = 'click') click, count(*) filter (event_type = 'view') as view from events group by 1")
def status_pivot(spark, d):
    return facets.status_counts(table(spark, d, "events").withColumn("source", F.col("user_id") % 7), "source", "event_type", ["click", "view"])


_TOP = "a as (select p_brand from rows_ group by 1 order by count(*) desc, 1 limit 12), t as (select o_orderpriority from rows_ group by 1 order by count(*) desc, 1 limit 15)"


@query(f"with {_ROWS}, {_TOP}, c as (select p_brand, o_orderpriority, count(*) n from rows_ group by 1, 2) select a.p_brand, t.o_orderpriority, coalesce(n, 0) n from a cross join t left join c on c.p_brand = a.p_brand and c.o_orderpriority = t.o_orderpriority")
def matrix(spark, d):
    return charts.matrix(rows(spark, d), "p_brand", "o_orderpriority", 12, 15)


@query(f"""with {_ROWS}, p as (select p_type, o_orderpriority, l_orderkey, bool_or(flag) flag from rows_ group by all),
a as (select p_type from p group by 1 order by count(distinct l_orderkey) desc, 1 limit 4), b as (select o_orderpriority from p group by 1 order by count(distinct l_orderkey) desc, 1 limit 3)
select p_type, o_orderpriority, count(*) studies, round(count(*) filter (flag) / count(*), 6) placebo_ratio from p where p_type in (from a) and o_orderpriority in (from b) group by 1, 2""")
def distinct_matrix(spark, d):
    return charts.distinct_matrix(rows(spark, d), "p_type", "o_orderpriority", "l_orderkey", F.col("flag"), 4, 3)


@query(f"""with {_ROWS}, s as (select p_brand, count(distinct l_orderkey) studies, count(distinct case when flag then l_orderkey end) placebo, count(*) mentions from rows_ group by 1 having count(distinct l_orderkey) >= 2 order by 2 desc, 1 limit 20),
x as (select *, mentions / studies density, max(mentions / studies) over () top, list(studies) over () l from s)
select p_brand, studies, placebo, mentions, round(density, 6) density, case when density / top < 0.33 then 'low' when density / top < 0.67 then 'medium' else 'high' end band, list_sort(l)[len(l) // 2 + 1] median_studies from x""")
def signals(spark, d):
    return charts.signals(rows(spark, d), "p_brand", "l_orderkey", F.col("flag"))


@query(f"""with {_ROWS}, b as (select p_brand from rows_ group by 1 order by count(distinct l_orderkey) desc, 1 limit 10),
f as (select l_orderkey, arg_min(l_shipmode, k) s, arg_min(p, k) p from (select *, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey k, l_linestatus l_shipmode, case when l_returnflag = 'N' then 'Not Stated' else 'Phase' || l_returnflag end p from rows_) group by 1)
select 'source' link, s as "from", p as "to", count(*) n from f group by 2, 3 union all
select 'phase', p, p_brand, count(*) from (select distinct l_orderkey, p_brand from rows_ where p_brand in (from b)) join f using (l_orderkey) group by 2, 3""")
def flows(spark, d):
    phased = rows(spark, d).withColumn("phase", F.when(F.col("l_returnflag") == "N", "NA").otherwise(F.concat(F.lit("PHASE"), F.col("l_returnflag"))))
    return charts.flows(phased.withColumn("k", line_order()), "l_orderkey", "l_linestatus", "phase", "p_brand", "k")


@query(f"""with {_ROWS}, s as (select p_brand, count(distinct l_orderkey) s, count(*) m, count(distinct case when flag then l_orderkey end) p, count(distinct case when year(o_orderdate) > 1996 then l_orderkey end) r, count(distinct p_type) v from rows_ group by 1 order by 2 desc, 1 limit 5)
select p_brand, round(s / max(s) over (), 6) studies, round(m / max(m) over (), 6) mentions, round(p / s, 6) placebo, round(r / s, 6) recency, round(v / max(v) over (), 6) diversity from s""")
def profiles(spark, d):
    dated = rows(spark, d).withColumn("year", F.year("o_orderdate"))
    return charts.profiles(dated, "p_brand", "l_orderkey", F.col("flag"), "year", "p_type", 2001)


@query("""with f as (select o_custkey, min(year(o_orderdate)) y, bool_or(o_orderstatus = 'P') p from orders group by 1), n as (select y as year, count(*) n, count(*) filter (p) placebo from f group by 1)
select *, sum(n) over (order by year) n_total, sum(placebo) over (order by year) placebo_total from n""")
def timeline(spark, d):
    return charts.timeline(table(spark, d, "orders"), "o_custkey", F.year("o_orderdate"), F.col("o_orderstatus") == "P")


@query("""with y as (select case when year(o_orderdate) < 1998 then 'pre-1998' else cast(year(o_orderdate) // 10 * 10 as varchar) || 's' end "decade" from orders), n as (select "decade", count(*) n from y group by 1)
select *, round(n / sum(n) over (), 6) share from n""")
def decades(spark, d):
    return charts.decades(table(spark, d, "orders"), F.year("o_orderdate"), 1998)


@query(f"with {_ROWS} select p_brand value, count(distinct l_orderkey) n from rows_ group by 1")
def distinct_counts(spark, d):
    return facets.distinct_counts(rows(spark, d), "l_orderkey", F.col("p_brand"), "value")


_STATS = "s as (select p_brand, count(distinct l_orderkey) studies, count(distinct case when flag then l_orderkey end) placebo from rows_ group by 1)"


def brand_stats(spark, d):
    per = rows(spark, d).groupBy("p_brand", "l_orderkey").agg(F.max("flag").alias("flag"))
    return per.groupBy("p_brand").agg(F.count("*").alias("studies"), F.count_if("flag").alias("placebo"))


@query(f"with {_ROWS}, {_STATS} select *, round(placebo / studies, 6) placebo_ratio, case when placebo / studies > 0.3 then 'high' when placebo / studies > 0.1 then 'some' else 'low' end band from s")
def placebo_bands(spark, d):
    return charts.bands(brand_stats(spark, d), "studies", "placebo")


@query(f"with {_ROWS}, t as (select count(distinct l_orderkey) t from rows_), n as (select p_brand as value, count(distinct l_orderkey) n from rows_ group by 1 order by 2 desc, 1 limit 15) select value, n, round(n * 100 / t, 4) pct from n, t")
def top_shares(spark, d):
    return charts.top_shares(rows(spark, d), "l_orderkey", F.array("p_brand"), "value")


@query(f"with {_ROWS}, {_STATS}, r as (select *, row_number() over (order by studies desc, p_brand) k, sum(placebo) over () / sum(studies) over () q from s) select p_brand, studies, placebo, round(q, 6) pooled_ratio, k <= 7 or placebo <= 4 labelled from r")
def signal_map(spark, d):
    return charts.signal_map(brand_stats(spark, d), "p_brand", "studies", "placebo")


@query(f"with {_ROWS}, {_STATS} select * from s where studies >= 100")
def minimum_support(spark, d):
    return facets.supported(brand_stats(spark, d), "studies", 100)


@query(f"with {_ROWS}, s as (select l_partkey, count(distinct l_orderkey) studies, count(distinct case when flag then l_orderkey end) placebo from rows_ group by 1) select * from s where placebo <= 4 and l_partkey not in (11, 12)")
def evidence_gaps(spark, d):
    stats = facets.facet_stats(rows(spark, d), {"part": F.col("l_partkey")}, "l_orderkey", F.col("flag"))
    stats = stats.select(F.col("value").cast("long").alias("l_partkey"), F.col("study_count").alias("studies"), F.col("placebo_study_count").alias("placebo"))
    return facets.evidence_gaps(stats, "l_partkey", "placebo", [11, 12])


@query("""with n as (select p_partkey, p_brand, lower(p_type) t from part) select l_orderkey, l_linenumber, count(*) n from lineitem join n on p_partkey = l_partkey where l_returnflag = 'R' and lower(p_brand) = 'brand#3' and (t like '%promo%' or t like '%eco%') group by 1, 2""")
def cross_filtered(spark, d):
    lists = rows(spark, d).withColumn("brands", F.array(F.col("p_brand"), F.lit("other")))
    kept = explore.cross_filter(lists, {"l_returnflag": "r", "brands": "BRAND#3", "p_type": ""}, ["Promo", "eco"], "p_type")
    return kept.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("select 'lineitem' as table, count(*) as rows from lineitem union all select 'orders', count(*) from orders union all select 'part', count(*) from part")
def table_totals(spark, d):
    return facets.table_totals({n: table(spark, d, n) for n in ("lineitem", "orders", "part")})


@query("select (select count(*) from orders) studies, count(*) arms, count(*) filter (p_size % 5 = 0) placebo_arms, (select count(*) from lineitem) mentions, (select count(distinct l_partkey) from lineitem) keywords from part")
def fetch_summary(spark, d):
    return facets.fetch_summary(table(spark, d, "orders"), table(spark, d, "part"), table(spark, d, "lineitem"), "l_partkey", F.col("p_size") % 5 == 0)


@query("select quantile_cont(p_size, 0.25) q1, quantile_cont(p_size, 0.5) median, quantile_cont(p_size, 0.75) q3, sum(p_size) total, count(*) filter (p_type = 'PROMO') / count(*) promo from part")
def enrolment_quartiles(spark, d):
    return facets.shares_and_quartiles(table(spark, d, "part"), "p_size", {"promo": (F.col("p_type") == "PROMO", F.lit(True))})


@query("select o_custkey, count(distinct o_orderstatus) n_values from orders group by 1 having count(distinct o_orderstatus) > 1")
def inconsistent_ids(spark, d):
    return with_most_values(table(spark, d, "orders"), "o_custkey", "o_orderstatus")


@query(f"with {_ROWS} select p_brand, count(*) n from rows_ group by 1 order by 2 desc, 1 limit 10")
def keyword_frequency(spark, d):
    return facets.counts(rows(spark, d), F.col("p_brand"), "p_brand").orderBy(F.desc("n"), "p_brand").limit(10)


@query("select quantile_cont(c_acctbal, 0.25) q1, quantile_cont(c_acctbal, 0.5) median, quantile_cont(c_acctbal, 0.75) q3, sum(c_acctbal) total, count(*) filter (c_mktsegment = 'BUILDING' and c_acctbal > 0) / count(*) filter (c_acctbal > 0) building from customer")
def shares_and_quartiles(spark, d):
    return facets.shares_and_quartiles(table(spark, d, "customer"), "c_acctbal", {"building": (F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 0)})


_LABELS = "x as (select doc_id, case when text like '%!!%' then 'junk' when length(text) < 400 then 'short' else 'good' end p, case when quality = 1 then 'good' else 'junk' end t from documents join labels using (doc_id))"


def labelled(spark, d):
    guess = F.when(F.col("text").contains("!!"), "junk").when(F.length("text") < 400, "short").otherwise("good")
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", guess.alias("p"), F.when(F.col("quality") == 1, "good").otherwise("junk").alias("t"))


@query(f"""with {_LABELS}, c as (select p c from x union select t from x), n as (select c, count(*) filter (p = c and t = c) tp, count(*) filter (p = c and t <> c) fp, count(*) filter (p <> c and t = c) fn from c, x group by 1)
select c as class, tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) ppv, round(tp / nullif(tp + fn, 0), 6) sensitivity from n""")
def classification_metrics(spark, d):
    return sampling.classification_metrics(labelled(spark, d), "p", "t")


@query(f"with {_LABELS} select count(*) n, round(count(*) filter (p = t) / count(*), 6) accuracy, round(count(*) filter (t = 'junk') / count(*), 6) false_positive_rate from x")
def classification_accuracy(spark, d):
    return sampling.accuracy(labelled(spark, d), "p", "t", "junk")


@query("with r as (select *, md5('7' || o_orderkey) h from orders), k as (select *, row_number() over (partition by o_orderpriority order by h, o_orderkey) <= 2 f from r) select o_orderkey, o_orderpriority from k order by f desc, h, o_orderkey limit 50")
def stratified_sample(spark, d):
    return sampling.stratified_sample(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 50, seed="7")


@query("with r as (select o_orderkey, o_orderpriority from orders order by md5('3' || o_orderkey), o_orderkey limit 20) select cast(row_number() over (order by o_orderkey) as int) sample_id, o_orderkey, o_orderpriority, '' is_correct, '' notes from r")
def review_sheet(spark, d):
    picked = table(spark, d, "orders").orderBy(sampling.seeded("o_orderkey", "3"), "o_orderkey").limit(20)
    return sampling.review_sheet(picked, "sample_id", ["o_orderkey", "o_orderpriority"], ["is_correct", "notes"], F.col("o_orderkey"))


@query("""with f as (select * from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey where (lower(p_name) like '%1%' or lower(p_brand) like '%1%') and l_returnflag = 'R' and o_orderstatus = 'F'),
s as (select p_type as value, count(*) mention_count, count(distinct l_orderkey) study_count from f group by 1) select 'type' facet, value, mention_count, study_count, 0 placebo_study_count from s""")
def filtered_facets(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    state = explore.FilterState(contains={"p_name|p_brand": "1"}, equals={"l_returnflag": "R", "o_orderstatus": "F"}, flags={"flag": False})
    hit = rows(spark, d).join(parts, "p_partkey").where(state.condition())
    return facets.facet_stats(hit, {"type": F.col("p_type")}, "l_orderkey", F.col("flag"))


@query("""select o_orderkey, hit from (select o_orderkey, 'brand' hit from orders where o_orderkey in (select l_orderkey from lineitem join part on p_partkey = l_partkey where p_brand = 'Brand#23') union all
select o_orderkey, 'year' from orders where year(o_orderdate) > 2000 union all select o_orderkey, 'flag' from orders where o_orderstatus = 'P' union all
select o_orderkey, 'any' from orders where lower(o_orderpriority || ' ' || o_orderstatus) like '%urgent f%') where o_orderkey in (select l_orderkey from lineitem)""")
def search_language(spark, d):
    found = rows(spark, d).withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    find = lambda q: explore.search(q, {"brand": "p_brand"}, ["o_orderpriority", "o_orderstatus"], "day", F.col("flag"))
    hits = F.array_compact(F.array(*(F.when(find(q), F.lit(n)) for n, q in (("brand", "brand:Brand#23"), ("year", "year:>2000"), ("flag", "placebo:yes"), ("any", "URGENT F")))))
    return found.select(F.col("l_orderkey").alias("o_orderkey"), F.explode(hits).alias("hit")).distinct()


def indexed(spark, d):
    """Lines with their part and order, written with an index of three texts."""
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    lines = rows(spark, d).join(parts, "p_partkey").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = staged(spark, "index")
    search_index.build(lines, {"p_name": F.col("p_name"), "p_brand": F.col("p_brand"), "any": F.concat_ws(" ", "o_orderpriority", "o_orderstatus")}, path)
    return search_index.Index(spark, path)


@query("""select 'brand' hit, l_orderkey, l_linenumber from lineitem join part on p_partkey = l_partkey where lower(p_brand) like '%and#23%' union all select 'year', l_orderkey, l_linenumber from lineitem join orders on o_orderkey = l_orderkey where year(o_orderdate) > 2000
union all select 'any', l_orderkey, l_linenumber from lineitem join orders on o_orderkey = l_orderkey where lower(o_orderpriority || ' ' || o_orderstatus) like '%urgent f%' union all
select 'both', l_orderkey, l_linenumber from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey where (lower(p_name) like '%art%' or lower(p_brand) like '%d#1%') and lower(p_brand) like '%#1%' and o_orderstatus = 'F'""")
def indexed_search(spark, d):
    """Searches and a filter that read only the buckets and rows that the index leaves."""
    found, flag = indexed(spark, d), F.col("flag")
    find = lambda q: found.search(q, {"brand": "p_brand"}, ("any", ["o_orderpriority", "o_orderstatus"]), "day", flag)
    state = explore.FilterState(contains={"p_name|p_brand": "d#1", "p_brand": "#1"}, equals={"o_orderstatus": "F"})
    wide = explore.FilterState(contains={"p_name": "art", "p_brand": "#1"}, equals={"o_orderstatus": "F"})
    both = found.filtered(state).unionByName(found.filtered(wide)).distinct()
    parts = {"brand": find("brand:AND#23"), "year": find("year:>2000"), "any": find("URGENT F"), "both": both}
    out = [x.select(F.lit(n).alias("hit"), "l_orderkey", "l_linenumber") for n, x in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("select o_orderkey, o_orderpriority, o_totalprice from orders order by lower(o_orderpriority) desc, o_totalprice, o_orderkey limit 100")
def sorted_page(spark, d):
    return explore.sorted_page(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderpriority", True, 100, ["o_totalprice", "o_orderkey"])


@query("""with r as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) k from lineitem), f as (select l_orderkey, l_returnflag, l_linestatus from r where k = 1),
o as (select l_orderkey, string_agg(distinct l_partkey || ':' || l_linestatus, ',' order by l_partkey || ':' || l_linestatus) outcomes from lineitem group by 1) select * from f join o using (l_orderkey)""")
def detail_index(spark, d):
    index = evidence.detail_index(table(spark, d, "lineitem").withColumn("p", F.col("l_partkey").cast("string")).withColumn("k", F.struct("l_linenumber", "l_partkey", "l_suppkey")), "l_orderkey", ["l_returnflag", "l_linestatus"], ["p", "l_linestatus"], "k")
    texts = F.array_sort(F.transform("outcomes", lambda x: F.concat_ws(":", x["p"], x["l_linestatus"])))
    return index.withColumn("outcomes", F.array_join(texts, ","))


@query("with r as (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) rank from orders) select o_custkey, cast(rank as int) rank, o_orderkey from r where rank <= 10")
def top_ten_per_study(spark, d):
    return top_per_key(table(spark, d, "orders"), ["o_custkey"], 10, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "rank", "o_orderkey")


@query("""with x as (select *, o_orderkey % 10 k from orders), n as (select case when k = 1 then 'replaced' else o_orderpriority end p, case when k = 2 then 'Z' else o_orderstatus end s, o_custkey, o_orderstatus = 'F' f from x where k <> 3),
l as (select 'priority' facet, p as value, o_custkey, f from n union all select 'status', s, o_custkey, f from n) select facet, value, count(*) mention_count, count(distinct o_custkey) study_count, count(distinct case when f then o_custkey end) placebo_study_count from l group by 1, 2""")
def kept_facets(spark, d):
    """Facet counts carried through three increments (rows replaced twice, rows removed) instead of counted again."""
    o, k = table(spark, d, "orders").withColumn("flag", F.col("o_orderstatus") == "F"), F.col("o_orderkey") % 10
    by = ({"priority": F.col("o_orderpriority"), "status": F.col("o_orderstatus")}, "o_custkey", F.col("flag"))
    state = facets.facet_state(o, *by)
    stats = facets.state_stats(state)
    for old, new in ((o.where(k == 1), o.where(k == 1).withColumn("o_orderpriority", F.lit("replaced"))), (o.where(k == 2), o.where(k == 2).withColumn("o_orderstatus", F.lit("Z"))), (o.where(k == 3), o.limit(0))):
        changes = settle(facets.state_changes(old, new, *by))
        state = settle(facets.added(state, changes))
        stats = settle(facets.touched_stats(stats, changes, state))
    return stats
