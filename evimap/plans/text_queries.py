"""Text rules and entity resolution."""

from __future__ import annotations

from evimap.functions import rules as R
from evimap.functions import text as T
from evimap.operators import dictionary, evidence, resolve
from evimap.operators.incremental import keyed
from evimap.plans.queries import query, table
from pyspark.sql import functions as F

WORDS = ["license", "apache", "the", "mit", "thatin", "und", "email"]
VETO = {"mit": r"\bmit\s+license\b", "the": r"\bthe\s+the\b"}
CATEGORIES = [("Licence text", ["apache license", "mit"]), ("German", ["und", "keit"]), ("French", ["eaux", "que"]), ("English", ["the", "thatin"])]

_PARTS = r"string_split_regex(translate(t, '/()-,;[]', '        '), '\s+')"


def _has(token: str, text: str = "t") -> str:
    if len(token) <= 3:
        found = f"list_contains({_PARTS.replace('(t,', f'({text},')}, '{token}')"
    else:
        # RE2 knows ASCII word characters only, Spark's (?U) all of them: word neighbours are excluded by class
        found = rf"regexp_matches({text}, '(^|[^\pL\pN\pM_]){token}($|[^\pL\pN\pM_])')"
    return found + (f" and not regexp_matches({text}, '{VETO[token]}')" if token in VETO else "")


def docs(spark, d):
    return table(spark, d, "documents")


@query("with x as (select doc_id, lower(text) t from documents), k as (select doc_id, unnest([" + ", ".join(f"case when {_has(w)} then '{w}' end" for w in WORDS) + "]) keyword from x) select * from k where keyword is not null")
def keyword_mentions(spark, d):
    return evidence.mentions(docs(spark, d), F.col("text"), WORDS, VETO).select("doc_id", "keyword")


# The dictionary is the start of every document: its first word if that is short, else its first two.
_TERMS = r"""d as (select doc_id, lower(text) t from documents), w as (select regexp_extract(t, '^[a-z]+(?: [a-z]+)?') f from d),
terms as (select distinct case when length(split_part(f, ' ', 1)) <= 3 then split_part(f, ' ', 1) else f end x from w where f <> '')"""


@query(rf"""with {_TERMS}, m as (select doc_id, t, chr(1) || regexp_replace(t, '([^\pL\pN\pM_])', chr(1) || '\1' || chr(1), 'g') || chr(1) e from d)
select doc_id, x keyword from m, terms where length(x) > 3 and contains(e, chr(1) || replace(x, ' ', chr(1) || ' ' || chr(1)) || chr(1)) or length(x) <= 3 and list_contains({_PARTS}, x)""")
def dictionary_mentions(spark, d):
    """Terms that come from a table, found in every document."""
    own = docs(spark, d).select("doc_id", "text")
    first = F.regexp_extract(F.lower("text"), "^[a-z]+(?: [a-z]+)?", 0)
    word = F.split_part(first, F.lit(" "), F.lit(1))
    terms = own.select(F.when(F.length(word) <= 3, word).otherwise(first).alias("term"))
    return dictionary.mentions(own, F.col("text"), terms).select("doc_id", "keyword")


def _case(text: str) -> str:
    return "case " + " ".join(f"when {' or '.join('(' + _has(t, text) + ')' for t in tokens)} then '{name}'" for name, tokens in CATEGORIES) + " end"


@query(f"with x as (select doc_id, lower(source) s, lower(source || ' ' || text) t from documents) select doc_id, coalesce({_case('s')}, {_case('t')}, 'Unmapped') category from x")
def categories(spark, d):
    return docs(spark, d).select("doc_id", R.category(F.col("source"), F.col("text"), CATEGORIES, VETO).alias("category"))


@query("select doc_id from documents where regexp_matches(lower(text), '\\b(the|und)\\b') and regexp_matches(lower(text), '\\b(apache license|mit license)\\b')")
def phrase_query(spark, d):
    return docs(spark, d).where(R.phrase_query(F.col("text"), [["the", "und"], ["Apache License", "MIT License"]])).select("doc_id")


# One text for each unit pattern, with what is found in it and the unit it stands for; then texts without a unit, or with a percent sign.
_UNIT_TEXTS = [
    (" rise of 9 mmHg/s", "mmhg/s", "mmHg/s"), (" mm Hg", "mm hg", "mmHg"), (" cmH2O", "cmh2o", "cmH2O"), (" mmol per L", "mmol per l", "mmol/L"), (" mEq / L", "meq / l", "mEq/L"), (" mg/dL", "mg/dl", "mg/dL"),
    (" ug/kg/min", "ug/kg/min", "mcg/kg/min"), (" ng/kg/min", "ng/kg/min", "ng/kg/min"), (" units/hour", "units/hour", "units/hr"), (" ml/kg/min", "ml/kg/min", "mL/kg/min"), (" L/min/m^2", "l/min/m^2", "L/min/m2"),
    (" mL / min / m2", "ml / min / m2", "mL/min/m2"), (" mL/m2", "ml/m2", "mL/m2"), (" L / min", "l / min", "L/min"), (" ml/min", "ml/min", "mL/min"), (" mL/beat", "ml/beat", "mL/beat"), (" beats per minute", "beats per minute", "bpm"),
    (" dynes*s/cm5/m2", "dynes*s/cm5/m2", "dyn*s/cm5/m2"), (" dyn s/cm^5", "dyn s/cm^5", "dyn*s/cm5"), (" Wood units", "wood units", "Wood units"), (" watts", "watts", "W"), (" msec or ms", "ms", "ms"), (" seconds", "seconds", "s"),
    (" % EF", "%", "%"), (" % of baseline", "", "score"), (" items", "", "score"), (" bpm, later mmHg", "mmhg", "mmHg"), (" barrels/minute", "", "score"),
]


def _cases(values, of: str = "l_linenumber + l_orderkey") -> str:
    return f"case ({of}) % {len(values)} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


def _choice(values, n):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (n % len(values) + 1).cast("int"))


@query(f"select l_orderkey, l_linenumber, {_cases([r for _, r, _ in _UNIT_TEXTS])} raw, {_cases([u for _, _, u in _UNIT_TEXTS])} unit from lineitem")
def units(spark, d):
    n = F.col("l_linenumber")
    u = R.unit(F.concat(n.cast("string"), _choice([t for t, _, _ in _UNIT_TEXTS], n + F.col("l_orderkey"))))
    return table(spark, d, "lineitem").select("l_orderkey", n, u["raw"].alias("raw"), R.fallback_unit(u["normal"], F.lit("ICU Severity Score")).alias("unit"))


@query("""select o_orderkey, case o_orderkey % 5 when 0 then 'placebo' when 1 then 'usual_care' when 2 then 'active_control' when 3 then 'sham' else 'experimental' end arm, o_orderkey % 5 in (0, 3) placebo from orders""")
def arm_types(spark, d):
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "Matching PLACEBO pill").when(k == 1, "Standard of care").when(k == 2, "an active comparator").when(k == 3, "Sham device").otherwise("New drug")
    return table(spark, d, "orders").select("o_orderkey", R.classify_arm(text).alias("arm"), R.is_placebo(text).alias("placebo"))


# The title of a document is its whole first line.  The edit distance of the comparison engine counts bytes, so accented
# letters are folded and any other character outside ASCII becomes one question mark, in both engines.
_FOLD = ("äöüßáàâãåçéèêëíìîïñóòôõúùûý", "aousaaaaaceeeeiiiinoooouuuy")
_HEADS = f"h as (select doc_id, source, lower(trim(regexp_replace(regexp_replace(translate(lower(split_part(text, chr(10), 1)), '{_FOLD[0]}', '{_FOLD[1]}'), '[^\\x00-\\x7F]', '?', 'g'), '\\s+', ' ', 'g'))) t from documents)"


def heads(spark, d):
    first = F.translate(F.lower(F.substring_index("text", "\n", 1)), *_FOLD)
    return docs(spark, d).select("doc_id", "source", F.lower(T.normal_space(F.regexp_replace(first, r"[^\x00-\x7F]", "?"))).alias("t"), "lang")


# Where no edit distance is taken, titles are compared as they are, in every script.
_TITLES = r"h as (select doc_id, source, lower(trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g'))) t from documents)"


def whole_titles(spark, d):
    first = F.substring_index("text", "\n", 1)
    return docs(spark, d).select("doc_id", "source", F.lower(T.normal_space(first)).alias("t"))


_BOTH = "a as (select doc_id, t from h where source like 'src1%'), b as (select doc_id, t from h where source not like 'src1%')"


def halves(spark, d):
    """Documents of the sources src1, src10 to src19, and of all others."""
    h = heads(spark, d)
    one = F.col("source").startswith("src1")
    return h.where(one), h.where(~one)


@query(f"with {_TITLES}, {_BOTH} select a.doc_id left_id, min(b.doc_id) right_id from a join b on a.t = b.t and a.t <> '' group by 1")
def exact_titles(spark, d):
    h, one = whole_titles(spark, d), F.col("source").startswith("src1")
    return resolve.exact_title_matches(h.where(one), h.where(~one), "doc_id", "doc_id", "t", "t")


_SPLIT = r"list_distinct(list_filter(string_split_regex(t, '[^\pL\pN\pM_]+'), lambda w: length(w) >= 4))"
_WORDS = f"x as (select t, min(doc_id) id, {_SPLIT} w from a group by t), y as (select t, min(doc_id) id, {_SPLIT} w from b group by t)"
_SHARED = "p as (select x.t tl, y.t tr, x.id il, y.id ir, len(list_intersect(x.w, y.w)) s, len(x.w) n, len(y.w) m from x join y on list_has_any(x.w, y.w))"
_SIM = "1 - levenshtein(tl, tr) / greatest(length(tl), length(tr))"


@query(f"""with {_HEADS}, {_BOTH}, {_WORDS}, {_SHARED}, q as (select tl, ir, {_SIM} sim from p where s >= greatest(2, n // 2) and s / (n + m - s) >= 0.5),
f as (select *, row_number() over (partition by tl order by sim desc, ir) k from q where sim >= 0.85) select a.doc_id left_id, ir right_id, round(sim, 6) similarity from f join a on a.t = tl where k = 1""")
def fuzzy_titles(spark, d):
    return resolve.fuzzy_title_matches(*halves(spark, d), "doc_id", "doc_id", "t", "t").withColumn("similarity", F.round("similarity", 6))


@query(f"""with {_HEADS}, {_BOTH}, {_WORDS}, {_SHARED}, q as (select tl, ir, {_SIM} sim from p where s / (n + m - s) >= 0.2), f as (select *, row_number() over (partition by tl order by sim desc, ir) k from q)
select a.doc_id left_id, ir right_id, round(sim, 6) similarity from f join a on a.t = tl where k = 1""")
def nearest_titles(spark, d):
    return resolve.nearest_titles(*halves(spark, d), "doc_id", "doc_id", "t", "t").withColumn("similarity", F.round("similarity", 6))


# A loop over the titles in the order of their first record: each stays unless an earlier one that stays is close.
_CHAIN = f"""ct as (select t, min(id) o, {_SPLIT} w from r3 where t <> '' group by t),
cs as (select l.t tl, r.t tr, l.o ol, r.o o, len(list_intersect(l.w, r.w)) s, len(l.w) n, len(r.w) m from ct l join ct r on r.o < l.o and list_has_any(l.w, r.w)),
cp as (select * from (select *, {_SIM} sim from cs where s >= greatest(2, n // 2) and s / (n + m - s) >= 0.5) where sim >= 0.85), cn as (select tl, list(tr) e, row_number() over (order by any_value(ol)) i from cp group by tl),
walk as (select cast(0 as bigint) i, cast([] as varchar[]) gone union all select cn.i, case when len(list_filter(e, lambda x: not list_contains(gone, x))) > 0 then list_append(gone, tl) else gone end from walk join cn on cn.i = walk.i + 1),
gone as (select unnest(gone) t from (select gone from walk order by i desc limit 1)), cb as (select r3.id l, o r, row_number() over (partition by r3.id order by sim desc, o) k from r3 join cp on cp.tl = r3.t where r3.t in (from gone) and cp.tr not in (from gone) and o < r3.id),
links as (select r3.id l, ct.o r from r3 join ct on ct.t = r3.t where ct.o <> r3.id and r3.t not in (from gone) union all select l, r from cb where k = 1)"""


@query(f"with recursive {_HEADS}, r3 as (select doc_id id, t from h where source like 'src%'), {_CHAIN} select l left_id, r right_id from links")
def chained_titles(spark, d):
    """Every document is new: later ones with an equal or close title belong to earlier ones."""
    return resolve.chained(heads(spark, d).where(F.col("source").startswith("src")).select("doc_id", "t"), "doc_id", "t")[1]


@query(f"with {_HEADS} select a.doc_id left_id, b.doc_id right_id, round(case when greatest(length(a.t), length(b.t)) > 0 then 1 - levenshtein(a.t, b.t) / greatest(length(a.t), length(b.t)) else 1 end, 6) similarity from h a join h b on b.doc_id = a.doc_id + 1")
def known_pairs(spark, d):
    h = heads(spark, d)
    pairs = h.select(F.col("doc_id").alias("left_id"), (F.col("doc_id") + 1).alias("right_id"))
    return resolve.known_pairs(pairs, h, h, "doc_id", "doc_id", "t", "t").withColumn("similarity", F.round("similarity", 6))


@query(f"with {_TITLES}, w as (select doc_id, {_SPLIT} w from h) select a.doc_id, round(case when len(a.w) + len(b.w) > 0 then len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) else 0 end, 6) jaccard from w a join w b on b.doc_id = a.doc_id + 1")
def word_jaccard(spark, d):
    h = whole_titles(spark, d).select("doc_id", T.title_words(F.col("t")).alias("w"))
    after = h.select((F.col("doc_id") - 1).alias("doc_id"), F.col("w").alias("v"))
    return h.join(after, "doc_id").select("doc_id", F.round(T.word_jaccard(F.col("w"), F.col("v")), 6).alias("jaccard"))


_SLICES = """b as (select o_orderkey id, 'base' sources, case when o_orderkey % 3 = 0 then '' else o_orderpriority end country from orders where o_orderkey % 4 < 3),
e as (select o_orderkey id, 'ext' sources, o_orderstatus country from orders where o_orderkey % 4 >= 2)"""


def slices(spark, d):
    o = table(spark, d, "orders").withColumn("id", F.col("o_orderkey"))
    base = o.where("o_orderkey % 4 < 3").select("id", F.lit("base").alias("sources"), F.when(F.col("id") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("country"))
    return base, o.where("o_orderkey % 4 >= 2").select("id", F.lit("ext").alias("sources"), F.col("o_orderstatus").alias("country"))


@query(f"with {_SLICES} select b.id, case when e.id is null then 'base' else 'base;ext' end sources, coalesce(nullif(b.country, ''), e.country) country from b left join e on e.id = b.id")
def merge_by_id(spark, d):
    return resolve.merge_by_id(*slices(spark, d), "id", "sources", ["country"])


@query(f"with {_SLICES} select * from e where id not in (select id from b) and id % 5 <> 0")
def new_rows(spark, d):
    base, ext = slices(spark, d)
    return resolve.unmatched(ext, ext.where("id % 5 = 0").select(F.col("id").alias("left_id")), "id", base)


@query("select case when l_orderkey % 10 = 0 then l_orderkey + 1 else l_orderkey end l_orderkey, count(*) n from lineitem group by 1")
def remapped_children(spark, d):
    crosswalk = table(spark, d, "orders").where("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("left_id"), (F.col("o_orderkey") + 1).alias("right_id"))
    return resolve.remap(table(spark, d, "lineitem").select("l_orderkey"), "l_orderkey", crosswalk).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""with u as (select o_custkey, o_orderkey, 0 p from orders where o_orderstatus = 'F' union all select o_custkey, o_orderkey, 1 from orders where o_orderstatus <> 'F'),
r as (select *, row_number() over (partition by o_custkey order by p, o_orderkey) k from u) select o_custkey, o_orderkey from r where k = 1""")
def union_first_wins(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return resolve.union_first_wins([o.where("o_orderstatus = 'F'").drop("o_orderstatus"), o.where("o_orderstatus <> 'F'").drop("o_orderstatus")], ["o_custkey"], F.col("o_orderkey"))


@query("select o_orderkey, o_custkey from orders order by md5('5|' || o_orderkey || '|' || o_custkey), o_orderkey, o_custkey limit 50")
def sampled_pairs(spark, d):
    return resolve.sample_pairs(table(spark, d, "orders").select("o_orderkey", "o_custkey"), 50, "5", "o_orderkey", "o_custkey")


@query(r"""select doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) = '' empty, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) size, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) hash from documents""")
def normal_space(spark, d):
    t = T.normal_space(F.col("text"))
    return docs(spark, d).select("doc_id", (F.lower(t) == "").alias("empty"), F.length(t).cast("long").alias("size"), F.md5(t).alias("hash"))


@query(r"""select l_orderkey, l_linenumber, case l_linenumber % 4 when 0 then '''=' || l_comment when 1 then l_comment when 2 then '''a' || chr(10) || '@' || l_comment else '-' || l_comment end safe from (select *, l_returnflag || l_linestatus l_comment from lineitem)""")
def formula_guard(spark, d):
    n, c = F.col("l_linenumber") % 4, F.concat("l_returnflag", "l_linestatus")
    text = F.when(n == 0, F.concat(F.lit("="), c)).when(n == 1, c).when(n == 2, F.concat(F.lit("a\n@"), c)).otherwise(F.concat(F.lit("-"), c))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.formula_safe(text).alias("safe"))


@query("select o_orderkey, case o_orderkey % 3 when 0 then 0 when 1 then o_orderkey else o_orderkey + 5000000000 end n from orders")
def lenient_numbers(spark, d):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_orderkey").cast("string"), F.lit("x"))).when(F.col("o_orderkey") % 3 == 2, (F.col("o_orderkey") + 5000000000).cast("string")).otherwise(F.concat(F.lit(" "), F.col("o_orderkey").cast("string")))
    return table(spark, d, "orders").select("o_orderkey", T.lenient_int(text).alias("n"))


@query("select p_partkey, lower(p_brand) drug from part")
def drug_names(spark, d):
    return table(spark, d, "part").select("p_partkey", T.drug_name(F.concat(F.col("p_brand"), F.lit('  50 mg (oral "x") Tablet'))).alias("drug"))


@query("select o_orderkey, strftime(o_orderdate, '%Y') || case when o_orderkey % 3 > 0 then strftime(o_orderdate, '-%m') else '' end || case when o_orderkey % 3 = 2 then strftime(o_orderdate, '-%d') else '' end as date from orders")
def partial_dates(spark, d):
    k, o = F.col("o_orderkey") % 3, F.col("o_orderdate")
    date = T.partial_date(F.date_format(o, "yyyy"), F.when(k == 1, F.date_format(o, "MMM")).when(k == 2, F.date_format(o, "M")), F.when(k == 2, F.date_format(o, "d")), F.lit(""))
    return table(spark, d, "orders").select("o_orderkey", date.alias("date"))


@query("select o_orderkey, case o_orderkey % 3 when 0 then 'Phase2' when 1 then 'Not Stated' else 'Phase1; Phase2' end phase from orders")
def clean_phases(spark, d):
    k = F.col("o_orderkey") % 3
    return table(spark, d, "orders").select("o_orderkey", T.clean_phase(F.when(k == 0, "PHASE2").when(k == 1, "NA").otherwise("PHASE1; PHASE2")).alias("phase"))


@query("select o_orderkey, round(date_sub('second', o_orderdate, timestamp '2002-01-01') / 86400, 4) age, case when o_orderdate > timestamp '2001-12-31' then 'today' when o_orderdate > timestamp '2001-12-30' then '1 day ago' else cast(floor(date_sub('second', o_orderdate, timestamp '2002-01-01') / 86400) as bigint) || ' days ago' end freshness from orders")
def ages(spark, d):
    age = T.age_days(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("2002-01-01").cast("timestamp"))
    return table(spark, d, "orders").select("o_orderkey", F.round(age, 4).alias("age"), T.freshness(age).alias("freshness"))


# Ids of every known form, then some that are none; % stands for the number.
_ID_FORMS = [
    "NCT%", "PMID:%", "EUCTR2004-%-12", "ISRCTN%", "ACTRN%", "ChiCTR-TRC-%", "DRKS%", "JPRN-UMIN%", "CTRI/2010/%", "PACTR%", "REBEC-x%", "KCT%", "IRCT2015-%N1", "TCTR%", "SLCTR/2012/%", "RPCEC0%", "PER-%-14", "NTR%", "LBCTR-a-%",
    "NCTx%", "XYZ%", "ISRCTN %", "nct%", "",
]


@query(f"select o_orderkey, o_orderkey % {len(_ID_FORMS)} < 19 trial, o_orderkey % {len(_ID_FORMS)} = 0 nct from orders")
def trial_ids(spark, d):
    number = F.lpad(F.col("o_orderkey").cast("string"), 8, "0")
    ident = F.replace(_choice(_ID_FORMS, F.col("o_orderkey")), F.lit("%"), number)
    return table(spark, d, "orders").select("o_orderkey", T.is_trial_id(ident).alias("trial"), T.is_nct_id(ident).alias("nct"))


@query("select o_orderkey, o_custkey from orders where o_orderpriority <> '1-URGENT'")
def non_blank_keys(spark, d):
    blank = F.when(F.col("o_orderpriority") == "1-URGENT", " ").otherwise(F.col("o_orderpriority"))
    return keyed(table(spark, d, "orders").withColumn("k", blank), ["k"]).select("o_orderkey", "o_custkey")


@query("""select o_orderkey, string_agg(l_partkey || '::' || replace(l_returnflag, 'R', 'R'), ';;' order by l_partkey, l_returnflag) records from orders join lineitem on l_orderkey = o_orderkey group by 1""")
def encoded_records(spark, d):
    lists = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_returnflag"))).alias("records"))
    orders = table(spark, d, "orders").select("o_orderkey")
    return evidence.encoded_lists(lists.join(orders, "o_orderkey"), {}, {"records": ["l_partkey", "l_returnflag"]})
