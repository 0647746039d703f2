"""Rules on text statistics whose cutoffs come with a bound on the good documents that they reject.

Every document gets counts over its whole text (words are runs without white
space of ASCII) and, of these, rule statistics in whole thousandths: the share
of symbols among the characters of words, of repeated lines among lines, of
words in repeated windows among words, and the mean length of a word in tenths.
A document that fails the base rule (fewer than 10 words, or above a fifth of
its words in windows found twice) goes in any case; the cutoffs are for the rest.

Cutoffs are chosen for each stratum from labelled documents, split by a hash of
the key.  One half proposes: for each rule and each of ``LEVELS``, the lowest
cutoff that at most that share of its good documents reaches.  So a stratum has
a sequence of rule sets, from lenient to strict, that the other half has no part
in.  The other half tests them in this order: a rule set passes if the exact
binomial (Clopper-Pearson) upper bound on the share of good documents that any
of its rules rejects is at most ``RISK``, and the first that fails ends the
sequence.  Tests of a fixed sequence need no correction among themselves; among
S strata each is made at ``DOUBT / S`` (Bonferroni), so with a chance of at least
1 - ``DOUBT`` no stratum loses more than ``RISK`` of its good documents.  Of the
rule sets that pass, the one that rejects most bad documents of the proposing
half counts, less ``COST`` times its share of good ones; the more lenient wins
ties.  Where no set passes (too few labels, say) the stratum keeps all.

Labels: of a repeated key the lowest label; equal texts of a stratum are one
observation, with the lowest label and the least key, so copies do not pass for
evidence.  A null stratum is one of its own.  Null and empty texts have no words
and fail the base rule.  Rows that repeat, or have a null key (without a label),
are judged each; columns that the result adds replace columns of the same name.
Empty tables give no rows, and without labels nothing but the base rule acts.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evimap.llm import hashing as H
from evimap.llm.components import shared_folder

WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
LEVELS, RISK, DOUBT, COST = (0.0, 0.001, 0.002, 0.005, 0.01, 0.02), 0.05, 0.05, 10
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: Rule statistics by name, as SQL over the counts; greater is worse.
RULES = {
    "symbols": "1000 * n_symbols div greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "long_words": "10 * word_chars div greatest(n_words, 1)",
}
BASE_FAILED = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that are found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    if len(names) == len(words):
        return 0
    codes, most = ids[:n].copy(), len(names)
    for i in range(1, window):
        if most * len(names) >= 1 << 62:
            codes = np.unique(codes, return_inverse=True)[1]
            most = int(codes.max()) + 1
        codes, most = codes * len(names) + ids[i : n + i], most * len(names)
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    change[:n] += twice
    change[window : n + window] -= twice
    return int((np.cumsum(change) > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(data.count(c) for c in SYMBOLS), len(lines), len(lines) - len(set(lines)), repeat_words(words)


def measured(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, a hash of the text, ``COUNTS`` and base_failed of each row."""
    H.small_batches(df.sparkSession)
    rows = df.select(text, *keep, F.xxhash64(text).alias("text_hash"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])

    def run(batches):
        for batch in batches:
            found = [counts(t.as_py()) for t in batch.column(0)]
            own = [pa.array(x, pa.int64()) for x in zip(*found)] if found else [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *own], [*keep, "text_hash", *COUNTS])

    return rows.mapInArrow(run, f"{kinds}, {', '.join(f'{c} long' for c in COUNTS)}").withColumn("base_failed", F.expr(BASE_FAILED))


def upper_bound_holds(k: int, n: int, risk: float, doubt: float) -> bool:
    """True where at most ``doubt`` of samples of n show k cases or fewer when ``risk`` of all are cases: P(Bin(n, risk) <= k) <= doubt."""
    if k >= n * risk:  # the bound is above the share seen
        return False
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk)
    term, total, ratio = 1.0, 0.0, (1 - risk) / risk
    for i in range(k, -1, -1):  # terms fall from k down, by a growing factor
        total += term
        term *= ratio * i / (n - i + 1)
        if term < 1e-17 * total:
            break
    return log(k) + math.log(total) <= math.log(doubt)


def cutoffs(facts: DataFrame, key: str, stratum: str, labels: DataFrame, label: str) -> DataFrame:
    """of (a stratum) and the cutoff of each rule, a row for each stratum with a rule set that passed."""
    spark = facts.sparkSession
    said = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k_")).agg(F.min(F.col(label)).alias("y"))
    rows = facts.where("not base_failed").join(said, facts[key] == said["k_"])
    rows = rows.groupBy(F.col(stratum).alias("stratum"), "text_hash", *COUNTS).agg(F.min(F.struct("y", F.col(key).cast("string").alias("k"))).alias("x"))
    proposes = F.instr(F.lit("02468ace"), F.substring(F.md5("x.k"), 1, 1)) > 0
    rows = rows.select("stratum", (F.col("x.y") > 0).alias("good"), proposes.alias("proposes"), *(F.expr(v).alias(r) for r, v in RULES.items()))
    folder = f"{shared_folder(spark)}/labelled-{uuid.uuid4()}"
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)

    # Histograms of whole thousandths: what a window sees of a stratum and rule does not grow with the rows.
    each = rows.where("good and proposes").select("stratum", F.explode(F.create_map(*(x for r in RULES for x in (F.lit(r), F.col(r))))).alias("rule", "v"))
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("v"))
    reached = each.groupBy("stratum", "rule", "v").count().withColumn("reach", F.sum("count").over(down)).withColumn("n", F.sum("count").over(Window.partitionBy("stratum", "rule")))
    cut = [F.coalesce(F.max(F.when(F.col("reach") > F.floor(F.col("n") * F.lit(q)), F.col("v"))) + 1, F.lit(0)).alias(f"c{i}") for i, q in enumerate(LEVELS)]
    sets = reached.groupBy("stratum", "rule").agg(F.array(*cut).alias("cut")).groupBy(F.col("stratum").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("sets"))

    # The least level at which a row is rejected, and from it how many are at each.
    level = lambda r: F.coalesce(F.array_position(F.transform(F.col("sets")[r], lambda c: F.col(r) >= c), True), F.lit(0))
    least = F.array_min(F.array(*(F.when(level(r) > 0, level(r) - 1).otherwise(len(LEVELS)) for r in RULES)))
    hit = rows.join(sets, F.col("stratum").eqNullSafe(F.col("of"))).select("stratum", "good", "proposes", least.alias("least"))
    n = lambda c, i: F.count_if(c & (F.col("least") <= i))
    tested, seen = F.col("good") & ~F.col("proposes"), F.col("proposes")
    found = hit.groupBy("stratum").agg(
        F.count_if(tested).alias("n"), F.array(*(n(tested, i) for i in range(len(LEVELS)))).alias("lost"),
        F.array(*(n(seen & ~F.col("good"), i) for i in range(len(LEVELS)))).alias("caught"), F.count_if(seen & ~F.col("good")).alias("bad"),
        F.array(*(n(seen & F.col("good"), i) for i in range(len(LEVELS)))).alias("wrong"), F.count_if(seen & F.col("good")).alias("right"),
    )
    found = found.withColumn("strata", F.lit(found.count()))  # one row for each stratum

    def choose(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                passed = 0
                while passed < len(LEVELS) and upper_bound_holds(r["lost"][passed], r["n"], RISK, DOUBT / r["strata"]):
                    passed += 1
                worth = [r["caught"][i] / max(1, r["bad"]) - COST * r["wrong"][i] / max(1, r["right"]) for i in range(passed)]
                out.append(worth.index(max(worth)) if worth else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int32())], ["stratum", "level"])

    kind = rows.schema["stratum"].dataType.simpleString()
    chosen = found.mapInArrow(choose, f"stratum {kind}, level int").where("level is not null")
    kept = f"{shared_folder(spark)}/cutoffs-{uuid.uuid4()}"
    sets.join(chosen, F.col("of").eqNullSafe(F.col("stratum"))).select("of", *(F.col("sets")[r][F.col("level")].alias(f"cut_{r}") for r in RULES)).write.parquet(kept)
    return spark.read.parquet(kept)


def judged(df: DataFrame, key: str, text: str, stratum: str, labels: DataFrame, label: str) -> DataFrame:
    """``key``, ``stratum``, ``COUNTS``, base_failed, the rules that reject (``rejected_by``) and kept, for each row."""
    spark, folder = df.sparkSession, f"{shared_folder(df.sparkSession)}/measured-{uuid.uuid4()}"
    measured(df, text, [key, stratum]).write.parquet(folder)
    facts = spark.read.parquet(folder)
    cut = cutoffs(facts, key, stratum, labels, label)
    rows = facts.join(cut, facts[stratum].eqNullSafe(cut["of"]), "left")
    hits = F.array_compact(F.array(*(F.when(F.expr(v) >= F.col(f"cut_{r}"), F.lit(r)) for r, v in RULES.items())))
    rows = rows.withColumn("rejected_by", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(hits))
    return rows.select(facts[key], facts[stratum], *COUNTS, "base_failed", "rejected_by", (F.size("rejected_by") == 0).alias("kept"))


_LEVELS = f"[{', '.join(map(str, LEVELS))}]"
RULES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)),
win AS (SELECT r, i, w AS w0, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, unnest(list(i)) AS i FROM win WHERE w4 IS NOT NULL GROUP BY r, w0, w1, w2, w3, w4 HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM twice, range(0, 5) AS x(o) GROUP BY r),
c AS (SELECT r, doc_id, lang, t, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
f AS (SELECT r, doc_id, lang, t, n_words, word_chars, n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM c LEFT JOIN rep USING (r)),
s AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  [1000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1), 10 * word_chars // greatest(n_words, 1)] AS v FROM f),
y AS (SELECT doc_id, min(quality) AS y FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
l AS (SELECT lang, t, any_value(v) AS v, min(struct_pack(y := y, k := s.doc_id::VARCHAR)) AS x FROM s JOIN y ON s.doc_id = y.doc_id WHERE NOT base_failed GROUP BY lang, t),
rows_ AS (SELECT coalesce(lang, chr(0)) AS g, v, x.y > 0 AS good, instr('02468ace', left(md5(x.k), 1)) > 0 AS proposes FROM l),
each AS (SELECT g, j, v[j] AS v FROM rows_, range(1, 5) AS x(j) WHERE good AND proposes),
reached AS (SELECT g, j, v, count(*) OVER (PARTITION BY g, j ORDER BY v DESC) AS reach, count(*) OVER (PARTITION BY g, j) AS n FROM each),
cut AS (SELECT g, j, z, coalesce(max(v) FILTER (WHERE reach > floor(n * {_LEVELS}[z])) + 1, 0) AS c FROM reached, range(1, {len(LEVELS) + 1}) AS x(z) GROUP BY g, j, z),
sets AS (SELECT g, z, list(c ORDER BY j) AS c FROM cut GROUP BY g, z),
hit AS (SELECT rows_.g, z, good, proposes, v[1] >= c[1] OR v[2] >= c[2] OR v[3] >= c[3] OR v[4] >= c[4] AS out FROM rows_ JOIN sets ON rows_.g = sets.g),
found AS (SELECT g, z, count(*) FILTER (WHERE good AND NOT proposes) AS n, count(*) FILTER (WHERE good AND NOT proposes AND out) AS lost,
  (count(*) FILTER (WHERE proposes AND NOT good AND out))::DOUBLE / greatest(1, count(*) FILTER (WHERE proposes AND NOT good)) - {COST} * (count(*) FILTER (WHERE proposes AND good AND out))::DOUBLE / greatest(1, count(*) FILTER (WHERE proposes AND good)) AS worth FROM hit GROUP BY g, z),
p AS (SELECT *, lost < n * {RISK} AND list_sum(list_transform(range(0, lost + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) <= {DOUBT} / (SELECT count(DISTINCT g) FROM found) AS pass FROM found),
ok AS (SELECT * FROM (SELECT *, bool_and(pass) OVER (PARTITION BY g ORDER BY z) AS all_ FROM p) WHERE all_),
best AS (SELECT g, arg_max(z, struct_pack(worth := worth, z := -z)) AS z FROM ok GROUP BY g)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(v[1] >= c[1] OR v[2] >= c[2] OR v[3] >= c[3] OR v[4] >= c[4], false) AS kept
FROM s LEFT JOIN (SELECT g, c FROM best JOIN sets USING (g, z)) b ON coalesce(s.lang, chr(0)) = b.g
"""
