"""The dictionary as a table against the compiled rules, token by token."""

import random

from evimap.functions import defaults as D
from evimap.functions import rules as R
from evimap.operators import dictionary
from pyspark.sql import functions as F

ODD_TERMS = ["a-b", "MAP", "the", "o'brien", "o’brien", "°C", "(95% ci)", "----", " -- x", "über", "naïve test", "x/y", "1.5 mg", "CO2", "co", "of", "", " ", "a  b", "word", "WORD", "words", "éclat", "日本", "日本語 x", "a\x01b c"]
PIECES = ["map", "the", "MAP kinase", "o'Brien", "°C", "(95% CI)", "a----b", "x -- x", "über", "Übermut", "naïve test", "x/y", "1.5 mg", "11.5 mg", "CO2", "co", "[of]", "a  b", "a b", "word", "words", "word-s", "éclat", "日本", "日本語 x", "hazard ratio", "HR", "hr 1.2", "sv40", "SV", "mean arterial pressure", "lactate clearance", "\n", " ", ",", "-", "a\x01b c", "_word_"]


def test_same_as_the_rules(spark):
    rng = random.Random(11)
    texts = [(i, rng.choice(["", " ", ""]).join(rng.choice(PIECES + [" "] * 12) for _ in range(rng.randint(0, 14)))) for i in range(400)] + [(1000, None), (1001, ""), (1, "map and more"), (1, "map and more")]
    terms = list(dict.fromkeys([*D.KEYWORDS, *ODD_TERMS]))
    df = spark.createDataFrame(texts, "id long, body string").repartition(3)
    vetoes = spark.createDataFrame(sorted(D.VETOES.items()), "term string, pattern string")
    want = [tuple(r) for r in df.select("id", "body", F.explode(R.matches(F.col("body"), terms)).alias("keyword")).collect()]
    got = dictionary.mentions(df, F.col("body"), spark.createDataFrame([(t,) for t in [*terms, "MAP", None]], "term string"), vetoes=vetoes)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 700
    assert dictionary.mentions(df.limit(0), F.col("body"), spark.createDataFrame([("map",)], "term string")).collect() == []
    assert dictionary.mentions(df, F.col("body"), spark.createDataFrame([], "term string")).collect() == []


def test_many_terms(spark):
    """100,000 terms, most of one common word and a rare one: only those of a text's rare words are looked for."""
    terms = spark.range(100_000).select(F.concat(F.lit("common t"), "id").alias("term"))
    texts = spark.range(2000).select("id", F.concat(F.lit("a common t"), F.col("id") * 7, F.lit(" and common of t"), "id").alias("body"))
    got = dictionary.mentions(texts, F.col("body"), terms).collect()
    assert sorted((r.id, r.keyword) for r in got) == sorted((i, f"common t{7 * i}") for i in range(2000))
