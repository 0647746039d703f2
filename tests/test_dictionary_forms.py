"""A text's forms are made once, and terms that are a word or a couple meet its sets instead of being searched in it."""

from evimap.functions import rules as R
from evimap.operators import dictionary
from pyspark.sql import functions as F


def test_boundaries_are_searched_once_for_anchors(spark):
    df = spark.createDataFrame([("a b",)], "body string")
    plan = df.select(dictionary.anchors(F.col("body")).alias("a"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "split(body" not in plan


def test_only_terms_of_more_than_two_words_are_searched(spark):
    texts = spark.createDataFrame([(1, "Mean arterial pressure, of (95% CI) mean\u2003flow\u00a0b2 x"), (2, "arterial  pressure of mean arterial")], "id long, body string")
    terms = ["mean arterial", "arterial pressure", "arterial  pressure", "mean", "flow", "mean arterial pressure", "(95%", "b2", "x", "pressure, of", "(95% ci)", "mean\u2003flow", "lost"]
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    held = texts.select(F.explode(dictionary.anchors(F.lower("body"))).alias("anchor")).groupBy("anchor").agg(F.count("*").alias("texts"))
    whole = {r.term: r.whole for r in dictionary.index(dictionary.places(df, "term"), held).collect()}
    assert {t for t, w in whole.items() if w} >= {"mean arterial", "mean", "flow", "pressure, of", "mean\u2003flow"} and not whole["mean arterial pressure"] and not whole["(95% ci)"]
    got = {(r.id, r.keyword) for r in dictionary.mentions(texts, F.col("body"), df).collect()}
    want = {(r.id, r.keyword) for r in texts.select("id", F.explode(R.matches(F.col("body"), terms)).alias("keyword")).collect()}
    assert got == want and len(want) == 12
