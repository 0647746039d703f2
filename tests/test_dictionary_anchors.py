"""Terms of several words are looked up only in texts that have two of their words side by side."""

import time

from evimap.operators import dictionary
from pyspark.sql import functions as F


def test_words_apart_do_not_meet(spark):
    texts = spark.createDataFrame([("alpha  beta and gamma-delta",), ("beta alpha gamma delta",), ("x alpha beta, gamma-delta",)], "body string")
    held = [set(r.a) for r in texts.select(dictionary.anchors(F.col("body")).alias("a")).collect()]
    terms = spark.createDataFrame([("alpha beta",), ("Gamma-Delta",), ("alpha",), ("----",), ("",)], "term string")
    own = {r.term: set(r.places) for r in dictionary.places(terms, "term").collect()}
    assert [{t for t, p in own.items() if p <= h} for h in held] == [{"Gamma-Delta", "alpha"}, {"alpha"}, {"alpha beta", "Gamma-Delta", "alpha"}]


def test_long_text(spark):
    """Time grows with a text, not with its square."""
    texts = spark.range(1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("word"), i)), " ").alias("body"))
    terms = spark.range(1, 60_000, 100).select(F.concat(F.lit("word"), "id", F.lit(" word"), F.col("id") + 1).alias("term"))
    began = time.time()
    assert dictionary.mentions(texts, F.col("body"), terms).count() == 600 and time.time() - began < 40
