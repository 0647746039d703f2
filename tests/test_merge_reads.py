"""A merge reads its sources once, however many ways of matching look at them."""

from evimap.operators import resolve
from pyspark.sql import functions as F


def test_sources_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(i):
        seen.add(1)
        return i

    looked = F.udf(look, "long").asNondeterministic()
    shape = "id long, title string, sources string, country string"
    base = spark.createDataFrame([(i, f"early goal directed trial number{i}", "base", "") for i in range(20)], shape)
    new = spark.createDataFrame([(i, f"early goal directed trial number{i - 90}", "new", "zz") for i in range(100, 130)], shape)
    merged, crosswalk = resolve.merge_sources(base.withColumn("id", looked("id")), new.withColumn("id", looked("id")), "id", "title", "sources", ["country"])
    assert sorted((r.left_id, r.right_id) for r in crosswalk.where("left_id < 110").collect()) == [(i, i - 90) for i in range(100, 110)]
    assert {r.id: r.country for r in merged.collect()}[15] == "zz" and seen.value == 50
