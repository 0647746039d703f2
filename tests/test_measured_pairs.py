"""Close titles are measured in many tasks, however few bytes they have."""

from evimap.operators import resolve
from pyspark.sql import functions as F


def test_close_titles_are_measured_in_many_tasks(spark):
    words = [" ".join(f"word{(i + j) % 97}" for j in range(12)) for i in range(60)]
    pairs = spark.createDataFrame([(w, w[:-1] + "x", len(w), len(w), 2) for w in words], "title_l string, title_r string, n_l int, n_r int, apart int").coalesce(1)
    found = resolve._measured(pairs, F.lit(0.85))
    assert found.rdd.getNumPartitions() > 8 and found.count() == 60
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "levenshtein" in plan[: plan.index("RepartitionByExpression")] and "levenshtein" not in plan[plan.index("RepartitionByExpression") :]
