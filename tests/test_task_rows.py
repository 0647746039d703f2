"""Tasks hold so many rows, however large the tables are and however few bytes their rows have."""

import pytest
from evimap.operators import lineage
from evimap.plans.facet_queries import rows
from evimap.plans.queries import QUERIES
from pyspark.sql import functions as F

D = "/root/testdata/sf0.001"


def test_joined_lines_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(lineage, "TASK_ROWS", 100)
    lines = rows(spark, D)
    assert lines.rdd.getNumPartitions() >= 60
    assert lines.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 400


@pytest.mark.parametrize("name", ["facet_stats", "replace_children"])
def test_first_sums_are_made_in_as_many_tasks(spark, monkeypatch, name):
    monkeypatch.setattr(lineage, "TASK_ROWS", 100)
    plan = QUERIES[name](spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_many_parts_are_dealt_too(spark, monkeypatch):
    want = sorted(map(str, rows(spark, D).collect()))
    monkeypatch.setattr(lineage, "TASK_ROWS", 100)
    lines = rows(spark, D)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [l_partkey" not in plan and plan.count("REPARTITION_BY_NUM") == 4
    assert sorted(map(str, lines.collect())) == want
