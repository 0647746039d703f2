"""Orders and messages that hold for keys and numbers of any size."""

from evimap.operators import enrich, quality
from evimap.plans.queries import QUERIES
from pyspark.sql import functions as F


def test_first_line_with_large_part_keys(spark, tmp_path):
    """Part keys above a million do not push a line behind the next one."""
    rows = [(1, 1, 1_500_000, 7, "A", "F"), (1, 2, 10, 3, "N", "O"), (2, 1, 5, 2_000_000, "R", "O"), (2, 1, 6, 1, "A", "F")]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.l_orderkey: (r.l_returnflag, r.l_linestatus) for r in QUERIES["detail_index"](spark, str(tmp_path)).collect()}
    assert got == {1: ("A", "F"), 2: ("R", "O")}


def test_numbers_of_messages_are_plain(spark):
    """As digits, without an exponent, as the comparison engine writes them."""
    for x, want in ((0.0005, "0.0005"), (12345678.25, "12345678.25"), (30000000.0, "30000000.0"), (0.0, "0.0"), (0.85, "0.85"), (10.0, "10.0"), (None, "none")):
        facts = spark.createDataFrame([(x,)], "x double")
        got = quality.single_fact(facts, quality.Check("r", "P1", F.lit(True), F.col("x"), "value")).first()
        assert got.message == f"value: {want}"


def test_ages_are_rounded_as_in_sql(spark):
    """6,156 seconds are 0.07125 days, in doubles a little less."""
    log = spark.sql("select 'a' k, timestamp '2024-01-01 00:00:00' t union all select 'b', timestamp '2024-01-01 01:42:36'")
    assert enrich.staleness(log, "k", "t").first().age_days == 0.0712
