import hashlib
import json

from evimap.operators import evidence, facets, provenance, quality, resolve, sampling
from evimap.operators.dedup import one_per_key
from pyspark.sql import functions as F


def test_living_map(spark):
    found = spark.createDataFrame([("NCT1", "primary", "Change in MAP (mmHg)", "MAP", "MAP"), ("NCT2", "other", "SOFA", "SOFA", "score"), ("NCT9", "other", "zzz", "zzz", "")], "nct_id string, outcome_type string, measure string, keyword string, matched_text string")
    studies = spark.createDataFrame([("NCT1", "old", 0), ("NCT1", "title", 1), ("NCT2", "b", 0)], "nct_id string, brief_title string, placebo_arm_count int")
    rows = {r.nct_id: r for r in evidence.living_map(found, studies).collect()}
    assert (rows["NCT1"].normalized_keyword, rows["NCT1"].normalized_unit, rows["NCT1"].has_placebo_arm, rows["NCT1"].brief_title) == ("MAP", "mmHg", True, "title")
    assert (rows["NCT2"].normalized_keyword, rows["NCT2"].normalized_unit, rows["NCT2"].has_placebo_arm) == ("ICU Severity Score", "score", False)
    assert (rows["NCT9"].normalized_keyword, rows["NCT9"].brief_title, rows["NCT9"].has_placebo_arm) == ("Unmapped", None, False)


def test_counts_before_exploding_and_detail(spark):
    df = spark.createDataFrame([("a", [True, False], ["x", "y"])], "id string, arms array<boolean>, outcomes array<string>")
    r = evidence.arm_counts(df, "arms", "outcomes", lambda x: x, lambda x: F.lit(2)).first()
    assert (r.arm_count, r.placebo_arm_count, r.outcome_count, r.hemo_outcome_count) == (2, 1, 2, 4)
    arms = evidence.arms_map(spark.createDataFrame([("a", "p"), ("a", "d")], "id string, label string"), "id", ["label"])
    more = spark.createDataFrame([("a", ["1", "2", "3"])], "id string, pmids array<string>")
    d = evidence.detail_view(df.select("id"), arms, more, "id", {"pmids": 2}).first()
    assert [x.label for x in d.arms] == ["d", "p"] and d.pmids == ["1", "2"]


def test_facets_do_not_depend_on_row_order(spark):
    rows = spark.createDataFrame([("a", 1, True, ["x", "y"]), ("a", 1, True, ["x"]), ("b", 2, None, []), (None, 3, False, None)], "k string, study int, flag boolean, tags array<string>")
    stats = lambda df: sorted(map(tuple, facets.facet_stats(df, {"k": F.coalesce("k", F.lit("none")), "tag": F.coalesce("tags", F.array().cast("array<string>"))}, "study", F.col("flag")).collect()))
    assert stats(rows) == stats(rows.orderBy(F.desc("study"))) == [("k", "a", 2, 1, 1), ("k", "b", 1, 1, 0), ("k", "none", 1, 1, 0), ("tag", "x", 2, 1, 1), ("tag", "y", 1, 1, 1)]
    assert facets.co_occurrence(rows.limit(0), "study", "k").collect() == []


def test_fuzzy_titles_are_symmetric(spark):
    a = spark.createDataFrame([(1, "Early goal directed therapy in septic shock"), (2, "Something else entirely here"), (3, None), (4, "")], "id int, title string")
    b = spark.createDataFrame([(10, "Early goal-directed therapy in septic shock"), (11, "early goal directed theraphy in septic shocks"), (12, None)], "id int, title string")
    one = resolve.fuzzy_title_matches(a, b, "id", "id", "title", "title").collect()
    assert [(r.left_id, r.right_id) for r in one] == [(1, 10)] and one[0].similarity > 0.95
    assert {r.right_id for r in resolve.fuzzy_title_matches(b, a, "id", "id", "title", "title").collect()} == {1}


def test_first_rows_and_samples(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, n int, v string")
    assert sorted(map(tuple, one_per_key(df, ["k"], F.col("n")).collect())) == [("a", 1, "y"), ("b", 3, None)]
    rows = spark.range(200).withColumn("c", F.when(F.col("id") < 3, "rare").otherwise("common"))
    picked = sampling.stratified_sample(rows, "c", "id", 10)
    assert picked.where("c = 'rare'").count() >= 2 and picked.count() == 10 and picked.collect() == sampling.stratified_sample(rows.repartition(5), "c", "id", 10).collect()


def test_records_and_files(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text(json.dumps({"id": "1", "n": 2}) + "\nbroken\n" + json.dumps({"n": 3}))
    assert [r.id for r in provenance.read_records(spark, str(tmp_path / "r"), "id string, n int", ["id"]).collect()] == ["1"]
    files = provenance.file_manifest(spark, str(tmp_path / "r")).collect()
    assert files[0].sha256 == hashlib.sha256((tmp_path / "r" / "a.json").read_bytes()).hexdigest()
    counts = spark.createDataFrame([("a", 2), ("b", 0)], "s string, n int")
    assert not quality.sources_active(counts, "s", "n", ["a", "b"]).first().passed and quality.sources_active(counts, "s", "n", ["a"]).first().passed
    assert quality.registry_diversity(counts).first().message == "registries: 2"
    record = spark.createDataFrame([("", {"a": "b"}, True)], "ontology_version string, input_hashes map<string,string>, parquet_written boolean")
    assert [r.passed for r in quality.provenance_checks(record).orderBy("rule_id").collect()] == [True, False, True]
