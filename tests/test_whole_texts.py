from evimap.operators import resolve
from evimap.plans import queries


def test_living_map_reads_whole_documents(spark, tmp_path):
    text = "Mean arterial pressure. " + "word " * 300 + "in mmHg at rest"
    spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["living_map"](spark, str(tmp_path)).collect()
    assert rows and {(r.unit_raw, r.normalized_unit, r.measure, r.matched_text) for r in rows} == {("mmhg", "mmHg", text[:200], text[:500])}
    assert "whole_text" not in rows[0].asDict()


def test_nearest_titles_of_every_left_row(spark):
    a = spark.createDataFrame([(1, "Early goal directed therapy"), (2, "early  goal directed THERAPY"), (3, "nothing alike")], "id int, title string")
    b = spark.createDataFrame([(10, "Early goal directed therapies"), (11, "Late goal")], "id int, title string")
    got = resolve.nearest_titles(a, b, "id", "id", "title", "title").collect()
    assert sorted((r.left_id, r.right_id) for r in got) == [(1, 10), (2, 10)]
