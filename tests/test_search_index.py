"""Searches through the index against the same searches by scan."""

import random
import re

import pyarrow as pa
from evimap.operators import explore, search_index
from pyspark.sql import functions as F

SHAPE = "id long, title string, drug string, year string, placebo boolean"


def test_same_as_a_scan(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: rng.choice(["Vasopressin", "noradrenaline", "shock", "MAP < 65", "überlebt", "日本語の題", "a b", "xy", ""])
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 4))) if i % 11 else None, word(), f"20{rng.randrange(10, 26)}", rng.random() < 0.5) for i in range(900)]
    rows += [(i, "needle in bucket", "rare", "1999", True) for i in (5000, 5001)]
    df = spark.createDataFrame(rows, SHAPE).repartitionByRange(9, "id")
    path, both = str(tmp_path / "index"), ["title", "drug"]
    search_index.build(df, {"title": F.col("title"), "drug": F.col("drug"), "all": F.concat_ws(" ", *both)}, path)
    index = search_index.Index(spark, path)
    ids = lambda x: sorted(r.id for r in x.collect())
    for q in ("vasopressin", "drug:SHOCK", "drug:xy", "title:map < 6", "year:>2015", "year:2012", "year:x", "placebo:yes", "日本語", "überlebt a", "x", "", "needle", "no such", "drug:", "k vaso"):
        want = df.where(explore.search(q, {"drug": "drug", "title": "title"}, both, "year", F.col("placebo")))
        assert ids(index.search(q, {"drug": "drug", "title": "title"}, ("all", both), "year", F.col("placebo"))) == ids(want), q
    for state in (explore.FilterState(contains={"title|drug": "Shock", "title": "Vaso"}, flags={"placebo": True}), explore.FilterState(contains={"title|drug": "xy", "drug": "noradr"}, equals={"year": "2015"}), explore.FilterState(equals={"drug": "shock"})):
        assert ids(index.filtered(state)) == ids(df.where(state.condition()))
    # the two rows of a rare word: one bucket is read, and only these rows leave it
    hits = index.candidates([[("title", "needle")]])
    assert ids(hits) == [5000, 5001]
    plan = hits._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(_bucket#\d+L? = \d+\)|PartitionFilters: \[[^\]]*_bucket#\d+L? IN \(\d+\)", plan) and df.rdd.getNumPartitions() == 9
    search_index.build(df.limit(0), {"title": F.col("title")}, str(tmp_path / "none"))
    assert search_index.Index(spark, str(tmp_path / "none")).filtered(explore.FilterState(contains={"title": "shock"})).collect() == []


def test_bitmaps_of_a_batch_without_a_row_for_each_trigram(monkeypatch):
    monkeypatch.setattr(search_index, "GRAMS", 3)
    monkeypatch.setattr(search_index, "PIECE", 200)
    rng, rows = random.Random(4), []
    for i in range(400):
        rows.append((i // 150, i % 150 * 217 % 32768, "".join(rng.choice("aab 語é😀") for _ in range(rng.randint(0, 9))), rng.choice(["brand#1", "brand#2", "", "xy"])))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows])], ["bucket", "_place", "t0", "t1"])
    got, want = {}, {}
    for out in search_index.partial_postings(["x", "y"])(iter([batch, batch.slice(0, 0)])):
        for r in out.to_pylist():
            places = {8 * i + k for i, byte in enumerate(r["bits"]) for k in range(8) if byte >> k & 1}
            got.setdefault((r["text"], r["gram"], r["bucket"]), set()).update(places)
            assert places and len(r["bits"]) == 4096
    for b, place, *texts in rows:
        for name, t in zip("xy", texts):
            for j in range(len(t) - 2):
                want.setdefault((name, t[j : j + 3], b), set()).add(place)
    assert got == want and len({k[2] for k in got}) == 3
