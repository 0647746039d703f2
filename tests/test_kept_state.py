"""State that is carried instead of computed again: facet counts, hash trees, exact quantiles, hashes of large files."""

import hashlib
import math
import random

import numpy as np
import pytest

from evimap.operators import facets, provenance, quality
from pyspark.sql import functions as F

SHAPE = "id long, study string, value string, tags array<string>, flag boolean"


def test_facets_after_ten_increments(spark):
    rng = random.Random(3)
    draw = lambda i: (i, rng.choice(["s1", "s2", "s3", "s4", None]), rng.choice("abc") if rng.random() > 0.1 else None, [rng.choice("xyz") for _ in range(rng.randint(0, 3))], rng.choice([True, False, None]))
    rows = {i: draw(i) for i in range(200)}
    frame = lambda x: spark.createDataFrame(list(x), SHAPE)
    by = ({"value": F.col("value"), "tags": F.col("tags")}, "study", F.col("flag"))
    state = spark.createDataFrame(facets.facet_state(frame(rows.values()), *by).collect(), "facet string, value string, study string, n long, flagged long")
    stats = spark.createDataFrame(facets.state_stats(state).collect(), "facet string, value string, mention_count long, study_count long, placebo_study_count long")
    for _ in range(10):
        gone, came = rng.sample(sorted(rows), 30), [draw(rng.randrange(260)) for _ in range(25)]
        came = list({r[0]: r for r in came}.values())
        old = [rows[i] for i in {*gone, *(r[0] for r in came)} if i in rows]
        for i in gone:
            rows.pop(i)
        rows |= {r[0]: r for r in came}
        changes = facets.state_changes(frame(old), frame(came), *by)
        state = spark.createDataFrame(facets.added(state, changes).collect(), state.schema)
        stats = spark.createDataFrame(facets.touched_stats(stats, changes, state).collect(), stats.schema)
    plain = lambda df: sorted(map(tuple, df.select(stats.columns).collect()), key=str)
    assert plain(stats) == plain(facets.facet_stats(frame(rows.values()), *by))
    empty = facets.added(state, facets.state_changes(frame(rows.values()), frame([]), *by))
    assert empty.collect() == []


def test_rules_from_the_state_are_those_from_the_map(spark):
    rng = random.Random(7)
    rows = [(f"N{rng.randrange(40)}" if rng.random() > 0.05 else None, rng.choice(["MAP", "Unmapped", "Adjunct"]), rng.choice(["mmHg", "", None, " "]), rng.choice([True, False, None]), rng.choice(["x", None])) for _ in range(500)]
    wide = spark.createDataFrame(rows, "nct_id string, cat string, unit string, flag boolean, none string")
    studies = spark.createDataFrame([("N1", "60000", "ACTUAL"), ("N2", "0", "actual"), ("N3", "x", None)], "nct_id string, n string, t string")
    ok, flag = F.coalesce(F.col("nct_id") != "N7", F.lit(True)), F.col("flag")
    names = {"cat": F.col("cat"), "unit": F.col("unit"), "none": F.col("none")}
    for df in (wide, wide.limit(0)):
        want = quality.map_facts(df, studies, "nct_id", "cat", "unit", flag, ok, ["Adjunct"], "n", "t", {"s1": "unit", "s2": "none"}).first().asDict()
        got = quality.state_facts(facets.facet_state(df, names, "nct_id", flag), studies, "nct_id", "cat", "unit", ok, ["Adjunct"], "n", "t", ["unit", "none"]).first().asDict()
        assert got == {k: v for k, v in want.items() if k in got} and {"categories", "bad_ids", "empty_sections", "implausible", "core_studies"} <= set(got)


@pytest.mark.parametrize("kind", ["doubles", "skewed", "equal", "two", "tiny", "edges", "few"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(5)
    v = {
        "doubles": rng.standard_normal(5000), "skewed": np.exp(40 * rng.standard_normal(5000)), "equal": np.array([3.5] * 4000 + [1.0] * 20 + [9.25] * 30), "two": np.array([1.0, 2.0]),
        "tiny": np.array([0.0, 5e-324, 1e-323] * 900), "edges": np.concatenate([rng.standard_normal(2000), [math.inf] * 1500, [-math.inf] * 900, [1.7e308, -1.7e308] * 30]), "few": np.array([7.0]),
    }[kind]
    df = spark.createDataFrame([(float(x),) for x in rng.permutation(v)] + [(None,)], "v double").repartition(4)
    at = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = df.agg(F.percentile("v", F.array(*map(F.lit, at)))).first()[0]
    for cells, few in ((1024, 1024), (4, 3)):
        got = facets.exact_quantiles(df, "v", at, cells, few)
        assert all(g == w or math.isnan(g) and math.isnan(w) or abs(g - w) <= 1e-12 * abs(w) for g, w in zip(got, want)), (got, want)
    assert facets.exact_quantiles(df.limit(0), "v", [0.5]) == [None]
    assert math.isnan(facets.exact_quantiles(spark.createDataFrame([(math.nan,), (1.0,)], "v double"), "v", [1.0])[0])


def test_hash_tree_traces_changes(spark):
    old = spark.range(3000).select("id", (F.col("id") % 7).cast("string").alias("a"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("b"))
    assert sorted(map(tuple, provenance.hash_tree(old, ["id"]).collect())) == sorted(map(tuple, provenance.hash_tree(old.repartition(7), ["id"]).collect()))
    assert provenance.changed_nodes(provenance.hash_tree(old, ["id"]), provenance.hash_tree(old.sort("a"), ["id"])).collect() == []
    new = old.withColumn("a", F.when(F.col("id") == 1234, "x").otherwise(F.col("a")))
    found = provenance.changed_nodes(provenance.hash_tree(old, ["id"]), provenance.hash_tree(new, ["id"])).orderBy("level").collect()
    leaf = hashlib.md5(b"=1234").hexdigest()[:3]
    assert [(r.level, r.node) for r in found] == [(i, leaf[:i]) for i in range(4)] and found[0].old_rows == found[0].new_rows == 3000
    assert sorted((r.id, r.a, r.side) for r in provenance.changed_rows(old, new, ["id"]).collect()) == [(1234, "2", "old"), (1234, "x", "new")]
    # a null is not an empty text, a row twice is not the row once, and one side may be empty
    twice = old.unionByName(old.where("id = 5"))
    assert [tuple(r) for r in provenance.changed_rows(old, twice, ["id"]).select("id", "side").collect()] == [(5, "new")]
    other = old.withColumn("a", F.when(F.col("id") == 9, None).otherwise(F.col("a")))
    assert {r.id for r in provenance.changed_rows(old, other, ["id"]).collect()} == {9}
    assert provenance.changed_rows(old.limit(0), old.limit(20), ["id"]).count() == 20


def test_hashes_of_large_files(spark, tmp_path):
    (tmp_path / "a b%20c.bin").write_bytes(b"x" * 3_000_000 + b"end")
    with open(tmp_path / "three.bin", "wb") as f:
        f.truncate(3 << 30)  # sparse: no disk is used
    want = {}
    for p in tmp_path.iterdir():
        with open(p, "rb") as f:
            want[p.name] = hashlib.file_digest(f, "sha256").hexdigest()
    for largest in (1 << 28, 1000):
        got = {r.path.rsplit("/", 1)[1]: (r.sha256, r.bytes) for r in provenance.file_manifest(spark, str(tmp_path), largest=largest).collect()}
        assert {k: v for k, (v, _) in got.items()} == want and got["three.bin"][1] == 3 << 30
