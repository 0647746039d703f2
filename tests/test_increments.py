import json
import random

import pytest

from evimap.operators import greedy, provenance, quality
from evimap.operators import incremental as I
from evimap.sources import files
from evimap.streaming import upserts
from pyspark.sql import functions as F

P = "nct_id string, title string, status string"
C = "nct_id string, drug string, dose string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, shape):
    return spark.createDataFrame(data, shape)


def test_parent_update_and_insert(spark):
    base = frame(spark, [("NCT001", "a", "Recruiting"), ("NCT002", "b", "Completed"), ("NCT003", "c", "Recruiting")], P)
    delta = frame(spark, [("NCT002", "b v2", "Active"), ("NCT004", "d", "New")], P)
    once = I.upsert(base, delta, ["nct_id"])
    want = [("NCT001", "a", "Recruiting"), ("NCT002", "b v2", "Active"), ("NCT003", "c", "Recruiting"), ("NCT004", "d", "New")]
    assert rows(once) == want and rows(I.upsert(once, delta, ["nct_id"])) == want
    assert rows(I.upsert(base.limit(0), delta, ["nct_id"])) == rows(delta)


def test_child_replace(spark):
    base = frame(spark, [("NCT001", "x", "1"), ("NCT002", "y", "1"), ("NCT002", "z", "1")], C)
    delta, parents = frame(spark, [("NCT002", "w", "9")], C), frame(spark, [("NCT002",)], "nct_id string")
    out = I.replace_children(base, delta, parents, "nct_id")
    assert rows(out) == [("NCT001", "x", "1"), ("NCT002", "w", "9")] == rows(I.replace_children(out, delta, parents, "nct_id"))


def test_missing_sides_blank_ids_and_schema(spark):
    base = frame(spark, [("NCT001", "a", "R")], P)
    assert I.upsert(base, None, ["nct_id"]) is base and I.upsert(None, base, ["nct_id"]) is base
    wide = frame(spark, [("NCT001", "val1")], "nct_id string, extra_col string")
    assert rows(I.upsert(wide, frame(spark, [("NCT002", "t", "s"), ("", "t", "s"), (None, "t", "s")], P), ["nct_id"])) == [("NCT001", "val1"), ("NCT002", None)]
    twice = frame(spark, [("NCT009", "t1", "1"), ("NCT009", "t2", "2")], P)
    assert rows(I.upsert(base, twice, ["nct_id"], ["status"])) == [("NCT001", "a", "R"), ("NCT009", "t2", "2")]


def test_insert_ignore_with_two_keys(spark):
    shape = "id string, pmid string, doi string, n int"
    base = frame(spark, [("1", "p1", "d1", 0)], shape)
    delta = frame(spark, [("1", "p1", "d9", 1), ("1", "p2", "d1", 2), ("1", "p3", None, 3), ("1", None, "d4", 4), ("1", "p3", "d5", 5), ("2", "p1", "d1", 6)], shape)
    want = [("1", "p1", "d1", 0), ("1", "p3", None, 3), ("1", None, "d4", 4), ("2", "p1", "d1", 6)]
    assert rows(I.insert_ignore(base, delta, [["id", "pmid"], ["id", "doi"]], ["n"])) == sorted(want, key=str)


def one_by_one(base, delta, unique):
    """Rows kept by insertion in order; keys are places in the tuples."""
    seen, out = [set(), set()], list(base)
    for r in base + delta:
        own = [tuple(r[i] for i in k) for k in unique]
        if r in base or not any(None not in v and v in s for v, s in zip(own, seen)):
            out += [] if r in base else [r]
            for v, s in zip(own, seen):
                s.add(v)
    return sorted(out, key=str)


@pytest.mark.parametrize("n, values", [(10_000, 2500), (10_000, 40), (400, 30)])
def test_insert_ignore_is_that_of_a_loop(spark, n, values):
    rng = random.Random(n + values)
    pick = lambda: None if rng.random() < 0.1 else f"v{min(rng.randrange(values), rng.randrange(values))}"
    base = [("1", pick(), pick(), -1 - i) for i in range(20)]
    delta = [(str(rng.randrange(2)), pick(), pick(), i) for i in range(n)] + [("1", None, None, n), ("1", None, None, n + 1)]
    shape = "id string, pmid string, doi string, n int"
    got = I.insert_ignore(frame(spark, base, shape), frame(spark, rng.sample(delta, len(delta)), shape).repartition(5), [["id", "pmid"], ["id", "doi"]], ["n"])
    assert rows(got) == one_by_one(base, delta, [(0, 1), (0, 2)])


def test_insert_ignore_crosswise(spark):
    shape = "id string, pmid string, doi string, n int"
    base, delta = [("1", "p1", "d1", 0)], [("1", "p3", "d1", 1), ("1", "p3", "d5", 2)]
    keys = [["id", "pmid"], ["id", "doi"]]
    assert rows(I.insert_ignore(frame(spark, base, shape), frame(spark, delta, shape), keys, ["n"])) == [base[0], delta[1]]
    # rows that repeat whole, and an empty side
    assert rows(I.insert_ignore(frame(spark, [], shape), frame(spark, delta[:1] * 3, shape), keys, ["n"])) == delta[:1]
    assert rows(I.insert_ignore(frame(spark, base, shape), frame(spark, [], shape), keys, ["n"])) == base


def test_links_are_decided_as_by_a_loop(spark):
    rng = random.Random(4)
    pairs = {tuple(sorted(rng.sample(range(600), 2), reverse=True)) for _ in range(1500)} | {(i + 1, i) for i in range(700, 730)}
    stays: dict = {}
    for node in sorted({x for p in pairs for x in p}):
        stays[node] = not any(stays.get(e) for later, e in pairs if later == node)
    got = greedy.first_by_links(frame(spark, sorted(pairs), "later long, earlier long")).collect()
    assert len(got) == len(stays) and {r.node: r.stays for r in got} == stays
    assert greedy.first_by_links(frame(spark, [], "later long, earlier long")).collect() == []


def test_retention_keeps_the_newest(spark):
    log = frame(spark, [("a", i) for i in range(15)] + [("b", 1)], "label string, n int")
    assert rows(I.newest(log, ["label"], 10, F.desc("n")).select("label", "n")) == sorted([("a", i) for i in range(5, 15)] + [("b", 1)], key=str)


@pytest.mark.parametrize("replay", [False, True])
def test_stream_of_increments(spark, tmp_path, replay):
    land, table, shape = tmp_path / "land", str(tmp_path / "table"), "nct_id string, title string, seq long"
    land.mkdir()
    for i, docs in enumerate([[("NCT001", "a", 1), ("NCT002", "b", 1)], [("NCT002", "b2", 2), ("NCT003", "c", 2)]]):
        (land / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("nct_id", "title", "seq"), x))) for x in docs))
        for _ in range(1 + replay):
            upserts.merge_stream(upserts.landed(spark, str(land), shape), table, shape, ["nct_id"], ["seq"], str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(upserts.current(spark, table, shape)) == [("NCT001", "a", 1), ("NCT002", "b2", 2), ("NCT003", "c", 2)]


def size_of(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_buckets_split_as_the_table_grows(spark, tmp_path):
    """A batch rewrites a bounded share of the files while the table grows to ten times its size, and the table stays that of a plain upsert."""
    table, shape, most, rng = tmp_path / "t", "id long, body string, seq long", 200, random.Random(1)
    want, written = {}, []
    def land(number, keys):
        batch = [(k, f"{number}-{k}-" + "x" * 40, number) for k in keys]
        upserts.merge(frame(spark, batch, shape), number, str(table), shape, ["id"], ["seq"], most)
        want.update({r[0]: r for r in batch})
    land(0, range(300))
    for n in range(1, 10):
        land(2 * n - 1, range(300 * n, 300 * (n + 1)))
        land(2 * n, rng.sample(range(300 * n), 2))
        written.append(size_of(table / f"version={2 * n}"))
    entries = upserts.directory(spark, str(table))
    assert len(entries) > 15 and all(rows <= most for _, _, rows in entries) and sum(rows for _, _, rows in entries) == 3000
    prefixes = [b for b, _, _ in entries]
    assert sum(2.0 ** -len(p) for p in prefixes) == 1.0  # they cover every hash once
    assert max(written[4:]) <= 2 * max(written[:2])
    assert rows(upserts.current(spark, str(table), shape)) == sorted(want.values(), key=str)
    # a batch that runs again changes nothing, an older state can still be read, and old files go
    upserts.merge(frame(spark, [(5, "again", 30)], shape), 30, str(table), shape, ["id"], ["seq"], most)
    once = rows(upserts.current(spark, str(table), shape))
    upserts.merge(frame(spark, [(5, "again", 30)], shape), 30, str(table), shape, ["id"], ["seq"], most)
    assert rows(upserts.current(spark, str(table), shape)) == once
    assert rows(upserts.current(spark, str(table), shape, before=30)) == sorted(want.values(), key=str)
    assert rows(upserts.lookup(spark, str(table), shape, ["id"], frame(spark, [(5,), (77777,)], "id long"))) == [(5, "again", 30)]
    before = size_of(table)
    assert upserts.vacuum(spark, str(table)) > 10 and size_of(table) < before / 2 and rows(upserts.current(spark, str(table), shape)) == once
    assert rows(upserts.current(spark, str(tmp_path / "none"), shape)) == []


def test_badges_and_changes(spark):
    runs = frame(spark, [("a", 1, 0, 0, 100), ("a", 2, 0, 0, 104), ("a", 3, 0, 0, 104), ("a", 4, 1, 0, 200), ("a", 5, 0, 1, 200)], "label string, n int, failed int, major int, studies int")
    assert [r.badge for r in provenance.badges(runs, "label", "n", "failed", "major").orderBy("n").collect()] == ["silver", "silver", "gold", "bronze", "silver"]
    assert [r.severity for r in provenance.changes(runs, "label", "n", ["studies"]).orderBy("n").collect()] == ["none", "none", "none", "major", "none"]


def test_quality_rows(spark):
    assert quality.schema_check(spark.range(1), "schema", ["id", "x"]).first().message == "missing columns: x"
    facts = frame(spark, [(10, 9, 61.0, 2, 1, 3)], "trials int, enriched int, age_days double, sources int, hashes int, tables int")
    assert {r.rule_id: r.passed for r in quality.enrichment_checks(facts).collect()} == {"enrichment_coverage": True, "enrichment_staleness": False, "enrichment_sources": False, "enrichment_store": True, "source_hashes": True}
    a, b = frame(spark, [("x",), ("y",)], "k string"), frame(spark, [("x",), ("z",)], "k string")
    assert not quality.expected_categories(a, b, "k").first().passed and quality.reference_recall(a, b, "k").first().passed


@pytest.mark.parametrize("size", [0, 200])
def test_facts_gathered_with_the_write(spark, tmp_path, size):
    """The facts that the write gives back, and their rules, are those of a pass over the written map."""
    rng = random.Random(5)
    data = [(rng.choice(["s1", "s2", "bad", None]), rng.choice(["x", "Unmapped", "adj", None]), rng.choice(["mg", " ", None])) for _ in range(size)]
    wide = frame(spark, data, "nct_id string, category string, unit string").repartition(3)
    ok = F.col("nct_id").startswith("s")
    facts = files.write_map(wide, str(tmp_path / "map"), "broad", quality.row_facts("category", "unit", ok, ["adj"]))
    back = files.read_map(spark, str(tmp_path / "map"), "broad") if size else wide
    studies = frame(spark, [], "nct_id string, n string, kind string")
    plain = quality.map_facts(back.drop("label"), studies, "nct_id", "category", "unit", F.lit(True), ok, ["adj"], "n", "kind")
    want = plain.first().asDict()
    assert facts == {k: want[k] for k in facts} and facts["mentions"] == size
    assert rows(quality.row_checks(spark, facts)) == rows(quality.run_checks(plain, quality.map_checks()).where(F.col("rule_id").isin(*quality.ROW_RULES)))
    assert files.write_map(wide, str(tmp_path / "map"), "narrow") == {}


def test_table_hash_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert provenance.table_hash(df).first() == provenance.table_hash(df.orderBy(F.desc("id")).repartition(3)).first() != provenance.table_hash(df.limit(99)).first()
    assert provenance.rule_version([("a", ["b"])]) != provenance.rule_version([("a", ["c"])])
