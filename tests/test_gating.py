"""The gate of the fetch cycle: its stream, stopped and started again, against the batch rule and a plain loop."""

import datetime as dt
import random

from evimap.operators import enrich
from evimap.streaming import gating
from pyspark.sql import functions as F

SHAPE = "study string, source string, at timestamp, status string, asks boolean"
DAY = dt.timedelta(days=1)
UTC = dt.timezone.utc


def land(spark, folder, number, rows):
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.parquet(f"{folder}/{number}")


def run(spark, land_at, own, clock):
    rows = spark.readStream.schema(SHAPE).parquet(f"{land_at}/*")
    query = gating.start(gating.changes(rows, ["study", "source"], "at", "status", "asks", 2.0, clock=clock), own, clock)
    query.awaitTermination()
    return spark.read.schema("study string, source string, number long, due boolean, since long").parquet(f"{own}/changes")


def due(rows, now, limit=2 * DAY):
    asked = {r[:2] for r in rows if r[4] and None not in r[:2]}
    fresh = {r[:2] for r in rows if r[3] in ("ok", "empty") and now - r[2] <= limit}
    return asked - fresh


def random_rows(rng, n, start, days):
    kinds = [("ok", False), ("empty", False), ("error", False), (None, True), (None, True), ("ok", True), (None, False)]
    return [(rng.choice(["a", "b", "c", "d", "e", "f", None]), rng.choice("xyz"), start + DAY * rng.uniform(0, days), *rng.choice(kinds)) for _ in range(n)]


def test_event_clock_with_restarts(spark, tmp_path):
    rng = random.Random(7)
    rows = sorted(random_rows(rng, 240, dt.datetime(2024, 1, 1), 20), key=lambda r: r[2])
    rows[-1] = ("a", "x", rows[-1][2], "error", False)
    sent = None
    for i in range(3):
        land(spark, tmp_path / "land", i, rows[80 * i : 80 * (i + 1)])
        sent = run(spark, tmp_path / "land", str(tmp_path / "own"), "at")
        seen = rows[: 80 * (i + 1)]
        now = max(r[2] for r in seen if None not in r[:2])
        assert {tuple(r)[:2] for r in gating.work_list(sent, ["study", "source"]).collect()} == due(seen, now.replace(microsecond=now.microsecond // 1000 * 1000))
    # started again without anything new, nothing goes out twice
    changes = [tuple(r) for r in sent.collect()]
    again = [tuple(r) for r in run(spark, tmp_path / "land", str(tmp_path / "own"), "at").collect()]
    assert sorted(changes) == sorted(again) and len({c[:3] for c in changes}) == len(changes) > 20
    # each key's changes take turns, from due on, numbered without gaps
    for key in {c[:2] for c in changes}:
        mine = sorted(c[2:4] for c in changes if c[:2] == key)
        assert mine == [(n + 1, n % 2 == 0) for n in range(len(mine))]
    # since: the end of the newest good fetch, or the first request
    for r in gating.work_list(sent, ["study", "source"]).collect():
        ms = lambda x: (x - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
        good = [ms(x[2]) for x in rows if x[:2] == (r.study, r.source) and x[3] in ("ok", "empty")]
        asked = min(ms(x[2]) for x in rows if x[:2] == (r.study, r.source) and x[4])
        assert r.since == (max(asked, max(good) + 2 * 86_400_000) if good else asked)


def test_time_of_day_in_any_order(spark, tmp_path):
    """Rows older than ones seen before count in full, and the batch rule says the same."""
    rng = random.Random(3)
    start = dt.datetime.now(UTC).replace(tzinfo=None) - 6 * DAY
    rows = random_rows(rng, 60, start, 5.9)
    land(spark, tmp_path / "land", 0, rows[:30])
    run(spark, tmp_path / "land", str(tmp_path / "own"), None)
    land(spark, tmp_path / "land", 1, rows[30:])
    sent = run(spark, tmp_path / "land", str(tmp_path / "own"), None)
    got = {tuple(r)[:2] for r in gating.work_list(sent, ["study", "source"]).collect()}
    log = spark.createDataFrame(rows, SHAPE)
    want = enrich.needs_refetch(log.where("asks and study is not null").select("study", "source").distinct(), log, ["study", "source"], "at", "status", F.current_timestamp(), 2.0)
    assert got == {tuple(r) for r in want.collect()} == due(rows, dt.datetime.now(UTC).replace(tzinfo=None)) and got


def test_batch_rule(spark):
    """A failed fetch does not undo a good one; a fetch of just the limit's age is fresh."""
    t = lambda h, us=0: dt.datetime(2024, 1, 10, 12) - dt.timedelta(hours=h) + dt.timedelta(microseconds=us)
    log = spark.createDataFrame([("a", t(5), "ok"), ("a", t(1), "error"), ("b", t(48), "empty"), ("c", t(48, -1), "ok"), ("d", t(1), "error")], "k string, at timestamp, status string")
    work = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "k string")
    got = enrich.needs_refetch(work, log, ["k"], "at", "status", F.lit(t(0)), 2.0)
    assert sorted(r.k for r in got.collect()) == ["c", "d", "e"]
