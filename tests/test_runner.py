"""A source of the session read, stored by its policy and logged; a second run changes nothing."""

from evimap.operators import incremental
from evimap.sources import landing, runner
from pyspark.sql import functions as F

SHAPE = "nct_id string, resultList struct<result: array<struct<pmid: string, pmcid: string, doi: string, title: string, journalTitle: string, firstPublicationDate: string, pubType: string>>>"


def papers(shape=SHAPE):
    """The class goes to the tasks by value, as one of a notebook does."""

    class Papers(runner.DocumentSource):
        document = shape

        @classmethod
        def name(cls):
            return "papers"

        def pieces(self):
            return list(range(int(self.options["pages"])))

        def fetch(self, page):
            if page == int(self.options.get("broken", "-1")):
                raise RuntimeError("service is down")
            for i in range(5 * page, 5 * page + 5):
                one = lambda pmid, doi: (pmid, None, doi, f"t{i}", "j", "2020", "article")
                yield (f"NCT{i:08d}", ([one(f"p{i}", f"d{i}"), one(f"p{i}x", f"d{i}"), one(f"p{i}x", f"e{i}")],))

    return Papers


def test_source_is_read_stored_and_logged(spark, tmp_path):
    spark.dataSource.register(papers())
    path, pages = str(tmp_path / "store"), lambda n, **more: (lambda: spark.read.format("papers").options(pages=n, **more).load())
    assert pages(4)().rdd.getNumPartitions() == 4
    alex = spark.createDataFrame([(["https://doi.org/d1"],)], "d array<string>").select(F.transform("d", lambda x: F.struct(x.alias("doi"), F.lit(3).alias("cited_by_count"), F.lit(1).alias("referenced_works_count"))).alias("results"))
    log = runner.run(spark, path, {"openalex": lambda: alex, "europmc": pages(2)}, "one")
    assert [(r.phase, r.source, r.status, r.rows, r.version) for r in log.orderBy("at").collect()] == [(1, "europmc", "ok", 20, 1), (2, "openalex", "ok", 1, 1)]
    # each study has its first paper, and the one that the first only keeps from its second key
    store = runner.Store(spark, path)
    assert sorted((r.pmid, r.doi) for r in store.table("europmc").where("nct_id = 'NCT00000003'").collect()) == [("p3", "d3"), ("p3x", "e3")]
    again = runner.run(spark, path, {"openalex": lambda: alex, "europmc": pages(2)}, "two").collect()
    assert {r.status for r in again} == {"unchanged"} and store.version("europmc") == store.version("openalex") == 1
    # more pages add rows, newer counts replace, and a service that fails keeps its table while the others go on
    more = alex.withColumn("results", F.transform("results", lambda x: x.withField("cited_by_count", F.lit(9))))
    log = {r.source: r for r in runner.run(spark, path, {"openalex": lambda: more, "europmc": pages(3, broken=2)}, "three").collect()}
    assert log["europmc"].status == "error" and log["europmc"].error and log["openalex"].status == "ok" and store.table("europmc").count() == 20
    assert [r.cited_by_count for r in store.table("openalex").collect()] == [9]
    assert runner.run(spark, path, {"europmc": pages(3)}, "four").first().rows == 30
    assert {r.source: r["rows"] for r in runner.stored(store, ["europmc", "openalex"]).collect()} == {"europmc": 30, "openalex": 1}


def test_registered_parser(spark, tmp_path):
    own = landing.Parser(1, lambda docs: docs.select("k", "v"), (("k",),), "replace")
    landing.register("own", own)
    try:
        rows = [(1, "a"), (2, "b"), (1, "c")]
        log = runner.run(spark, str(tmp_path / "s"), {"own": lambda: spark.createDataFrame(rows, "k int, v string")}, "r").first()
        assert (log.status, log.rows) == ("ok", 2)
        assert sorted(map(tuple, runner.Store(spark, str(tmp_path / "s")).table("own").collect())) == [(1, "c"), (2, "b")]
    finally:
        del landing.PARSERS["own"]


def test_only_rows_that_meet_are_put_in_order_and_nothing_new_writes_nothing(spark, tmp_path, monkeypatch):
    shape, sizes, placed = "id string, v string", [], incremental.placed
    monkeypatch.setattr(incremental, "placed", lambda rows, *more: sizes.append(rows.count()) or placed(rows, *more))
    landing.register("own", landing.Parser(1, lambda docs: docs, (("id",), ("v",)), "ignore"))
    try:
        rows = [(f"k{i}", f"v{i}") for i in range(50)] + [("k1", "w"), ("x", "v2"), (None, "v3"), (None, None), (None, None)]
        run = lambda more, name: runner.run(spark, str(tmp_path), {"own": lambda: spark.createDataFrame(rows + more, shape).repartition(3)}, name).first()
        assert (run([], "one").rows, sizes) == (52, [6])
        assert (run([], "two").status, (tmp_path / "own" / "version=2").exists()) == ("ok", True)  # rows without keys never collide
        rows = [r for r in rows if any(r)]
        assert (run([], "three").status, (tmp_path / "own" / "version=3").exists()) == ("unchanged", False)
        assert [(r.status, r.rows, r.version) for r in [run([("new", "v1"), ("new", "new")], "four")]] == [("ok", 55, 3)]
    finally:
        del landing.PARSERS["own"]
