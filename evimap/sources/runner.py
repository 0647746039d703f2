"""Sources as plug-ins of the session, and the run that reads, stores and logs them phase by phase.

A source is a format of the session (``DocumentSource``, registered with
``spark.dataSource.register``, or any other that ``spark.read`` knows) that gives
documents, and a ``landing.Parser`` that names its phase, the unique keys of its
table and what a conflict does.  ``run`` goes through the phases in order: each
source is read and parsed, its rows are merged into its table by its own policy,
and what happened is logged.  A source that fails is logged with its error and
keeps its table; the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from evimap.operators.dedup import last_per_key
from evimap.operators.incremental import insert_ignore, inserted, upsert
from evimap.operators.provenance import table_hash
from evimap.sources import landing
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LOG = "run string, phase int, source string, status string, rows long, version long, error string, at timestamp"


class DocumentSource(DataSource):
    """A service as a format of the session: subclasses say what there is to fetch and fetch it, a piece a task.

    ``document`` is the schema of a document as DDL.  ``pieces`` lists the
    parts of a read (pages, id ranges; small), and ``fetch`` gives the documents
    of one of them as tuples.  Both see the ``options`` of the read.
    """

    document = ""

    def schema(self) -> str:
        return self.document

    def pieces(self) -> Sequence[object]:
        return [None]

    def fetch(self, piece: object) -> Iterator[tuple]:
        raise NotImplementedError

    def reader(self, schema) -> DataSourceReader:
        return _Pieces(self)


class _Pieces(DataSourceReader):
    def __init__(self, source: DocumentSource) -> None:
        self.source = source

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.source.pieces()]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.source.fetch(partition.value)


class Store:
    """Tables of the sources, each a folder of versions, with the log beside them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log")
        there = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root)
        return self.spark.read.schema(LOG).json(f"{self.path}/_log") if there else self.spark.createDataFrame([], LOG)

    def version(self, source: str) -> int:
        """Number of the last stored version, 0 without any."""
        return self.log().where(F.col("source") == source).agg(F.max("version")).first()[0] or 0

    def table(self, source: str) -> DataFrame | None:
        n = self.version(source)
        return self.spark.read.parquet(f"{self.path}/{source}/version={n}") if n else None


def merged(base: DataFrame | None, rows: DataFrame, parser: landing.Parser) -> DataFrame | None:
    """Rows put into the table by the parser's keys and policy; None if the policy ignores all of them."""
    unique = [list(k) for k in parser.unique]
    if parser.on_conflict == "ignore" and base is not None:
        new = inserted(base, rows, unique, [])
        return None if new.isEmpty() else base.unionByName(new.select([c for c in base.columns if c in new.columns]), allowMissingColumns=True)
    base = rows.limit(0) if base is None else base
    if parser.on_conflict == "ignore":
        return insert_ignore(base, rows, unique, [])
    if parser.on_conflict != "replace":
        raise ValueError(f"no such policy: {parser.on_conflict}")
    for keys in parser.unique:  # a row replaces those it conflicts with, of the table and of its own increment
        rows = last_per_key(rows, list(keys), *sorted(c for c in rows.columns if c not in keys))
    head, *others = unique
    for keys in others:
        base = base.join(rows.select(keys), keys, "left_anti").select(base.columns)
    return upsert(base, rows, head)


def run(spark: SparkSession, path: str, documents: Mapping[str, Callable[[], DataFrame]], name: str, parsers: Mapping[str, landing.Parser] | None = None) -> DataFrame:
    """Run all sources of ``documents`` once; returns the log rows of the run.

    Status is ok (rows were added or changed), unchanged or error.  ``rows`` is
    the size of the table after the run.
    """
    parsers, store = landing.PARSERS if parsers is None else parsers, Store(spark, path)
    for phase in sorted({parsers[s].phase for s in documents}):
        for source in sorted(s for s in documents if parsers[s].phase == phase):
            status, rows, version, error = "error", None, None, None
            try:
                before = store.table(source)
                table = merged(before, parsers[source].parse(documents[source]()), parsers[source])
                if table is None:  # nothing came: no version is written
                    status, rows = "unchanged", before.count()
                else:
                    number = store.version(source) + 1
                    table.write.mode("overwrite").parquet(f"{path}/{source}/version={number}")
                    after = spark.read.parquet(f"{path}/{source}/version={number}")
                    own = table_hash(after).first()
                    status, rows = ("unchanged" if before is not None and table_hash(before).first() == own else "ok"), own["rows"]
                    version = number if status == "ok" else None  # a version that no log row names is not there
            except PySparkException as failure:
                error = " ".join(str(failure).split())[:500]
            row = spark.range(1).select(F.lit(name).alias("run"), F.lit(phase).alias("phase"), F.lit(source).alias("source"), F.lit(status).alias("status"), F.lit(rows).cast("long").alias("rows"), F.lit(version).cast("long").alias("version"), F.lit(error).cast("string").alias("error"), F.current_timestamp().alias("at"))
            row.write.mode("append").json(f"{path}/_log")
    return store.log().where(F.col("run") == name)


def stored(store: Store, sources: Sequence[str]) -> DataFrame:
    """source, rows: sizes of the tables as they are."""
    each = [store.table(s).agg(F.count("*").alias("rows")).select(F.lit(s).alias("source"), "rows") for s in sources]
    return reduce(lambda a, b: a.unionByName(b), each)
