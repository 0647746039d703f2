"""Text search over stored rows through trigram postings, so that a search reads the files that can hold a hit.

Rows are written in buckets of at most ``BUCKET`` rows, and each has a place in
its bucket.  For every indexed text and trigram the index has one bitmap of places for
each bucket that has it, sorted by trigram, so a search reads few row groups
of postings.  A condition becomes bitmaps: all trigrams of a value (and),
any of several texts (or), all conditions of a filter (and); buckets without a
bit left are not read, rows without a bit are dropped, and the exact condition is
tested on what remains.  Values of fewer than three characters and conditions
that are not on indexed texts restrict nothing here; they are tested only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from evimap.operators.explore import FilterState, search
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_POSTINGS = "text string, gram string, bucket long, bits binary"
#: Rows of a bucket: the bits of one bitmap.
BUCKET = 32768
#: Bitmaps that a task makes at a time (4 MB).
GRAMS = 1024
#: Bytes of texts that a task looks at together.
PIECE = 1 << 20


def partial_postings(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bitmaps of the rows of a batch (bucket, place, texts in lower case) by text, trigram and bucket.

    Trigrams are taken once from each distinct text of a batch, and bits are set
    in place: no row is made for a trigram of a row, and none is sorted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, places = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for bucket in np.unique(buckets):
                at = np.flatnonzero(buckets == bucket)
                for i, name in enumerate(names):
                    column = batch.column(2 + i).take(pa.array(at))
                    cuts = np.flatnonzero(np.diff(np.cumsum(pc.binary_length(column).to_numpy().astype(np.int64)) // PIECE)) + 1
                    for a, b in zip([0, *cuts], [*cuts, len(at)]):
                        coded = column.slice(a, b - a).dictionary_encode()
                        number: dict[str, int] = {}
                        own = [[number.setdefault(g, len(number)) for g in {t[j : j + 3] for j in range(len(t) - 2)}] for t in coded.dictionary.to_pylist()]
                        yield from _bitmaps(name, int(bucket), own, list(number), coded.indices.to_numpy(), places[at[a:b]])

    return run


def _bitmaps(name: str, bucket: int, own: list[list[int]], grams: list[str], codes: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each trigram, so many at a time; ``own`` are the trigrams (by number) of each text, ``codes`` the text of each place."""
    size = np.array([len(x) for x in own], np.int64)
    flat, first, n = np.array([g for x in own for g in x], np.int64), np.cumsum(size) - size, size[codes]
    end = np.cumsum(n)
    which = flat[np.arange(n.sum()) - np.repeat(end - n - first[codes], n)]
    place = np.repeat(places, n)
    order = np.argsort(which, kind="stable")
    which, place = which[order], place[order]
    for lo in range(0, len(grams), GRAMS):
        a, b = np.searchsorted(which, [lo, lo + GRAMS])
        bits = np.zeros((min(GRAMS, len(grams) - lo), BUCKET // 8), np.uint8)
        np.bitwise_or.at(bits, (which[a:b] - lo, place[a:b] >> 3), np.left_shift(1, place[a:b] & 7).astype(np.uint8))
        k = len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * k), pa.array(grams[lo : lo + k]), pa.array(np.full(k, bucket, np.int64)), pa.array([x.tobytes() for x in bits], pa.binary())],
            ["text", "gram", "bucket", "bits"],
        )


def build(rows: DataFrame, texts: Mapping[str, Column], path: str) -> None:
    """Write rows and postings; ``texts`` names the texts to index (columns, or several of them as one)."""
    spark, number = rows.sparkSession, F.monotonically_increasing_id()
    at = rows.withColumn("_n", number)  # partition in the high bits, place in the partition in the low 33
    place = F.col("_n").bitwiseAND((1 << 33) - 1)
    bucket = F.shiftright("_n", 33) * (1 << 18) + F.floor(place / BUCKET)
    at = at.withColumns({"_place": (place % BUCKET).cast("int"), "_bucket": bucket}).drop("_n")
    at.write.partitionBy("_bucket").parquet(f"{path}/rows")
    spark.range(1).select(F.lit(at.schema.json())).write.text(f"{path}/schema")  # an empty table has no file to tell it
    # postings come from the rows as written, whose places stay
    own = spark.read.schema(at.schema).parquet(f"{path}/rows")
    named = lambda name: lambda g: F.struct(F.lit(name).alias("text"), g.alias("gram"))
    texts = {name: F.lower(F.coalesce(c.cast("string"), F.lit(""))) for name, c in texts.items()}
    each = own.select(F.col("_bucket").cast("long").alias("bucket"), "_place", *(c.alias(f"t{i}") for i, c in enumerate(texts.values()))).mapInArrow(partial_postings(list(texts)), _POSTINGS)
    posted = each.groupBy("text", "gram", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    posted.repartitionByRange("text", "gram", "bucket").sortWithinPartitions("text", "gram", "bucket").write.parquet(f"{path}/postings")


class Index:
    """A stored index."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first().value))
        self.rows, self.postings = spark.read.schema(schema).parquet(f"{path}/rows"), spark.read.schema(_POSTINGS).parquet(f"{path}/postings")

    def places(self, text: str, value: str) -> DataFrame | None:
        """bucket, bits of the rows whose text has all trigrams of the value; None if it has none."""
        low = value.lower()
        wanted = sorted({low[i : i + 3] for i in range(len(low) - 2)})
        if not wanted:
            return None
        own = self.postings.where((F.col("text") == text) & F.col("gram").isin(wanted))
        return own.groupBy("bucket").agg(F.count("*").alias("n"), F.expr("bitmap_and_agg(bits)").alias("bits")).where(F.col("n") == len(wanted)).select("bucket", "bits")

    def candidates(self, conditions: Sequence[Sequence[tuple[str, str]]]) -> DataFrame:
        """Rows that can meet all conditions, each a choice of (text, value)."""
        found = []
        for choice in conditions:
            sides = [self.places(*c) for c in choice]
            if sides and all(s is not None for s in sides):
                found.append(reduce(lambda a, b: a.unionByName(b), sides).groupBy("bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits")))
        if not found:
            return self.rows.drop("_bucket", "_place")
        both = reduce(lambda a, b: a.unionByName(b), found).groupBy("bucket").agg(F.count("*").alias("n"), F.expr("bitmap_and_agg(bits)").alias("bits"))
        both = both.where((F.col("n") == len(found)) & (F.expr("bitmap_count(bits)") > 0)).select("bucket", "bits")
        buckets = [r.bucket for r in both.select("bucket").collect()]  # one number for each bucket with a hit
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = byte.bitwiseAND(F.expr("shiftleft(1, _place % 8)")) != 0
        own = self.rows.where(F.col("_bucket").isin(buckets)).withColumn("bucket", F.col("_bucket").cast("long"))
        return own.join(both, "bucket").where(hit).drop("bucket", "bits", "_bucket", "_place")

    def filtered(self, state: FilterState) -> DataFrame:
        """Rows that meet a filter; the texts that it looks in have to be indexed under their column names."""
        return self.candidates([[(c, value) for c in columns.split("|")] for columns, value in state.contains.items()]).where(state.condition())

    def search(self, query: str, fields: Mapping[str, str], everywhere: tuple[str, list[str]], year: str, flag: Column) -> DataFrame:
        """Rows that meet a query of the search language; ``everywhere`` is the indexed text of all columns and these columns."""
        q = query.strip().lower()
        name, colon, value = (x.strip() for x in q.partition(":"))
        exact = search(query, fields, everywhere[1], year, flag)
        if colon and name in ("year", "placebo"):  # no text, or free words that look like it
            return self.candidates([]).where(exact)
        return self.candidates([[(fields[name], value) if colon and name in fields else (everywhere[0], q)]]).where(exact)
