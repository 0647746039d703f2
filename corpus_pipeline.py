"""From raw documents to packed training sequences, in five stages.

Each stage gets all rows that the one before it kept; all but the last return
the columns of ``documents``.  Texts that lose all their bytes in ``repeats``
stay as empty documents.  Rows that repeat both doc_id and text are one
document for ``near_duplicates``.
"""

from __future__ import annotations

import uuid

from evimap.llm import jaccard_join, language_id, nbsvm, queries, suffix_dedup
from evimap.llm.components import shared_folder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least 0.7 stay; learned from all labelled ones, up to a bound."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.select(COLUMNS)
    model = nbsvm.fit(docs, labels, "doc_id", "text", "quality", F.lit(True))
    return nbsvm.score(docs, "text", model).where(F.col("score") >= nbsvm.THRESHOLD).select(COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough stay."""
    docs = docs.select(COLUMNS)
    known = language_id.fit(docs, "text", "lang", "doc_id", F.lit(True))
    return language_id.predict(docs, "text", known).where(~F.col("rejected")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays; documents without words stay all."""
    docs = docs.select(COLUMNS)
    found = jaccard_join.near_duplicates(docs, words=5, share=80)
    first = found.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_hash")).alias("x")).select("x.doc_id", "x.row_hash")
    keep = first.unionByName(found.where("label is null").select("doc_id", "row_hash")).groupBy(F.col("row_hash").alias("h_")).agg(F.collect_set(F.struct("doc_id")).alias("ids"))
    # dealt by the hash alone, so that texts are shuffled once for the join and for what repeats
    rows = docs.withColumn("h_", F.xxhash64("doc_id", "text")).join(keep, "h_").where(F.exists("ids", lambda x: x["doc_id"].eqNullSafe(F.col("doc_id"))))
    return rows.dropDuplicates(["doc_id", "h_"]).select(COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 that occur elsewhere go."""
    docs = docs.select(COLUMNS)
    cut = suffix_dedup.removed(docs, keep_text=True).where("kept is not null").select("k", "thash", "kept").distinct()
    rows = docs.withColumns({"k": F.xxhash64("doc_id"), "thash": F.xxhash64(F.coalesce("text", F.lit("")))})
    rows = rows.join(cut, ["k", "thash"], "left").withColumn("text", F.coalesce("kept", "text"))
    return rows.withColumn("n_chars", F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long")).select(COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 tokens; no two documents of a source, and no duplicates, share one."""
    return queries.packed(docs.select(COLUMNS))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("sequences", sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
