"""One thin query for each operator of this subpackage, with its production parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evimap.llm import jaccard_join, language_id, nbsvm, packing, preference, projection_search, quality_rules, scaled_sketch, suffix_dedup, suffix_tree_lm, token_alignment, unigram_pieces, whitening

#: Session setting that names a published vocabulary with byte fallback, and where it is else; not part of the repository.
PIECES_SETTING, PIECES = "spark.evimap.pieces", "/opt/tokenizers/piece_bpe_32k.model"
#: The same for a byte-level BPE.
BYTES_SETTING, BYTES = "spark.evimap.byte_bpe", "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file(spark: SparkSession, setting: str, default: str) -> bytes:
    return Path(spark.conf.get(setting, default)).read_bytes()


def fold(n: int, held: int, key: str = "doc_id"):
    """True for the rows of the held-out fold."""
    return F.crc32(F.col(key).cast("string")) % n == held


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_pairs(*preference.swapped_answers(table(spark, sf_dir, "conversations")))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, share=90).select("doc_id", "n_shingles", "component_id")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Bins of 2,048 tokens; no two documents of a source, and no duplicates, share one."""
    rows = packing.sized(docs, "doc_id", "text", "source", file(docs.sparkSession, BYTES_SETTING, BYTES))
    return packing.pack(rows, "doc_id", "n_tokens", "source", "clusters", "row_hash").drop("row_hash", "copy")


def op4_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(table(spark, sf_dir, "documents"), "doc_id", "text", fold(7, 2))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = language_id.fit(docs, "text", "lang", "doc_id", F.coalesce(~fold(5, 0), F.lit(True)))
    out = language_id.predict(docs.select("doc_id", "text"), "text", known)
    return out.select("doc_id", F.coalesce(fold(5, 0), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op7_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.half_edits(table(spark, sf_dir, "documents"))


def op8_unigram_pieces(spark: SparkSession, sf_dir: str, pieces: str | None = None) -> DataFrame:
    pieces = pieces or spark.conf.get(PIECES_SETTING, PIECES)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = unigram_pieces.encoded(docs, "text", unigram_pieces.load(pieces), with_ids=False)
    return out.select("doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip")


def op9_projection_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_search.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", ~fold(4, 2))
    out = nbsvm.score(docs, "text", model)
    return out.select("doc_id", F.coalesce(fold(4, 2), F.lit(False)).alias("held_out"), "score", (F.col("score") >= nbsvm.THRESHOLD).cast("int").alias("predicted"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judged(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", table(spark, sf_dir, "labels"), "quality")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.linked(table(spark, sf_dir, "documents"), "doc_id", "text", file(spark, BYTES_SETTING, BYTES), file(spark, PIECES_SETTING, PIECES))


QUERIES = {f.__name__: f for f in (op1_preference_pairs, op2_jaccard_join, op3_best_fit_packing, op4_suffix_tree_lm, op5_suffix_dedup, op6_language_id, op7_scaled_sketch, op8_unigram_pieces, op9_projection_search, op10_nbsvm_quality, op11_quality_rules, op12_embedding_whitening, op13_token_alignment)}
ORACLE_SQL: dict[str, str] = {"op1_preference_pairs": preference.PAIRS_SQL, "op2_jaccard_join": jaccard_join.LINKS_SQL, "op5_suffix_dedup": suffix_dedup.REPEATS_SQL, "op11_quality_rules": quality_rules.RULES_SQL}
