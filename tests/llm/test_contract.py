"""Every query of the subpackage, and the pipeline, on small tables with odd rows and on empty ones."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from evimap.llm import queries
from test_text_operators import ODD, documents

COLUMNS = {
    "op1_preference_pairs": {"conv_id"}, "op2_jaccard_join": {"doc_id", "n_shingles", "component_id"}, "op3_best_fit_packing": {"doc_id", "bin_id"},
    "op4_suffix_tree_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}, "op5_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op6_language_id": {"doc_id", "held_out", "lang_pred", "score"}, "op7_scaled_sketch": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op8_unigram_pieces": {"doc_id", "n_pieces"}, "op9_projection_search": {"query_id", "rank", "vec_id", "score"}, "op10_nbsvm_quality": {"doc_id", "held_out", "score", "predicted"},
    "op11_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op12_embedding_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op13_token_alignment": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
}


def write(spark, path, empty):
    docs = [r[:5] for r in documents(50, 6) + ODD]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {c % 3} {t}") for c in range(12) for t in range(4)]
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"), "labels": ([(i, int(i % 5 != 0), 0) for i in range(50)], "doc_id long, quality int, toxic int"),
        "conversations": (turns, "conv_id long, turn long, role string, text string"), "embeddings": ([(i, [float(i % 7), float(i % 11), 1.0], 0) for i in range(60)], "vec_id long, embedding array<float>, label int"),
    }
    for name, (rows, shape) in tables.items():
        spark.createDataFrame([] if empty else rows, shape).write.parquet(f"{path}/{name}.parquet")
    return docs


@pytest.fixture(scope="module", params=[False, True], ids=["odd rows", "empty"])
def tables(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = write(spark, path, request.param)
    return path, [] if request.param else docs


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, tables, name):
    path, docs = tables
    rows = queries.QUERIES[name](spark, path)
    got = rows.collect()
    assert COLUMNS[name] <= set(rows.columns)
    if not docs:
        assert got == []
    elif name in ("op2_jaccard_join", "op4_suffix_tree_lm", "op5_suffix_dedup", "op6_language_id", "op7_scaled_sketch", "op8_unigram_pieces", "op10_nbsvm_quality", "op11_quality_rules", "op13_token_alignment"):
        assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in docs)
    elif name == "op9_projection_search":
        assert len(got) == 3 * 20
    if "held_out" in rows.columns:
        assert all(r.held_out is not None for r in got)


def test_pipeline(spark, tables):
    path, docs = tables
    out = corpus_pipeline.run(spark, path)
    assert {"doc_id", "bin_id"} <= set(out.columns) and (out.count() > 0) == bool(docs)


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    rows = queries.QUERIES[name](spark, SF)
    want = db.sql(queries.ORACLE_SQL[name])
    columns = sorted(want.columns)
    assert sorted(rows.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert sorted(tuple(str(r[c]) for c in columns) for r in rows.collect()) == sorted(tuple(str(r[i]) for i in place) for r in want.fetchall())
