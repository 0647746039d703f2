import math
import os
import time

import numpy as np
import pytest

from evimap.llm import projection_search as P
from evimap.llm import unigram_pieces as U
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def brute(vectors, q, k=20):
    scores = vectors @ vectors[q]
    return [i for i in np.lexsort((np.arange(len(vectors)), -np.round(scores, 9))) if i != q][:k], scores


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((1500, 24)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    vectors[400:700] = vectors[400]  # many equal vectors: ties
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(vectors)]
    rows += [(5000, None, "", 0), (5020, [0.0] * 24, "", 0), (5040, [float("nan")] + [1.0] * 23, "", 0), (5060, [1.0], "", 0), (5061, [0.5], "", 0), (None, [1.0] * 24, "", 0), (5080, [None] + [1.0] * 23, "", 0), (20, vectors[20].tolist(), "", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, q string, rank int")
    got = {}
    for r in P.nearest(df, "vec_id", "embedding", F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    exact = vectors.astype(np.float64)
    assert got.pop(5060) == [(1, 5061, 0.5)]  # vectors of another length are searched among themselves
    assert set(got) == set(range(0, 1500, 20))
    hits = total = 0
    for q, found in got.items():
        want, scores = brute(exact, q)
        assert [x[0] for x in sorted(found)] == list(range(1, 21))
        assert all(math.isclose(s, scores[i], rel_tol=1e-12, abs_tol=1e-12) for _, i, s in found)
        hits += len(set(want) & {i for _, i, _ in found})
        total += 20
    assert hits / total >= 0.9


def test_the_stop_holds_and_saves_most_of_the_work():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((200, 48))
    vectors = (centres[rng.integers(0, 200, 12000)] + 0.6 * rng.standard_normal((12000, 48))).astype(np.float32)
    norm = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max()))
    keys, queries = np.arange(12000), np.arange(0, 12000, 100)
    got, verified = P.search_block(keys, vectors, queries, vectors[queries], 20, norm)
    assert verified / (len(queries) * 12000) < 0.4
    exact, by = vectors.astype(np.float64), {}
    for q, i, _ in got:
        by.setdefault(q, set()).add(i)
    assert np.mean([len(by[q] & set(brute(exact, q)[0])) / 20 for q in queries.tolist()]) >= 0.9


def test_recall_on_the_driver_table(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("driver tables are not here")
    rows = {r.vec_id: r.embedding for r in P.usable(spark.read.parquet(path).withColumnRenamed("vec_id", "i"), "i", "embedding").select(F.col("id").alias("vec_id"), F.col("v").alias("embedding")).collect()}
    keys, vectors = np.array(sorted(rows)), np.array([rows[k] for k in sorted(rows)])
    found = {}
    for r in P.nearest(spark.read.parquet(path), "vec_id", "embedding", F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    places = [i for i, k in enumerate(keys.tolist()) if k % 20 == 0]
    assert np.mean([len(found[keys[i]] & set(keys[brute(vectors, i)[0]].tolist())) / 20 for i in places]) >= 0.9


def test_search_of_little_or_nothing(spark):
    shape = "vec_id long, embedding array<float>"
    assert P.nearest(spark.createDataFrame([], shape), "vec_id", "embedding", F.col("id") % 20 == 0).collect() == []
    two = spark.createDataFrame([(20, [1.0, 2.0]), (3, [2.0, 0.5])], shape)
    assert [tuple(r) for r in P.nearest(two, "vec_id", "embedding", F.col("id") % 20 == 0).collect()] == [(20, 1, 3, 3.0)]


@pytest.fixture(scope="module")
def vocabulary():
    return U.load(MODEL)


def best_score(text, v):
    known = {t: i for i, t in enumerate(v.text) if t and i not in set(v.byte.tolist())}
    raw, best = " " + text, [0.0]
    for end in range(1, len(raw) + 1):
        options = [best[end - 1] + v.unknown] if raw[end - 1 : end].encode() not in known else []
        options += [best[s] + v.score[known[p]] for s in range(max(0, end - 24), end) if (p := raw[s:end].encode()) in known]
        best.append(max(options))
    return best[-1]


def test_pieces_are_best_and_come_back(spark, vocabulary):
    texts = ["The quick brown fox", "  two  spaces\nand\ttabs ", "naïve Überraschung 漢字 🙂🙂", "x" * 300, "a", "MixedCASE_under-score", "͸ odd \u0001", f"a{U.MARK}b {U.MARK}", "Ünterstützung" * 400, "the whole sentence of words " * 400]
    for text, ids in zip(texts, U.encode(texts, vocabulary, {})):
        own = set(vocabulary.byte.tolist())
        score, at = 0.0, 0
        while at < len(ids):
            if ids[at] in own:
                lead = vocabulary.text[ids[at]][0]
                score += vocabulary.unknown
                at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            else:
                score += vocabulary.score[ids[at]]
                at += 1
        assert math.isclose(score, best_score(text, vocabulary), rel_tol=1e-9)
        assert U.decode(ids, vocabulary) == text
    rows = spark.createDataFrame([(i, t, "n") for i, t in enumerate([*texts, None, "", f"{U.MARK}x"])], "doc_id long, text string, n_pieces_ string")
    done = U.encoded(rows, "text", vocabulary)
    back = U.decoded(done, "ids", vocabulary).orderBy("doc_id").collect()
    assert [r.decoded for r in back] == [*texts, "", "", f"{U.MARK}x"] and all(r.round_trip for r in back)
    assert U.encoded(rows.limit(0), "text", vocabulary).collect() == []


def test_long_text_without_spaces(vocabulary):
    rng = np.random.default_rng(3)
    for letters in ("abcdefghijklmnop", "theingation", "x", "日本語é🙂a"):
        segment = (" " + "".join(rng.choice(list(letters), 1500))).encode()
        assert U.solve_long(segment, vocabulary).tolist() == U.solve([segment], vocabulary)[0].tolist()
    text = "".join(rng.choice(list("theingationrs"), 1_000_000))
    began = time.time()
    ids = U.encode([text], vocabulary, {})[0]
    assert time.time() - began < 30 and U.decode(ids, vocabulary) == text  # about 3 s on an idle core


def test_ranks_become_log_probabilities(vocabulary):
    plain = np.isfinite(vocabulary.score)
    assert plain.sum() > 31000 and math.isclose(np.exp(vocabulary.score[plain]).sum(), 1.0) and vocabulary.apart
    whole = lambda t: [vocabulary.text[i] for i in U.encode([t], vocabulary, {})[0]]
    assert whole("Device") == [b" Device"] and whole("international") == [b" international"]
    own = np.array([-1.5, -2.25, -0.5])
    assert U.log_probabilities(own, np.arange(3)) is own  # a unigram file's scores stay


def test_pieces_with_inner_markers(vocabulary):
    keys = [(b" a b", 0), (b" a", 1), (b" b", 2), (b"b", 3)]
    v = U.Vocabulary(*U.double_array(keys), np.log([0.4, 0.2, 0.2, 0.2]), [k for k, _ in keys], np.zeros(256, np.int64), -20.0, False)
    assert U.encode(["a b"], v, {})[0].tolist() == [0]


def test_doubles_are_searched_as_doubles(spark):
    rng = np.random.default_rng(12)
    v = rng.standard_normal((300, 3))
    v[7] = [1e200, -1e200, 3e199]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000, [0.1 + 1e-10, 0.0, 0.0]), (1020, [1.0, 0.0, 0.0])]
    got = P.nearest(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v", F.col("id") % 20 == 0, sure=0.999999).collect()
    found = {(r.query_id, r.vec_id): r.score for r in got}
    own = dict(rows)
    for (q, i), score in found.items():
        assert score == float((np.array(own[i]) * np.array(own[q])).sum())
    assert (1020, 7) in found and all((q, 7) in found for q in range(0, 300, 20) if float(v[q] @ (v[7] / 1e200)) > 0)
    exact = P.nearest(spark.createDataFrame(rows[300:] + [(1, [0.1, 5.0, 0.0])], "vec_id long, v array<double>"), "vec_id", "v", F.col("id") % 20 == 0).collect()
    assert {(r.query_id, r.vec_id): r.score for r in exact}[1020, 1000] == 0.1 + 1e-10
