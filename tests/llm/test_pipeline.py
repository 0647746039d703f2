import random
import re

import corpus_pipeline
from test_jaccard_join import brute as near_brute
from test_suffix_dedup import brute as repeat_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice(["the", "ing", "tion", "er", "and"]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    passage, rows = prose(70), []
    for i in range(120):
        text = prose(rng.randint(30, 90)) + (" " + passage + " " + prose(20) if i % 4 == 0 else "")
        if i % 6 == 5:
            text = rows[-1][1] + " tail"
        if i % 7 == 0:
            text = " ".join(w + "%%%" for w in text.split())
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    rows += [(500, None, None, None, None), (501, "", "en", "s0", 0), (502, "123 456", "en", "s0", 7)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int("%%%" not in (r[1] or "")), 0) for r in rows[:110]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "sequences":
            assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = [tuple(r) for r in docs.collect()]
        if name == "near_duplicates":
            groups = {}
            for d, _, c in near_brute([tuple(r) for r in before.collect()], 5, 80):
                groups.setdefault(c, []).append(d)
            assert sorted(r[0] for r in kept[name]) == sorted(min(x) for x in groups.values())
        if name == "repeats":
            want = {r[0]: r[1] - r[2] for r in repeat_brute([tuple(r) for r in before.collect()], 200)}
            assert {r[0]: len(r[1]) for r in kept[name]} == want
    assert not any("%%%" in (r[1] or "") for r in kept["quality"])
    assert {r[0] for r in kept["quality"]} >= {r[0] for r in rows[:120] if "%%%" not in r[1]}
    assert not {502} & {r[0] for r in kept["language"]}
    whole = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(whole) == sorted(kept["sequences"])


def test_near_duplicates_shuffle_texts_once(spark, tmp_path):
    rows = [(i, f"one two three four five six {'seven' if i % 5 else i}", "en", "s", 9) for i in range(40)] + [(None, "a text of a row without an id", "en", "s", 9)] * 2
    docs = spark.createDataFrame(rows + rows[:3], SCHEMA)
    out = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert not re.search(r"Exchange hashpartitioning\(doc_id#\d+L?, h_#", out._jdf.queryExecution().executedPlan().toString())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 0), (False, 1), *((False, i) for i in range(5, 40, 5)), (True, 0)]
