import random

from evimap.llm import language_id
from pyspark.sql import functions as F

STEMS = {"en": ["the", "thing", "with", "tion"], "fr": ["eaux", "que", "é", "ment"], "de": ["sch", "und", "ö", "keit"]}
SHAPE = "doc_id long, text string, lang string"


def prose(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def known(spark):
    rows = [(i, prose(lang, 100, i), lang) for i in range(120) for lang in STEMS]
    return language_id.fit(spark.createDataFrame(rows, SHAPE), "text", "lang", "doc_id", F.lit(True))


def test_one_rule_at_every_length(spark):
    clean = prose("de", 600_000, 1)
    assert len(clean) > 3_000_000
    shared = prose("de", 3000, 2).encode()
    rows = spark.createDataFrame([(1, clean, ""), (2, clean[:3000], ""), (3, clean[:200], "")], SHAPE)
    assert {r.doc_id: (r.lang_pred, r.rejected) for r in language_id.predict(rows, "text", known(spark)).collect()} == {i: ("de", False) for i in (1, 2, 3)}
    tie = language_id.predict(rows, "text", [("a", shared), ("b", shared)]).collect()
    assert {(r.doc_id, r.score, r.rejected) for r in tie} == {(i, 0.0, True) for i in (1, 2, 3)}


def test_long_labelled_texts_are_learned(spark):
    rows = [(i, prose(lang, 100, i), lang) for i in range(60) for lang in ("en", "fr")] + [(100 + i, prose("de", 8000, i), "de") for i in range(3)]
    rows += [(200, "Zażółć gęślą jaźń", "pl"), (201, "", "xx"), (202, None, "xx")]
    df = spark.createDataFrame(rows, SHAPE)
    found = dict(language_id.fit(df, "text", "lang", "doc_id", F.lit(True)))
    assert set(found) == {"en", "fr", "de", "pl"} and all(8 <= len(b) <= language_id.DICTIONARY_BYTES for b in found.values())
    assert len(found["de"]) > language_id.DICTIONARY_BYTES // 2
    held = spark.createDataFrame([(i, prose("de", 80, 900 + i), "") for i in range(20)], SHAPE)
    assert {(r.lang_pred, r.rejected) for r in language_id.predict(held, "text", list(found.items())).collect()} == {("de", False)}
