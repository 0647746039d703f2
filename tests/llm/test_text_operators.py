import hashlib
import math
import os
import random

import numpy as np
import pytest
import zstandard

from evimap.llm import language_id, nbsvm, packing, preference, queries, scaled_sketch
from evimap.llm.token_alignment import ByteLevel
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
STEMS = {"en": ["the", "thing", "with", "tion"], "fr": ["eaux", "que", "é", "ment"], "de": ["sch", "und", "ö", "keit"]}


def documents(n=240, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(STEMS))
        words = ["".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(20, 200))]
        junk = i % 5 == 0
        rows.append((i, " ".join(w + "$$$" if junk else w for w in words), lang, f"s{i % 3}", 0, 9.0))
    return rows


ODD = [(900, None, None, None, None, None), (901, "", "en", "", 0, 0.0), (902, " \t\n", "en", "s1", 3, 0.0), (903, "1234 !!", "en", "s1", 3, 0.0), (None, "thing the with", None, "s0", 1, 1.0), (7, "the thing with", "en", "s0", 1, 1.0), (904, "the thing " * 9000, "en", "s0", 1, 1.0)]


def fold(n, r):
    return F.crc32(F.col("doc_id").cast("string")) % n == r


def test_language(spark):
    df = spark.createDataFrame(documents() + ODD, DOCS)
    known = language_id.fit(df, "text", "lang", "doc_id", ~fold(5, 0))
    assert {n for n, _ in known} == set(STEMS) and all(len(b) <= language_id.DICTIONARY_BYTES for _, b in known)
    rows = language_id.predict(df.drop("lang", "source"), "text", known).collect()
    assert len(rows) == 247
    right = {d[0]: d[2] for d in documents()}
    assert sum(r.lang_pred == right[r.doc_id] for r in rows if r.doc_id in right and r.doc_id != 7) >= 236
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902, 903):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert language_id.predict(df.limit(0), "text", known).collect() == []
    assert language_id.predict(df.limit(2), "text", language_id.fit(df.limit(0), "text", "lang", "doc_id", F.lit(True))).first().lang_pred == "und"


def test_copies_of_a_row_are_drawn_once(spark):
    """3,000 copies of one row under one key: the pieces that reach the driver are distinct."""
    rows = [(1, "die einheit und der schutz " * 3, "de")] * 3000 + [(2, "the thing with the tion", "en")]
    known = dict(language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", "doc_id", F.lit(True)))
    assert known["de"].count(b"einheit") == 3 and set(known) == {"de", "en"}


def test_quality(spark):
    rows = documents() + ODD
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(240) if i % 2] + [(i, 0) for i in range(0, 240, 10)] + [(1, 1), (901, None), (None, 1)], "doc_id long, quality int")
    model = nbsvm.fit(df, labels, "doc_id", "text", "quality", ~fold(4, 2))
    out = nbsvm.score(df, "text", model)
    assert out.columns.count("score") == 1
    got = out.collect()
    assert len(got) == 247 and all(0 <= r.score <= 1 for r in got)
    assert sum((r.score >= 0.7) == (r.doc_id % 5 != 0) for r in got if r.doc_id is not None and r.doc_id < 240 and len(r.text) > 30) >= 236
    none = nbsvm.fit(df, labels.limit(0), "doc_id", "text", "quality", F.lit(True))
    assert {r.score for r in nbsvm.score(df, "text", none).collect()} == {0.5}


def shingles(text, k=scaled_sketch.SHINGLE_BYTES):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    return {raw[i : i + k] for i in range(max(1, len(raw) - k + 1))} if raw else set()


def containment(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / min(len(a), len(b)) if a and b else float(len(a) == len(b))


def test_sketch_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(scaled_sketch, "RANGE_BYTES", 4000)  # many ranges
    rows = documents(60, 4) + ODD
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    items = sorted(((-(1 << 63) if r[0] is None else r[0], r[1] or "", r[0]) for r in rows), key=lambda x: x[:2])
    want = {}
    for (_, text, key), (_, after, _) in zip(items, items[1:] + items[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want[key, len(text), hashlib.sha256(edited.encode()).hexdigest()] = (round(containment(text, edited), 9), round(containment(text, after), 9))
    # with every hash kept, likeness is the containment of the shingle sets itself
    every = scaled_sketch.half_edits(df, fraction=1.0).collect()
    assert {(r.doc_id, r.n_chars, r.edited_sha256): (round(r.near_edited, 9), round(r.near_next, 9)) for r in every} == want
    got = scaled_sketch.half_edits(df).collect()
    assert len(got) == len(every) == len(rows) and {(r.doc_id, r.n_chars, r.edited_sha256) for r in got} == set(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all((r.fingerprint == "") == (r.n_chars == 0) for r in got)
    exact = [want[r.doc_id, r.n_chars, r.edited_sha256][0] for r in got if r.n_chars > 600]
    assert abs(np.mean(exact) - np.mean([r.near_edited for r in got if r.n_chars > 600])) < 0.05
    assert scaled_sketch.half_edits(spark.createDataFrame([], DOCS)).collect() == []


def test_sketches_merge_and_keep_no_hash_above_the_limit(spark):
    rows = documents(60, 4)
    short = [(1000 + i, f"{i:02d} short text!"[:13], "en", "s", 0, 0.0) for i in range(40)]
    plain = scaled_sketch.fingerprints(spark.createDataFrame(rows + short, DOCS), "doc_id", "text").collect()
    assert all(x <= scaled_sketch.FRACTION * 2**52 for r in plain for x in r.sketch)
    assert sum(not r.sketch for r in plain if r.doc_id >= 1000) > 20
    merged = scaled_sketch.merge(scaled_sketch.fingerprints(spark.createDataFrame(rows[:4], DOCS), "doc_id", "text").withColumn("g", F.lit(1)), "g").first()
    assert set(merged.sketch) == {x for r in plain if r.doc_id in (0, 1, 2, 3) for x in r.sketch}


def test_language_against_a_plain_loop(spark):
    rows = documents(40, 8) + ODD + [(2000, "A B ", "en", "s", 0, 0.0), (2001, "thing the und " * 3000, "en", "s", 0, 0.0)]
    df = spark.createDataFrame(rows, DOCS)
    known = language_id.fit(df, "text", "lang", "doc_id", F.lit(True))
    coders = {n: zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=zstandard.ZstdCompressionDict(b, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_dict_id=False, write_content_size=False) for n, b in known}
    for r in language_id.predict(df, "text", known).collect():
        if not any(c.isalpha() for c in r.text or ""):
            continue
        raw, size = r.text.lower().encode(), {}
        for name, coder in coders.items():
            size[name] = sum(len(coder.compress(raw[i : i + language_id.BLOCK])) for i in range(0, len(raw), language_id.BLOCK))
        order = sorted(size.values())
        assert size[r.lang_pred] == order[0] and abs(r.score - (order[1] - order[0]) / order[1]) < 1e-12
        assert r.rejected == (r.score < language_id.MIN_MARGIN)


def test_quality_against_plain_sums(spark):
    rows = [r for r in documents(80, 3)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(80)] * 2, "doc_id long, quality int")
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows + rows[:3]], DOCS + ", y string, _key int")
    model = nbsvm.fit(df, labels, "doc_id", "text", "quality", F.lit(True))

    def grams(text):
        raw, words = text.encode(), [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in text.encode().split()]
        out = {(int.from_bytes(raw[i : i + 3], "big") * 0x9E3779B97F4A7C15 % 2**64) >> (64 - nbsvm.BITS) for i in range(len(raw) - 2)}
        return sorted(out | {(n * 0xC2B2AE3D27D4EB4F % 2**64) >> (64 - nbsvm.BITS) for n in (2, 3, 4) if any(len(set(words[i : i + n])) == 1 for i in range(len(words) - n + 1))})

    for r in nbsvm.score(df, "text", model).collect():
        own = grams(r.text)
        margin = sum(model.weight[p] for p in own) / math.sqrt(model.damping + sum(model.ratio[p] ** 2 for p in own)) + model.bias
        assert abs(r.score - 1 / (1 + math.exp(-(model.slope * margin + model.shift)))) < 1e-4


def test_descent_solves_the_hinge_loss():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(30, 6, replace=False)).astype(np.int32) for _ in range(60)]
    y, ratio = rng.integers(0, 2, 60), rng.standard_normal(30)
    w, bias = nbsvm.descend(rows, y, ratio, 0.5, cost=1.0, rounds=400)
    values = np.zeros((60, 31))
    for i, x in enumerate(rows):
        values[i, x] = ratio[x] / np.sqrt(0.5 + np.sum(ratio[x] ** 2))
    values[:, 30] = 1
    loss = lambda v: 0.5 * v @ v + np.maximum(0, 1 - np.where(y > 0, 1, -1) * (values @ v)).sum()
    best = np.append(w, bias)
    own = loss(best)
    assert all(loss(best + rng.standard_normal(31) * s) >= own - 2e-2 for s in (0.3, 0.1, 0.03, 0.01) for _ in range(50))


def test_best_fit_takes_the_tightest(spark):
    rng = random.Random(3)
    items = sorted(((rng.randint(0, 60), rng.choice(["a", "a", "b", "c", None, ""]), rng.choice([None, 1, 2, 3, 4])) for _ in range(300)), key=lambda x: -x[0])
    placed = packing.best_fit([(n, s, [] if c is None else [c]) for n, s, c in items], 100)
    bins = {}
    for (n, s, c), (b, start) in zip(items, placed):
        own = bins.setdefault(b, [0, set(), set()])
        gaps = [100 - o[0] - n for k, o in bins.items() if k != b and o[0] + n <= 100 and not (s and s in o[1]) and not (c is not None and c in o[2])]
        if own[0] or own[1]:
            assert not gaps or 100 - own[0] - n <= min(gaps)
        else:
            assert not gaps
        assert start == own[0] and not (s and s in own[1]) and not (c is not None and c in own[2])
        own[0] += n
        own[1].add(s), own[2].add(c)
        assert own[0] <= 100


@pytest.mark.skipif(not os.path.exists(queries.BYTES), reason="tokenizer files are not here")
def test_pack_places_everything(spark):
    rows = documents() + ODD + [ODD[-1]] * 3 + [(905, "ab " * 40_000, "en", "s2", 1, 0.0)]
    bpe = open(queries.BYTES, "rb").read()
    coder = ByteLevel(bpe)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    sized = packing.sized(df, "doc_id", "text", "source", bpe)
    got = packing.pack(sized, "doc_id", "n_tokens", "source", "clusters", "row_hash").collect()
    want = {}
    for d, t, *_ in rows:
        want[d] = want.get(d, 0) + len(coder.encode(t or "")) + 1
    have, bins = {}, {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.n_tokens
        bins.setdefault(r.bin_id, []).append((r.start, r.n_tokens))
    assert have == want
    for own in bins.values():
        own.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[0][0] == 0 and own[-1][0] + own[-1][1] <= packing.CAPACITY
    assert packing.pack(sized.limit(0), "doc_id", "n_tokens", "source", "clusters", "row_hash").collect() == []
    # the same by plain loops: groups by hash, then best fit over sets instead of bitmaps
    facts = {(r.doc_id, r.row_hash): r for r in sized.collect()}
    for g in {r.bin_id >> 32 for r in got}:
        own = sorted((r for r in got if r.bin_id >> 32 == g), key=lambda r: (-r.n_tokens, r.doc_id is None, r.doc_id or 0, r.piece, r.row_hash, r.copy))
        open_: list = []
        for r in own:
            fact = facts[r.doc_id, r.row_hash]
            fits = [b for b in open_ if b[0] >= r.n_tokens and not (fact.source and fact.source in b[1]) and not b[2] & set(fact.clusters)]
            tight = min((b[0] for b in fits), default=None)
            mine = next((b for b in open_ if b[3] == r.bin_id), None)
            if mine is None:
                assert not fits and r.start == 0
                open_.append(mine := [packing.CAPACITY, set(), set(), r.bin_id])
            else:
                assert mine[0] == tight and mine in fits
            mine[0] -= r.n_tokens
            mine[1].add(fact.source), mine[2].update(fact.clusters)
    # whole sequences give every text back
    decode = lambda ids: b"".join(coder.spelled[i] for i in ids).decode()
    texts = {}
    for r in packing.sequences(df, "doc_id", "text", "source", bpe, 50256).collect():
        assert len(r.ids) <= packing.CAPACITY and len(r.ids) == sum(s.n_tokens for s in r.segments)
        for s in r.segments:
            texts.setdefault(s.key, []).append((s.piece, r.ids[s.start : s.start + s.n_tokens]))
    for d in (0, 5, 17, 905):
        whole = [i for _, own in sorted(texts[d]) for i in own]
        assert whole[-1] == 50256 and decode(whole[:-1]) == next(t for k, t, *_ in rows if k == d)


def test_answers_of_any_keys(spark):
    """Keys far apart, or texts, get the answer of the next key all the same."""
    plain = [(i * 5_000_000 if i % 2 else -i, 0, "assistant", f"a{i}") for i in range(300)]
    for shape, name in (("conv_id long", lambda k: k), ("conv_id string", lambda k: f"{k:x}")):
        turns = [(name(k), *r) for k, *r in plain]
        rows = preference.preference_pairs(*preference.swapped_answers(spark.createDataFrame(turns, shape + ", turn long, role string, text string").repartition(7))).collect()
        order = sorted(turns)
        after = {t[0]: order[(i + 1) % len(order)][3] for i, t in enumerate(order)}
        assert {r.conv_id: r.rejected for r in rows} == {k: f"<|assistant|>\n{v}<|end|>\n" for k, v in after.items()}


def test_long_and_repeated_turns(spark):
    shape = "conv_id long, turn long, role string, text string"
    turns = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3000)] + [(5, 0, "user", "q"), (5, 0, "user", "q"), (5, 1, "assistant", "a"), (9, 0, "assistant", "z"), (5000, 0, "assistant", "alone")]
    df = spark.createDataFrame(turns, shape)
    got = {r.conv_id: r for r in preference.preference_pairs(*preference.swapped_answers(df)).collect()}
    assert got[1].n_prompt_turns == 2999 and got[1].rejected == "<|assistant|>\na<|end|>\n" and got[1].rejected_spans == "14-22"
    assert got[5].n_prompt_turns == 2 and got[5].rejected == "<|assistant|>\nz<|end|>\n" and got[9].rejected.startswith("<|assistant|>\nalone")
    assert got[5000].rejected == "<|assistant|>\nt2999<|end|>\n"
    only = preference.preference_pairs(*preference.swapped_answers(df.where("conv_id = 9"))).collect()
    assert [(r.conv_id, r.rejected) for r in only] == [(9, "<|assistant|>\n<|end|>\n")]
    assert preference.preference_pairs(*preference.swapped_answers(df.limit(0))).collect() == []
    spans = preference.preference_pairs(*(preference.conversations(x) for x in (df.where("conv_id = 1"), df.where("conv_id = 9")))).first()
    own = [spans.chosen[int(a) : int(b)] for a, b in (x.split("-") for x in spans.chosen_spans.split(","))]
    assert own == [f"t{i}<|end|>" for i in range(1, 3000, 2)]
