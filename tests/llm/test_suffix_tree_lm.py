import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from evimap.llm import suffix_tree_lm as L
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, score string"


def held_fold():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def corpus():
    rng = random.Random(8)
    syllables = ["tion", "er", "an", "the", "é", "ing", "ou", "st"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(words).title() for _ in range(rng.randint(0, 80))), "s") for i in range(200)]
    return [*rows, (900, None, None), (901, "", ""), (902, "rare_word_only_here \t" * 2, ""), (None, "no key", ""), (3, rows[3][1], ""), (903, "long " * 4000, "")]


def test_baseline_and_gain(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = L.score(df, "doc_id", "text", held_fold()).collect()
    held = {r.doc_id: r.h for r in df.select("doc_id", F.coalesce(held_fold(), F.lit(False)).alias("h")).collect()}
    train = Counter(t for d, text, _ in rows if not held[d] for t in tokens(text))
    n, v = sum(train.values()), len(train)
    want = sorted((str(d), held[d], len(t := tokens(text)), sum(train[x] > 0 for x in t), n, round(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in t), 6)) for d, text, _ in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got if r.held_out) > 1.2 * sum(r.base_score for r in got if r.held_out)
    assert all(r.score < 0 for r in got)


def plain_chances(train, texts, least):
    """log10 probability of every symbol of ``texts``, from a tree of dictionaries."""
    lead = bytes([L.END]) * L.DEPTH
    line = lambda t: lead + b" ".join([*t.split(), b""]) + lead[:1]
    table = {}
    for s in map(line, train):
        for i in range(L.DEPTH, len(s)):
            for d in range(L.DEPTH + 1):
                table.setdefault(s[i - d : i], Counter())[s[i]] += 1

    def gain(c):
        own, above = table[c], table[c[1:]]
        return sum(k * math.log(k / sum(own.values()) / (above[x] / sum(above.values()))) for x, k in own.items())

    keep = {c for c in table if len(c) <= L.SHORT or gain(c) >= least}
    keep |= {c[i:] for c in keep for i in range(len(c))} | {b""}

    def chance(c, x):
        own, above = table.get(c, Counter()), chance(c[1:], x) if c else 1 / L.SYMBOLS
        return (max(own[x] - L.DISCOUNT, 0) + L.DISCOUNT * len(own) * above) / sum(own.values()) if own else above

    out = []
    for s in map(line, texts):
        for i in range(L.DEPTH, len(s)):
            out.append(math.log10(chance(next(s[i - d : i] for d in range(L.DEPTH, -1, -1) if s[i - d : i] in keep), s[i])))
    return out, keep


def some_texts(n):
    rng = random.Random(2)
    return [" ".join(rng.choice(["ab", "abc", "ba", "c", "abcabc"]) for _ in range(30)).encode() for _ in range(n)]


def test_tree_against_a_plain_one():
    train, new = some_texts(60), [b"abc ba c", b"zab", b"", b"abcabc abcabc ab"]
    codes, counts = np.unique(L.grams(*L.symbols(train)), return_counts=True)
    asked = np.unique(L.grams(*L.symbols(new)))
    codes, counts = L.added([(codes, counts), (asked, np.zeros(len(asked)))])
    short = L.root(*(x.astype(t) for x, t in zip(np.unique(L.grams(*L.symbols(train), L.SHORT), return_counts=True), (np.uint64, np.int64))))
    for least in (5.0, 0.0, 1e9):
        found = np.log10(L.chances(codes, counts, short, least))
        want, keep = plain_chances(train, new, least)
        assert np.allclose(found[np.searchsorted(codes, L.grams(*L.symbols(new)))], want, atol=1e-6)
    _, keep = plain_chances(train, new, 5.0)
    assert max(map(len, keep)) > L.SHORT


def test_probabilities_add_up():
    codes, counts = np.unique(L.grams(*L.symbols(some_texts(60))), return_counts=True)
    short = L.root(*(x.astype(t) for x, t in zip(np.unique(L.grams(*L.symbols(some_texts(60)), L.SHORT), return_counts=True), (np.uint64, np.int64))))
    for context in (int(codes[len(codes) // 2]) >> 8, 0x616263616263, 0x7A7A7A7A7A7A):
        every = np.arange(256, dtype=np.uint64) | np.uint64(context << 8)
        all_codes, all_counts = L.added([(codes, counts), (every, np.zeros(256))])
        assert math.isclose(L.chances(all_codes, all_counts, short)[np.searchsorted(all_codes, every)].sum(), 1, rel_tol=1e-9)


def test_score_of_rows(spark, monkeypatch):
    """Whole query over several chunks and blocks, against the plain tree."""
    monkeypatch.setattr(L, "CHUNK_BYTES", 600)
    train, new = some_texts(60), [b"abc ba c", b"zab", b"", b"abcabc abcabc ab", "\u00c9t\u00e9".encode()]
    rows = [(i, t.decode(), "t") for i, t in enumerate(train)] + [(100 + i, t.decode(), "h") for i, t in enumerate(new)]
    got = {r.doc_id: r.score for r in L.score(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", F.col("score") == "h").collect()}
    for i, t in enumerate(new):
        assert math.isclose(got[100 + i], sum(math.floor(x * L.STEP + 1e-6) for x in plain_chances(train, [t], L.GAIN)[0]) / L.STEP, abs_tol=2 / L.STEP)


def test_added_text_keeps_contexts():
    """A context that passes still passes when other text is added: the threshold does not grow."""
    other = [bytes(random.Random(i).choices(b"mnopqrstuvwxyz ", k=300)) for i in range(60)]
    held = [b"abcabc abc abcabc"]
    both = sum(plain_chances(some_texts(60) + other, held, L.GAIN)[0])
    assert both > sum(plain_chances(some_texts(60), held, L.GAIN)[0]) - 1


def test_nothing_to_learn_from(spark):
    assert L.score(spark.createDataFrame([], SCHEMA), "doc_id", "text", held_fold()).collect() == []
    only = L.score(spark.createDataFrame([(1, "a b", "")], SCHEMA), "doc_id", "text", F.lit(True)).collect()[0]
    assert (only.n_tokens, only.n_known, only.train_tokens, only.base_score) == (3, 0, 0, 0.0)
    assert math.isclose(only.score, -5 * math.log10(L.SYMBOLS), abs_tol=5 / L.STEP)
