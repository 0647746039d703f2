"""Text counts against plain loops, exact bounds, and cutoffs on labelled rows with known faults."""

import random
import re
from fractions import Fraction
from math import comb

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evimap.llm import quality_rules as Q


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aab  \n\t\x0b\x1c\xa0é#|<日")), max_size=120))
def test_counts(text):
    assert Q.counts(text) == plain(text)


def test_counts_of_long_texts():
    rng = random.Random(1)
    for n, vocabulary in ((3000, 3), (3000, 3000), (2500, 40)):
        text = " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
        text += " " + text[:200] + "\n" + text[:50] + "\n" + text[:50]
        words = text.split()
        seen: dict = {}
        for i in range(len(words) - 4):
            seen.setdefault(tuple(words[i : i + 5]), []).append(i)
        assert Q.repeat_words(words) == len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)})
    assert Q.counts(None) == Q.counts("") == (0,) * 6
    many = [f"w{i}".encode() for i in range(200_000)]  # codes of five words pass 2^63
    assert Q.repeat_words(many + many[5:15]) == 20


@pytest.mark.parametrize("risk, doubt", [(0.05, 0.01), (0.01, 0.05), (0.3, 0.001)])
def test_exact_bound(risk, doubt):
    r = Fraction(risk)
    for n in (0, 1, 5, 59, 100, 400):
        below = Fraction(0)
        for k in range(min(n, 60) + 1):
            below += comb(n, k) * r**k * (1 - r) ** (n - k)
            assert Q.upper_bound_holds(k, n, risk, doubt) == (k < n * risk and below <= Fraction(doubt))
    assert Q.upper_bound_holds(4_900_000, 100_000_000, 0.05, 1e-6) and not Q.upper_bound_holds(5_000_000, 100_000_000, 0.05, 1e-6)


SHAPE, LABELS = "doc_id long, text string, lang string, n_words int", "doc_id long, quality int"


def text(rng, symbols=0, words=40):
    out = [rng.choice("abcdefgh") * rng.randint(1, 6) + str(rng.randrange(1000)) for _ in range(words)]
    return " ".join(w + "$" * (symbols and rng.randint(1, symbols)) for w in out)


def test_cutoffs(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, 3 if i % 6 == 0 else 0), ("en", "fr", "de")[i % 3] if i < 1800 else "rare", 0) for i in range(1830)]
    rows += [(i, text(rng, 3 if i % 2 else 0), "en", 0) for i in range(3000, 3040)] + [(5000, None, None, 0), (5001, "", "en", 0), (None, text(rng), None, 0), (5, rows[5][1], "de", 0), (5, rows[5][1], "de", 0), (5002, "a b c d e " * 50, "en", 0)]
    labels = [(i, int(i % 6 != 0)) for i in range(1830)] + [(5001, None), (None, 0), (77, 1)]
    df, said = spark.createDataFrame(rows, SHAPE).repartition(3), spark.createDataFrame(labels, LABELS)
    got = Q.judged(df, "doc_id", "text", "lang", said, "quality").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None or r.lang == "rare":
            assert r.kept  # too few labels to certify anything
        elif r.doc_id in (5000, 5001, 5002):
            assert r.base_failed and not r.kept and r.rejected_by == ["base"]
        else:
            bad = r.doc_id % 2 == 1 if r.doc_id >= 3000 else r.doc_id % 6 == 0
            assert r.kept != bad, r
    assert all(r.kept != r.base_failed for r in Q.judged(df, "doc_id", "text", "lang", said.limit(0), "quality").collect())
    assert Q.judged(df.limit(0), "doc_id", "text", "lang", said, "quality").collect() == []


def test_false_rejection_is_limited(spark):
    """Good and bad documents overlap: what is chosen stays below the risk on fresh documents of each stratum."""
    rng = random.Random(8)
    draw = lambda i: (i, text(rng, rng.choice((0, 0, 1, 2))), "en" if i % 2 else "fr", 0)
    rows = [draw(i) for i in range(3000)]
    said = spark.createDataFrame([(i, int(rng.random() < 0.8)) for i in range(2000)], LABELS)
    got = Q.judged(spark.createDataFrame(rows, SHAPE), "doc_id", "text", "lang", said, "quality").where("doc_id >= 2000").collect()
    for lang in ("en", "fr"):
        own = [r for r in got if r.lang == lang]
        assert sum(not r.kept for r in own) <= (Q.RISK + 0.02) * len(own)
    # copies are one observation: 200 good rows of one text certify nothing
    same = [(i, "one good text of ten words or a few more than that", "en", 0) for i in range(200)] + [(1000 + i, text(rng, 3), "en", 0) for i in range(50)]
    said = spark.createDataFrame([(i, 1) for i in range(200)] + [(1000 + i, 0) for i in range(50)], LABELS)
    assert all(r.kept for r in Q.judged(spark.createDataFrame(same, SHAPE), "doc_id", "text", "lang", said, "quality").collect())
