"""Token alignment against both tokenizers run on whole texts, and the product of fragments."""

import hashlib
import os
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from evimap.llm import queries, token_alignment as T

pytestmark = pytest.mark.skipif(not os.path.exists(queries.BYTES), reason="tokenizer files are not here")
A, B = (Path(p).read_bytes() if os.path.exists(p) else b"" for p in (queries.BYTES, queries.PIECES))


@pytest.fixture(scope="module")
def coder():
    return T.Coder(A, B)


def ends(coder, text):
    """(end, id) of both whole encodings, or None where they do not spell the text."""
    if len(COMMON) < 2:
        COMMON.extend([coder, Tokenizer.from_str(A.decode())])
        COMMON[1].encode_special_tokens = True
    own = COMMON[1]
    sides = []
    for ids, table in ((own.encode(f" {text}", add_special_tokens=False).ids, coder.a_bytes), (coder.b.encode(text), coder.b_bytes)):
        at, side = 0, []
        for i in ids:
            side.append((at := at + len(table[i]), i))
        if b"".join(table[i] for i in ids) != f" {text}".encode():
            return None
        sides.append(side)
    return sides


def plain(coder, text):
    """n_a, n_b, n_groups, n_links, links and text of the groups by one walk over all bytes' ends."""
    sides = ends(coder, text) if text else None
    if not sides:
        return 0, 0, 0, 0, Counter(), ""
    groups, own, a, b = [], ([], []), dict(sides[0]), dict(sides[1])
    for end in sorted({*a, *b}):
        if end in a:
            own[0].append(a[end])
        if end in b:
            own[1].append(b[end])
        if end in a and end in b:
            groups.append(own)
            own = ([], [])
    pairs = Counter((x, y) for g in groups for x in g[0] for y in g[1])
    said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    return len(a), len(b), len(groups), sum(pairs.values()), pairs, hashlib.sha256(said.encode()).hexdigest()


ODD = ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \tb", "\n", "a\x1c b", "x\xa0 y", "  two  spaces  ", "<|endoftext|> and <s> </s> <0x41>", "a▁b", "\x00 \x00a", "don't we'll 'tis", "日本語 テキスト", "é é Å ﬁ", "😀 😀👍🏽", "a　 b", "123 4567 a1b2", "\r\n \r\n", "word" * 300, "a" + " " * 30_000 + "b", "\n" * 9000]
LETTERS = st.text(alphabet=st.sampled_from(list(" \n\tabé'st1.,　\x1c▁日😀<>|") + [" "] * 5), max_size=60)


COMMON: list = []


@settings(max_examples=400, deadline=None)
@given(LETTERS, st.integers(1, 9))
def test_ranges_are_independent(text, chunk):
    if not COMMON:
        plain(T.Coder(A, B), " a")
    coder = COMMON[0]
    want = plain(coder, text)
    for f in [coder.range(text)] + [whole(coder, text, chunk)] * bool(text):
        got = T._answer(f)
        assert (*got[:4], Counter({(c >> 20, c & (1 << 20) - 1): n for c, n in zip(got[4].tolist(), got[5].tolist())}), got[6]) == want


def whole(coder, text, chunk):
    out = T.Fragment()
    for r in T.ranges(coder.cut(text), chunk):
        f = coder.range(*r)
        if f is None:
            return None
        out = out.then(f)
    return out


def same(x, y):
    flat = lambda f: [v.tolist() if isinstance(v, np.ndarray) else v for v in T._packed(f)]
    return flat(x) == flat(y)


def test_fragments_join_in_any_nesting(coder):
    rng = random.Random(5)
    text = "".join(rng.choice(["the ", "of", "日本", "é", " tion", "\n", "qx"]) for _ in range(400))
    spelled, (a, b) = f" {text}".encode(), ends(coder, text)
    for chunk in (1, 3, 17, 64, 1000):  # ranges that leave groups open on both sides
        sides = [[[(e, i) for e, i in side if lo < e <= lo + chunk] for side in (a, b)] for lo in range(0, len(spelled), chunk)]
        parts = [T.fragment(*(np.array([t[n] for t in side], np.int64) for side in own for n in (1, 0))) for own in sides]
        want = T.Fragment()
        for p in parts:
            want = want.then(p)
        for _ in range(3):
            row = list(parts)
            while len(row) > 1:
                i = rng.randrange(len(row) - 1)
                row[i : i + 2] = [row[i].then(row[i + 1])]
            assert same(row[0], want) and same(T.Fragment().then(want), want) and same(want.then(T.Fragment()), want)
        assert hashlib.sha256(want.whole().text.encode()).hexdigest() == plain(coder, text)[5]


def test_large_groups(coder):
    a, b = np.arange(100) % 7, np.arange(90) % 5
    got = T.one(a, b)
    assert dict(zip(got.pairs.tolist(), got.times.tolist())) == Counter((x << 20) + y for x in a.tolist() for y in b.tolist())
    assert got.links == 9000 and got.text == ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def test_counts_over_all_rows_and_long_texts(spark, coder):
    rng = random.Random(2)
    words = ["the", "thing", "überlänge", "eaux", "日本語", "x" * 700, "a\nb", " ", "don't", "1234"]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 300)))) for i in range(40)]
    rows += [(100, rows[-1][1]), (None, "the thing"), (None, None), (100, rows[-1][1]), (7, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row long, n_a long")
    said = [plain(coder, t) for _, t in rows]
    held = Counter(p for x in said for p in x[4])
    most: dict = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    want = sorted((str(k), *x[:4], sum(m for p, m in x[4].items() if held[p] == most[p[0]]), sum(m * held[p] for p, m in x[4].items()), x[5]) for (k, _), x in zip(rows, said))
    for long, chunk in ((1 << 20, 1 << 18), (50, 64)):
        got = T.linked(df, "doc_id", "text", A, B, long, chunk).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert T.linked(df.limit(0), "doc_id", "text", A, B).collect() == []
