"""Word sets meet in blocks of both sides, long sets as well; distances are those of the plain table."""

import itertools
import random

from evimap.operators import edits, resolve, word_blocks
from test_titles import distance


def test_long_sets_that_are_not_alike_are_not_looked_up(spark, monkeypatch):
    """256 bits said of two sets of 150 words that they could be alike, whatever they had in common."""
    rng, seen = random.Random(8), []
    pool = [f"word{i:04d}" for i in range(3000)]
    texts = [" ".join(rng.sample(pool, rng.randint(130, 170))) for _ in range(120)]
    texts += [" ".join([*t.split()[:60], *rng.sample(pool, 90)]) for t in texts[:20]]
    rows = resolve.titles(spark.createDataFrame(list(enumerate(texts)), "id long, title string"), "id", "title")
    exact = resolve._alike

    def counted(pairs, *how):
        seen.append(pairs.count())
        return exact(pairs, *how)

    monkeypatch.setattr(resolve, "_alike", counted)
    sets = {frozenset(t.split()) for t in texts}
    want = {(a, b) for a, b in itertools.product(sets, repeat=2) if len(a & b) / len(a | b) >= 0.2}
    got = [(frozenset(r.w_l), frozenset(r.w_r)) for r in resolve.word_set_pairs(rows, rows, 0.2, False).collect()]
    assert len(got) == len(set(got)) and set(got) == want and seen[0] < 1.2 * len(want)


def test_many_blocks(spark, monkeypatch):
    rng = random.Random(3)
    sets = [sorted(rng.sample("abcdefghijklmnop", rng.randint(1, 9))) for _ in range(300)]
    left, right = ([(i, w) for i, w in enumerate(x)] for x in (sets[:180], sets[120:]))
    monkeypatch.setattr(word_blocks, "WORDS", 120)
    assert word_blocks.grid(900, 890, 4) == (8, 8) and word_blocks.grid(10, 10, 8) == (1, 1)
    dfs = [spark.createDataFrame(x, "set long, w array<string>") for x in (left, right)]
    for least, half in ((0.2, False), (0.5, True), (1.0, False)):
        like = lambda a, b: len(a & b) / len(a | b) >= least and (not half or len(a & b) >= max(2, len(a) // 2))
        want = sorted((i, j) for i, a in left for j, b in right if like(set(a), set(b)))
        got = [tuple(r) for r in word_blocks.pairs(*dfs, least, half).collect()]
        assert len(got) == len(set(got)) and set(got) >= set(want) and len(got) < 1.2 * len(want)
    assert word_blocks.pairs(dfs[0].limit(0), dfs[1], 0.2, False).collect() == []


def test_distances():
    rng = random.Random(4)
    for _ in range(1500):
        a = "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 150)))
        b = list(a) if rng.random() < 0.6 else [rng.choice("abcé ") for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 9)):
            b.insert(rng.randint(0, len(b)), rng.choice("abü"))
        b, limit = "".join(b), rng.randint(0, 150)
        d = distance(a, b)
        assert edits.distance(a, b, limit) == (d if d <= limit else -1)
