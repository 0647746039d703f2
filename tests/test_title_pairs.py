"""Pairs of word sets that cannot be alike are dropped where they meet; those that are alike all stay."""

import itertools
import random

from evimap.operators import resolve


def test_few_pairs_are_looked_up(spark, monkeypatch):
    rng, seen = random.Random(5), []
    pool = [f"word{i:03d}" for i in range(60)]
    texts = [" ".join(rng.sample(pool, rng.randint(4, 14))) for _ in range(240)]
    texts += [" ".join([*t.split()[1:], "other"]) for t in texts[:60]]
    rows = resolve.titles(spark.createDataFrame(list(enumerate(texts)), "id long, title string"), "id", "title")
    exact = resolve._alike

    def counted(pairs, *how):
        seen.append(pairs.count())
        return exact(pairs, *how)

    monkeypatch.setattr(resolve, "_alike", counted)
    sets = [frozenset(t.split()) for t in texts]
    for least, half in ((0.5, True), (0.2, False)):
        want = {(a, b) for a, b in itertools.product(set(sets), repeat=2) if len(a & b) / len(a | b) >= least and (not half or len(a & b) >= max(2, len(a) // 2))}
        got = [(frozenset(r.w_l), frozenset(r.w_r)) for r in resolve.word_set_pairs(rows, rows, least, half).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        assert seen.pop() < 1.5 * len(want)
