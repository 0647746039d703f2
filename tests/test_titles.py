"""Title matches against loops over all pairs, under skew, and the chain of new records against one after the other."""

import random
import re
import time

from evimap.operators import resolve


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(t):
    return {w for w in re.split(r"\W+", t) if len(w) >= 4}


def like(a, b, least, shared_half):
    """Similarity of b to a if their words are alike enough, else -1."""
    x, y = words(a), words(b)
    if not x or not y or shared_half and len(x & y) < max(2, len(x) // 2) or len(x & y) / len(x | y) < least:
        return -1
    return 1 - distance(a, b) / max(len(a), len(b))


def some_titles(rng, n):
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            t = list(rng.choice(out))
            for _ in range(rng.randint(1, 4)):
                t[rng.randrange(len(t))] = rng.choice("abcd e")
            out.append(" ".join("".join(t).split()))
        else:
            out.append(" ".join(rng.choice(["early", "goal", "directed", "trial", "septic", "shock", "of", "überlang", f"n{rng.randrange(9)}"]) for _ in range(rng.randint(1, 7))))
    return [t for t in out if t]


def test_best_titles(spark):
    rng = random.Random(6)
    a, b = some_titles(rng, 150), some_titles(rng, 150)
    left, right = [(i, t) for i, t in enumerate(a)], [(1000 + i, t) for i, t in enumerate(b + a[:20])]
    dfs = [spark.createDataFrame(x, "id long, title string") for x in (left, right)]
    for least, shared_half, least_similarity, find in ((0.5, True, 0.85, resolve.fuzzy_title_matches), (0.2, False, -1, resolve.nearest_titles)):
        want = set()
        for i, t in left:
            found = [(-like(t, u, least, shared_half), j) for j, u in right if like(t, u, least, shared_half) >= max(0, least_similarity)]
            if found:
                want.add((i, min(found)[1], round(-min(found)[0], 9)))
        assert {(r.left_id, r.right_id, round(r.similarity, 9)) for r in find(*dfs, "id", "id", "title", "title").collect()} == want


def test_one_common_word(spark):
    rows = spark.range(1500).selectExpr("id", "concat('chapter ', id) title")
    resolve.nearest_titles(rows.limit(5), rows, "id", "id", "title", "title").collect()
    began = time.time()
    got = resolve.nearest_titles(rows, rows.selectExpr("id + 10000 id", "title"), "id", "id", "title", "title").collect()
    assert sorted((r.left_id, r.right_id) for r in got) == [(i, 10000 + i) for i in range(1500)] and time.time() - began < 15
    odd, even = rows.where("id % 2 = 1"), rows.where("id % 2 = 0")
    got = {r.left_id: r.right_id for r in resolve.nearest_titles(odd, even, "id", "id", "title", "title").collect()}
    for i in (1, 77, 431, 1499):
        assert got[i] == min((distance(str(i), str(j)) / max(len(f"chapter {i}"), len(f"chapter {j}")), j) for j in range(0, 1500, 2))[1]
    # word sets meet, not titles: one pair here
    sets = resolve.titles(rows.where("id < 1000"), "id", "title")
    assert resolve.word_set_pairs(sets, sets, 0.2, shared_half=False).count() == 1


def test_chain_is_that_of_a_loop(spark):
    rng = random.Random(9)
    own = some_titles(rng, 260)
    rows = [(i, t if rng.random() > 0.05 else None) for i, t in enumerate(own + rng.sample(own, 60))]
    stays, links, index = [], set(), {}
    for i, t in rows:
        if not t:
            stays.append(i)
        elif t in index:
            links.add((i, index[t]))
        else:
            found = [(-like(t, u, 0.5, True), j) for u, j in index.items() if like(t, u, 0.5, True) >= 0.85]
            if found:
                links.add((i, min(found)[1]))
            else:
                stays.append(i)
                index[t] = i
    kept, crosswalk = resolve.chained(spark.createDataFrame(rows, "id long, title string").repartition(3), "id", "title")
    assert sorted(r.id for r in kept.collect()) == stays
    assert {(r.left_id, r.right_id) for r in crosswalk.collect()} == links and len(links) > 80
    kept, crosswalk = resolve.chained(spark.createDataFrame([], "id long, title string"), "id", "title")
    assert kept.collect() == crosswalk.collect() == []
