import random
import re

import pytest

from evimap.llm import jaccard_join as J
from evimap.llm.components import components

SCHEMA = "doc_id long, text string, c string, label string"


def brute(rows, words, share):
    sets = []
    for _, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, texts = prose(40), []
    for _ in range(60):
        texts.append(prose(rng.choice([0, 1, 2, 3, 5, 8, 20, 60, 150])) + (passage if rng.random() < 0.3 else []))
    for i in range(110):  # near copies, also of near copies
        w = list(texts[rng.randrange(len(texts))] if i < 60 else texts[-1])
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(w)
    rows = [(i, " ".join(t).upper() if i % 7 == 0 else " \t".join(t), "x", "y") for i, t in enumerate(texts)]
    return [*rows, (500, None, None, None), (501, "", "", ""), (502, " \n\t", "", ""), (None, rows[5][1], "", ""), (None, "only here", "", ""), (7, rows[7][1], "", ""), (8, "quite another text than eight", "", ""), (503, "word " * 3000, "", "")]


@pytest.mark.parametrize(("seed", "words", "share"), [(1, 3, 90), (2, 5, 80), (3, 1, 50)])
def test_against_brute_force(spark, seed, words, share):
    rows = corpus(seed)
    got = J.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), words=words, share=share).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, words, share)


def test_empty_table(spark):
    assert J.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_path(spark):
    rng = random.Random(5)
    nodes = rng.sample(range(10_000), 200)
    links = [(a, b) for a, b in zip(nodes[:120], nodes[1:120])] + [(nodes[150], nodes[150]), (nodes[160], nodes[161]), (nodes[161], nodes[160])]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{n: min(nodes[:120]) for n in nodes[:120]}, nodes[160]: min(nodes[160:162]), nodes[161]: min(nodes[160:162])}
