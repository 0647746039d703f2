import hashlib
import random

from evimap.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, k string, thash string"


def brute(rows, window):
    places = {}
    for i, (_, text, *_) in enumerate(rows):
        raw = (text or "").encode()
        for s in range(len(raw) - window + 1):
            places.setdefault(raw[s : s + window], []).append((i, s))
    gone = [set() for _ in rows]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                gone[i].update(range(s, s + window))
    out = []
    for (doc, text, *_), g in zip(rows, gone):
        raw = (text or "").encode()
        kept = bytes(b for j, b in enumerate(raw) if j not in g)
        out.append((doc, len(raw), len(g), sum(j - 1 not in g for j in g), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(20, 90)) for _ in range(8)]
    rows = []
    for i in range(150):
        kind = rng.random()
        text = prose(rng.randint(0, 120))
        if kind < 0.5:
            for _ in range(rng.randint(1, 3)):
                cut = rng.randint(0, 30)
                text += rng.choice(passages)[cut:] + prose(rng.randint(0, 20))
        elif kind < 0.6 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.7 and rows:
            text = (rng.choice(rows)[1] or "x")
            at = rng.randint(0, len(text))
            text = text[:at] + "#" + text[at:]
        rows.append((i, text, "a", "b"))
    period = "xyz" * 200
    return [*rows, (900, None, None, None), (901, "", "", ""), (902, period, "a", "b"), (903, "q" * 700, "a", "b"), (None, prose(400), "a", "b"), (None, passages[0] * 2, "a", "b"), (5, rows[5][1], "a", "b"), (6, "other " + prose(60), "a", "b")]


def test_against_brute_force(spark):
    rows = corpus()
    got = S.removed(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 200)


def test_small_window(spark):
    rows = corpus(4)
    got = S.removed(spark.createDataFrame(rows, SCHEMA).repartition(3), window=50, gram=16).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 50)


def test_empty_table(spark):
    assert S.removed(spark.createDataFrame([], SCHEMA)).collect() == []


def test_merge_keeps_order_and_prefixes():
    rng = random.Random(1)
    runs = []
    for _ in range(7):
        own = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 40)))
        runs.append((own, [0, *(S.common(a, b, 0) for a, b in zip(own, own[1:]))][: len(own)]))
    run, place, shared = S.merge_runs(runs)
    merged = [runs[r][0][p] for r, p in zip(run, place)]
    assert merged == sorted(x for own, _ in runs for x in own)
    assert shared[1:] == [S.common(a, b, 0) for a, b in zip(merged, merged[1:])]
