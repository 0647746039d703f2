import random

import corpus_pipeline
from evimap.llm import queries


def test_near_copies_share_no_bin(spark, tmp_path):
    rng, rows = random.Random(8), []
    for i in range(40):
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(100)]
        rows += [(2 * i, " ".join(words), "en", f"s{i}", 0), (2 * i + 1, " ".join(words[:50] + ["changed"] + words[51:]) + " ", "en", f"t{i}", 0)]
    rows += [(1000 + i, text, None, None, 0) for i, text in enumerate([None, None, "", "", " "])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_best_fit_packing(spark, str(tmp_path)).collect()
    bins = {r.doc_id: r.bin_id for r in got}
    assert len(got) == len(bins) == len(rows)
    assert not [i for i in range(40) if bins[2 * i] == bins[2 * i + 1]]
    assert len({bins[1000 + i] for i in range(5)}) == 1
    assert sorted(map(tuple, corpus_pipeline.sequences(spark, df, str(tmp_path)).collect())) == sorted(map(tuple, got))
