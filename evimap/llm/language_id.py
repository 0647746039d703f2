"""Language by compression: the raw-content dictionary that makes a text smallest names its language.

One zstandard raw-content dictionary per language is cut from a bounded sample
of pieces of labelled texts (``dictionary_bytes`` for each language).  A text is
encoded in blocks of ``BLOCK`` bytes, each against the fresh dictionaries, so
what a dictionary saves grows with the text.  Its language is that of the
smallest sum of encodings; ties go to the language with more labelled texts,
then by name.  Letter case is folded first.  ``score`` is the relative margin
(second - best) / second of the sums.  A text of any length whose margin is
under ``min_margin`` is rejected.  Null, empty and letterless texts are ``und``,
score 0, rejected.  With no labelled text at all, every text is ``und``.
"""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H

DICTIONARY_BYTES = 48_000
MIN_MARGIN, BLOCK = 0.01, 4096
#: A dictionary is made of so many pieces at least: whole short texts and slices of long ones.
PIECES = 128
UNKNOWN = "und"
LEVEL = 6
_LETTER = regex.compile(r"\p{L}")


def fit(df: DataFrame, text: str, lang: str, key: str, where: Column, dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """Dictionaries, commonest language first, of each language with a labelled text that is not empty.

    The sample is bounded: every labelled text counts as pieces of at most about
    ``dictionary_bytes / PIECES`` bytes, and pieces are taken whole in the order
    of a hash of ``key``, text and place until the bytes are full.
    """
    rows = df.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.octet_length(text).alias("size"), F.xxhash64(key, text).alias("own")).where("size > 0")
    rows = rows.withColumn("of", F.ceil(F.col("size") / max(1, dictionary_bytes // PIECES)).cast("int"))
    hashes = F.transform(F.sequence(F.lit(0), F.col("of") - 1), lambda i: F.struct(i.alias("place"), F.xxhash64("own", i).alias("h")))
    first = F.array_min(F.transform(hashes, lambda x: x["h"]))
    sizes = {r.lang: r for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min(first).alias("first")).collect()}
    if not sizes:
        return []
    known = lambda value: F.create_map(*(F.lit(x) for name, r in sizes.items() for x in (name, value(r))))[F.col("lang")]
    share, least = known(lambda r: int(min(1.0, 2 * dictionary_bytes / r["size"]) * (1 << 40))), known(lambda r: r["first"])
    rows = rows.withColumns({"share": share, "least": least, "width": F.ceil(F.char_length("text") / F.col("of")).cast("int")})
    chosen = F.filter(hashes, lambda x: (F.pmod(x["h"], F.lit(1 << 40)) < F.col("share")) | (x["h"] == F.col("least")))
    cut = F.transform(chosen, lambda x: F.struct(x["h"].alias("h"), F.substring("text", x["place"] * F.col("width") + 1, F.col("width")).alias("text")))
    found: dict[str, list] = {name: [] for name in sizes}
    for r in rows.select("lang", F.explode(cut).alias("x")).select("lang", "x.*").distinct().collect():
        found[r.lang].append((r.h, r.text.lower().encode()))
    out = []
    for name in sorted(sizes, key=lambda x: (-sizes[x].n, x)):
        blob = b""
        for _, t in sorted(set(found[name])):
            if len(blob) + len(t) < dictionary_bytes:
                blob += t + b"\n"
        out.append((name, blob))
    return [(name, blob.ljust(8, b"\n")) for name, blob in out if blob.strip()]


def predict(df: DataFrame, text: str, dictionaries: list[tuple[str, bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``rejected`` to all rows and columns, in place of columns so named; narrow."""
    df = H.without(df, "lang_pred", "score", "rejected")
    H.small_batches(df.sparkSession)
    names = [n for n, _ in dictionaries]
    blobs = df.sparkSession.sparkContext.broadcast([b for _, b in dictionaries])
    place, columns = df.columns.index(text), df.columns

    def run(batches):
        coders = []
        for blob in blobs.value:
            own = zstandard.ZstdCompressionDict(blob, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=False, write_dict_id=False, write_content_size=False).compress)
        for batch in batches:
            langs, scores, out = [], [], []
            for t in batch.column(place).to_pylist():
                if t is None or not coders or not _LETTER.search(t):
                    langs.append(UNKNOWN), scores.append(0.0), out.append(True)
                    continue
                raw = t.lower().encode()
                blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
                sizes = [sum(map(len, map(c, blocks))) for c in coders]
                best = min(sizes)
                at = sizes.index(best)
                second = min((s for i, s in enumerate(sizes) if i != at), default=None)
                margin = 1.0 if second is None else (second - best) / second
                langs.append(names[at]), scores.append(margin), out.append(margin < min_margin)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(out, pa.bool_())], [*columns, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
