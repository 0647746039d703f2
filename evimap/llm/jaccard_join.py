"""Exact Jaccard join of word-shingle sets with adaptive multi-match prefixes.

Shingles are ordered by estimated document frequency, rarest first.  A set of n
shingles that must overlap in at least t(n) has a prefix of n - t(n) + m of
them; two linked sets share at least min(m) shingles of their prefixes.  ``m``
is chosen for each set so that the longer prefix costs less than the candidates
it saves, by the frequencies of its shingles.  Frequencies come from a sketch
of fixed size over all texts; they order and tune, and never decide a link.

Equal sets form a class before the join.  Each shared shingle first pairs its
classes with the most typical one; after the verified links are merged, only
pairs of classes that share a shingle, are still in different components and
can be alike by sizes, places and dead shingles are counted and verified.  So no
group of near copies is expanded into pairs, and no link between components is
missed.  Sets are told apart by
64-bit shingle hashes, and classes by 64 bits of their digest.

Null, empty and blank texts have no shingles and are alone; a text of fewer
words than a shingle is one shingle.  Rows that repeat a key are separate rows.
Null keys sort last: a component's id is its smallest key, null if it has none.
Keys can be of any type that has an order.  Only the columns named are read, and
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H
from evimap.llm.components import components, settle

#: Counters of the frequency sketch, and the blocks in which they are added up.
COUNTERS, BLOCKS = 1 << 20, 64
#: Bits of the filter of texts to verify.
MARKS = 1 << 26
#: Cost of one candidate over that of one more prefix shingle; factor by which one more match thins candidates out.
VERIFY, THINNING = 20.0, 4.0
#: Sets of SURE_SIZE or more need at least MATCHES matches (or as many as they must share).
MATCHES, SURE_SIZE = 8, 16


def frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """Estimated document frequency by ``hash % COUNTERS``; what reaches the driver has a fixed size."""

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for lo, hi, data, offsets in H.slabs(batch.column(0)):
                own, _ = H.distinct_by_row(*H.shingle_hashes(*H.word_hashes(data, offsets), words), hi - lo)
                total += np.bincount((own % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        parts = total.reshape(BLOCKS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([x.tobytes() for x in parts.astype(np.int32)], pa.binary())], ["block", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS // BLOCKS, np.int64)
        for x in table["counts"]:
            total += np.frombuffer(x.as_py(), np.int32)
        return pa.table({"block": table["block"][:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = texts.mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary").collect()
    out = np.zeros((BLOCKS, COUNTERS // BLOCKS), np.int64)
    for r in parts:
        out[r.block] = np.frombuffer(r.counts, np.int64)
    return out.ravel()


def prefix_size(costs: np.ndarray, size: int, least: int) -> tuple[int, int]:
    """Prefix length and matches needed, for shingles in order with their candidate costs."""
    base = size - least + 1
    spread = float(costs[:base].sum())
    matches = np.arange(min(MATCHES, least) if size >= SURE_SIZE else 1, least + 1)
    total = base + matches - 1 + VERIFY * spread / THINNING ** np.minimum(matches - 1, 60)
    best = int(matches[np.argmin(total)])
    return base + best - 1, best


def sets(df: DataFrame, words: int, share: int, counts: np.ndarray) -> DataFrame:
    """Class (digest of the set), size, matches needed and prefix of each text of ``df`` (k, r, text)."""
    shared = df.sparkSession.sparkContext.broadcast(counts.astype(np.float32))

    def run(batches):
        table = shared.value
        for batch in batches:
            digest, sizes, needed, prefixes = [], [], [], []
            for lo, hi, data, offsets in H.slabs(batch.column(2)):
                own, first = H.distinct_by_row(*H.shingle_hashes(*H.word_hashes(data, offsets), words), hi - lo)
                cost = table[(own % np.uint64(COUNTERS)).astype(np.int64)]
                for a, b in zip(first.tolist(), first[1:].tolist()):
                    n, h = b - a, own[a:b]
                    sizes.append(n)
                    if not n:
                        digest.append(0), needed.append(0), prefixes.append(np.zeros(0, np.int64))
                        continue
                    order = np.lexsort((h, cost[a:b]))
                    length, m = prefix_size(cost[a:b][order], n, -(-share * n // 100))
                    digest.append(int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "big", signed=True)), needed.append(m), prefixes.append(h[order[:length]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digest, pa.int64()), pa.array(sizes, pa.int32()), pa.array(needed, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["k", "r", "c", "n", "m", "prefix"],
            )

    kind = df.schema["k"].dataType.simpleString()
    return df.mapInArrow(run, f"k {kind}, r long, c long, n int, m int, prefix array<bigint>")


def enough(share: int) -> Column:
    """Whether ``met`` common prefix shingles of two classes leave room for a link."""
    overlap = F.expr(f"cast(ceil({share} * (cast(n_a as bigint) + n_b) / {100 + share}) as bigint)")
    rest = F.greatest(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
    return (F.col("met") >= F.least("m_a", "m_b")) & (F.col("met") + rest >= overlap)


def live_classes(classes: DataFrame, share: int) -> DataFrame:
    """Classes with their prefix shingles that other classes have too: c, n, m, p, gone, at (places in the prefix), s.

    A prefix shingle of one class only is dead.  A partner shares at least as
    many prefix shingles as both need, so its prefix reaches past the last of
    them; dead shingles before that one cannot be anywhere in the partner.
    ``gone`` counts them.  Classes that share too few are left out.
    """
    postings = classes.select("c", "n", "m", F.size("prefix").alias("p"), F.posexplode("prefix").alias("at", "s"))
    alive = postings.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("s")
    own = postings.join(alive, "s").groupBy("c").agg(*(F.first(v).alias(v) for v in ("n", "m", "p")), F.array_sort(F.collect_list(F.struct("at", "s"))).alias("live"))
    partner = f"cast(ceil({share} * cast(n as bigint) / 100) as bigint)"
    must = F.expr(f"if({partner} >= {SURE_SIZE}, least({MATCHES}, cast(ceil({share} * {partner} / 100) as bigint)), 1)")
    own = own.withColumn("must", must.cast("int")).where(F.size("live") >= F.col("must"))
    return own.select("c", "n", "m", "p", F.expr("element_at(live, must).at - must + 1").alias("gone"), F.col("live.at").alias("at"), F.col("live.s").alias("s"))


def postings(own: DataFrame) -> DataFrame:
    """One row for each live shingle (s) of each class, with its place and the live shingle before it."""
    rows = own.select("c", "n", "m", "p", "gone", "at", F.col("s").alias("every"), F.posexplode("s").alias("k", "s"))
    return rows.select("c", "n", "m", "p", "gone", "s", F.expr("at[k]").alias("at"), F.expr("if(k > 0, every[k - 1], null)").alias("before"))


def possible(share: int) -> str:
    """Whether sizes and shingles known to be gone on both sides allow a link."""
    most = "least(n_a - gone_a, n_b - gone_b)"
    return f"100L * {most} >= {share}L * (n_a + n_b - {most})"


def first_shared(share: int) -> str:
    """Whether a shingle can be the first that two linked classes share.

    All they share then stands at its place or after it, on both sides.  Where
    both have the same live shingle before it, they share that one.
    """
    room = " and ".join(f"{100 + share}L * (n_{x} - at_{x}) >= {share}L * (n_a + n_b)" for x in "ab")
    return f"{room} and not coalesce(before_a = before_b, false)"


def side(rows: DataFrame, x: str) -> DataFrame:
    return rows.select("s", F.col("c").alias(x), *(F.col(v).alias(f"{v}_{x}") for v in ("n", "gone", "at", "before", "label")))


def marks(ids: DataFrame) -> np.ndarray:
    """Bits of ``MARKS`` places, set where one of ``ids`` (r bigint) falls; what reaches the driver has a fixed size."""
    width = MARKS // BLOCKS

    def put(table: pa.Table) -> pa.Table:
        own = np.zeros(width, bool)
        own[table["r"].to_numpy().view(np.uint64) // np.uint64(BLOCKS) % np.uint64(width)] = True
        return pa.table({"block": table["block"][:1], "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    parts = ids.select(F.pmod("r", F.lit(BLOCKS)).cast("int").alias("block"), "r").groupBy("block").applyInArrow(put, "block int, bits binary").collect()
    out = np.zeros((BLOCKS, width // 8), np.uint8)
    for r in parts:
        out[r.block] = np.frombuffer(r.bits, np.uint8)
    return out


def marked(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = ids.view(np.uint64) // np.uint64(BLOCKS) % np.uint64(MARKS // BLOCKS)
    return (bits[np.mod(ids, BLOCKS), (at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """The pairs of classes whose sets are alike enough, by intersection.

    Sets are made again from the texts that stand for the classes of ``pairs``;
    a filter of fixed size keeps most other texts from being hashed and sent.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(classes.select("c", "r"), "c").select("r")
    shared = texts.sparkSession.sparkContext.broadcast(marks(needed))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(marked(batch.column(0).to_numpy(), shared.value)))
            for lo, hi, data, offsets in H.slabs(batch.column(1)):
                own, first = H.distinct_by_row(*H.shingle_hashes(*H.word_hashes(data, offsets), words), hi - lo)
                items = [own[a:b].tobytes() for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(items, pa.binary())], ["r", "items"])

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= share * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    items = texts.select("r", "text").mapInArrow(run, "r long, items binary")
    ends = pairs.join(classes.select(F.col("c").alias("a"), F.col("r").alias("ra")), "a").join(classes.select(F.col("c").alias("b"), F.col("r").alias("rb")), "b")
    left = ends.join(items.select(F.col("r").alias("ra"), F.col("items").alias("x")), "ra")
    both = left.join(items.select(F.col("r").alias("rb"), F.col("items").alias("y")), "rb").select("a", "b", "x", "y")
    return both.mapInArrow(check, "a long, b long").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, share: int = 80) -> DataFrame:
    """One row for each input row: ``key``, n_shingles, component_id, class_size, row_hash, label.

    Two rows link when 100 * intersection >= ``share`` * union of their sets of
    ``words``-word shingles.  ``class_size`` counts the rows with an equal set,
    ``row_hash`` is xxhash64 of key and text, and ``label`` numbers the
    components (null for rows without shingles).
    """
    H.small_batches(df.sparkSession)
    texts = df.select(F.col(key).alias("k"), F.xxhash64(key, text).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = settle(sets(texts, words, share, frequencies(texts.select("text"), words)))
    alike = rows.where("n > 0").groupBy("c")
    classes = settle(alike.agg(F.first("n").alias("n"), F.first("m").alias("m"), F.first("prefix").alias("prefix"), F.min("r").alias("r"), F.min("k").alias("k"), F.count("*").alias("class_size")))

    own = settle(live_classes(classes, share))
    live = postings(own)
    first = live.groupBy("s").agg(F.min(F.struct("gone", "c", "n", "m", "p")).alias("x"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    heads = first.select("s", *(F.col(f"x.{v}").alias(f"{v}_x") for v in ("c", "gone", "n", "m", "p")))
    stars = live.join(heads, "s").where("c <> c_x")
    swap = lambda v, x: F.when(F.col("c") < F.col("c_x"), F.col(v if x == "a" else f"{v}_x")).otherwise(F.col(f"{v}_x" if x == "a" else v))
    stars = stars.select(swap("c", "a").alias("a"), swap("c", "b").alias("b"), *(swap(v, x).alias(f"{v}_{x}") for v in ("n", "m", "p", "gone") for x in "ab"))
    counted = stars.where(possible(share)).groupBy("a", "b").agg(F.count("*").alias("met"), *(F.max(f"{v}_{x}").alias(f"{v}_{x}") for v in ("n", "m", "p") for x in "ab"))
    tried = settle(counted.where(enough(share)).select("a", "b"))
    links = settle(verified(tried, classes, texts, words, share))

    joined = live.join(components(links).withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    mixed = joined.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("s")
    joined = settle(joined.join(mixed, "s"))
    apart = side(joined, "a").join(side(joined, "b"), "s").where(f"a < b and label_a <> label_b and {possible(share)} and {first_shared(share)}")
    apart = apart.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    for x in "ab":
        apart = apart.join(own.select(F.col("c").alias(x), *(F.col(v).alias(f"{v}_{x}") for v in ("n", "m", "p", "s"))), x)
    more = settle(apart.withColumn("met", F.size(F.array_intersect("s_a", "s_b"))).where(enough(share)).select("a", "b"))
    whole = components(links.unionByName(verified(more, classes, texts, words, share)))

    labels = classes.select("c", "k", "class_size").join(whole.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    ids = labels.groupBy("label").agg(F.min("k").alias("component_id"))
    named = labels.join(ids, "label").select("c", "component_id", "class_size", "label")
    out = rows.select("k", "r", "c", "n").join(named, "c", "left")
    return out.select(
        F.col("k").alias(key), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("k")).alias("component_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), F.col("r").alias("row_hash"), F.when(F.col("n") > 0, F.col("label")).alias("label"),
    )


#: The contract's columns for the table ``documents`` (words of three, 90 of 100): every pair that shares a shingle is counted.
LINKS_SQL = r"""
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
g as (select doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end)) s from t),
c as (select doc_id, s, len(s) n, min(doc_id) over (partition by s) c from g),
x as (select doc_id c, n, unnest(s) s from c where doc_id = c and n > 0),
p as (select a.c a, b.c b, any_value(a.n) n, any_value(b.n) m, count(*) k from x a join x b on a.s = b.s and a.c <> b.c group by 1, 2),
e as (select a, b from p where 100 * k >= 90 * (n + m - k)),
r as (select c a, c b from x group by 1 union select r.a, e.b from r join e on e.a = r.b),
l as (select a, min(b) label from r group by 1)
select doc_id, cast(n as bigint) n_shingles, case when n = 0 then doc_id else label end component_id from c left join l on l.a = c.c
"""
