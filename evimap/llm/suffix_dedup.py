"""Removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a string of ``window`` bytes that covers it also starts anywhere
else, in the same text or another.  Strings never cross texts and are judged on
the input.

1. Equal texts are grouped; of each group one stands for all as "elsewhere".
2. Every window has an anchor, its least ``gram``-byte hash (leftmost on ties),
   so equal windows have equal anchors at equal offsets.  Anchor hashes are
   exchanged in packed blocks; those met once cannot belong to a repeat.
3. Each task sorts the suffixes at its remaining anchors (cut where their
   windows end) and sends them as front-coded runs, dealt by anchor hash.
   The receiver merges the runs with a loser tree that keeps, for each player,
   the prefix known to be shared with the last winner, and compares from there.
4. In the merged order, suffixes with a common prefix of r bytes are neighbours
   with no smaller value between them; together with a 64-bit hash of the
   bytes left of the anchor this tells for each offset which windows are equal.

Null and empty texts count as empty and lose nothing; texts under ``window``
bytes lose nothing; equal texts of ``window`` bytes or more lose everything, as
do rows that repeat one another.  A null key is a value of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evimap.llm import hashing as H

WINDOW, GRAM = 200, 64
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: Anchors that a task holds before it sends them on.
_HELD = 2_000_000


def anchors(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchors of all windows of the rows: row, position in the row, hash, and the offsets lo..hi of the windows that start so far before it."""
    reach = window - gram + 1
    grams = H.gram_hashes(H.running(data), gram)
    none = np.zeros(0, np.int64)
    if len(grams) < reach:
        return {"row": none, "pos": none, "hash": none.astype(np.uint64), "lo": none, "hi": none}
    least, size = ((grams >> np.uint64(32)) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64), 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)[: len(at)]
    start = np.flatnonzero(np.arange(len(at)) + window <= offsets[row + 1])
    at = at[start]
    if not len(at):
        return {"row": none, "pos": none, "hash": none.astype(np.uint64), "lo": none, "hi": none}
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    p = at[first]
    return {"row": row[start[first]], "pos": p - offsets[row[start[first]]], "hash": grams[p], "lo": p - start[last], "hi": p - start[first]}


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    while known < end and a[known : known + 16] == b[known : known + 16]:
        known += 16
    known = min(known, end)
    while known < end and a[known] == b[known]:
        known += 1
    return known


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs, each with its strings and their common prefixes with the one before.

    Returns, in merged order, the run and the place in it of each string, and
    its common prefix with the string before.  Bytes known to be shared with
    the last winner are never compared again.
    """
    k = 1 << max(0, (len(runs) - 1).bit_length())
    runs = runs + [([], [])] * (k - len(runs))
    place = [0] * k
    head = [s[0] if s else b"" for s, _ in runs]
    shared = [0 if s else -1 for s, _ in runs]  # with the last winner; -1: nothing left

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = shared[a], shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = head[a], head[b]
        n = common(s, t, x)
        if n == len(s) or n < len(t) and s[n] < t[n]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    loser, winners = [0] * k, list(range(k))
    width = k
    while width > 1:
        above = []
        for i in range(0, width, 2):
            won, lost = play(winners[i], winners[i + 1])
            loser[(width + i) // 2] = lost
            above.append(won)
        winners, width = above, width // 2
    top = winners[0]
    out_run, out_place, out_shared = [], [], []
    while shared[top] >= 0:
        at = place[top]
        out_run.append(top), out_place.append(at), out_shared.append(shared[top])
        strings, prefixes = runs[top]
        place[top] = at = at + 1
        if at < len(strings):
            head[top], shared[top] = strings[at], prefixes[at]
        else:
            shared[top] = -1
        node = (k + top) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2
    return out_run, out_place, out_shared


def equal_windows(shared: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: np.ndarray, left_end: np.ndarray, window: int) -> np.ndarray:
    """For each suffix in merged order and each offset, whether its window equals another's."""
    n, deepest = len(lo), int(hi.max(initial=0))
    found = np.zeros((n, deepest + 1), bool)
    before = np.zeros(n, np.uint64)
    for o in range(deepest + 1):
        if o:
            grow = np.flatnonzero(hi >= o)
            before[grow] = before[grow] * np.uint64(H._BASE) + H._TABLE[left[left_end[grow] - o]]
        own = np.flatnonzero((lo <= o) & (hi >= o))
        if len(own) < 2:
            continue
        group = np.cumsum(shared < window - o).astype(np.uint64)[own]
        key = H.mix(before[own] + H.mix(group))
        order = np.argsort(key)
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(own), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found[own[order[twice]], o] = True
    return found


def _blocks(spark: SparkSession, size: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // 16_000_000), 1)


def repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Rows (key, its hash k, thash, sha, n_bytes, copies) and the repeated windows (k, thash, first, last start)."""
    spark = df.sparkSession
    H.small_batches(spark)
    base = df.select(F.col(key).alias("key"), F.xxhash64(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.withColumns({"thash": F.xxhash64("text"), "sha": F.sha2("text", 256), "n_bytes": F.octet_length("text").cast("long")})
    long_rows = base.where(F.col("n_bytes") >= window).select("k", "thash", "text")
    groups = base.groupBy("sha").agg(F.count("*").alias("copies"), F.min(F.struct("k", "thash")).alias("stands"))
    n = _blocks(spark, df.agg(F.sum(F.octet_length(text))).first()[0] or 0)

    def find(batches):
        held, size = [], 0

        def send():
            h, k, p = (np.concatenate(x) for x in zip(*held))
            block = (h % np.uint64(n)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            cuts = np.searchsorted(block[order], np.arange(n + 1))
            rows = [(b, order[cuts[b] : cuts[b + 1]]) for b in range(n) if cuts[b] < cuts[b + 1]]
            columns = [[b for b, _ in rows], *([x[i].tobytes() for _, i in rows] for x in (h, k, p.astype(np.int32)))]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["block", "h", "k", "p"])

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in H.slabs(batch.column(1)):
                a = anchors(data, offsets, window, gram)
                held.append((a["hash"], keys[lo:hi][a["row"]], a["pos"]))
                size += len(a["pos"])
                if size > _HELD:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    def met_again(table: pa.Table) -> pa.Table:
        h, k, p = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("h", np.uint64), ("k", np.int64), ("p", np.int32)))
        order = np.argsort(h)
        ranked = h[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(h), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = order[twice]
        return pa.table({"k": k[at], "p": p[at]})

    shape = "block int, h binary, k binary, p binary"
    again = long_rows.select("k", "text").mapInArrow(find, shape).groupBy("block").applyInArrow(met_again, "k long, p int")
    stands = groups.select("stands.k", "stands.thash")
    marked = again.groupBy("k").agg(F.collect_set("p").alias("at")).join(stands, "k")
    found = long_rows.join(marked, ["k", "thash"]).select("k", "thash", "text", "at")

    def runs(batches):
        for batch in batches:
            keys, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            own = batch.column(3)
            parts = []
            for lo, hi, data, offsets in H.slabs(batch.column(2)):
                a = anchors(data, offsets, window, gram)
                if not len(a["pos"]):
                    continue
                marks = own.slice(lo, hi - lo)
                counts = np.diff(marks.offsets.to_numpy())
                code = lambda row, pos: (row.astype(np.int64) << 40) | pos
                known = np.isin(code(a["row"], a["pos"]), code(np.repeat(np.arange(hi - lo), counts), marks.flatten().to_numpy().astype(np.int64)))
                absolute = a["pos"] + offsets[a["row"]]
                keep = np.flatnonzero(known)
                raw = data.tobytes()
                p, lo_, hi_ = absolute[keep], a["lo"][keep], a["hi"][keep]
                parts.append((
                    (a["hash"][keep] % np.uint64(n)).astype(np.int64), keys[lo:hi][a["row"][keep]], hashes[lo:hi][a["row"][keep]], a["pos"][keep], lo_, hi_,
                    [raw[x : x + window - y] for x, y in zip(p.tolist(), lo_.tolist())], [raw[x - y : x] for x, y in zip(p.tolist(), hi_.tolist())],
                ))
            if not parts:
                continue
            block, k, thash, p, lo_, hi_ = (np.concatenate([x[i] for x in parts]) for i in range(6))
            suffix, left = (sum((x[i] for x in parts), []) for i in (6, 7))
            order = sorted(range(len(suffix)), key=lambda i: (block[i], suffix[i]))
            rows = {c: [] for c in ("block", "k", "thash", "p", "lo", "hi", "shared", "tail", "size", "left")}
            i = 0
            while i < len(order):
                j, b = i, block[order[i]]
                while j < len(order) and block[order[j]] == b:
                    j += 1
                idx = np.array(order[i:j])
                shared = [0] + [common(suffix[x], suffix[y], 0) for x, y in zip(order[i:j], order[i + 1 : j])]
                tails = [suffix[x][s:] for x, s in zip(order[i:j], shared)]
                for c, v in (("k", k[idx]), ("thash", thash[idx]), ("p", p[idx].astype(np.int32)), ("lo", lo_[idx].astype(np.int16)), ("hi", hi_[idx].astype(np.int16)), ("shared", np.array(shared, np.int16)), ("size", np.array([len(t) for t in tails], np.int16))):
                    rows[c].append(v.tobytes())
                rows["block"].append(int(b)), rows["tail"].append(b"".join(tails)), rows["left"].append(b"".join(left[x] for x in order[i:j]))
                i = j
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if c == "block" else pa.binary()) for c, v in rows.items()], list(rows))

    def merge(table: pa.Table) -> pa.Table:
        def of(c: str, kind) -> list[np.ndarray]:
            return [np.frombuffer(x, kind) for x in table[c].to_pylist()]

        players = []
        for shared, size, tail in zip(of("shared", np.int16), of("size", np.int16), table["tail"].to_pylist()):
            strings, last, at = [], b"", 0
            for s, z in zip(shared.tolist(), size.tolist()):
                last = last[:s] + tail[at : at + z]
                at += z
                strings.append(last)
            players.append((strings, shared.tolist()))
        run, place, shared = (np.array(x, np.int64) for x in merge_runs(players))
        sizes = np.array([0, *(len(s) for s, _ in players)]).cumsum()
        at = sizes[run] + place
        k, thash, p, lo, hi = (np.concatenate(of(c, t))[at] for c, t in (("k", np.int64), ("thash", np.int64), ("p", np.int32), ("lo", np.int16), ("hi", np.int16)))
        ends = np.concatenate(of("hi", np.int16)).astype(np.int64).cumsum()[at]
        left = np.frombuffer(b"".join(table["left"].to_pylist()), np.uint8)
        shared[:1] = -1
        found = equal_windows(shared, lo, hi, left, ends, window)
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        item, begin = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1] - 1
        return pa.table({"k": k[item], "thash": thash[item], "first": p[item].astype(np.int64) - end, "last": p[item].astype(np.int64) - begin})

    shape = "block int, k binary, thash binary, p binary, lo binary, hi binary, shared binary, tail binary, size binary, left binary"
    windows = found.mapInArrow(runs, shape).groupBy("block").applyInArrow(merge, "k long, thash long, first long, last long")
    rows = base.select("key", "k", "thash", "sha", "n_bytes").join(groups.where("copies > 1").select("sha", "copies"), "sha", "left")
    return rows, windows


def removed(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row for each input row: ``key``, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` k, thash and kept.

    ``kept`` is what is left as text (bytes of characters cut in two are
    dropped), null where the row loses nothing.
    """
    rows, windows = repeats(df, key, text, window, gram)
    spans = windows.groupBy("k", "thash").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    base = df.select(F.col(key).alias("key"), F.xxhash64(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long_rows = base.withColumns({"thash": F.xxhash64("text"), "n_bytes": F.octet_length("text").cast("long")}).where(F.col("n_bytes") >= window).select("k", "thash", "text")

    def cut(batches):
        for batch in batches:
            out = []
            for raw, own in zip(batch.column(2).to_pylist(), batch.column(3)):
                raw, starts, ends = raw.encode(), own.values.field("first").to_numpy(), own.values.field("last").to_numpy() + window
                order = np.argsort(starts, kind="stable")
                starts, reach = starts[order], np.maximum.accumulate(ends[order])
                new = np.concatenate([[True], starts[1:] > reach[:-1]])
                begin, end = starts[new], reach[np.concatenate([new[1:], [True]])]
                kept = b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)]))
                out.append((len(raw) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if keep_text else None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string())))], ["k", "thash", "cut", "spans", "kept_sha", "kept"])

    part = long_rows.join(spans, ["k", "thash"]).select("k", "thash", "text", "spans").mapInArrow(cut, "k long, thash long, cut long, spans long, kept_sha string, kept string")
    gone = (F.coalesce("copies", F.lit(1)) > 1) & (F.col("n_bytes") >= window)
    part = part.groupBy("k", "thash").agg(*(F.min(c).alias(c) for c in ("cut", "spans", "kept_sha", "kept")))
    return rows.join(part, ["k", "thash"], "left").select(
        F.col("key").alias(key), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        *([F.col("k"), F.col("thash"), F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept")] if keep_text else []),
    )


#: The same query for the table ``documents``: the hash of every 200-byte string (as hexadecimal digits) of every text.
REPEATS_SQL = """
with t as (select doc_id, row_number() over () r, hex(encode(coalesce(text, ''))) h from documents),
g as (select r, o, substring(h, 2 * o + 1, 1398) g from (select r, h, unnest(range(0, length(h) // 2, 500)) o from t)),
w as (select r, o + j p, hash(substring(g, 2 * j + 1, 400)) k from (select r, o, g, unnest(range(0, greatest(0, length(g) // 2 - 199))) j from g)),
d as (select k from w group by k having count(*) > 1),
s as (select r, p, coalesce(p > lag(p) over (partition by r order by p) + 200, true) begins from w where k in (select k from d)),
i as (select r, p, count(*) filter (begins) over (partition by r order by p) run from s),
b as (select r, min(p) a, max(p) + 200 e from i group by r, run),
x as (select b.r, a, e, substring(h, 2 * lag(e, 1, 0) over (partition by b.r order by a) + 1, 2 * (a - lag(e, 1, 0) over (partition by b.r order by a))) piece from b join t on t.r = b.r),
z as (select r, count(*) n_spans, sum(e - a) n_removed, string_agg(piece, '' order by a) kept, max(e) e from x group by r)
select doc_id, cast(length(h) // 2 as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, coalesce(n_spans, 0) n_spans,
  sha256(unhex(case when z.r is null then h else kept || substring(h, 2 * e + 1) end)) kept_sha256
from t left join z on z.r = t.r
"""
