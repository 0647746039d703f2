"""Probabilistic suffix tree over the bytes of tokens, and the add-one unigram baseline.

A text is its words (A-Z lower-cased, split at ASCII white space) and an end
token.  The tree predicts a word byte by byte and then a space, and the end
token as one symbol, so the probabilities of all token sequences add up to at
most one.  Contexts are the last 1 to ``DEPTH`` symbols, across words.  Contexts
of up to ``SHORT`` symbols are kept where they were seen.  A longer one is kept
if its next-symbol distribution differs from that of its longest proper suffix:
count times divergence must reach ``GAIN`` nats, whatever the size of the
corpus, so a context that passes is not lost when other text is added and the
tree grows with the input.  Suffixes of kept contexts are kept too.
Distributions are smoothed by absolute discounting towards the suffix, and each
symbol is scored in the state of the longest kept suffix.

All counts cover all training texts.  The tree is a distributed table and never
stands whole anywhere.  Texts are dealt into chunks of bounded size; a chunk
sends each distinct word and each distinct string of DEPTH + 1 symbols once,
with its count, to the block its hash falls in.  Blocks add up, and send the
strings on to parts by the last SHORT + 1 symbols of their context, where every
longer context has all its counts.  A part tests, smooths and returns one log
probability a string (in steps of 1 / ``STEP``); blocks answer the chunks.  Only the counts of SHORT + 1
symbols (at most 2**24, whatever the input) are sent to every task.  There are
at most ``MAX_BLOCKS`` blocks, so messages grow with the input and not with its
square.  Words are told apart by 64-bit hashes.

Null and empty texts have the end token only; null keys belong to training;
repeated rows are scored, and counted, each.  Without training texts the tree
is uniform and N = V = 0.  Only the two columns named are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H

DEPTH, SHORT, GAIN, DISCOUNT = 6, 2, 12.0, 0.5
#: Log10 probabilities are rounded down to multiples of 1 / STEP, so that sums do not pass one (but for 16 decades at most).
STEP = 2048
END, SYMBOLS = 255, 256
CHUNK_BYTES, MAX_BLOCKS, MAX_PARTS = 8_000_000, 32_768, 4096
#: Blocks in which the counts of short strings are added up.
SUMS = 16


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each after DEPTH end symbols, and where each text starts."""
    lead = bytes([END]) * DEPTH
    parts = [lead + b" ".join([*w, b""]) + lead[:1] for w in (t.lower().split() for t in texts)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def grams(stream: np.ndarray, starts: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Codes of ``depth`` context symbols and the next one, for each predicted symbol in order."""
    n = len(stream) - DEPTH
    code = np.zeros(n, np.uint64 if depth > 3 else np.uint32)
    for j in range(DEPTH - depth, DEPTH + 1):
        code = (code << code.dtype.type(8)) | stream[j : j + n]
    keep = np.ones(n, bool)
    inner = starts[1:-1]
    for j in range(DEPTH):
        keep[inner - DEPTH + j] = False  # symbols before a text are given, not predicted
    return code[keep]


def low(codes: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` symbols of each code."""
    return codes & np.uint64((1 << (8 * n)) - 1)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of all parts in order, with their summed counts."""
    values, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([c for _, c in parts]), len(values)).astype(np.int64)


def discounted(count: np.ndarray, kinds: np.ndarray, total: np.ndarray, above: np.ndarray) -> np.ndarray:
    return np.where(total > 0, (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds * above) / np.maximum(total, 1), above)


def shut(x: np.ndarray, near: bool = False) -> bytes:
    """An array as compressed bytes, those of one place together; ``near``: as differences of neighbours."""
    x = np.diff(x, prepend=x.dtype.type(0)) if near else x
    raw = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def opened(raw: bytes, kind: type, near: bool = False) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    places = np.frombuffer(pa.decompress(raw[8:], size, codec="zstd", asbytes=True), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    x = np.ascontiguousarray(places.T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if near else x


@dataclass
class Root:
    """Counts of SHORT + 1 symbols, and the distributions of the contexts of one symbol."""

    codes: np.ndarray
    counts: np.ndarray
    total: np.ndarray  # by context of two symbols
    kinds: np.ndarray
    one: np.ndarray  # probability by context of one symbol and next

    def look(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, count of the context and probability of strings of three symbols."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        count = np.where(self.codes[at] == codes, self.counts[at], 0) if len(self.codes) else np.zeros(len(codes), np.int64)
        context = (codes >> np.uint64(8)).astype(np.int64)
        total = self.total[context]
        return count, total, discounted(count, self.kinds[context], total, self.one[(codes & np.uint64(0xFFFF)).astype(np.int64)])


def root(codes: np.ndarray, counts: np.ndarray) -> Root:
    """From the distinct training strings of three symbols, in order."""
    pairs = np.bincount(low(codes, 2).astype(np.int64), counts, 1 << 16).reshape(256, 256)
    nexts = pairs.sum(0)
    none = discounted(nexts, np.count_nonzero(nexts), nexts.sum(), np.full(256, 1 / SYMBOLS))
    one = discounted(pairs, np.count_nonzero(pairs, 1)[:, None], pairs.sum(1)[:, None], none)
    context = (codes >> np.uint64(8)).astype(np.int64)
    return Root(codes, counts, np.bincount(context, counts, 1 << 16).astype(np.int64), np.bincount(context, minlength=1 << 16), one.ravel())


def chances(codes: np.ndarray, counts: np.ndarray, short: Root, least: float = GAIN) -> np.ndarray:
    """Probability of the last symbol of each of these distinct strings in the state of the longest kept context.

    ``codes`` holds every training string whose context ends like one of theirs
    (SHORT + 1 symbols), and strings of a count of 0 to be scored as well.
    """
    above = np.unique(low(codes, SHORT + 1))
    above_count, above_total, chance = short.look(above)
    levels = []
    for d in range(SHORT + 1, DEPTH + 1):
        pairs, at = np.unique(low(codes, d + 1), return_inverse=True)
        count = np.bincount(at, counts, len(pairs))
        context, of = np.unique(pairs >> np.uint64(8), return_inverse=True)
        total, kinds = np.bincount(of, count, len(context)), np.bincount(of, count > 0, len(context))
        where = np.searchsorted(above, low(pairs, d))
        seen = np.flatnonzero(count)
        share = above_count[where[seen]] / above_total[where[seen]]
        gain = np.bincount(of[seen], count[seen] * np.log(count[seen] / total[of[seen]] / share), len(context))
        levels.append((d, where, context, of, count, total, kinds, gain >= least))
        above, above_count, above_total = pairs, count, total[of]
    for (_, _, shorter, *_, keep), (d, _, context, *_, passed) in zip(levels[-2::-1], levels[:0:-1]):
        keep[np.searchsorted(shorter, np.unique(low(context[passed], d - 1)))] = True
    for _, where, _, of, count, total, kinds, keep in levels:
        chance = np.where(keep[of], discounted(count, kinds[of], total[of], chance[where]), chance[where])
    return chance[at]


def steps(chance: np.ndarray) -> np.ndarray:
    """Minus log10 of probabilities in whole steps, rounded up; 16 decades at most."""
    return np.ceil(np.minimum(-np.log10(chance), 15.9) * STEP - 1e-6).astype(np.int16)


def score(df: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; the rows not held out are the training texts."""
    spark = df.sparkSession
    H.small_batches(spark)
    plain = df.select(F.col(key).alias("k"), F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def slabs(table):
        """Rows, raw texts and those of training, word hashes and where each row's begin."""
        held = table["held"].to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table["held"].to_numpy()
        for lo, hi, data, offsets in H.slabs(table["text"]):
            raw = data.tobytes()
            yield lo, hi, [raw[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())], held[lo:hi], data, offsets

    def brief(batches):
        parts, size = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], 0
        for batch in batches:
            for _, _, texts, held, data, _ in slabs(batch):
                size += len(data)
                own = [t for t, h in zip(texts, held.tolist()) if not h]
                if own:
                    parts = [added([*parts, np.unique(grams(*symbols(own), SHORT), return_counts=True)])]
        codes, counts = parts[0]
        block = codes % SUMS
        for b in range(SUMS):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([codes[block == b].tobytes()]), pa.array([counts[block == b].tobytes()]), pa.array([0 if b else size], pa.int64())], ["block", "h", "c", "size"])

    def total(table: pa.Table) -> pa.Table:
        codes, counts = added([(np.frombuffer(h, np.uint32), np.frombuffer(c, np.int64)) for h, c in zip(table["h"].to_pylist(), table["c"].to_pylist())])
        return pa.table({"h": [codes.tobytes()], "c": [counts.tobytes()], "size": [sum(table["size"].to_pylist())]})

    sums = plain.select("held", "text").mapInArrow(brief, "block int, h binary, c binary, size long").groupBy("block").applyInArrow(total, "h binary, c binary, size long").collect()
    codes, counts = added([(np.zeros(0, np.uint32), np.zeros(0, np.int64)), *((np.frombuffer(r.h, np.uint32), np.frombuffer(r.c, np.int64)) for r in sums)])
    nexts = np.bincount(codes & np.uint32(255), counts, 256).astype(np.int64)
    ends, tokens = int(nexts[END]), int(nexts[END] + nexts[32])
    n_chunks = max(1, -(-sum(r.size for r in sums) // CHUNK_BYTES))
    n_blocks = min(max(1, n_chunks // 2), MAX_BLOCKS)
    n_parts = min(n_blocks, MAX_PARTS)
    shared = spark.sparkContext.broadcast(root(codes.astype(np.uint64), counts))
    rows = plain.select(F.pmod(F.xxhash64("k", "text"), F.lit(n_chunks)).cast("int").alias("chunk"), "k", "held", "text")

    def dealt(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Order by block, and where each of the ``n`` blocks begins in it."""
        block = (H.mix(values) % np.uint64(n)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        return order, np.searchsorted(block[order], np.arange(n + 1))

    def packed(out: list[tuple], names: str) -> pa.Table:
        kinds = {"h": pa.binary(), "c": pa.binary()}
        return pa.table({c: pa.array([x[i] for x in out], kinds.get(c, pa.int32())) for i, c in enumerate(names.split())})

    def ask(table: pa.Table) -> pa.Table:
        words, strings, out = [], [], []
        for lo, hi, texts, held, data, offsets in slabs(table):
            hashes, first = H.word_hashes(data, offsets)
            own, at = np.unique(hashes, return_inverse=True)
            words.append((own, np.bincount(at, np.repeat(~held, np.diff(first)), len(own))))
            for out_of_fold in (False, True):
                some = [t for t, h in zip(texts, held.tolist()) if h == out_of_fold]
                if some:
                    own, count = np.unique(grams(*symbols(some)), return_counts=True)
                    strings.append((own, count * (not out_of_fold)))
        for kind, parts in ((0, words), (1, strings)):
            values, count = added(parts)
            order, cut = dealt(values, n_blocks)
            for b in np.flatnonzero(np.diff(cut)).tolist():
                own = order[cut[b] : cut[b + 1]]
                out.append((kind, b, table["chunk"][0].as_py(), shut(values[own], not kind), shut(count[own].astype(np.int32))))
        return packed(out, "kind block chunk h c")

    def sent(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
        near = not table["kind"][0].as_py()
        return [opened(x, np.uint64, near) for x in table["h"].to_pylist()], [opened(x, np.int32) for x in table["c"].to_pylist()]

    def merge(table: pa.Table) -> pa.Table:
        """Strings of a block with their counts, by part."""
        out = []
        if table["kind"][0].as_py():
            values, count = added(list(zip(*sent(table))))
            order, cut = dealt(low(values >> np.uint64(8), SHORT + 1), n_parts)
            for p in np.flatnonzero(np.diff(cut)).tolist():
                own = order[cut[p] : cut[p + 1]]
                out.append((1, table["block"][0].as_py(), p, shut(values[own]), shut(count[own])))
        return packed(out, "kind block part h c")

    def tree(table: pa.Table) -> pa.Table:
        """Log probabilities of a part's strings, back by block."""
        h, c = ([opened(x, t) for x in table[n].to_pylist()] for n, t in (("h", np.uint64), ("c", np.int64)))
        codes, at = np.unique(np.concatenate(h), return_inverse=True)  # each string comes from one block
        logs = steps(chances(codes, np.bincount(at, np.concatenate(c), len(codes)), shared.value))[at]
        ends_ = np.cumsum([len(x) for x in h])
        return packed([(1, b, p, shut(logs[e - len(x) : e])) for b, p, x, e in zip(table["block"].to_pylist(), table["part"].to_pylist(), h, ends_.tolist())], "kind block part c")

    def answer(table: pa.Table, logs: pa.Table) -> pa.Table:
        """What each chunk asked a block for: counts of words, or log probabilities of strings."""
        out = []
        if table.num_rows:
            h, c = sent(table)
            values, found = added(list(zip(h, c)))
            if table["kind"][0].as_py():
                order, cut = dealt(low(values >> np.uint64(8), SHORT + 1), n_parts)
                found = np.zeros(len(values), np.int16)
                for p, x in zip(logs["part"].to_pylist(), logs["c"].to_pylist()):
                    found[order[cut[p] : cut[p + 1]]] = opened(x, np.int16)
            out = [(table["kind"][0].as_py(), table["block"][0].as_py(), n, shut(found[np.searchsorted(values, x)])) for n, x in zip(table["chunk"].to_pylist(), h)]
        return packed(out, "kind block chunk c")

    def distinct(table: pa.Table) -> pa.Table:
        """How many words of a block are in training texts."""
        known = 0 if table["kind"][0].as_py() else np.count_nonzero(added(list(zip(*sent(table))))[1])
        return pa.table({"v": pa.array([known], pa.int64())})

    def grade(table: pa.Table, answers: pa.Table) -> pa.Table:
        n, parts = table.num_rows, []
        for lo, hi, texts, _, data, offsets in slabs(table):
            hashes, first = H.word_hashes(data, offsets)
            stream, starts = symbols(texts)
            code = grams(stream, starts)
            parts.append((lo, hi, [(*np.unique(hashes, return_inverse=True), first), (*np.unique(code, return_inverse=True), starts - DEPTH * np.arange(hi - lo + 1))]))
        kinds, sums = answers["kind"].to_numpy(), {}
        for kind, dtype in ((0, np.int64), (1, np.int16)):
            values = np.unique(np.concatenate([p[kind][0] for _, _, p in parts])) if parts else np.zeros(0, np.uint64)
            order, cut = dealt(values, n_blocks)
            found, own = np.zeros(len(values), dtype), answers.filter(pa.array(kinds == kind))
            for b, c in zip(own["block"].to_pylist(), own["c"].to_pylist()):
                found[order[cut[b] : cut[b + 1]]] = opened(c, dtype)
            for name, value in (("base", np.log10(found + 1.0)), ("known", found > 0)) if kind == 0 else (("score", found / -STEP),):
                sums[name] = np.zeros(n)
                for lo, hi, p in parts:
                    mine, at, first = p[kind]
                    run = np.concatenate([[0.0], np.cumsum(value[np.searchsorted(values, mine)][at])])
                    sums[name][lo:hi] = run[first[1:]] - run[first[:-1]]
        words = np.concatenate([np.diff(p[0][2]) for _, _, p in parts]) if parts else np.zeros(0, np.int64)
        return pa.table({
            "k": table["k"], "held_out": table["held"], "n_tokens": words + 1, "n_known": sums["known"].astype(np.int64) + int(ends > 0),
            "seen": sums["base"] + np.log10(ends + 1), "score": sums["score"],
        })

    shape = "kind int, block int, chunk int, h binary, c binary"
    # One plan without a stop: the exchanges of texts and of what the chunks ask are used by several consumers.
    asked = rows.groupBy("chunk").applyInArrow(ask, shape).groupBy("kind", "block")
    merged = asked.applyInArrow(merge, "kind int, block int, part int, h binary, c binary")
    logs = merged.groupBy("part").applyInArrow(tree, "kind int, block int, part int, c binary")
    told = asked.cogroup(logs.groupBy("kind", "block")).applyInArrow(answer, "kind int, block int, chunk int, c binary")
    kind = df.schema[key].dataType.simpleString()
    graded = rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(grade, f"k {kind}, held_out boolean, n_tokens long, n_known long, seen double, score double")
    known = F.coalesce(asked.applyInArrow(distinct, "v long").agg(F.sum("v")).scalar(), F.lit(0)) + int(ends > 0)
    base = F.col("seen") - F.col("n_tokens") * F.log10(known + (tokens + 1))
    return graded.select(F.col("k").alias(key), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
