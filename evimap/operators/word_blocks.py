"""Pairs of word sets that share enough words, found in blocks of both sides, so that no pair that is not alike leaves a task.

Sets are dealt to blocks by hash, and each block of one side meets each of the
other in a task of bounded size.  There the sets of one side are looked up in an
index of the other by their rarest words only: a set of n words that has to share
s has one of any n - s + 1 of them in common with its partner.  Words are
16-bit hashes; one that two words share only adds pairs for the caller to judge
(two sets of 50 words have a 26th of such a word on average).
What is shuffled grows with the sets and the blocks of the other side, not with pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a block of one side, and the fewest for which a side is cut to have more tasks.
WORDS, LEAST = 1 << 23, 1 << 16
#: Hashes of words, from -KINDS / 2 on.
KINDS = 1 << 16
#: Pairs that a task sends on together.
SENT = 1 << 16


def needed(n: int, least_jaccard: float, shared_half: bool) -> int:
    """Words that a set of ``n`` has to share at least, however large the other is."""
    s = max(1, int(np.ceil(least_jaccard * n - 1e-9)))
    return max(s, 2, n // 2) if shared_half else s


def block_pairs(least_jaccard: float, shared_half: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of one block (right: whether a set is of the right side; set; words): set_l, set_r that share enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rights, sets, sizes, words = [], [], [], []
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("words"))
            rights.append(batch.column(batch.schema.get_field_index("right")).to_numpy(zero_copy_only=False))
            sets.append(batch.column(batch.schema.get_field_index("set")).to_numpy())
            offsets = lists.offsets.to_numpy()
            sizes.append(np.diff(offsets))
            words.append(lists.values.to_numpy()[offsets[0] : offsets[-1]])
        right, own, size = np.concatenate(rights), np.concatenate(sets), np.concatenate(sizes).astype(np.int64)
        word, of_right = np.concatenate(words), np.repeat(right, size)
        word_l, word_r = (word[x].astype(np.int32) + KINDS // 2 for x in (~of_right, of_right))
        set_l, set_r, size_l, size_r = own[~right], own[right], size[~right], size[right]
        first_l, first_r = np.cumsum(size_l) - size_l, np.cumsum(size_r) - size_r
        posts = np.repeat(np.arange(len(set_r), dtype=np.int32), size_r)[np.argsort(word[of_right], kind="stable")]
        del words, word, of_right, own, size
        common = np.bincount(word_r, minlength=KINDS)
        start = np.cumsum(common) - common
        mark = np.zeros(KINDS, bool)
        at_l, at_r, held = [], [], 0
        for i, n in enumerate(size_l.tolist()):
            least = needed(n, least_jaccard, shared_half)
            if least > n or not len(set_r):
                continue
            mine = word_l[first_l[i] : first_l[i] + n]
            f = common[mine]
            rare = mine if least == 1 else mine[np.argpartition(f, n - least)[: n - least + 1]]
            rare = rare[common[rare] > 0]
            if not len(rare):
                continue
            met = np.concatenate([posts[start[w] : start[w] + common[w]] for w in rare.tolist()])
            if len(met) * 8 > len(set_r):
                times = np.bincount(met, minlength=len(set_r))
                found = np.flatnonzero(times)
                times = times[found]
            else:
                found, times = np.unique(met, return_counts=True)
            m = size_r[found]
            most = np.minimum(times + least - 1, np.minimum(n, m))
            keep = (most >= least) & (most >= (least_jaccard - 1e-9) * (n + m - most))
            found, m = found[keep], m[keep]
            if not len(found):
                continue
            mark[mine] = True
            ends = np.cumsum(m)
            hit = mark[word_r[np.arange(ends[-1]) - np.repeat(ends - m - first_r[found], m)]]
            mark[mine] = False
            shared = np.minimum(np.add.reduceat(hit, ends - m, dtype=np.int64), np.minimum(n, m))
            found = found[(shared >= least) & (shared >= (least_jaccard - 1e-9) * (n + m - shared))]
            at_l.append(np.full(len(found), set_l[i]))
            at_r.append(set_r[found])
            held += len(found)
            if held >= SENT:
                yield _sent(at_l, at_r)
                at_l, at_r, held = [], [], 0
        if held:
            yield _sent(at_l, at_r)

    return run


def _sent(at_l: list[np.ndarray], at_r: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(at_l)), pa.array(np.concatenate(at_r))], ["set_l", "set_r"])


def grid(words_l: int, words_r: int, tasks: int) -> tuple[int, int]:
    """Blocks of both sides: of at most ``WORDS`` words, and enough of them for ``tasks`` where sides are large enough to be cut; the fewest words sent."""
    least = [max(1, -(-words // WORDS)) for words in (words_l, words_r)]
    most = [max(n, words // LEAST) for n, words in zip(least, (words_l, words_r))]
    tasks = max(min(tasks, most[0] * most[1]), least[0] * least[1])
    able = [(rows, max(least[1], -(-tasks // rows))) for rows in range(least[0], min(most[0], max(least[0], tasks)) + 1)]
    return min((x for x in able if x[1] <= most[1]), key=lambda x: words_l * x[1] + words_r * x[0])


def pairs(left: DataFrame, right: DataFrame, least_jaccard: float, shared_half: bool) -> DataFrame:
    """set_l, set_r of the sets (set, w) of both sides that can be alike enough, each once; both sides are read more than once."""
    words = [x.agg(F.coalesce(F.sum(F.size("w")), F.lit(0)).alias("n")).first().n for x in (left, right)]
    tasks = 2 * left.sparkSession.sparkContext.defaultParallelism
    rows, columns = grid(*words, tasks)

    def side(x: DataFrame, right: bool) -> DataFrame:
        mine, others = (columns, rows) if right else (rows, columns)
        block, other = F.pmod(F.xxhash64("set"), F.lit(mine)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        own = x.select("set", F.transform("w", lambda y: (F.hash(y).bitwiseAND(KINDS - 1) - KINDS // 2).cast("short")).alias("words"), block.alias("block"), other.alias("other"))
        at = F.col("other") * columns + F.col("block") if right else F.col("block") * columns + F.col("other")
        return own.select(at.alias("at"), F.lit(right).alias("right"), "set", "words")

    # few keys, so as many partitions that hardly two share one; their number also keeps adaptive execution from putting small ones together
    both = side(left, False).unionByName(side(right, True)).repartition(max(tasks, 4 * rows * columns), "at")
    return both.groupBy("at").applyInArrow(block_pairs(least_jaccard, shared_half), "set_l long, set_r long")
