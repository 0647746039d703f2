"""Alignment of the tokens of two tokenizers over the same bytes, by an associative product of fragments.

A byte-level BPE (A) and a SentencePiece model (B) encode the same text; bytes
at which a token of both ends cut the tokens into groups, and every pair of an
A and a B token of one group is a link.  A stretch of bytes, looked at alone,
gives a ``Fragment``: the tokens up to its first common end (open prefix), the
groups between its first and last common ends (closed, kept as counts and as
text), the tokens behind (open suffix).  ``Fragment.then`` joins two neighbours
by closing what the suffix of the first and the prefix of the second make
together; it is associative, with the empty fragment as its unit, so neighbours
may be joined in any nesting.  Documents above ``LONG`` characters are cut into
ranges of ``CHUNK`` bytes that are dealt to tasks, and their fragments are
joined ``FAN`` at a time, level by level.  A shorter document is one range.

A range needs only the text around it: neither tokenizer has a token across a
single space between two other characters (``Coder`` looks that B has no piece
with a space after another character; else a text is one range), so a range is
encoded from such a space before its start to one after its end, and keeps the
tokens that end in it.  A stretch of more than ``CHUNK`` bytes without one is
not cut.

How many documents hold an id pair is counted over all rows, and joined back to
the pairs of each document; Spark takes the smaller side by its measured size.

Rows that are null, empty, or whose tokens do not spell a space and the text
have no tokens: zeros, and '' for the digest.  Every row is a document, also
rows that repeat and rows with a null key.  Only the two named columns are read
and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H
from evimap.llm.components import shared_folder

#: Bytes of a range; characters from which a text is dealt to several tasks; fragments joined at once.
CHUNK, LONG, FAN = 1 << 18, 1 << 20, 8
#: A pair of ids is a * 2^20 + b.
SHIFT = 20
#: How byte-level BPE cuts a text before it merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT, _ODD = re.compile(r"(?<=\S)(?= \S)"), re.compile(r"\s | \s| \Z")
_RUN = re.compile(r"\s{1000}")
_NONE = np.zeros(0, np.int64)
_SAID: list[np.ndarray] = []


@dataclass
class Groups:
    """Groups in a row: how many, their links, the id pairs (ascending) with how often each is linked, and their text."""

    n: int = 0
    links: int = 0
    pairs: np.ndarray = field(default_factory=lambda: _NONE)
    times: np.ndarray = field(default_factory=lambda: _NONE)
    text: str = ""

    def __add__(self, other: Groups) -> Groups:
        if not self.n or not other.n:
            return self if self.n else other
        pairs, times = summed(np.concatenate([self.pairs, other.pairs]), np.concatenate([self.times, other.times]))
        return Groups(self.n + other.n, self.links + other.links, pairs, times, f"{self.text};{other.text}")


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else _NONE
    return codes[first], np.add.reduceat(times, first) if len(first) else _NONE


def said(ids: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Each id in decimal with ',' (0), '|' (1) or ';' (2) behind it."""
    if not _SAID or len(_SAID[0]) <= 3 * ids.max():
        _SAID[:] = [np.array([f"{i}{m}" for i in range(int(ids.max()) + 50_000) for m in ",|;"], dtype=object)]
    return _SAID[0][3 * ids + mark]


def grouped(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Groups:
    """Groups of tokens; group g ends before token ``a_ends[g]`` of A and ``b_ends[g]`` of B."""
    a_starts, b_starts = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    p, q = a_ends - a_starts, b_ends - b_starts
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[a_ends - 1], mark_b[b_ends - 1] = 1, 2
    words = np.empty(len(a) + len(b), dtype=object)
    words[np.arange(len(a)) + np.repeat(b_starts, p)] = said(a, mark_a)
    words[np.arange(len(b)) + np.repeat(a_ends, q)] = said(b, mark_b)
    small = p * q <= 4096
    each = np.where(np.repeat(small, p), np.repeat(q, p), 0)  # links of every A token, but in the large groups
    upto = np.cumsum(each)
    right = np.arange(upto[-1]) + np.repeat(np.repeat(b_starts, p) - upto + each, each)
    pairs, times = summed((np.repeat(a, each) << SHIFT) + b[right], np.ones(upto[-1], np.int64))
    out = Groups(len(p), int((p * q).sum()), pairs, times, "".join(words.tolist())[:-1])
    for g in np.flatnonzero(~small):
        x, m = np.unique(a[a_starts[g] : a_ends[g]], return_counts=True)
        y, n = np.unique(b[b_starts[g] : b_ends[g]], return_counts=True)
        codes, counts = ((x[:, None] << SHIFT) + y).ravel(), (m[:, None] * n).ravel()
        out.pairs, out.times = summed(np.concatenate([out.pairs, codes]), np.concatenate([out.times, counts]))
    return out


@dataclass
class Fragment:
    """Tokens that end in a range of bytes.  Without a common end (``cut``) all are in the prefix."""

    head: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)
    cut: bool = False
    closed: Groups = field(default_factory=Groups)
    tail: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)
    tokens: tuple[int, int] = (0, 0)

    def then(self, other: Fragment) -> Fragment:
        tokens = (self.tokens[0] + other.tokens[0], self.tokens[1] + other.tokens[1])
        if not self.cut:
            return Fragment(_joined(self.head, other.head), other.cut, other.closed, other.tail, tokens)
        between = _joined(self.tail, other.head)
        if not other.cut:
            return Fragment(self.head, True, self.closed, between, tokens)
        return Fragment(self.head, True, self.closed + one(*between) + other.closed, other.tail, tokens)

    def whole(self) -> Groups:
        """The groups of a document: its start is a common end too, and so is its end."""
        return one(*self.head) + self.closed if self.cut else Groups()


def _joined(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])


def one(a: np.ndarray, b: np.ndarray) -> Groups:
    """The group of these tokens."""
    return grouped(a, np.array([len(a)]), b, np.array([len(b)]))


def fragment(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> Fragment:
    """Of the tokens of a range, with the bytes at which they end."""
    common, n = np.intersect1d(a_at, b_at, assume_unique=True), (len(a), len(b))
    if not len(common):
        return Fragment((a, b), tokens=n)
    x, y = np.searchsorted(a_at, common) + 1, np.searchsorted(b_at, common) + 1
    closed = grouped(a[x[0] : x[-1]], x[1:] - x[0], b[y[0] : y[-1]], y[1:] - y[0]) if len(common) > 1 else Groups()
    return Fragment((a[: x[0]], b[: y[0]]), True, closed, (a[x[-1] :], b[y[-1] :]), n)


class ByteLevel:
    """A byte-level BPE of a published file, in one process."""

    def __init__(self, file: bytes) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        model = json.loads(file)["model"]
        # Byte-level tokenizers write each byte as a printable character: itself, or else one from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.in_order = [model["vocab"]["".join(m)] for m in merges] == list(range(256, 256 + len(merges)))
        self.slow = Tokenizer.from_str(file.decode())
        self.slow.encode_special_tokens = True
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spelled = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]

    def encode(self, text: str) -> list[int]:
        """By ranks where ids are ranks: the same ids four times as fast, but long runs of white space are too deep for its pattern."""
        if not self.in_order or _RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Coder:
    """Both tokenizers in one process."""

    def __init__(self, a: bytes, b: bytes) -> None:
        import sentencepiece

        self.a, self.b = ByteLevel(a), sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = self.a.spelled
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes)]
        self.apart = not any(re.search("[^▁]▁", p) for p in pieces)

    def cut(self, text: str) -> list[str]:
        """Units between which no token reaches, each without the space before it."""
        if not self.apart:
            return [text]
        joined = f" {text}"
        return [u[1:] for u in _CUT.split(joined)] if _ODD.search(joined) else text.split(" ")

    def range(self, text: str, lo: int = 0, hi: int | None = None) -> Fragment | None:
        """Fragment of the tokens that end in (lo, hi] bytes of a space and the text; None where a tokenizer does not give these back."""
        if not text:
            return None
        spelled, sides = f" {text}".encode(), []
        for ids, table, sizes in ((self.a.encode(f" {text}"), self.a_bytes, self.sizes[0]), (self.b.encode(text), self.b_bytes, self.sizes[1])):
            if b"".join([table[i] for i in ids]) != spelled:
                return None
            ids = np.array(ids, np.int64)
            at = np.cumsum(sizes[ids])
            if lo or hi is not None:
                kept = (at > lo) & (at <= hi)
                ids, at = ids[kept], at[kept]
            sides += [ids, at]
        return fragment(*sides)


def ranges(units: list[str], chunk: int = CHUNK):
    """(text, lo, hi) for each range of about ``chunk`` bytes; a border inside a unit longer than that is left out."""
    ends = np.cumsum([1 + len(u.encode()) for u in units]).tolist()
    lo, first = 0, 0
    while first < len(units):
        hi, last = lo + chunk - lo % chunk, first
        while last < len(units) and ends[last] < hi:
            last += 1
        if last < len(units) and ends[last] - (ends[last - 1] if last else 0) > chunk:
            hi = ends[last]
        hi, base = min(hi, ends[-1]), ends[first - 1] if first else 0
        yield " ".join(units[first : last + 1]), lo - base, hi - base
        lo = hi
        first = last if last < len(units) and ends[last] > hi else last + 1


_ARRAYS = pa.list_(pa.int64())
_PARTS = {"head_a": _ARRAYS, "head_b": _ARRAYS, "cut": pa.bool_(), "n": pa.int64(), "links": pa.int64(), "pairs": _ARRAYS, "times": _ARRAYS, "body": pa.binary(), "tail_a": _ARRAYS, "tail_b": _ARRAYS, "n_a": pa.int64(), "n_b": pa.int64(), "spelled": pa.bool_()}
_PARTS_DDL = "head_a array<long>, head_b array<long>, cut boolean, n long, links long, pairs array<long>, times array<long>, body binary, tail_a array<long>, tail_b array<long>, n_a long, n_b long, spelled boolean"


def _packed(f: Fragment | None) -> list:
    if f is None:
        return [_NONE, _NONE, False, 0, 0, _NONE, _NONE, b"", _NONE, _NONE, 0, 0, False]
    return [*f.head, f.cut, f.closed.n, f.closed.links, f.closed.pairs, f.closed.times, f.closed.text.encode(), *f.tail, *f.tokens, True]


def _unpacked(r: dict) -> Fragment | None:
    if not r["spelled"]:
        return None
    array = {c: np.array(r[c], np.int64) for c in ("head_a", "head_b", "pairs", "times", "tail_a", "tail_b")}
    closed = Groups(r["n"], r["links"], array["pairs"], array["times"], r["body"].decode())
    return Fragment((array["head_a"], array["head_b"]), r["cut"], closed, (array["tail_a"], array["tail_b"]), (r["n_a"], r["n_b"]))


def _answer(f: Fragment | None) -> list:
    """n_a, n_b, n_groups, n_links, pairs, times, groups_sha256 of a document."""
    if f is None:
        return [0, 0, 0, 0, _NONE, _NONE, ""]
    all_ = f.whole()
    return [*f.tokens, all_.n, all_.links, all_.pairs, all_.times, hashlib.sha256(all_.text.encode()).hexdigest()]


_DOCS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "pairs": _ARRAYS, "times": _ARRAYS, "groups_sha256": pa.string()}
_DOCS_DDL = "n_a long, n_b long, n_groups long, n_links long, pairs array<long>, times array<long>, groups_sha256 string"
_CODERS: dict[str, Coder] = {}


def _coder(files) -> Coder:
    """The tokenizers of the broadcast files, read once in a process."""
    name, a, b = files.value
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Coder(a, b)
    return _CODERS[name]


def _columns(rows: list[list], types: dict) -> list[pa.Array]:
    return [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * len(types), types.values())]


def aligned(df: DataFrame, key: str, text: str, a: bytes, b: bytes, long: int = LONG, chunk: int = CHUNK) -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, pairs, times and groups_sha256 of each row, for tokenizer files of these contents."""
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    H.small_batches(spark)
    files = spark.sparkContext.broadcast((hashlib.sha256(a + b).hexdigest(), a, b))
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    is_long = F.coalesce(F.length("t") > long, F.lit(False))

    def short(batches):
        coder = _coder(files)
        for batch in batches:
            out = [_answer(coder.range(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(out, _DOCS)], ["k", *_DOCS])

    done = rows.where(~is_long).mapInArrow(short, f"k {kind}, {_DOCS_DDL}")
    most = rows.where(is_long).agg(F.max(F.octet_length("t"))).first()[0]
    if not most:
        return done.withColumnRenamed("k", key)

    # Ranges of long texts are written once: what they are called must not change when a task runs again.
    def split(batches):
        coder = _coder(files)
        for batch in batches:
            for k, t, row in zip(*(batch.column(i) for i in range(3))):
                for place, (own, lo, hi) in enumerate(ranges(coder.cut(t.as_py()), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k.as_py()], batch.column(0).type), pa.array([row.as_py()], pa.int64()), pa.array([place], pa.int64()), pa.array([lo], pa.int64()), pa.array([hi], pa.int64()), pa.array([own])],
                        ["k", "row", "place", "lo", "hi", "t"],
                    )

    folder = f"{shared_folder(spark)}/ranges-{uuid.uuid4()}"
    numbered = rows.where(is_long).withColumn("row", F.monotonically_increasing_id())
    numbered.mapInArrow(split, f"k {kind}, row long, place long, lo long, hi long, t string").write.parquet(folder)
    parts = spark.read.parquet(folder).repartition("row", "place")

    def begin(batches):
        coder = _coder(files)
        for batch in batches:
            out = [_packed(coder.range(t, lo, hi)) for lo, hi, t in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *_columns(out, _PARTS)], ["k", "row", "place", *_PARTS])

    shape = f"k {kind}, row long, place long, {_PARTS_DDL}"
    parts = parts.mapInArrow(begin, shape)

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        f: Fragment | None = Fragment()
        for r in table.to_pylist():
            g = _unpacked(r)
            f = f.then(g) if f and g else None
        first = table.slice(0, 1)
        head = {"k": first["k"], "row": first["row"], "place": pa.array([first["place"][0].as_py() // FAN])}
        return pa.table(head | dict(zip(_PARTS, _columns([_packed(f)], _PARTS))))

    places = 2 + most // chunk
    while places > 1:
        parts = parts.groupBy("row", F.expr(f"place div {FAN}")).applyInArrow(join, shape)
        places = -(-places // FAN)

    def end(batches):
        for batch in batches:
            out = [_answer(_unpacked(r)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(out, _DOCS)], ["k", *_DOCS])

    return done.unionByName(parts.mapInArrow(end, f"k {kind}, {_DOCS_DDL}")).withColumnRenamed("k", key)


def linked(df: DataFrame, key: str, text: str, a: bytes, b: bytes, long: int = LONG, chunk: int = CHUNK) -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row."""
    spark, folder = df.sparkSession, f"{shared_folder(df.sparkSession)}/aligned-{uuid.uuid4()}"
    aligned(df, key, text, a, b, long, chunk).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{folder}/documents")
    docs = spark.read.parquet(f"{folder}/documents")
    held = docs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).withColumn("a", F.shiftright("pair", SHIFT))
    held.write.parquet(f"{folder}/pairs")
    held = spark.read.parquet(f"{folder}/pairs")
    best = held.groupBy("a").agg(F.max("n").alias("most"))
    counts = held.join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    each = docs.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = each.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return docs.join(sums, "row", "left").select(key, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
