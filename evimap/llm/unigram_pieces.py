"""Encoding to pieces by unigram Viterbi over a double-array trie, with byte fallback, and decoding.

The vocabulary is read from a published SentencePiece file (a parameter).  Its
pieces have log probabilities, and the segmentation with the greatest sum wins.
A file of merge ranks has none; there the probability of the piece of rank r is
taken to fall as 1 / (r + 1), by Zipf's law, and all add up to one.  Nothing is
trained.  A space becomes the marker U+2581, and one is put before the text.
Characters that no piece covers, U+2581 itself among them, become byte pieces,
at the cost of the least log probability minus 10 for each character.  Where no
piece has a marker after another character (``load`` looks), texts fall into
segments (a run of markers, then other characters) that are solved
independently; else a text is one segment.  A task solves the distinct segments
together, all at once, one byte position after the other, and segments above
``ALONE`` bytes each by itself in time linear in their length.

Decoding joins the pieces, turns markers into spaces and drops the first one; it
gives back every text.  Null and empty texts have no pieces.  Columns that the
result adds replace columns of the same name; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evimap.llm import hashing as H

MARK = "▁"
_SEGMENT = regex.compile(rb" *[^ ]+| +")
#: Distinct segments that a task remembers.
_REMEMBERED = 300_000
#: Bytes above which a segment is solved by itself.
ALONE = 2048


@dataclass
class Vocabulary:
    base: np.ndarray  # by node
    check: np.ndarray  # parent by node, -1 where free
    piece: np.ndarray  # id by node, -1 where none ends
    score: np.ndarray  # log probability by id
    text: list[bytes]  # by id, spaces for markers
    byte: np.ndarray  # id of each byte's piece
    unknown: float
    apart: bool  # no piece has a marker after another character
    lists: list = field(default_factory=list)  # the trie and the scores as lists, made where long segments are solved


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and piece id of the nodes of a trie over byte strings."""
    root: dict = {}
    for key, ident in keys:
        node = root
        for b in key:
            node = node.setdefault(b, {})
        node[-1] = ident
    nodes, queue = 1, [(root, 0)]
    for node, _ in queue:
        children = [node[b] for b in node if b >= 0]
        nodes += len(children)
        queue += [(x, 0) for x in children]
    size, span = 2 * nodes + 4096, 512
    base, check, piece, used = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1), np.zeros(size, bool)
    used[0] = True
    free, wide, queue = 1, 1, [(root, 0)]
    for node, at in queue:
        piece[at] = node.get(-1, -1)
        labels = sorted(b for b in node if b >= 0)
        if not labels:
            continue
        while used[free]:
            free += 1
        start = max(1, (free if len(labels) == 1 else max(free, wide)) - labels[0])
        while True:  # the first place where all labels find a free node
            if start + span + 256 > len(used):
                grown = len(used)
                base, check, piece, used = (np.concatenate([x, np.full(grown, y, x.dtype)]) for x, y in ((base, 0), (check, -1), (piece, -1), (used, False)))
            taken = used[start + labels[0] : start + labels[0] + span].copy()
            for b in labels[1:]:
                taken |= used[start + b : start + b + span]
            if not taken.all():
                start += int(np.argmin(taken))
                break
            start += span
        base[at], wide = start, wide if len(labels) == 1 else max(wide, start + labels[0] - span)
        for b in labels:
            check[start + b], used[start + b] = at, True
            queue.append((node[b], start + b))
    check[0] = 0
    return base, check, piece


def load(path: str) -> Vocabulary:
    """Read on the driver; its size is that of the vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    byte, text, plain = np.zeros(256, np.int64), [b""] * n, []
    for i in range(n):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte[int(name[3:5], 16)] = i
            text[i] = bytes([int(name[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text[i] = name.replace(MARK, " ").encode()
            plain.append((text[i], i))
    score = log_probabilities(np.array([model.get_score(i) for i in range(n)]), np.array([i for _, i in plain]))
    apart = not any(b" " in t.lstrip(b" ") for t, _ in plain)
    return Vocabulary(*double_array(plain), score, text, byte, float(min(score[i] for _, i in plain)) - 10, apart)


def log_probabilities(score: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Scores of a unigram file as they are; whole numbers are merge ranks, turned by Zipf's law (equal ranks share a probability)."""
    own = score[pieces]
    if not np.array_equal(own, np.round(own)):
        return score
    ranks = np.searchsorted(np.sort(-own), -own)
    out, chance = np.full(len(score), -np.inf), 1 / (ranks + 1)
    out[pieces] = np.log(chance / chance.sum())
    return out


def solve(segments: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Best piece ids of each segment; works on all segments of about a length at once."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(segments)
    order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
    lo = 0
    while lo < len(order):
        hi, longest = lo, len(segments[order[lo]]) * 5 // 4 + 8
        while hi < len(order) and len(segments[order[hi]]) <= longest and (hi - lo + 1) * longest <= 2_000_000 + longest:
            hi += 1
        idx = order[lo:hi]
        lo = hi
        lengths = np.array([len(segments[i]) for i in idx])
        width = int(lengths.max())
        text = np.zeros((len(idx), width), np.uint8)
        text[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(segments[i] for i in idx), np.uint8)
        best = np.full((len(idx), width + 1), -np.inf)
        best[:, 0] = 0
        came, ident = np.zeros((len(idx), width + 1), np.int64), np.full((len(idx), width + 1), -1)
        for s in range(width):
            rows = np.flatnonzero((lengths > s) & (best[:, s] > -np.inf))
            if not len(rows):
                continue
            lead = text[rows, s]
            char = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            single = np.zeros(len(rows), bool)
            node, alive, t = np.zeros(len(rows), np.int64), np.arange(len(rows)), s
            while len(alive) and t < width:
                alive = alive[lengths[rows[alive]] > t]
                to = v.base[node[alive]] + text[rows[alive], t]
                fits = (v.base[node[alive]] > 0) & (v.check[to] == node[alive])
                alive, to = alive[fits], to[fits]
                node[alive] = to
                t += 1
                ends = alive[v.piece[to] >= 0]
                if len(ends):
                    r, p = rows[ends], v.piece[node[ends]]
                    value = best[r, s] + v.score[p]
                    better = value > best[r, t]
                    best[r[better], t], came[r[better], t], ident[r[better], t] = value[better], s, p[better]
                    single[ends[char[ends] == t - s]] = True
            lost = np.flatnonzero(~single)
            if len(lost):
                r, t_ = rows[lost], np.minimum(s + char[lost], lengths[rows[lost]])
                value = best[r, s] + v.unknown
                better = value > best[r, t_]
                r, t_ = r[better], t_[better]
                best[r, t_], came[r, t_], ident[r, t_] = value[better], s, -1
        for n, i in enumerate(idx):
            path, t = [], int(lengths[n])
            while t:
                s, p = int(came[n, t]), int(ident[n, t])
                path += [p] if p >= 0 else [int(v.byte[b]) for b in reversed(segments[i][s:t])]
                t = s
            out[i] = np.array(path[::-1], np.int64)
    return out


def solve_long(segment: bytes, v: Vocabulary) -> np.ndarray:
    """The same for one segment, walking the trie byte by byte: where nothing stands beside it, arrays of one row only cost."""
    if not v.lists:
        v.lists.extend(x.tolist() for x in (v.base, v.check, v.piece, v.score))
    (base, check, piece, score), n, never = v.lists, len(segment), -math.inf
    best, came, ident = array("d", [never]) * (n + 1), array("q", [0]) * (n + 1), array("i", [-1]) * (n + 1)
    best[0] = 0.0
    for s in range(n):
        at = best[s]
        if at == never:
            continue
        lead = segment[s]
        char, single, node, t = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4, False, 0, s
        while t < n and base[node] > 0:
            to = base[node] + segment[t]
            if check[to] != node:
                break
            node, t = to, t + 1
            p = piece[node]
            if p >= 0:
                if at + score[p] > best[t]:
                    best[t], came[t], ident[t] = at + score[p], s, p
                single |= t - s == char
        if not single:
            t = min(s + char, n)
            if at + v.unknown > best[t]:
                best[t], came[t], ident[t] = at + v.unknown, s, -1
    path, t = [], n
    while t:
        s, p = came[t], ident[t]
        path += [p] if p >= 0 else [int(v.byte[b]) for b in reversed(segment[s:t])]
        t = s
    return np.array(path[::-1], np.int64)


def encode(texts: list[str | None], v: Vocabulary, memory: dict) -> list[np.ndarray]:
    pieces, parts = [], []
    for t in texts:
        raw = b" " + t.encode() if t else b""
        parts.append(_SEGMENT.findall(raw) if v.apart else [raw] * bool(raw))
    new = list({s for p in parts for s in p if s not in memory})
    if len(memory) + len(new) > _REMEMBERED:
        memory.clear()
        new = list({s for p in parts for s in p})
    long = [s for s in new if len(s) > ALONE]
    memory.update(zip(long, (solve_long(s, v) for s in long)))
    new = [s for s in new if len(s) <= ALONE]
    memory.update(zip(new, solve(new, v)))
    for p in parts:
        pieces.append(np.concatenate([memory[s] for s in p]) if p else np.zeros(0, np.int64))
    return pieces


def decode(pieces, v: Vocabulary) -> str:
    return b"".join(v.text[i] for i in pieces)[1:].decode("utf-8", "replace")


def encoded(df: DataFrame, text: str, vocabulary: Vocabulary, with_ids: bool = True) -> DataFrame:
    """Adds to all rows and columns: n_pieces, n_byte_pieces, ids_sha256 (of little-endian 32-bit ids), round_trip, and with ``with_ids`` ids."""
    df = H.without(df, "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip", "ids")
    H.small_batches(df.sparkSession, 500)
    shared, place, columns = df.sparkSession.sparkContext.broadcast(vocabulary), df.columns.index(text), df.columns

    def run(batches):
        v, memory = shared.value, {}
        is_byte = np.zeros(len(v.score), bool)
        is_byte[v.byte] = True
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = encode(texts, v, memory)
            whole = [decode(x, v) == (t or "") for x, t in zip(found, texts)]
            more = [
                pa.array([len(x) for x in found], pa.int64()), pa.array([int(is_byte[x].sum()) for x in found], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in found], pa.string()), pa.array(whole, pa.bool_()),
            ]
            if with_ids:
                more.append(pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*columns, "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip", "ids"][: len(columns) + len(more)])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids)


def decoded(df: DataFrame, ids: str, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``decoded`` text; null ids give null."""
    shared, place, columns = df.sparkSession.sparkContext.broadcast(vocabulary), df.columns.index(ids), df.columns

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None if x is None else decode(x, shared.value) for x in batch.column(place).to_pylist()], pa.string())], [*columns, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.select(*(F.col(c) for c in columns)).mapInArrow(run, f"{fields}, decoded string")
