"""Edit distances of many pairs of titles: a column of the table of distances is one number of as many bits as a title has characters.

The method is that of Myers (1999): bits tell where the distance rises or falls
from one row to the next, and a handful of operations on whole numbers moves them
one character on.  What two titles begin and end with alike is taken off first, and
a pair is left as soon as its distance must be beyond its limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters after which a pair is looked at again whether it can still be within its limit.
STEP = 64


def _shared_start(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def distance(a: str, b: str, limit: int) -> int:
    """Insertions, deletions and replacements of characters between two titles, or -1 beyond ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return -1
    k = _shared_start(a, b)
    a, b = a[k:], b[k:]
    k = _shared_start(a[::-1], b[::-1])
    a, b = a[: len(a) - k], b[: len(b) - k]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) if len(b) <= limit else -1
    places: dict[str, int] = {}
    bit = 1
    for c in a:
        places[c] = places.get(c, 0) | bit
        bit <<= 1
    every, last = bit - 1, bit >> 1
    rises, falls, d, of = every, 0, len(a), places.get
    for at in range(0, len(b), STEP):
        # each character that is left lowers the distance by one at most
        if d - (len(b) - at) > limit:
            return -1
        for c in b[at : at + STEP]:
            equal = of(c, 0)
            x = (((equal & rises) + rises) ^ rises) | equal | falls
            up, down = falls | (every & ~(x | rises)), rises & x
            if up & last:
                d += 1
            elif down & last:
                d -= 1
            up = (up << 1) | 1
            x = equal | falls
            rises, falls = ((down << 1) | (every & ~(x | up))) & every, up & x & every
    return d if d <= limit else -1


def levenshtein_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (title_l, title_r, limit and any other columns) within their limit, with their distance as the last column."""
    for batch in batches:
        left, right, limit = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("title_l", "title_r", "limit"))
        d = [distance(*pair) for pair in zip(left, right, limit)]
        within = pa.array([x >= 0 for x in d])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d, pa.int32())], [*batch.schema.names, "d"]).filter(within)


def measured(pairs: DataFrame) -> DataFrame:
    """Pairs with a column ``d`` of their distance, those beyond ``limit`` left out."""
    return pairs.mapInArrow(levenshtein_within, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pairs.schema)}, d int")
