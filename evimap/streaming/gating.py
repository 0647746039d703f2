"""The gate of the fetch cycle as a stream: which work is due, kept by state and one timer for each key.

The stream has rows of the fetch log (``status`` says how a fetch ended) and
requests (``asks`` is true); a row can be both.  A key that was asked for is due
until a good fetch, and again once its newest good fetch is older than the
limit; fetches that failed leave it as it was.  That is ``enrich.needs_refetch``,
but a key costs work only when a row of it comes or its timer ends, however
long the log is.

Each change of a key goes out once, numbered from 1: due or not, since when
(milliseconds).  ``work_list`` is the newest change of each key.  Changes go to
files whose names the checkpoint holds, so a query that is started again neither
repeats nor loses one.

Rows with a null key are left out, as are log rows without a time; rows that
repeat change nothing.  Rows may come in any order.  With ``clock`` None, the
time of day decides and no row is ever late.  Else it names a column of event
times: the time is then the newest event less ``delay``, and rows older than that
are dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd

from evimap.operators.dedup import last_per_key
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

_PROVIDER, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY = 86_400_000


class Gate(StatefulProcessor):
    """State of a key: asked for since, newest good fetch, last change sent and its number, time of the timer (0: none)."""

    def __init__(self, names: Sequence[str], max_age: int, event_time: bool) -> None:
        self.names, self.max_age, self.event_time = list(names), max_age, event_time

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("gate", "asked long, good long, due boolean, number long, timer long")

    def _judged(self, key: tuple, asked: int | None, good: int | None, due: bool, number: int, timer: int, times) -> Iterator[pd.DataFrame]:
        """Moves the timer, keeps the state, and gives the change, if any."""
        now = times.getCurrentWatermarkInMs() if self.event_time else times.getCurrentProcessingTimeInMs()
        ends = 0 if good is None else good + self.max_age + 1  # a fetch of just the limit's age is still fresh
        is_due = asked is not None and ends <= now if good is not None else asked is not None
        wanted = ends if asked is not None and good is not None and not is_due else 0
        if timer != wanted:
            if timer:
                self.handle.deleteTimer(timer)
            if wanted:
                self.handle.registerTimer(wanted)
        changed = is_due != due
        if asked is not None or good is not None:
            self.state.update((asked, good, is_due, number + changed, wanted))
        if changed:
            since = good if not is_due else asked if good is None else max(asked, good + self.max_age)
            yield pd.DataFrame([(*key, number + 1, is_due, since)], columns=self.names)

    def _kept(self) -> tuple:
        return tuple(self.state.get()) if self.state.exists() else (None, None, False, 0, 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        asked, good, due, number, timer = self._kept()
        for part in rows:
            asks, goods = part.loc[part["asks"], "ms"], part.loc[part["good"], "ms"]
            asked = min([int(x) for x in ([asked] if asked is not None else []) + ([asks.min()] if len(asks) else [])], default=None)
            good = max([int(x) for x in ([good] if good is not None else []) + ([goods.max()] if len(goods) else [])], default=None)
        yield from self._judged(key, asked, good, due, number, timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        asked, good, due, number, _ = self._kept()
        yield from self._judged(key, asked, good, due, number, 0, timerValues)

    def close(self) -> None:
        pass


def changes(rows: DataFrame, keys: Sequence[str], stamp: str, status: str, asks: str, max_age_days: float, good: Sequence[str] = ("ok", "empty"), clock: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """``keys``, number, due, since (milliseconds) of a streaming frame of log rows and requests."""
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    ms = F.unix_millis(F.col(stamp).cast("timestamp"))
    inner = [F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)]  # names of its own, which rows of any names cannot clash with
    slim = rows.where(there & F.col(stamp).isNotNull()).select(*inner, ms.alias("ms"), F.coalesce(F.col(status).isin(*good), F.lit(False)).alias("good"), F.coalesce(F.col(asks), F.lit(False)).alias("asks"), *([F.col(clock).cast("timestamp").alias("clock")] if clock else []))
    slim = slim.withWatermark("clock", delay) if clock else slim.where("good or asks")  # failed fetches move an event clock on
    shape = StructType([StructField(k, slim.schema[i].dataType) for i, k in enumerate(keys)]).add("number", LongType()).add("due", BooleanType()).add("since", LongType())
    return slim.groupBy(*slim.columns[: len(keys)]).transformWithStateInPandas(Gate(shape.names, int(max_age_days * _DAY), clock is not None), shape, "Append", "EventTime" if clock else "ProcessingTime")


def start(found: DataFrame, folder: str, clock: str | None = None, every: str | None = None) -> StreamingQuery:
    """Writes the changes below ``folder``, which all executors share: all that has landed, then stops; with ``every`` (an interval) it goes on.

    ``clock`` as for ``changes``.  By the time of day a run is one batch, as
    timers that can always end would keep it from stopping.
    """
    conf = found.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)  # timers need it; the query keeps the settings it started with
    try:
        out = found.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/changes").option("checkpointLocation", f"{folder}/checkpoint")
        return out.trigger(**({"processingTime": every} if every else {"availableNow": True} if clock else {"once": True})).start()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)


def work_list(sent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and since of the keys that are due, from the changes as they were written."""
    return last_per_key(sent, list(keys), "number").where("due").select(*keys, "since")
