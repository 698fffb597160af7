"""Stalls: a watched item that gives no sign of life for too long, by event-time timers, one item's state at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siftstone.streaming.resume import large_state

OUT = StructType([StructField("item", StringType()), StructField("at_us", LongType()), StructField("stalls", LongType())])


class Watch(StatefulProcessor):
    """State of an item: its last sign, whether that silence has been counted, and its stalls so far. Times are microseconds."""

    def __init__(self, patience_us: int, tries: int):
        self.patience, self.tries = patience_us, tries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("watched", "last long, counted boolean, stalls long")

    def _count(self, key: Any, last: int, stalls: int) -> Iterator[pd.DataFrame]:
        if stalls == self.tries:
            yield pd.DataFrame({"item": [key[0]], "at_us": [last + self.patience], "stalls": [stalls]})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last, counted, stalls = self.state.get() if self.state.exists() else (None, False, 0)
        for at in sorted(t for frame in rows for t in frame["at_us"].tolist()):
            if last is not None and at < last:
                continue  # older than a sign of an earlier batch
            if last is not None and not counted and at - last > self.patience:
                stalls += 1
                yield from self._count(key, last, stalls)
            last, counted = at, False
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if stalls < self.tries:
            self.handle.registerTimer((last + self.patience) // 1000 + 1)
        self.state.update((last, False, stalls))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        last, counted, stalls = self.state.get()
        if not counted and expiredTimerInfo.getExpiryTimeInMs() > (last + self.patience) // 1000:
            self.state.update((last, True, stalls + 1))
            yield from self._count(key, last, stalls + 1)

    def close(self) -> None:
        pass


def quarantined(signs: DataFrame, patience: str = "30 minutes", tries: int = 2, late: str = "10 seconds", item: str = "item", at: str = "at") -> DataFrame:
    """(item, at, stalls) when a streamed item has stalled `tries` times: no sign for longer than `patience`.

    signs: a stream with a sign of life a row. A silence counts once, when the watermark (the latest sign of
    all less `late`) has passed its end, or when the next sign shows it. An item is reported once. Signs later
    than the watermark allows are dropped by the engine; null items are one item, null times are no signs.
    """
    spark = signs.sparkSession
    large_state(spark)
    us = spark.range(1).select(F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {patience})").alias("us")).first().us
    rows = signs.filter(F.col(at).isNotNull()).withWatermark(at, late).select(F.col(item).cast("string").alias("item"), at, F.unix_micros(at).alias("at_us"))
    found = rows.groupBy("item").transformWithStateInPandas(Watch(us, tries), OUT, "append", "eventTime")
    return found.select("item", F.timestamp_micros("at_us").alias("at"), "stalls")
