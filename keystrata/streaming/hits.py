"""Streaming forms of event operators. Throttling and binding are extensions: those surveyed are batch only."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def throttled(stream: DataFrame, key: str, ts: str, width: str = "40 milliseconds", late: str = "10 minutes") -> DataFrame:
    """First row time of each key and bucket; state is dropped once the watermark has passed it."""
    timed = stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", late)
    return timed.groupBy(F.window("event_time", width), key).agg(F.min("event_time").alias("first_ts"), F.count("*").alias("n")).select(F.col("window.start").alias("bucket"), key, "first_ts", "n")


def bind_once(stream: DataFrame, key: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """Rows whose key wasn't seen within the watermark."""
    return stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", late).dropDuplicatesWithinWatermark([key]).drop("event_time")


class FirstVisible(StatefulProcessor):
    """A session is counted once, when it is first seen visible; nothing else is kept of it.

    Its state is a flag. A timer, set again by each row, drops the flag when the session has been quiet for
    `quiet_ms` of event time: a session that comes back later is a new one.
    """

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counted = handle.getValueState("counted", "at timestamp, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, last = None, None
        for part in rows:
            seen, latest = part.loc[part["visible"].fillna(False).astype(bool), "event_time"], part["event_time"].max()
            first = min([x for x in (first, seen.min() if len(seen) else None) if x is not None], default=None)
            last = latest if last is None else max(last, latest)
        held = self.counted.get() if self.counted.exists() else None
        if held is None and first is not None:
            yield pd.DataFrame({"session": [key[0]], "counted_at": [first]})
        timer = int(last.timestamp() * 1000) + self.quiet_ms
        if held is not None and held[1] is not None:
            timer = max(timer, held[1])
            if timer != held[1]:
                self.handle.deleteTimer(held[1])
        if held is not None or first is not None:
            self.handle.registerTimer(timer)
            self.counted.update((held[0] if held is not None else first, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counted.clear()
        yield pd.DataFrame({"session": pd.Series([], dtype=object), "counted_at": pd.Series([], dtype="datetime64[ns]")})

    def close(self) -> None:
        pass


def first_visible(stream: DataFrame, session: str, ts: str, visible: str, quiet: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """session and counted_at of each session at its first visible row of a step; needs the RocksDB state store."""
    quiet_ms = int(pd.Timedelta(quiet).total_seconds() * 1000)
    given = stream.select(F.col(session).cast("string").alias("session"), F.col(ts).cast("timestamp").alias("event_time"), F.col(visible).alias("visible")).where("session is not null and event_time is not null")
    return given.withWatermark("event_time", late).groupBy("session").transformWithStateInPandas(FirstVisible(quiet_ms), "session string, counted_at timestamp", "append", "eventTime")
