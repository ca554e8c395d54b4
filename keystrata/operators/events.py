"""Event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import bucket_ms
from .keyed import first_per_key


def first_visible(log: DataFrame, session: str, order: list[str], visible: Column, values: list[str]) -> DataFrame:
    """The one counted row of each session: its first visible one."""
    return first_per_key(log.where(visible), [session], order, values)


def toggle_parity(log: DataFrame, key: str, toggles: Column) -> DataFrame:
    """Whether an odd number of toggles leaves a key's flag set."""
    return log.groupBy(key).agg((F.count_if(toggles) % 2 == 1).alias("flag"))


def throttled(log: DataFrame, key: str, ts: str, order: list[str], width_ms: int, values: list[str]) -> DataFrame:
    """The first row of each key and time bucket."""
    return first_per_key(log.withColumn("bucket", bucket_ms(F.col(ts), width_ms)), [key, "bucket"], order, values)


def evicted(cache: DataFrame, namespace: str, current: str) -> DataFrame:
    """What remains of a cache at start-up: rows of the current namespace only."""
    return cache.where(F.col(namespace) == current)
