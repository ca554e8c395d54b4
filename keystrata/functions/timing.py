"""Time keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(ts: Column, prefix: str = "cache") -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.date_format(ts, "yyyy-MM"))


def bucket_ms(ts: Column, width_ms: int) -> Column:
    """Number of the time bucket of a timestamp."""
    return F.floor(F.unix_millis(ts.cast("timestamp")) / width_ms)
