"""Log and continue (O12, O26): bad rows kept apart with a reason, and counted, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.store import scratch


def reasoned(rows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """rows with `reason`: the first whose condition holds (null doesn't), null for good rows."""
    return rows.withColumn("reason", F.coalesce(*(F.when(c, F.lit(n)) for n, c in reasons.items())))


def quarantined(rows: DataFrame, reasons: dict[str, Column], path: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good rows, bad rows with `reason`, counts of all rows and of each reason).

    rows are run once: good and bad ones are written side by side, and observed on the way. The counts are those
    of the rows written, however often the result is read.
    """
    path, seen = path or scratch(rows.sparkSession), Observation()
    tagged = reasoned(rows, reasons).observe(seen, F.count("*").alias("rows"), *(F.count_if(F.coalesce(F.col("reason") == n, F.lit(False))).alias(n) for n in reasons))
    tagged.withColumn("#bad", F.col("reason").isNotNull()).write.partitionBy("#bad").parquet(path)
    held = rows.sparkSession.read.schema(tagged.schema.add("#bad", "boolean")).parquet(path)
    return held.where("not `#bad`").drop("#bad", "reason"), held.where("`#bad`").drop("#bad"), {k: int(v) for k, v in seen.get.items()}
