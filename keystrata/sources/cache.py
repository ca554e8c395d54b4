"""Tables cached by calendar month (G21): partitions that are replaced, pruned and evicted whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import _files

MONTH = "month"


def put_months(df: DataFrame, path: str, ts: str) -> None:
    """Write df by month of a timestamp. Months that df has rows of are replaced, others stay."""
    dated = df.withColumn(MONTH, F.date_format(ts, "yyyy-MM"))
    dated.where(F.col(MONTH).isNotNull()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def months(spark: SparkSession, path: str) -> list[str]:
    """Months held, oldest first."""
    files, at = _files(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    return sorted(n.removeprefix(f"{MONTH}=") for n in names if n.startswith(f"{MONTH}="))


def evict(spark: SparkSession, path: str, current: str, months_kept: int = 1) -> list[str]:
    """Drop all months but the last months_kept up to the current one; those dropped. No row is read or written."""
    held = months(spark, path)
    kept = set([m for m in held if m <= current][-months_kept:])
    for m in (m for m in held if m not in kept):
        files, at = _files(spark, f"{path}/{MONTH}={m}")
        files.delete(at, True)
    return [m for m in held if m not in kept]


def read_months(spark: SparkSession, path: str, schema: str, first: str | None = None) -> DataFrame:
    """Rows held with their month (text); from a month on, only its partitions and later ones are listed and read."""
    rows = spark.read.schema(f"{schema}, {MONTH} string").parquet(path)
    return rows.where(F.col(MONTH) >= first) if first else rows
