"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str = "local[*]", **more: str) -> SparkSession:
    return SparkSession.builder.master(master).config(map=DEFAULTS | more).getOrCreate()
