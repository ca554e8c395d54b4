"""Rule tables (O12-O14, O17d, O36, G24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import first_per_key


def inline(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table as literals of the plan."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _first_rules(rules: DataFrame, key: str, order: list[str] | None) -> DataFrame:
    """The first rule of each key by order, then by the other columns."""
    values = [c for c in rules.columns if c != key]
    return first_per_key(rules, [key], [*(order or []), *values], values) if values else rules.distinct()


def lookup(rows: DataFrame, rules: DataFrame, selector: str, key: str, order: list[str] | None = None) -> DataFrame:
    """rows with the first rule of their selector, by order and then the rules' other columns; rows that find none are left out (no write)."""
    return rows.join(_first_rules(rules, key, order), F.col(selector) == F.col(key)).drop(key)


def decision_overlay(rows: DataFrame, rules: DataFrame, selector: str, key: str, default: str, order: list[str] | None = None) -> DataFrame:
    """As lookup, but a null or empty selector takes the default rule."""
    chosen = F.coalesce(F.nullif(F.col(selector), F.lit("")), F.lit(default))
    return rows.withColumn("#chosen", chosen).join(_first_rules(rules, key, order), F.col("#chosen") == F.col(key)).drop("#chosen", key)


def unpivot(rows: DataFrame, pairs: list[tuple[Column, Column]], *keep: str) -> DataFrame:
    """One (key, value) row for each pair; a key may depend on the row."""
    return rows.select(*keep, F.explode(F.array(*(F.struct(k.alias("key"), v.cast("string").alias("value")) for k, v in pairs))).alias("kv")).select(*keep, "kv.key", "kv.value")


def zip_positions(rows: DataFrame, left: Column, right: Column, *keep: str, header_rows: int = 2) -> DataFrame:
    """Parallel arrays as rows: position from 0, presented row, both elements."""
    zipped = F.arrays_zip(left.alias("a"), right.alias("b"))
    return rows.select(*keep, F.posexplode(zipped).alias("pos", "z")).select(*keep, "pos", (F.col("pos") + header_rows).alias("ui_row"), F.col("z.a").alias("a"), F.col("z.b").alias("b"))


def localised(rows: DataFrame, texts: DataFrame, key: str, locale: str) -> DataFrame:
    """rows with `label` from a (key, locale, text) dictionary; null where it has none."""
    t = texts.select(F.col("key").alias(key), F.col("locale").alias(locale), F.col("text").alias("label"))
    return rows.join(t, [key, locale], "left")
