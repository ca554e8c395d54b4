"""Measures that mustn't be added up (G20): a mark in a column's metadata, and sums that heed it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_ADDITIVE = "non_additive"


def non_additive(column: Column, name: str, why: str) -> Column:
    """column as name, marked. Selecting, filtering, joining and grouping keep the mark, an expression drops it."""
    return column.alias(name, metadata={NON_ADDITIVE: why})


def reason(df: DataFrame, name: str) -> str | None:
    """Why a column mustn't be added up; null if it may."""
    return df.schema[name].metadata.get(NON_ADDITIVE)


def totals(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Sums of columns by group; a marked column is refused."""
    marked = {c: why for c in columns if (why := reason(df, c))}
    if marked:
        raise ValueError("not additive: " + "; ".join(f"{c} ({why})" for c, why in marked.items()))
    return df.groupBy(*by).agg(*(F.sum(c).alias(c) for c in columns))


def summary(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Sums of columns that may be added, largest values (still marked) of those that mayn't."""
    return df.groupBy(*by).agg(*(non_additive(F.max(c), c, why) if (why := reason(df, c)) else F.sum(c).alias(c) for c in columns))
