"""Keyed lists.

"First" and "last" are grouped minima and maxima with partial results before the shuffle, not
windows, so a key with very many rows costs no task more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remove_key(rows: DataFrame, key: str, value: object) -> DataFrame:
    """Rows whose key isn't the value; rows without a key stay, all duplicates go."""
    return rows.where(~F.col(key).eqNullSafe(F.lit(value)))


def containing(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in others; null never does."""
    return rows.join(others.select(key), key, "left_semi")


def lacking(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key doesn't occur in others (guard against loading twice); null never does."""
    return rows.join(others.select(key), key, "left_anti")


def first_per_key(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """keys and the values of each key's first row by order (total, nulls first)."""
    picked = F.min_by(F.struct(*values), F.struct(*order)).alias("first")
    return rows.groupBy(*keys).agg(picked).select(*keys, *(F.col(f"first.{v}").alias(v) for v in values))


def status_binary(entries: DataFrame, installed: DataFrame, key: str) -> DataFrame:
    """entries with status active or error; duplicates in installed don't multiply entries."""
    there = installed.select(key).where(F.col(key).isNotNull()).distinct().withColumn("#there", F.lit(True))
    return entries.join(there, key, "left").withColumn("status", F.when(F.col("#there"), "active").otherwise("error")).drop("#there")


def status_tristate(entries: DataFrame, installed: DataFrame, key: str, order: list[str], status: str) -> DataFrame:
    """entries with the status of the first installed row of their key.

    No row: error. First row's status 0: disabled. Otherwise, a missing status too: active.
    """
    first = first_per_key(installed.where(F.col(key).isNotNull()).withColumn("#off", F.coalesce(F.col(status) == 0, F.lit(False))), [key], order, ["#off"])
    return entries.join(first, key, "left").withColumn("status", F.when(F.col("#off").isNull(), "error").when(F.col("#off"), "disabled").otherwise("active")).drop("#off")


def guarded_append(rows: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """rows, then the new rows whose key isn't there; of several new rows of a key the first.

    The guard is the key itself. New rows with a null key are appended each.
    """
    fresh = new.join(rows.select(key), key, "left_anti")
    keyed = fresh.where(F.col(key).isNotNull())
    once = first_per_key(keyed, [key], order, [c for c in new.columns if c != key]).select(*new.columns)
    return rows.unionByName(once).unionByName(fresh.where(F.col(key).isNull()))


def append_outcome(status: Column) -> Column:
    """What an append does at a present status: nothing, refused as disabled, or installed."""
    return F.when(status == "active", "already_active").when(status == "disabled", "already_disabled").otherwise("installed")


def write_barrier(log: DataFrame, session: str, order: list[str], closes: Column) -> DataFrame:
    """log with `barred`: whether an earlier row of the session closed it to writes."""
    at = F.struct(*order)
    first = log.where(closes).groupBy(session).agg(F.min(at).alias("#closed"))
    return log.join(first, session, "left").withColumn("barred", F.coalesce(at > F.col("#closed"), F.lit(False))).drop("#closed")


def fold_to_map(rows: DataFrame, group: str, key: str, value: str, order: list[str], seed: dict[str, str] | None = None) -> DataFrame:
    """group and `entries`, a map from key to the last value by order, over a seed."""
    last = rows.where(F.col(key).isNotNull()).groupBy(group, key).agg(F.max_by(value, F.struct(*order)).alias("v"))
    folded = last.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col("v"))))).alias("m"))
    if not seed:
        return folded.select(group, F.col("m").alias("entries"))
    start = F.create_map(*(F.lit(x) for kv in seed.items() for x in kv))
    return folded.select(group, F.map_concat(F.map_filter(start, lambda k, _: ~F.map_contains_key(F.col("m"), k)), "m").alias("entries"))


def bind_once(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, all columns."""
    return first_per_key(rows, [key], order, [c for c in rows.columns if c != key]).select(*rows.columns)


def move_after(rows: DataFrame, position: str, moved: Column, anchor: Column, before: bool = False) -> DataFrame:
    """rows with `sort_key`: the moved rows stand right after (or before) the anchor's position.

    Only a key is computed; order by it (then position) to present.
    """
    at = rows.where(anchor).agg(F.min(position).alias("#anchor"))
    # one row, from an aggregate without keys
    return rows.join(F.broadcast(at)).withColumn("sort_key", F.when(moved & F.col("#anchor").isNotNull(), F.col("#anchor") + F.lit(-0.5 if before else 0.5)).otherwise(F.col(position).cast("double"))).drop("#anchor")


def guarded_drop(rows: DataFrame, label: str, drop: list[str], marker: str) -> DataFrame:
    """rows without those labels, if a row labelled marker is there; else all rows."""
    there = rows.where(F.col(label) == marker).agg((F.count("*") > 0).alias("#marked"))
    return rows.join(F.broadcast(there)).where(~(F.col("#marked") & F.coalesce(F.col(label).isin(*drop), F.lit(False)))).drop("#marked")
