"""Ordered lists without a task that holds one: dense positions and running values.

Rows are dealt by ranges of their order and written once, each with a number that grows with the order
(`#at`). What a range has to know of those before it (rows, or the running values of the one group
that reaches into it) is a row or two a range, so a hot group is split over ranges like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written
from .keyed import first_per_key, move_after

#: monotonically_increasing_id keeps the partition above these bits.
_BITS = 33


def ranged(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """rows, written once, with `#at`: a long that grows with the order over all rows (nulls first)."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.withColumn("#at", F.monotonically_increasing_id()))


def _range() -> Column:
    return F.shiftright("#at", _BITS)


def numbered(rows: DataFrame, order: list[Column | str], name: str = "pos", start: int = 0) -> DataFrame:
    """rows with their dense position in a total order, from start."""
    placed = ranged(rows, order)
    counts = placed.groupBy(_range().alias("#range")).agg(F.count("*").alias("#rows"), F.min("#at").alias("#first"))
    # a row a range
    before = Window.orderBy("#range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("#range", "#first", F.coalesce(F.sum("#rows").over(before), F.lit(0)).alias("#before"))
    joined = placed.withColumn("#range", _range()).join(F.broadcast(offsets), "#range")
    return joined.withColumn(name, F.col("#at") - F.col("#first") + F.col("#before") + start).drop("#range", "#first", "#before", "#at")


def running(placed: DataFrame, group: list[str], sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None) -> DataFrame:
    """placed (from `ranged`, ordered by group first) with running values of the rows of the group before each.

    Sums are 0 and maxima null before the first row.
    """
    parts = [(n, F.sum, c) for n, c in (sums or {}).items()] + [(n, F.max, c) for n, c in (maxima or {}).items()]
    placed = placed.withColumn("#range", _range()).withColumns({f"#v_{n}": c for n, _, c in parts})
    totals = placed.groupBy("#range", *group).agg(*(f(f"#v_{n}").alias(f"#t_{n}") for n, f, _ in parts))
    # a group in several ranges fills all but the first and last of them: at most two such groups a range
    several = totals.groupBy(*group).agg(F.count("*").alias("#n")).where(F.col("#n") > 1)
    same = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group]
    held = totals.alias("l").join(several.alias("r"), same, "left_semi")
    earlier = Window.partitionBy(*group).orderBy("#range").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.select("#range", *(F.col(g).alias(f"#g_{g}") for g in group), *(f(f"#t_{n}").over(earlier).alias(f"#c_{n}") for n, f, _ in parts))
    before = Window.partitionBy("#range", *group).orderBy("#at").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({n: f(f"#v_{n}").over(before) for n, f, _ in parts})
    on = (local["#range"] == carried["#range"]) & F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"#g_{g}"))
    joined = local.join(F.broadcast(carried), on, "left").drop(carried["#range"])
    both = {n: F.coalesce(n, F.lit(0)) + F.coalesce(f"#c_{n}", F.lit(0)) if f is F.sum else F.greatest(n, f"#c_{n}") for n, f, _ in parts}
    return joined.withColumns(both).select(*[c for c in placed.columns if not c.startswith("#v_") and c != "#range"], *both)


def appended(rows: DataFrame, new: DataFrame, key: str, order: list[str], position: str = "pos", status: str = "status") -> DataFrame:
    """rows, then the new rows whose key isn't there, with status 1 and the next positions in their order.

    Of several new rows of a key the first by order counts; new rows with a null key are appended each. order
    has to be total. rows without a position (null) count as none.
    """
    fresh = new.join(rows.select(key), key, "left_anti")
    once = first_per_key(fresh.where(F.col(key).isNotNull()), [key], order, [c for c in new.columns if c != key]).select(*new.columns)
    last = rows.agg(F.max(position)).first()[0]
    listed = numbered(once.unionByName(fresh.where(F.col(key).isNull())), order, position, 0 if last is None else last + 1)
    return rows.unionByName(listed.withColumn(status, F.lit(1).cast(rows.schema[status].dataType)), allowMissingColumns=True)


def moved(rows: DataFrame, position: str, chosen: Column, anchor: Column, before: bool = False) -> DataFrame:
    """rows with the chosen ones right after (or before) the anchor, in their order, and positions renumbered from 0.

    Without an anchor the order stays. An anchor that is chosen itself stands with the rest of them.
    """
    return numbered(move_after(rows, position, chosen, anchor, before), ["sort_key", position], "#new").withColumn(position, F.col("#new")).drop("#new", "sort_key")


def replayed(log: DataFrame, session: str, order: list[str], key: str, op: str) -> DataFrame:
    """The list that a log of operations leaves in each session: session, key, pos (from 0) and status.

    append adds a key with status 1 unless it is there; delete removes it, and bars later appends until a
    restart; disable sets the status of a key that is there to 0, which an append doesn't undo. Barred
    appends and other operations change nothing. A key that survives was added by its first append not
    barred after its last delete, so no state is carried from row to row. order has to be total.
    """
    placed = running(ranged(log, [session, *order]), [session], maxima={"#deleted": F.when(F.col(op) == "delete", F.col("#at")), "#restarted": F.when(F.col(op) == "restart", F.col("#at"))})
    barred = F.coalesce(F.col("#deleted") > F.coalesce("#restarted", F.lit(-1)), F.lit(False))
    kept = placed.where(F.col(key).isNotNull() & F.col(op).isin("append", "delete", "disable") & ~((F.col(op) == "append") & barred)).select(session, key, op, "#at")
    last = kept.where(F.col(op) == "delete").groupBy(session, key).agg(F.max("#at").alias("#gone"))
    left = kept.join(last, [session, key], "left").where((F.col(op) != "delete") & (F.col("#at") > F.coalesce("#gone", F.lit(-1))))
    added = left.groupBy(session, key).agg(F.min(F.when(F.col(op) == "append", F.col("#at"))).alias("#added"), F.max(F.when(F.col(op) == "disable", F.col("#at"))).alias("#off"))
    alive = added.where("`#added` is not null").withColumn("status", F.when(F.col("#off") > F.col("#added"), 0).otherwise(1))
    listed = running(ranged(alive, [session, "#added"]), [session], sums={"pos": F.lit(1)})
    return listed.select(session, key, "pos", "status")


def coverage(rows: DataFrame, group: str, low: str, high: str) -> DataFrame:
    """group, covered (true: a merged interval, false: a stretch between two of them), low and high.

    Intervals low to high are of whole numbers, ends included; adjacent ones merge, empty ones are left
    out. Starts and ends are counted by point before they are ordered; prefix sums give how many
    intervals are open at each point, so a group is swept over as many ranges as it takes.
    """
    given = rows.where(F.col(low) <= F.col(high)).select(F.col(group), F.col(low).cast("long").alias("l"), F.col(high).cast("long").alias("h"))
    ends = given.select(group, F.explode(F.array(F.struct(F.col("l").alias("point"), F.lit(1).alias("by")), F.struct((F.col("h") + 1).alias("point"), F.lit(-1).alias("by")))).alias("e")).select(group, "e.*")
    turned = ends.groupBy(group, "point").agg(F.sum("by").alias("by")).where("by <> 0")
    swept = running(ranged(turned, [group, "point"]), [group], sums={"open": F.col("by")})
    # an interval begins where none was open, and is over where none is left
    edges = swept.where("open = 0 or open + by = 0").withColumn("begins", (F.col("open") == 0).cast("long")).select(group, "point", "begins", "#at")
    counted = running(edges, [group], sums={"no": F.col("begins")})
    begins = F.col("begins") == 1
    whole = counted.select(group, F.lit(True).alias("covered"), F.when(begins, F.col("no")).otherwise(F.col("no") - 1).alias("no"), F.when(begins, F.col("point")).alias("low"), F.when(~begins, F.col("point") - 1).alias("high"))
    between = counted.select(group, F.lit(False).alias("covered"), (F.col("no") - 1).alias("no"), F.when(~begins, F.col("point")).alias("low"), F.when(begins, F.col("point") - 1).alias("high"))
    return whole.unionByName(between).groupBy(group, "covered", "no").agg(F.max("low").alias("low"), F.max("high").alias("high")).where("low is not null and high is not null").drop("no")
