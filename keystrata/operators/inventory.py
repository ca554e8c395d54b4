"""Inventory reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keyed import first_per_key


def id_split(rows: DataFrame, column: str, separator: str = "/") -> DataFrame:
    """One row a part of a composite id, as `part`, with its place."""
    return rows.select("*", F.posexplode(F.split(F.col(column), f"\\Q{separator}\\E")).alias("part_no", "part"))


def range_bounds(text: Column) -> tuple[Column, Column]:
    """(low, high) of '1-160'."""
    parts = F.split(text, "-")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def range_expand(rows: DataFrame, column: str) -> DataFrame:
    """One row a point of each range: for small ranges; in_ranges and range_tiling don't expand."""
    low, high = range_bounds(F.col(column))
    return rows.where(low <= high).select("*", F.explode(F.sequence(low, high)).alias("point"))


def in_ranges(points: DataFrame, value: str, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """points joined to each range low <= value <= high of whole numbers; any ranges, overlapping or not.

    A range belongs to the level of the power of two that is its length at least, where it touches
    two bins at most; a point meets one bin of each level there is (64 at most). So it's an equi-join
    with two rows a range and one a point and level, and no range is expanded. Null matches nothing.
    """
    sized = ranges.where(F.col(low) <= F.col(high)).withColumn("#level", F.ceil(F.log2(F.col(high).cast("double") - F.col(low) + 1)).cast("int"))
    levels = sorted(r[0] for r in sized.select("#level").distinct().collect())  # 64 numbers at most
    if not levels:
        levels = [0]
    width = lambda level: F.pow(F.lit(2), level).cast("long")
    bin_of = lambda x, level: F.floor(x / width(level)).cast("long")
    bins = F.array_distinct(F.array(bin_of(F.col(low), F.col("#level")), bin_of(F.col(high), F.col("#level"))))
    held = sized.withColumn("#bin", F.explode(bins))
    asked = points.where(F.col(value).isNotNull()).withColumn("#level", F.explode(F.array(*map(F.lit, levels)))).withColumn("#bin", bin_of(F.col(value), F.col("#level")))
    return asked.join(held, ["#level", "#bin"]).where((F.col(value) >= F.col(low)) & (F.col(value) <= F.col(high))).drop("#level", "#bin")


def range_tiling(rows: DataFrame, group: str, low: str, high: str) -> DataFrame:
    """Per group: points (sum of lengths), first and last, and how many ranges leave a gap to, or overlap, those before.

    Ranges are ordered by low, then high; ranges without points are left out.
    """
    before = Window.partitionBy(group).orderBy(low, high).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.where(F.col(low) <= F.col(high)).withColumn("#reach", F.max(high).over(before))
    return seen.groupBy(group).agg(
        F.sum(F.col(high).cast("long") - F.col(low) + 1).alias("points"),
        F.min(low).alias("first"),
        F.max(high).alias("last"),
        F.count_if(F.col(low) > F.col("#reach") + 1).alias("gaps"),
        F.count_if(F.col(low) <= F.col("#reach")).alias("overlaps"),
    )


def override(official: Column, qa: Column) -> tuple[Column, Column]:
    """(the official figure, else the checked one; deviation of the checked one in percent)."""
    return F.coalesce(official, qa), F.when(official != 0, (qa - official) / official * 100)


def publish_split(rows: DataFrame, defensible: Column) -> DataFrame:
    """rows with `route`: published only where the transformation is known to be sound."""
    return rows.withColumn("route", F.when(defensible, "published").otherwise("pending"))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Full outer comparison on a key: side, and for each column whether both agree (null equals null)."""
    a = left.select(key, *(F.col(c).alias(f"left_{c}") for c in columns), F.lit(True).alias("#left"))
    b = right.select(key, *(F.col(c).alias(f"right_{c}") for c in columns), F.lit(True).alias("#right"))
    side = F.when(F.col("#right").isNull(), "left").when(F.col("#left").isNull(), "right").otherwise("both")
    return a.join(b, key, "full_outer").select(key, side.alias("side"), *(F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")).alias(f"same_{c}") for c in columns))


def children_with_parent(children: DataFrame, parents: DataFrame, parent_key: str, id_key: str) -> DataFrame:
    return children.join(parents, F.col(parent_key) == F.col(id_key))


def orphans(children: DataFrame, parents: DataFrame, parent_key: str, id_key: str) -> DataFrame:
    """Children without a parent; a null parent counts as none."""
    return children.join(parents.select(id_key), F.col(parent_key) == F.col(id_key), "left_anti")


def childless(parents: DataFrame, children: DataFrame, id_key: str, parent_key: str) -> DataFrame:
    return parents.join(children.select(parent_key), F.col(id_key) == F.col(parent_key), "left_anti")


def secondary_match(left: DataFrame, right: DataFrame, pair: list[str]) -> DataFrame:
    """Inner join on a pair of keys; null never matches. To count matches, see secondary_counts."""
    return left.join(right, pair)


def secondary_counts(left: DataFrame, right: DataFrame, pair: list[str], *by: str) -> DataFrame:
    """Number of matches on a pair of keys, by some of them: both sides are counted first, so no pair of rows is made."""
    a, b = (x.groupBy(*pair).agg(F.count("*").alias(n)) for x, n in ((left, "#a"), (right, "#b")))
    return a.join(b, pair).groupBy(*by).agg(F.sum(F.col("#a") * F.col("#b")).alias("n"))


def layer_union(layers: dict[str, DataFrame], include: list[str], class_column: str) -> DataFrame:
    """All layers with their name, columns missing in one null, of the included classes."""
    out: DataFrame | None = None
    for name, rows in layers.items():
        tagged = rows.where(F.col(class_column).isin(*include)).withColumn("layer", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no layers")
    return out


def curated_overlay(rows: DataFrame, curated: DataFrame, pair: list[str], order: list[str]) -> DataFrame:
    """rows, overlaid by curated ones: a curated row replaces all rows of its pair of keys.

    Of several curated rows of a pair the first by order (then by its other columns) counts. A pair
    with a null matches nothing: such rows of both are kept each.
    """
    whole = F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull()
    values = [c for c in curated.columns if c not in pair]
    first = first_per_key(curated.where(whole), pair, [*order, *(v for v in values if v not in order)], values) if values else curated.where(whole).distinct()
    kept = rows.join(first.select(*pair), pair, "left_anti")
    return kept.unionByName(first, allowMissingColumns=True).unionByName(curated.where(~whole), allowMissingColumns=True)


def status_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def route_live(rows: DataFrame, live: Column) -> DataFrame:
    return rows.withColumn("route", F.when(live, "live").otherwise("cached"))
