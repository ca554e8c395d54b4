"""Planar ring and unit expressions (G3-G6, G18, G19). Rings are open arrays of [x, y]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def axis_swap(ring: Column, order: Column) -> Column:
    """[x, y] pairs from pairs in the declared order: 'Y(E), X(N)' is swapped, others are kept."""
    return F.when(order == "Y(E), X(N)", F.transform(ring, lambda p: F.array(p[1], p[0]))).otherwise(ring)


def ring_area(ring: Column) -> Column:
    """Shoelace area of an open ring, in square units; null under one point, 0 under three."""

    def area(r: Column) -> Column:
        n = F.size(r)
        steps = F.transform(F.sequence(F.lit(0), n - 1), lambda i: r[i][0] * r[(i + 1) % n][1] - r[(i + 1) % n][0] * r[i][1])
        return F.when(n > 0, F.abs(F.aggregate(steps, F.lit(0.0), lambda x, y: x + y)) / 2)

    # bound once: a computed ring would be made anew at every point
    return F.transform(F.array(ring), area)[0]


def ring_area_dka(ring: Column) -> Column:
    return F.round(ring_area(ring) / 1000, 3)


def bbox(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def declared_points(status: Column) -> tuple[Column, Column]:
    """(N, M) of a status text holding __N_of_M__, null without."""
    part = lambda k: F.nullif(F.regexp_extract(status, r"__(\d+)_of_(\d+)__", k), F.lit("")).cast("int")
    return part(1), part(2)


def circle_radius(area_dka: Column) -> Column:
    """Radius in metres of a circle of that area (1 dka = 1000 m2)."""
    return F.sqrt(area_dka * 1000 / F.pi())


def km2_units(km2: Column) -> tuple[Column, Column]:
    """(ha, dka)."""
    return km2 * 100, km2 * 1000
