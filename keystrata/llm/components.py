"""Connected components of an edge table by alternating large-star and small-star steps.

Labels spread through joins and grouped minima only; no list of neighbours is ever built, so
a hub with very many links costs no more memory than any other row, and its links are dealt over
several tasks where they are joined to its label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release, spread


def _star(edges: DataFrame, total: int) -> DataFrame:
    """One large star over both directions, then one small star; `total` edges (a, b) with a > b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
    large = spread(both, least.select("a", F.least("a", "low").alias("low")), "a", F.col("b"), least, 2 * total).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    # after a large star a node has few links, to the least of each of its neighbourhoods
    down = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("hub"), "low")
    joined = large.join(down, F.col("a") == F.col("hub"))
    small = joined.select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b")
    return small.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; component is the smallest node reachable.

    edges: columns a and b of one comparable type; loops and nulls are ignored, repeats and
    either direction allowed. An empty table gives an empty one.
    """
    given = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut(given.distinct(), most=edges.count())
    while True:
        # done when every node either has one link to a smaller node, or only links to larger ones
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(now.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        links = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        found = links.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).alias("open")).first()
        if not found.open:
            break
        before = now
        # a small star gives two rows a link, a large one no more links than there are ends
        now = cut(_star(before, found.n), most=4 * found.n)
        release(before)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
