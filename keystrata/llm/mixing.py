"""Mixing sources to target weights (operator 10), natively.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share 150 % of all
words; a source's target stops at twice its words and the excess goes to the others by weight.
That is one water level, found from prefix sums over the sources sorted by where they fill up.

Selection: complete epochs first, then a fraction by Efraimidis-Spirakis sampling: each row gets
the exponential key -ln(u) / weight, u from a hash of its id, and rows go in key order until the
rest of the target is met; the last row is taken in part, by words. Weights default to the
plausibility of a text's mean word length. Texts are read once: what is planned from, sizes and
keys, is written with the columns to keep.

Rows are summed in cells of a source, equal steps of log2(key), whose sums are prefix-summed
apart, so no source has to fit one task. The steps shrink as rows grow: the logarithm of an
exponential key has a density of at most 1 / e, whatever the weights, which bounds the share of its
source's rows in a cell, and `CELL_ROWS` the number. Rows alike in id and text have one key and cell.
Only the one cell of a source in which its rest ends is sorted, without the texts, for the row at
which it ends; all rows before that one are taken whole. So a source has one row of results, and
these are sent to the rows where they measure under `SOURCES_BYTES`, else rows of hot sources are dealt.

Edge cases: null and empty texts have size 0 and are taken 0 times; a source whose sizes are 0
has target 0; a null doc_id hashes as an empty one; repeated rows are rows each; empty tables
give empty results. Columns of docs pass through; those named size, source_size, target or taken
are replaced by the results. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, spread, word_count

WEIGHTS = (5, 2, 1)
CELL_ROWS = 2_048
SOURCES_BYTES = 32 << 20
RESULTS = ("size", "source_size", "target", "taken")


def plausibility(text: Column, size: Column) -> Column:
    """1 at six characters a word, less the further away."""
    return 1 / (1 + F.abs(F.ln(F.greatest(F.coalesce(F.char_length(text), F.lit(0)), F.lit(1)) / (6.0 * F.greatest(size, F.lit(1))))))


def sampling_key(doc_id: Column, weight: Column, seed: str = "mix") -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.ln((bits + 0.5) / 2.0**52) / weight


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, absent, source_size, weight, target; sizes: one row a source, a table of sources only."""
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    named = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")).cast("double"))
    cap, everything = F.col("source_size") * most, Window.partitionBy()
    before = Window.orderBy(cap / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    levels = named.withColumn("total", F.sum("source_size").over(everything) * share).withColumn("level", (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level rises while sources fill up and falls after the first that doesn't
    return levels.withColumn("target", F.least(cap, F.max("level").over(everything) * F.col("weight"))).drop("total", "level")


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, quality=plausibility, seed: str = "mix", columns: tuple[str, ...] | None = None) -> DataFrame:
    """columns (default: all) of docs with size, source_size, target and taken (words the mix takes of each row)."""
    passed = [c for c in columns or docs.columns if c not in RESULTS]
    size = word_count(F.col("text"))
    keyed = docs.select(*passed, size.alias("#size"), sampling_key(F.col("doc_id"), quality(F.col("text"), size), seed).alias("#key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("#id"), F.coalesce("source", F.lit("")).alias("#name"), F.col("source").isNull().alias("#absent"), F.monotonically_increasing_id().alias("#row"))
    keyed = cut(keyed)
    # 1 / (e * ln 2) is about a half: rows of a cell = rows / (2 * steps) at most
    steps = max(1, -(-keyed.count() // (2 * CELL_ROWS)))
    place = F.floor(F.greatest(F.least(F.log2("#key"), F.lit(1e3)), F.lit(-1e3)) * steps).alias("#cell")
    keyed = keyed.select("*", place)
    cell = ["#name", "#absent", "#cell"]
    sums = cut(keyed.groupBy(*cell).agg(F.sum("#size").alias("#held")))
    per_source = sums.groupBy("#name", "#absent").agg(F.sum("#held").alias("source_size")).withColumn("source", F.when(~F.col("#absent"), F.col("#name")))
    goal = targets(per_source, share, most, weights).select(F.col("#name"), F.col("#absent"), F.col("source_size").alias("#total"), F.col("target").alias("#target"))
    ahead = Window.partitionBy("#name", "#absent").orderBy("#cell").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("#total") > 0, F.floor(F.col("#target") / F.col("#total"))).otherwise(0)
    goal = cut(goal.withColumn("#epochs", epochs).withColumn("#rest", F.round(F.col("#target") - F.col("#epochs") * F.col("#total")).cast("long")))
    begun = sums.withColumn("#begin", F.coalesce(F.sum("#held").over(ahead), F.lit(0)))
    # the cell and then the row in which the rest ends: one of each a source, none where all rows are taken
    ends = begun.join(goal.select("#name", "#absent", "#rest"), ["#name", "#absent"]).where("`#begin` <= `#rest` and `#rest` < `#begin` + `#held`").withColumn("#left", F.col("#rest") - F.col("#begin"))
    order = ["#key", "#id", "#size", "#row"]
    within = F.coalesce(F.sum("#size").over(Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stops = keyed.select(*cell, *order).join(ends.select(*cell, "#left"), cell).withColumn("#short", F.col("#left") - within).where("`#short` >= 0 and `#short` < `#size`")
    known = cut(goal.join(stops.select("#name", "#absent", F.struct(*order).alias("#stop"), "#short"), ["#name", "#absent"], "left").withColumn("#source", F.struct("#name", "#absent")).drop("#name", "#absent", "#rest"))
    row = F.struct(*order)
    extra = F.when(F.col("#stop").isNull() | (row < F.col("#stop")), F.col("#size")).when(row == F.col("#stop"), F.col("#short")).otherwise(0)
    taken = F.col("#epochs") * F.col("#size") + extra
    named = keyed.withColumn("#source", F.struct("#name", "#absent"))
    measured = known.agg(F.coalesce(F.sum(F.lit(96) + F.octet_length("#source.#name") + F.coalesce(F.octet_length("#stop.#id"), F.lit(0))), F.lit(0))).first()[0]
    both = named.join(F.broadcast(known), "#source") if measured <= SOURCES_BYTES else spread(named, known, "#source", F.col("#row"))
    return both.select(*passed, F.col("#size").alias("size"), F.col("#total").alias("source_size"), F.col("#target").alias("target"), taken.cast("long").alias("taken"))


def first_words(text: Column, count: Column) -> Column:
    """The text up to and with its count-th word and the white space after it."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), count.cast("int")), "")


def copies(taken: DataFrame) -> DataFrame:
    """The mix itself: a row of docs for each whole or partial time it is taken."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    part = F.col("taken") - whole * F.col("size")
    counts = F.concat(F.array_repeat(F.col("size"), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>")))
    each = taken.withColumn("#words", F.explode(counts))
    return each.withColumn("text", F.when(F.col("#words") < F.col("size"), first_words(F.col("text"), F.col("#words"))).otherwise(F.col("text"))).drop("#words")
