"""Hard-negative mining (operator 12): blocked dense products in two passes.

Vectors are scaled to whole numbers; a row's score is its inner product with the anchor. Anchors come
in blocks of at most `anchor_block` rows (counted after they are dealt by hash) of one length, broadcast as
one float64 matrix, which bounds what the driver holds and sends; blocks run one after another. For each
block all rows are scanned twice, in Arrow batches that are the other side of a matrix product (exact:
`exact.products`):

1. Each task keeps the best `positives` rows of each anchor's own label. Such lists are mergeable: tasks'
   lists are merged by a window over the anchor, at most `positives` rows a task and anchor.
2. Each task keeps the best `negatives` rows of other labels within the score window of each anchor and
   positive, merged alike.

No list of pairs is ever made: what a task gives doesn't grow with its rows.

Edge cases: rows with null id, label or vector, or with null or non-finite components, take no part.
Scores tie to the smaller id; rows with the anchor's own id are no positives of it. Repeated rows are
candidates each; a repeated anchor (id, label and vector) is answered once. Anchors meet rows of their
own length only. An anchor without positives, or a positive without negatives, gives no row; a negative
positive_score has no window. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .exact import products

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: Anchors of a matrix product.
ROWS = 256


def labelled(df: DataFrame, label: Column, scale: float = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, label and v (whole numbers as doubles) of each row that takes part."""
    x = F.col(vector_col)
    whole = x.isNotNull() & F.col(id_col).isNotNull() & label.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(whole).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(x, lambda v: v.cast("double") * F.lit(float(scale))).alias("v"))


class Best:
    """For each of n lists the k best (score, id): higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.list, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.bar, self.bar_id = np.full(n, np.iinfo(np.int64).min), np.full(n, np.iinfo(np.int64).max)

    def offer(self, lists: np.ndarray, scores: np.ndarray, able: np.ndarray, ids: np.ndarray) -> None:
        """scores: lists x ids, of which those able count."""
        bar = self.bar[lists][:, None]
        able = able & ((scores > bar) | ((scores == bar) & (ids[None] < self.bar_id[lists][:, None])))
        if np.count_nonzero(able) > 4 * self.k * len(lists) and len(ids) > self.k:
            kth = np.partition(np.where(able, scores, np.iinfo(np.int64).min), len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            able &= scores >= kth[:, None]
        at, who = np.nonzero(able)
        if not len(at):
            return
        new = np.concatenate([self.list, lists[at]]), np.concatenate([self.score, scores[at, who]]), np.concatenate([self.id, ids[who]])
        order = np.lexsort((new[2], -new[1], new[0]))
        held = new[0][order]
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        place = np.arange(len(held)) - np.repeat(first, np.diff(np.append(first, len(held))))
        kept = order[place < self.k]
        self.list, self.score, self.id = (x[kept] for x in new)
        last = order[place == self.k - 1]
        self.bar[new[0][last]], self.bar_id[new[0][last]] = new[1][last], new[2][last]


def _scan(rows: DataFrame, shared, lists: int, k: int, offer, length: int) -> DataFrame:
    """list, id and score of the k best of each task's rows; offer(best, anchors' rows, scores, labels, ids) gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = shared.value[0], Best(lists, k)
        for b in batches:
            x = np.floor(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, length))
            ids, labels = b.column("id").to_numpy(), b.column("label").to_numpy()
            for a in range(0, len(anchors), ROWS):
                offer(best, shared.value, np.arange(a, min(a + ROWS, len(anchors))), products(anchors[a : a + ROWS], x), labels, ids)
        yield pa.RecordBatch.from_arrays([pa.array(best.list), pa.array(best.id), pa.array(best.score)], ["list", "id", "score"])

    found = rows.select("id", "label", "v").mapInArrow(run, "list long, id long, score long")
    ranked = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _block(rows: DataFrame, anchors: tuple[np.ndarray, np.ndarray, np.ndarray], length: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The answers of one block of anchors (ids, labels, vectors)."""
    context, (ids, labels, vectors) = rows.sparkSession.sparkContext, anchors
    first = context.broadcast((vectors, ids, labels))

    def alike(best: Best, given, own, scores, other_labels, other_ids) -> None:
        best.offer(own, scores, (given[2][own][:, None] == other_labels[None]) & (given[1][own][:, None] != other_ids[None]), other_ids)

    # at most anchor_block * positives rows
    found = _scan(rows, first, len(ids), positives, alike, length).select("list", "rank", "id", "score").toArrow()
    at, place, name, score = (np.asarray(found.column(c), np.int64) for c in ("list", "rank", "id", "score"))
    held, names = np.full((positives, len(ids)), -1), np.zeros((positives, len(ids)), np.int64)
    held[place - 1, at], names[place - 1, at] = score, name
    # no window of a negative score holds anything; so -1 stands for no positive, too
    least, most = -(-low * np.maximum(held, 0) // 100), np.where(held >= 0, high * held // 100, -1)
    second = context.broadcast((vectors, labels, least, most))

    def unlike(best: Best, given, own, scores, other_labels, other_ids) -> None:
        others = given[1][own][:, None] != other_labels[None]
        for p in range(positives):
            within = others & (scores >= given[2][p, own][:, None]) & (scores <= given[3][p, own][:, None])
            best.offer(own * positives + p, scores, within, other_ids)

    mined = cut(_scan(rows, second, len(ids) * positives, negatives, unlike, length))
    first.destroy()
    second.destroy()
    facts = rows.sparkSession.createDataFrame(pa.table({"list": (np.arange(len(ids))[:, None] * positives + np.arange(positives)).ravel(), "anchor_id": np.repeat(ids, positives), "positive_id": names.T.ravel(), "positive_score": held.T.ravel()}))
    # as many rows as a block has positives
    return mined.join(F.broadcast(facts), "list").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchor_block: int = 16_384) -> DataFrame:
    """For each anchor and each of its best `positives`: the best `negatives` rows of other labels.

    rows and anchors: id, label, v from `labelled`. A negative's score is from low to high percent
    of the positive's; rank is its place among them.
    """
    spark = rows.sparkSession
    anchors = anchors.select("id", "label", "v").distinct()
    block_of = lambda blocks: F.pmod(F.xxhash64("id", "label", "v", F.lit(2)), F.lit(blocks))
    out = spark.createDataFrame([], RESULT)
    for length, total in [(r.length, r["count"]) for r in anchors.groupBy(F.size("v").alias("length")).count().orderBy("length").collect()]:
        alike, fitting = anchors.where(F.size("v") == length), rows.where(F.size("v") == length)
        blocks = 1 if total <= anchor_block else -(-2 * total // anchor_block)
        while blocks > 1 and alike.groupBy(block_of(blocks).alias("b")).count().agg(F.max("count")).first()[0] > anchor_block:
            blocks *= 2
        for block in range(blocks):
            got = (alike if blocks == 1 else alike.where(block_of(blocks) == block)).toArrow()
            vectors = np.floor(np.asarray(got.column("v").combine_chunks().flatten(), float)).reshape(len(got), length)
            given = np.asarray(got.column("id"), np.int64), np.asarray(got.column("label"), np.int64), vectors
            out = out.unionByName(_block(fitting, given, length, positives, negatives, low, high))
    return out
