"""Exact top-k search (operator 1): pivot-table elimination on integer vectors.

Components become floor(1024 * x). The score of a query q and a vector x is their inner product,
which is (|q|^2 + |x|^2 - d(q, x)^2) / 2, and a pivot table gives d(q, x) >= max |d(q, p) -
d(x, p)| over all pivots p: an upper bound of the score. Within each batch a query's vectors are
evaluated in order of their bounds until the bound falls under the k-th best score so far.

Pivots are far apart: each next one is the row farthest from those before, of a bounded sample.

Queries come in blocks of at most `query_block` rows of one length (counted after they are dealt by
hash), which bounds what the driver holds and sends. Blocks run one after another, a scan each, and
their answers are written before the next begins. Each task keeps k scores a query, so a query
meets at most k rows a task in the final ranking, whatever the input holds.

Edge cases: vectors null, or holding null or non-finite components, take no part, nor do rows
with null vec_id; empty vectors score 0 with each other. Queries meet vectors of their own
length only. Each distinct query (id and vector) is answered once; repeated candidate rows are
candidates each; rows with the query's own id are left out. Scores are exact for components of any
size (`exact.products`); only a score beyond 64 bits that is evaluated is an error. Ties go
to the smaller vec_id. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .exact import products

SCALE = 1024
STEP = 512
SAMPLE = 2_048


def integers(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and the vector of each row that takes part, scaled; `_vectors` and tasks take the floor of its doubles."""
    x = F.col(vector_col)
    whole = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(whole).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: v.cast("double") * F.lit(float(SCALE))).alias("v"))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _search(q_ids, q, q_table, x_ids, x, x_table, k, top) -> None:
    """Update top (query -> (scores, ids)) with the vectors of one batch."""
    x_norm, q_norm = (x * x).sum(1), (q * q).sum(1)
    # the whole batch at once: products and sums of whole numbers under 2**53 are exact as floats
    small = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1]) < 2.0**53
    for a in range(len(q)):
        gap = np.abs(x_table - q_table[a]).max(1) if x_table.shape[1] else np.zeros(len(x))
        far = q_norm[a] + x_norm
        gap = np.maximum(gap - 1e-6 * (1 + np.sqrt(far) + q_table[a].max(initial=0)), 0)  # distances and norms are rounded
        bound = (far - gap * gap) / 2 + 0.5 + 1e-9 * far
        bound[~np.isfinite(bound)] = np.inf
        scores, ids = top.get(a, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        able = np.flatnonzero((x_ids != q_ids[a]) & (bound >= scores[-1] if len(scores) == k else True))
        able = able[np.argsort(-bound[able], kind="stable")]
        at, step = 0, STEP
        while at < len(able):
            if len(scores) == k and bound[able[at]] < scores[-1]:
                break
            part = able[at : at + step]
            found, names = (x[part] @ q[a]).astype(np.int64) if small else products(q[a : a + 1], x[part])[0], x_ids[part]
            if len(scores) == k:
                near = found >= scores[-1]
                found, names = found[near], names[near]
            if len(found):
                scores, ids = _best(np.concatenate([scores, found]), np.concatenate([ids, names]), k)
            at, step = at + step, 2 * step
        if len(scores):
            top[a] = scores, ids


def _far_apart(rows: np.ndarray, pivots: int) -> np.ndarray:
    """At most `pivots` rows, each the farthest from those before."""
    chosen, gap = [0], _distances(rows, rows[:1])[:, 0]
    while len(chosen) < pivots and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def _vectors(rows: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and vectors of a bounded number of rows, on the driver."""
    got = rows.select("id", "v").toArrow()
    return np.asarray(got.column("id"), np.int64), np.floor(np.asarray(got.column("v").combine_chunks().flatten(), float)).reshape(len(got), length)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = 32, query_block: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query; both tables from integers()."""
    spark = vectors.sparkSession
    queries = queries.select("id", "v").distinct()
    lengths = [(r.n, r["count"]) for r in queries.groupBy(F.size("v").alias("n")).count().orderBy("n").collect()]
    parts = []
    for length, total in lengths:
        # any choice gives valid bounds
        sample = _vectors(vectors.where(F.size("v") == length).orderBy(F.xxhash64("id", F.lit(1)), "id", "v").limit(SAMPLE), length)[1]
        p = _far_apart(sample, pivots) if len(sample) else sample
        own, blocks = queries.where(F.size("v") == length), 1 if total <= query_block else -(-2 * total // query_block)
        block_of = lambda blocks: F.pmod(F.xxhash64("id", "v", F.lit(2)), F.lit(blocks))
        while blocks > 1 and own.groupBy(block_of(blocks).alias("b")).count().agg(F.max("count")).first()[0] > query_block:
            blocks *= 2
        for block in range(blocks):
            ids, q = _vectors(own if blocks == 1 else own.where(block_of(blocks) == block), length)
            order = np.lexsort((*q.T[::-1], ids))
            ids, q = ids[order], q[order]
            shared = spark.sparkContext.broadcast((ids, q, _distances(q, p), p))
            found = vectors.where(F.size("v") == length).mapInArrow(_searcher(shared, length, k), "query_id long, query_no int, vec_id long, score long")
            ranked = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
            found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
            if len(lengths) * blocks > 1:
                found = cut(found)
                shared.destroy()
            parts.append(found)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(squares, 0))


def _searcher(shared, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, q_table, p = shared.value
        top: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            x = np.floor(b.column("v").flatten().to_numpy(zero_copy_only=False)).reshape(b.num_rows, length)
            _search(q_ids, q, q_table, b.column("id").to_numpy(zero_copy_only=False), x, _distances(x, p), k, top)
        sizes = [len(top[a][0]) for a in top]
        no = np.repeat(np.array(list(top), np.int32), sizes)
        scores = np.concatenate([top[a][0] for a in top]) if top else np.zeros(0, np.int64)
        ids = np.concatenate([top[a][1] for a in top]) if top else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(q_ids[no]), pa.array(no), pa.array(ids), pa.array(scores)], ["query_id", "query_no", "vec_id", "score"])

    return run
