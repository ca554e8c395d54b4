"""Token-ID output (operator 2): best-fit-decreasing packing into rows of one length.

Whole texts are encoded, cut losslessly into pieces of at most `length` tokens, and packed by
best-fit decreasing: pieces go longest first to the open row whose remaining capacity is the
smallest that holds them, found by a segment tree over capacities that counts open rows. Packing
happens within each task, in windows of about `window` tokens, so no shuffle is needed and
memory doesn't depend on the input; the same input partition gives the same rows again.

A packed row is written as `ids` (little-endian uint16, or uint32 for larger vocabularies,
padded to `length` with `pad`), `cu_seqlens` (0, then the end of each segment), the position
resets (`starts`: where position ids begin at `offsets` again: 0, or the piece's place in its
document if that was cut) and each segment's `doc_ids`, `texts` (a number of its own for each row
of docs, so rows sharing an id can be told apart) and piece number.

Edge cases: null and empty texts give no tokens and no segment; rows with null id are packed
with a null id; repeated rows are packed each; empty tables give no rows; extra columns are
ignored. Very long texts are cut into as many pieces as needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import DEFAULT, encode, ranks

SCHEMA = "row_id string, ids binary, n_tokens int, cu_seqlens array<int>, starts array<int>, offsets array<int>, doc_ids array<long>, texts array<long>, pieces array<int>"


class Capacities:
    """Segment tree over remaining capacities 0..length, counting open rows of each."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << max(1, length).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = capacity + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and give (capacity, row) of the smallest capacity >= least, or None."""
        at, count = least + self.leaves, self.count
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return capacity, self.rows[capacity].pop()


def pack(sizes: list[int], length: int) -> list[list[int]]:
    """Best-fit decreasing: the pieces of each row. Ties go to the earlier piece."""
    tree, out = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found = length, len(out)
            out.append([])
        capacity, row = found
        out[row].append(i)
        if capacity > sizes[i]:
            tree.add(capacity - sizes[i], row)
    return out


def _emit(pieces: list, length: int, kind, pad: int, name: str) -> pa.RecordBatch:
    rows = pack([len(p[2]) for p in pieces], length)
    matrix = np.full((len(rows), length), pad, kind)
    cols: list[list] = [[] for _ in range(7)]
    for r, own in enumerate(rows):
        ends = np.cumsum([0, *(len(pieces[i][2]) for i in own)])
        for s, i in enumerate(own):
            matrix[r, ends[s] : ends[s + 1]] = pieces[i][2]
        for c, x in zip(cols, (int(ends[-1]), ends.tolist(), ends[:-1].tolist(), [pieces[i][1] * length for i in own], [pieces[i][0] for i in own], [pieces[i][3] for i in own], [pieces[i][1] for i in own]), strict=True):
            c.append(x)
    ints = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([f"{name}-{r}" for r in range(len(rows))]),
            pa.array([m.tobytes() for m in matrix], pa.binary()),
            pa.array(cols[0], pa.int32()),
            pa.array(cols[1], ints),
            pa.array(cols[2], ints),
            pa.array(cols[3], ints),
            pa.array(cols[4], pa.list_(pa.int64())),
            pa.array(cols[5], pa.list_(pa.int64())),
            pa.array(cols[6], ints),
        ],
        ["row_id", "ids", "n_tokens", "cu_seqlens", "starts", "offsets", "doc_ids", "texts", "pieces"],
    )


def packed(docs: DataFrame, length: int = 2_048, window: int = 2_000_000, vocabulary: str = DEFAULT, pad: int = 0) -> DataFrame:
    """Packed rows of the whole texts of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kind = np.dtype("<u2" if max(ranks(vocabulary).values()) < 1 << 16 else "<u4")
        part, pieces, held, windows = task.partitionId() if (task := TaskContext.get()) else 0, [], 0, 0
        name, number = f"{part}", part << 40
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                text = text.as_py()
                if not text:
                    continue
                ids = encode(text, vocabulary).astype(kind)
                pieces += [(doc_id, k, ids[at : at + length], number) for k, at in enumerate(range(0, len(ids), length))]
                number += 1
                held += len(ids)
                if held >= window:
                    yield _emit(pieces, length, kind, pad, f"{name}-{windows}")
                    pieces, held, windows = [], 0, windows + 1
        if pieces:
            yield _emit(pieces, length, kind, pad, f"{name}-{windows}")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def segments(rows: DataFrame) -> DataFrame:
    """Read packed rows back: doc_id, text, piece, ids (array of int) of every segment, natively.

    The hex text of a segment's bytes is cut into one number a token, for uint16 ids.
    """
    each = rows.select("ids", F.explode(F.arrays_zip("doc_ids", "texts", "pieces", "starts", F.slice("cu_seqlens", 2, F.size("starts")).alias("ends"))).alias("s"))
    raw = F.hex(F.substring(F.col("ids"), F.col("s.starts") * 2 + 1, (F.col("s.ends") - F.col("s.starts")) * 2))
    low_first = F.transform(F.sequence(F.lit(0), F.col("s.ends") - F.col("s.starts") - 1), lambda i: F.conv(F.concat(F.substring(raw, i * 4 + 3, F.lit(2)), F.substring(raw, i * 4 + 1, F.lit(2))), 16, 10).cast("int"))
    return each.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.texts").alias("text"), F.col("s.pieces").alias("piece"), low_first.alias("ids"))
