"""SimHash near-duplicates (operator 11): exact comparison of fingerprints in tiles of equal bit counts.

A row's fingerprint has a bit set where over half of the 64-bit hashes (XXH64, seed 42) of its word
shingles have it, repeats included. Rows whose fingerprints differ in `radius` bits at most are linked.

1. One narrow pass makes the fingerprints. Equal ones collapse to a class.
2. The 64 bits are cut into parts; a tile is made of the fingerprints with the same number of set bits in
   each part. Two fingerprints within the radius have counts that differ by no more than the radius
   in all, so tile pairs beyond it are skipped, and each fingerprint is sent to its own tile and to half
   of those within the radius that hold any. With more `parts` fewer pairs are left to compare, but each
   fingerprint is sent to more tiles: 20 with 4 parts (the same at every size), which leave 1 pair in 70 of
   random fingerprints, 72 with 8 (1 in 3,000), 272 with 16 (1 in 2 million). `parts_for` says which
   suits a number of fingerprints; a wide radius, whose steps are very many (289,540 with 4 parts and radius 30), gets fewer parts. The
   answer is the same for any.
3. In a tile, home fingerprints in chunks of `TILE` are compared with all that were sent there, which stream
   by in sorted order: numpy exclusive-or and bit counts, some millions at once. A large tile is
   several chunks, each a task's work of its own. Only links that join two groups of a chunk are kept, so a
   dense tile gives no more links than it has rows a chunk.
4. Links are joined into components; the class of a row names its component.

The comparison is exact: no link is missed, whatever the tiles. Edge cases: null texts and texts without
words have fingerprint zero and are linked like any other; fewer words than a shingle are one shingle.
Rows that share an id are one document: all that is linked with any of them is reachable from it. Rows
with null id link like others but give no component its name; a group reachable from no id has a null
component_id. Repeated rows share a class. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, cut, release, spread
from .components import components

BITS, SEED = 64, 42
TILE, STREAM = 4_096, 512
#: Hashes counted at once, and how many fingerprints one is to be compared with on average.
COUNTED, MEETINGS = 1 << 15, 8_192
#: Tiles that a fingerprint is sent to at most beside its own.
STEPS = 512


def fingerprint(text: bytes, width: int = 3) -> int:
    """Of the shingles of UTF-8 text, A-Z as a-z; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and just the six separators
    if not words:
        return 0
    n, digest = max(1, len(words) - width + 1), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, COUNTED):
        part = words[a : min(n, a + COUNTED) + width - 1]
        count = min(n, a + COUNTED) - a
        hashes = np.fromiter((digest(b" ".join(part[i : i + width]), SEED) for i in range(count)), "<u8", count)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and f, the fingerprint as a signed long, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = buffers(b.column("text"))
            found = np.array([fingerprint(data[i:j].tobytes(), width) for i, j in zip(at[:-1], at[1:], strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found.view(np.int64))], ["id", "f"])
        pa.default_memory_pool().release_unused()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, f long")


def steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of the bit counts of two fingerprints within the radius, one of each and its negative, without zero."""
    out = set()
    for changed in range(1, min(parts, radius) + 1):
        for where in combinations(range(parts), changed):
            for by in product(range(-radius, radius + 1), repeat=changed):
                if 0 not in by and sum(map(abs, by)) <= radius and by[0] > 0:
                    out.add(tuple(by[where.index(i)] if i in where else 0 for i in range(parts)))
    return sorted(out)


def n_steps(parts: int, radius: int) -> int:
    """How many `steps` gives, without making them."""
    return sum(comb(parts, k) * comb(radius, k) * 2**k for k in range(1, parts + 1)) // 2


def parts_for(n: int, radius: int) -> int:
    """Parts of which a fingerprint of n is compared with MEETINGS others or fewer, if bits were random; 16 at most."""
    for parts in (1, 2, 4, 8, 16):
        size = BITS // parts
        # chance that two parts have equal counts, near that of counts a step apart
        equal = float(np.prod([(2 * i - 1) / (2 * i) for i in range(1, size + 1)]))
        if n * (2 * n_steps(parts, radius) + 1) * equal**parts <= MEETINGS:
            break
    return parts


def _tile(f: Column, parts: int, step: tuple[int, ...] | None = None) -> Column:
    """Number of the tile of a fingerprint, or of one that lies a step below; null if there can't be one."""
    size, out, able = BITS // parts, F.lit(0).cast("long"), F.lit(True)
    for i in range(parts):
        mask = ((1 << size) - 1) << (i * size)
        count = F.bit_count(f.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long")))
        if step is not None and step[i]:
            count = count - step[i]
            able = able & count.between(0, size)
        out = out * (size + 1) + count
    return out if step is None else F.when(able, out)


def _spanning(home: np.ndarray, label: np.ndarray, others: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links of others to home, and between home rows that others join; label: the group of each home row, updated."""
    near = np.bitwise_count(others[:, None] ^ home[None]) <= radius
    for y in np.flatnonzero(near.any(1)):
        hits = np.flatnonzero(near[y])
        if others[y] != home[hits[0]]:
            yield others[y], home[hits[0]]
        for x in hits[1:]:
            if label[x] != label[hits[0]]:
                yield others[y], home[x]
                label[label == label[x]] = label[hits[0]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, home, label = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            tile, chunk, sent, f = (b.column(c).to_numpy() for c in ("tile", "chunk", "sent", "f"))
            f = f.view(np.uint64)
            ends = np.append(np.flatnonzero((tile[1:] != tile[:-1]) | (chunk[1:] != chunk[:-1]) | (sent[1:] != sent[:-1])) + 1, len(f))
            links, first = [], 0
            for end in ends:
                unit, rows = (tile[first], chunk[first]), f[first:end]
                if unit != now:
                    now, home, label = unit, np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if not sent[first]:  # home rows come first, those of one chunk perhaps in several batches
                    home, label = np.concatenate([home, rows]), np.arange(len(home) + len(rows))
                for a in range(0, len(rows), STREAM):
                    # home rows meet home rows as far as there are any yet, so each pair of them is met
                    links.extend(_spanning(home, label, rows[a : a + STREAM], radius))
                first = end
            a, c = (np.array(x, np.uint64).view(np.int64) for x in (zip(*links, strict=True) if links else ((), ())))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return run


def links(classes: DataFrame, radius: int = 2, parts: int = 4) -> DataFrame:
    """Links (a, b) that join all of the distinct fingerprints f of classes within the radius; fewer parts if it has too many steps."""
    while parts > 1 and n_steps(parts, radius) > STEPS:
        parts //= 2
    own = classes.select("f", _tile(F.col("f"), parts).alias("tile"))
    tiles = cut(own.groupBy("tile").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("f"), "chunks").cast("int")
    # a home row is sent on to the chunks before its own, others to all chunks of their tile
    home = own.join(tiles, "tile").select("tile", "f", F.explode(F.sequence(F.lit(0), chunk)).alias("chunk"), chunk.alias("own")).select("tile", "chunk", (F.col("chunk") < F.col("own")).cast("int").alias("sent"), "f")
    away = F.filter(F.array(*(_tile(F.col("f"), parts, step) for step in steps(parts, radius))), lambda t: t.isNotNull())
    others = classes.select("f", F.explode(away).alias("tile")).join(tiles, "tile").select("tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("sent"), "f")
    rows = home.unionByName(others).repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "sent")
    found = cut(rows.mapInArrow(_compare(radius), "a long, b long"), arrow_rows=10_000)
    release(tiles)
    return found


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", parts: int = 4) -> DataFrame:
    """id, fingerprint (16 hexadecimal digits) and component_id (smallest id reachable over links) of each row."""
    rowwise = cut(fingerprints(docs, width, id_col, text_col), arrow_rows=500)
    classes = cut(rowwise.groupBy("f").agg(F.min("id").alias("id"), F.max("id").alias("last"), F.count("*").alias("rows")))
    n = classes.count()
    joins = links(classes, radius, parts)
    # rows of one id with different fingerprints are one document
    several = rowwise.where("id is not null").groupBy("id").agg(F.min("f").alias("low"), F.max("f").alias("high")).where("low <> high").select("id", "low")
    shared = rowwise.join(several, "id").select(F.col("f").alias("a"), F.col("low").alias("b")).where("a <> b")
    linked = cut(components(joins.unionByName(shared)), most=n)
    whole = classes.join(linked, F.col("f") == F.col("node"), "left").select("f", "id", "rows", F.coalesce("component", "f").alias("group"))
    names = whole.groupBy("group").agg(F.min("id").alias("component_id"))
    named = cut(spread(whole, names, "group", F.col("f")).select("f", "rows", "component_id"), most=n)
    release(classes, joins, linked)
    out = spread(rowwise, named.select("f", "component_id"), "f", F.monotonically_increasing_id(), named.select("f", F.col("rows").alias("n")))
    return out.select("id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
