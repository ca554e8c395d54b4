"""Near-duplicate detection (operator 7) on SetSketch registers.

A row's set holds the distinct word shingles of its whole text. Register i keeps the truncated
base-b logarithm of the smallest of exponentially distributed hashes of the set's members, so
registers of a union are the register-wise maxima of the parts (mergeable), and equal registers
become likelier with similarity (locality-sensitive). The steps:

1. One narrow pass sketches every row. Rows of one set (equal size and 128-bit digest) collapse
   to a class with a number of its own; copies are never expanded into pairs.
2. Registers are cut into bands; classes agreeing in a band share a bucket. Each bucket first
   links its members to two of them only (smallest number and smallest hash), a count linear in
   the bucket. The joint likelihood of the similarity, from registers above, below and equal and
   both set sizes, says which of these stars can reach the similarity at all.
3. Full sets are made for the classes of likely stars only. A class is compared with its likeliest
   centre first, with the others where they would still join components.
4. Where a bucket's members aren't in one component then, pairs of different components are
   left. Buckets of up to `SMALL` members are paired by a join, again on registers first; larger
   ones are first narrowed in tiles of registers to the members with a likely partner elsewhere,
   and those compared in tiles of full sets, bounded by rows and by bytes, which give only the
   links that join components. A pair that shares several large buckets is met in the first only. Every join with a centre or a bucket deals hot keys over several
   tasks. No bucket is capped.
5. Every link is confirmed on the full sets; links are joined into components.

Misses: with the default 160 registers in 32 bands of 5, two sets of similarity 0.8 fail to share
a bucket with probability 3e-6; the likelihood falls short by `margin` (0.2, six standard deviations
of the estimate) with less than 1e-6. Both hit only links that no other path joins.

Edge cases: null or empty texts and texts without words have empty sets, which are linked with
nothing; fewer words than a shingle count as one shingle. Rows that share an id are one document:
all that is linked with any of them is reachable from it. Rows with null id are classed like others
by their text, and never give a component its name: a class reachable from no id has a null
component_id (and is kept). Repeated rows share a class. Empty tables give empty results. Extra
columns of docs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, cut, mix64, release, runs, shingles, spread, stream64
from .components import components

BASE, RATE, TOP = 1.02, 20.0, (1 << 16) - 2
SMALL, TILE, SET_TILE, TILE_BYTES = 32, 16_384, 2_048, 8 << 20
FEW, PAIR_ROWS = 1_000_000, 1_000


def registers(sets: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """Registers (rows x m, uint16) of sets given as concatenated 64-bit hashes; 0 for empty sets."""
    rows = len(first) - 1
    filled = np.flatnonzero(np.diff(first))
    low = np.empty((m, len(filled)), np.uint64)
    a, b = stream64(m, 21) | np.uint64(1), stream64(m, 22)
    with np.errstate(over="ignore"):
        for i in range(m if len(filled) else 0):
            low[i] = np.minimum.reduceat((sets ^ b[i]) * a[i], first[filled])
    smallest = -np.log1p(-np.minimum((low.T.astype(float) + 0.5) / 2.0**64, 1 - 2.0**-53)) / RATE
    out = np.zeros((rows, m), np.uint16)
    if len(filled):
        out[filled] = np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP + 1)
    return out


def _log_likelihood(j, above, below, same, u):
    v = 1 - u
    p = -np.log1p(-np.clip(u - v * j, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    q = -np.log1p(-np.clip(v - u * j, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    return above * np.log(p) + below * np.log(q) + same * np.log(np.clip(1 - p - q, 1e-12, 1))


def _counts(x: np.ndarray, y: np.ndarray):
    above, below = (x > y).sum(-1), (x < y).sum(-1)
    return above, below, x.shape[-1] - above - below


def likeliest(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of aligned register rows, given both set sizes."""
    counts, u = _counts(x, y), nx / (nx + ny)
    low, high = np.zeros_like(u), np.minimum(u / (1 - u), (1 - u) / u)
    for _ in range(24):  # the likelihood is concave in the similarity
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = _log_likelihood(a, *counts, u) > _log_likelihood(b, *counts, u)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


def reaches(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, least: float) -> np.ndarray:
    """Whether the likeliest similarity is `least` at least: the likelihood still rises there."""
    counts, u = _counts(x, y), nx / (nx + ny)
    rises = _log_likelihood(least + 1e-4, *counts, u) >= _log_likelihood(least, *counts, u)
    return rises & (np.minimum(nx, ny) >= least * np.maximum(nx, ny))


def sketch(given: DataFrame, width: int = 2, bands: int = 32, rows: int = 5) -> DataFrame:
    """id, mark, n_shingles, digest (null for an empty set), registers (binary), bands (array of long); given: id, mark, text."""
    m, factor = bands * rows, stream64(rows, 23) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = buffers(b.column("text"))
            for i, j in runs(at):
                sets, first = shingles(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
                size = np.diff(first)
                filled = np.flatnonzero(size)
                digest = np.zeros((j - i, 2), np.uint64)
                with np.errstate(over="ignore"):
                    if len(filled):
                        digest[filled, 0] = np.add.reduceat(mix64(sets), first[filled])
                        digest[filled, 1] = np.bitwise_xor.reduceat(mix64(sets + np.uint64(0x5851F42D4C957F2D)), first[filled])
                    k = registers(sets, first, m)
                    keys = mix64((k.reshape(j - i, bands, rows).astype(np.uint64) * factor).sum(2) + (np.arange(bands, dtype=np.uint64) << np.uint64(32)))
                empty = size == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("id").slice(i, j - i),
                        b.column("mark").slice(i, j - i),
                        pa.array(size),
                        pa.array([None if e else d.tobytes() for e, d in zip(empty, digest, strict=True)], pa.binary()),
                        pa.array([None if e else r.tobytes() for e, r in zip(empty, k, strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i) * bands + 1, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64))),
                    ],
                    ["id", "mark", "n_shingles", "digest", "registers", "bands"],
                )
        pa.default_memory_pool().release_unused()

    return given.select("id", "mark", "text").mapInArrow(run, "id long, mark long, n_shingles long, digest binary, registers binary, bands array<long>")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """c and the sorted distinct shingle hashes of its text as packed bytes; texts: c, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = buffers(b.column("text"))
            for i, j in runs(at):
                sets, first = shingles(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
                raw = pa.py_buffer(sets.tobytes())
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer((first * 8).tobytes()), raw]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("c").slice(i, j - i), packed], ["c", "members"])
        pa.default_memory_pool().release_unused()

    return texts.select("c", "text").mapInArrow(run, "c long, members binary")


def scored(pairs: DataFrame, facts: DataFrame, least: float, m: int) -> DataFrame:
    """Those pairs (a, b) whose likeliest similarity is `least` at least, with it as `near`; b may be hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, m) for c in ("x", "y"))
            nx, ny = (batch.column(c).to_numpy().astype(float) for c in ("nx", "ny"))
            able = np.flatnonzero(reaches(x, y, nx, ny, least)) if len(x) else np.zeros(0, int)
            near = likeliest(x[able], y[able], nx[able], ny[able])
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(able)), batch.column("b").take(pa.array(able)), pa.array(near)], ["a", "b", "near"])

    left = facts.select(F.col("c").alias("a"), F.col("registers").alias("x"), F.col("n_shingles").alias("nx"))
    right = facts.select(F.col("c").alias("b"), F.col("registers").alias("y"), F.col("n_shingles").alias("ny"))
    return spread(pairs.join(left, "a"), right, "b", F.col("a"), *_tally(pairs)).select("a", "b", "x", "y", "nx", "ny").mapInArrow(run, "a long, b long, near double")


def _tally(pairs: DataFrame) -> tuple[DataFrame, int]:
    return pairs.groupBy("b").agg(F.count("*").alias("n")), pairs.count()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) with 100 * intersection >= percent * union on their full sets; b may be hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) * 100 < percent * len(q) or len(q) * 100 < percent * len(p):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        pa.default_memory_pool().release_unused()

    left, right = sets.select(F.col("c").alias("a"), F.col("members").alias("x")), sets.select(F.col("c").alias("b"), F.col("members").alias("y"))
    pairs = pairs.select("a", "b")
    return spread(pairs.join(left, "a"), right, "b", F.col("a"), *_tally(pairs)).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those pairs that known components (node, component) don't join yet."""
    a, b = known.select(F.col("node").alias("a"), F.col("component").alias("ca")), known.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    left = pairs.join(a, "a", "left")
    return spread(left, b, "b", F.col("a"), *_tally(pairs), how="left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def _first_here(large: np.ndarray, x: int, others: np.ndarray, at: int) -> np.ndarray:
    """Those of others that share no earlier large bucket with x than the one of band number `at`."""
    shared = (large[others] == large[x]) & (large[x] != 0)
    return others[shared.argmax(1) == at]


def _narrow(group: pd.DataFrame, percent: int, least: float, m: int) -> pd.DataFrame:
    """Members of a tile that have a likely partner in another component, met here first."""
    i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
    k = np.frombuffer(b"".join(group["registers"]), np.uint16).reshape(len(group), m)
    n, block, part, large = group["n_shingles"].to_numpy(), group["block"].to_numpy(), group["component"].to_numpy(), np.stack(group["large"].to_numpy())
    at = int(np.flatnonzero(large[0] == group["band"].iloc[0])[0])
    wanted = np.zeros(len(group), bool)
    for x in np.flatnonzero(block == i):
        others = np.flatnonzero((block == j) & (part != part[x]) & ((np.arange(len(n)) > x) | (i != j)) & (100 * np.minimum(n[x], n) >= percent * np.maximum(n[x], n)))
        others = _first_here(large, x, others, at)
        if len(others):
            near = others[reaches(k[x], k[others], n[x].astype(float), n[others].astype(float), least)]
            wanted[near] = True
            wanted[x] |= len(near) > 0
    return group.loc[wanted, ["band", "c", "component", "n_shingles", "registers", "large"]]


def _tile(group: pd.DataFrame, percent: int, least: float, m: int) -> pd.DataFrame:
    """Verified links between a tile's components, of pairs met here first; one for each two components joined."""
    i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
    group = group.sort_values(["block", "c"], kind="stable")
    k = np.frombuffer(b"".join(group["registers"]), np.uint16).reshape(len(group), m)
    n, ids, block = group["n_shingles"].to_numpy(), group["c"].to_numpy(), group["block"].to_numpy()
    first = np.concatenate([[0], np.cumsum(n)])
    names, member = np.unique(np.frombuffer(b"".join(group["members"]), np.uint64), return_inverse=True)
    held = np.zeros(len(names), bool)
    labels, part = np.unique(group["component"].to_numpy(), return_inverse=True)
    large = np.stack(group["large"].to_numpy())
    at = int(np.flatnonzero(large[0] == group["band"].iloc[0])[0])
    joined = np.arange(len(labels))
    found = []
    for x in np.flatnonzero(block == i):
        now = joined[part]
        others = np.flatnonzero((block == j) & (now != now[x]) & ((np.arange(len(ids)) > x) | (i != j)))
        # sizes too far apart can't reach the similarity
        others = others[100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others])]
        others = _first_here(large, x, others, at)
        if len(others):
            others = others[reaches(k[x], k[others], n[x].astype(float), n[others].astype(float), least)]
        if not len(others):
            continue
        held[member[first[x] : first[x + 1]]] = True
        both = np.array([np.count_nonzero(held[member[first[y] : first[y + 1]]]) for y in others], np.int64)
        for y in others[(100 * both >= percent * (n[x] + n[others] - both)) & (both > 0)]:
            if joined[part[x]] != joined[part[y]]:
                found.append((ids[x], ids[y]))
                joined[joined == joined[part[y]]] = joined[part[x]]
        held[member[first[x] : first[x + 1]]] = False
    return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])


def _tiled(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """rows (band, c, ...) in every tile (i, j) of their bucket that they are part of; tiles: band, tiles, n."""
    placed = spread(rows, tiles.select("band", "tiles"), "band", F.col("c"), tiles.select("band", "n"), None)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("c", F.lit(3)), "tiles").cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, F.col("block")).alias("i"), F.greatest(t, F.col("block")).alias("j")))
    return placed.withColumn("pair", F.explode(pair)).select("*", "pair.i", "pair.j").drop("pair", "tiles")


def _from_large(placed: DataFrame, large: DataFrame, classes: DataFrame, sets_of, percent: int, least: float, m: int) -> DataFrame:
    """Links between components that share a large bucket; large: band, n of each."""
    tiles = large.select("band", "n", (F.floor(F.col("n") / TILE) + 1).cast("int").alias("tiles"))
    rows = cut(spread(placed.select("band", "c", "component"), tiles, "band", F.col("c"), tiles.select("band", "n")).select("band", "c", "component"))
    # each class with the large buckets it is in, in their places among its bands; a pair is met in the first it shares
    own = rows.groupBy("c").agg(F.collect_set("band").alias("own"))
    facts = cut(classes.join(own, "c").select("c", "registers", "n_shingles", F.transform("bands", lambda b: F.when(F.array_contains("own", b), b).otherwise(F.lit(0).cast("long"))).alias("large")))
    schema = "band long, c long, component long, n_shingles long, registers binary, large array<long>"
    wanted = cut(_tiled(rows, tiles).join(facts, "c").groupBy("band", "i", "j").applyInPandas(lambda g: _narrow(g, percent, least, m), schema).dropDuplicates(["band", "c"]))
    sized = wanted.groupBy("band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    tiles = cut(sized.select("band", "n", (F.greatest(F.floor(F.col("n") / SET_TILE), F.floor(F.col("size") * 8 / TILE_BYTES)) + 1).cast("int").alias("tiles")))
    whole = _tiled(wanted, tiles).join(sets_of(wanted.select("c").distinct()), "c")
    links = cut(whole.groupBy("band", "i", "j").applyInPandas(lambda g: _tile(g, percent, least, m), "a long, b long"))
    release(rows, facts, wanted, tiles)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, margin: float = 0.2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links), kept, mark and group of each row.

    Two rows are linked if 100 * intersection >= percent * union of their shingle sets. mark is
    xxhash64(text, 7); group numbers what texts alone link, without shared ids, null for empty sets.
    """
    m, least = bands * rows, percent / 100 - margin
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("mark", F.xxhash64("text", F.lit(7)))
    rowwise = cut(sketch(given, width, bands, rows))
    filled = rowwise.where("digest is not null")
    named = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "mark")).alias("rep")
    classes = filled.groupBy("digest").agg(named, F.first("registers").alias("registers"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("rows"))
    # numbered as written: the number is the same for all that read it
    classes = cut(classes.select(F.monotonically_increasing_id().alias("c"), "digest", "rep.id", "rep.mark", "registers", "bands", "n_shingles", "rows"))
    facts, found = classes.select("c", "registers", "n_shingles"), classes.count()
    buckets = classes.select(F.explode("bands").alias("band"), "c")
    shared = cut(buckets.groupBy("band").agg(F.min("c").alias("hub"), F.min_by("c", F.xxhash64("c")).alias("hub2"), F.count("*").alias("n")).where("n > 1"))
    members = cut(spread(buckets, shared, "band", F.col("c"), shared.select("band", "n"), found * bands))
    stars = cut(members.select("c", F.explode(F.array("hub", "hub2")).alias("b")).where("c <> b").select(F.col("c").alias("a"), "b").distinct(), most=2 * members.count())
    likely = cut(scored(stars, facts, least, m))

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Full sets of the classes wanted (c), each from one row of its class."""
        wanted = cut(wanted.join(classes.select("c", "id", "mark"), "c").select("c", F.col("id").alias("#id"), F.col("mark").alias("#mark")), most=found)
        named = F.broadcast(wanted) if wanted.count() <= FEW else wanted  # three numbers a row
        texts = given.join(named, given.id.eqNullSafe(F.col("#id")) & (given.mark == F.col("#mark")))
        return full_sets(texts, width).groupBy("c").agg(F.first("members").alias("members"))

    sets = cut(sets_of(likely.select(F.explode(F.array("a", "b")).alias("c")).distinct()))
    pairs = likely.count()
    best = cut(likely.groupBy("a").agg(F.max_by("b", F.struct("near", "b")).alias("b")), most=pairs)
    first = cut(verified(best, sets, percent), PAIR_ROWS)
    rest = cut(apart(likely.select("a", "b").join(best, ["a", "b"], "left_anti"), components(first)), most=pairs)
    second = cut(verified(rest, sets, percent), PAIR_ROWS)
    links = first.unionByName(second)
    known = components(links)
    placed = cut(members.select("band", "c", "n").join(known, F.col("c") == F.col("node"), "left").select("band", "c", "n", F.coalesce("component", "c").alias("component")))
    open_ = cut(placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.first("n").alias("n")).where("low <> high").select("band", "n"), most=shared.count())
    few = placed.join(open_.where(F.col("n") <= SMALL).select("band"), "band")
    few = few.alias("l").join(few.alias("r"), F.expr("l.band = r.band and l.component < r.component")).select(F.greatest("l.c", "r.c").alias("a"), F.least("l.c", "r.c").alias("b")).distinct()
    seen = stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    few = cut(scored(cut(few.join(seen, ["a", "b"], "left_anti")), facts, least, m).select("a", "b"))
    if not few.isEmpty():
        links = links.unionByName(cut(verified(few, cut(sets_of(few.select(F.explode(F.array("a", "b")).alias("c")).distinct())), percent), PAIR_ROWS))
    large = open_.where(F.col("n") > SMALL)
    if not large.isEmpty():
        links = links.unionByName(_from_large(placed, large, classes, sets_of, percent, least, m))
    linked = cut(components(links))
    groups = cut(classes.join(linked, F.col("c") == F.col("node"), "left").select("digest", "id", "rows", F.coalesce("component", "c").alias("group")))
    release(shared, members, stars, likely, sets, best, first, rest, second, placed, open_, few)
    # rows of one id with different texts are one document, so they join their groups
    several = cut(filled.where("id is not null").groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("id"))
    if several.isEmpty():
        whole = groups.withColumn("root", F.col("group"))
    else:
        own = filled.join(several, "id").select("id", "digest").distinct().join(groups.select("digest", "group"), "digest")
        own = cut(own.select("id", "group").distinct())
        joins = own.join(own.groupBy("id").agg(F.min("group").alias("b")), "id").select(F.col("group").alias("a"), "b")
        whole = groups.join(components(joins), F.col("group") == F.col("node"), "left").withColumn("root", F.coalesce("component", "group"))
    names = whole.groupBy("root").agg(F.min("id").alias("component_id"))
    by_digest = cut(spread(whole.select("root", "digest", "group", "rows"), names, "root", F.col("digest")).select("digest", "group", "component_id", "rows"))
    plain = rowwise.select("id", "mark", "n_shingles", "digest")
    joined = spread(plain, by_digest.drop("rows"), "digest", F.monotonically_increasing_id(), by_digest.select("digest", F.col("rows").alias("n")), plain.count(), how="left")
    named = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select("id", "n_shingles", named.alias("component_id"), "mark", "group").withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
