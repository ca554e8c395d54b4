"""Shared parts of the training-data operators: written tables, joins of hot keys and byte-level text hashing.

The hashing helpers work on the UTF-8 buffers that Arrow hands over, a bounded run of
bytes at a time, so memory doesn't depend on how many rows an Arrow batch holds.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One white-space or one word character of the contracts: \x20 and \x09 to \x0D separate words.
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 18
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a few numbers that make a file of some megabytes.
FILE_ROWS = 1 << 18


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="keystrata-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, arrow_rows: int = 2_000, most: int | None = None) -> DataFrame:
    """Write df once, as a Parquet table in the session's spark.checkpoint.dir, and read it from there.

    Lineage ends there, later steps read only the columns they need, and the planner knows the
    table's true size. Only a local session (as in tests) gets a folder of its own where none is
    set; a cluster's executors share no temporary folder, so there an unset folder is an error.

    arrow_rows: most rows of a batch sent to Python while it is written, fewer where rows are wide.
    most: no more rows than this are written, a few numbers each; they go to one file for each FILE_ROWS
    of them, so a small table isn't dealt over as many files as there are shuffle partitions.
    """
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(max(1, -(-most // FILE_ROWS)))
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    given = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(arrow_rows, int(given)) if int(given) > 0 else arrow_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, given)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the tables of frames made by cut that nothing will read any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(many: DataFrame, one: DataFrame, key: str, by: Column, counts: DataFrame | None = None, total: int | None = None, how: str = "inner", least: int = 1_024, hot_keys: int = 4_096) -> DataFrame:
    """many joined to one (a row a key) on key, the rows of a hot key dealt over several tasks.

    Hot are keys with more than `least` and more than total / hot_keys rows of many. There are
    fewer than hot_keys of these, which bounds what the driver holds and sends; the row of a hot
    key is repeated once for each part, so at most total / least times in all. by tells rows of a
    key apart. counts (key, n; without null) and total are those of many, if known already. Null
    matches nothing, but its rows are dealt like those of other keys.
    """
    total = many.count() if total is None else total
    most = max(least, -(-total // hot_keys))
    if counts is None:
        counts = many.groupBy(key).agg(F.count("*").alias("n"))
    elif how == "left":
        known = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        counts = counts.select(key, "n").unionByName(counts.sparkSession.range(1).select(F.lit(None).cast(counts.schema[key].dataType).alias(key), F.lit(total - known).alias("n")))
    hot = counts.where(F.col("n") > most).select(F.xxhash64(key).alias("h"), F.ceil(F.col("n") / most).cast("int").alias("p")).collect()
    if not hot:
        return many.join(one, key, how)
    # fewer than hot_keys rows of two numbers
    parts = F.broadcast(many.sparkSession.createDataFrame([(r.h, r.p) for r in hot], "`#h` long, `#p` int").groupBy("#h").agg(F.max("#p").alias("#p")))
    dealt = many.withColumn("#by", F.xxhash64(by)).join(parts, F.xxhash64(key) == F.col("#h"), "left").withColumn("#part", F.coalesce(F.pmod("#by", F.col("#p")).cast("int"), F.lit(0)))
    repeated = one.join(parts, F.xxhash64(key) == F.col("#h"), "left").withColumn("#part", F.explode(F.sequence(F.lit(0), F.coalesce("#p", F.lit(1)) - 1)))
    return dealt.drop("#h", "#p", "#by").join(repeated.drop("#h", "#p"), [key, "#part"], how).drop("#part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream64(n: int, seed: int) -> np.ndarray:
    """n reproducible 64-bit words."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = stream64(256, 11)
_VALUES[65:91] = _VALUES[97:123]
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_PLACED = stream64(1, 14)[0]
_BASE = int(stream64(1, 12)[0]) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTORS = stream64(64, 13) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK_BYTES, 1 << max(0, n - 1).bit_length())
    if size in _powers:
        return _powers[size]
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if size == CHUNK_BYTES:
        _powers[size] = (out[0], out[1])
    return out[0], out[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def runs(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each; a longer row comes alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        last = min(last, n)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some rows, A-Z as a-z; and the first word of each row.

    A word's hash mixes the sum of a 64-bit mix of each letter with its place, so no two words collide by
    their structure, as they would by sums of powers. data: bytes of exactly these rows; offsets: row offsets from 0.
    """
    n, rows = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    letter = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = letter.copy()
    begins[1:] &= ~letter[:-1] | edge[1:-1]
    ends = letter.copy()
    ends[:-1] &= ~letter[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.zeros(n, np.int64)
    first[start] = start
    place = np.arange(n) - np.maximum.accumulate(first)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64((place.astype(np.uint64) << np.uint64(8)) + _LOWER[data] + _PLACED), out=total[1:])
        h = mix64(total[end] - total[start] + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h, np.searchsorted(start, offsets).astype(np.int64)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct, sorted 64-bit hashes of each row's word shingles; and the first of each row.

    A row of fewer words than width has its whole sequence as its one shingle; a row without
    words has none.
    """
    h, first = words(data, offsets)
    rows, count = len(offsets) - 1, np.diff(first)
    sizes = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    at = np.zeros(rows + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    out = np.empty(at[-1], np.uint64)
    with np.errstate(over="ignore"):
        if len(h) >= width:
            joined = h[: len(h) - width + 1] * _FACTORS[0]
            for t in range(1, width):
                joined = joined + h[t : len(h) - width + 1 + t] * _FACTORS[t]
            joined = mix64(joined)
        for i in np.flatnonzero(count):
            if count[i] >= width:
                out[at[i] : at[i + 1]] = joined[first[i] : first[i + 1] - width + 1]
                out[at[i] : at[i + 1]].sort()
            else:
                part = h[first[i] : first[i + 1]] * _FACTORS[: count[i]]
                out[at[i]] = mix64(np.uint64([int(part.sum()) ^ int(count[i])]))[0]
    new = np.ones(len(out), bool)
    if len(out):
        new[1:] = out[1:] != out[:-1]
        new[at[:-1][sizes > 0]] = True
    kept = np.zeros(len(out) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    return out[new], kept[at]
