"""Expiring deduplication of clicks (operator 13): keyed state of a Structured Streaming query.

A click opens a window of `gap` hours; later clicks of its id within it are repeats, counted into the
window, and the next one beyond it closes the window and opens another. Batches of clicks are
fed in order to a stateful query that is started anew for each of them on one checkpoint. The steps:

1. One pass deals the clicks to batches and counts equal ones (id, hour and hash) together before
   and in a shuffle, so an id with very many repeats reaches the state as few rows. The batches are
   written as Parquet folders in the shared folder; each start of the query sees one more of them.
2. By a watermark of `late` hours late clicks are dropped, and it lets timeouts close windows that nothing can join any
   more. Hours are whole, so the watermark is shifted by a millisecond (an hour equal to the bound
   is still in time) and timeouts by half an hour: neither depends on how ties are treated. Windows due
   after a batch close as the next start begins: those of a bucket that gets rows before these are
   folded, others by their timeout. They are marked as closed after the batch before.
3. The last start also gets a sentinel row for each bucket, which holds no click: a bucket that sees it closes all its
   windows. So no start has a second step, without rows, which would load and store the state of all
   partitions once more.

State is kept for many ids together: a call for each id costs as much as some 100 rows. Ids are dealt to buckets
of about `bucket_rows` rows a batch; the state of a bucket holds the id, start, counters, crc sum and opener's hash
of each window still open, packed side by side (72 bytes a window), and its timeout is when the first of them
expires. Sorted rows of all ids of a bucket are folded at once. A task holds the rows and windows of one bucket in
Python and, in the JVM while it runs, the windows of its partition before and after the step: each start reads them
from the checkpoint and lets go of them once they are written. So the number of shuffle partitions bounds what a task holds.

The input and the closed windows are written once each, so a lost executor costs the steps it was in:
a start that failed can be repeated, as it overwrites what its steps wrote.

Edge cases: rows with null id, null arrival or a negative id have no copies and take no part; a null in
any other column is empty text in the hash, and so is a value that is no finite number. Repeated
rows are repeats like others, without conflict. Ties of hour and hash are equal rows. Hours up to 1970
are late from the first batch on. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .common import shared_folder

HOUR_MS = 3_600_000
FED = "bucket int, click_id long, hour long, hash binary, n long, event_time timestamp"
#: overdue: closed after the batch before the one that the start reads.
CLOSED = "click_id long, start_hour long, n_repeats long, n_conflicts long, conflict_crc long, hash binary, overdue boolean"
#: The packed columns of open windows: 8 bytes each but the hash, which has 32.
PACKED = ("click_id", "start", "repeats", "conflicts", "crc", "hash")
OPEN = ", ".join(f"{c} binary" for c in PACKED)

#: Settings of the session that streams.
STREAMING = {
    "spark.sql.session.timeZone": "UTC",
    # one map a partition, in the heap of the task that runs: a native store leaves memory behind each time it is opened
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    # each start reads the state anew, so none is kept for it
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",  # a start is one step
}


def _micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp; one without a zone is UTC."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    return F.unix_micros(F.col(column).cast("timestamp"))


def copies(clicks: DataFrame) -> DataFrame:
    """click_id, hour, place (an hour to deal batches by) and hash (32 bytes) of each row's copies 0 to click_id % 3."""
    value = F.when(F.abs("value") < float("inf"), F.floor(100 * F.col("value") + 0.5).cast("long"))
    rows = clicks.where("click_id >= 0 and arrived_at is not null").select(
        F.col("click_id").cast("long").alias("click_id"),
        F.floor(_micros(clicks, "arrived_at") / F.lit(1_000_000 * 3_600)).alias("arrived"),
        F.concat_ws("|", *(F.coalesce(x.cast("string"), F.lit("")) for x in (F.col("client_id"), F.col("kind"), value, _micros(clicks, "ts"), F.col("props")))).alias("content"),
        F.explode(F.sequence(F.lit(0), (F.col("click_id") % 3).cast("int"))).alias("j"),
    )
    rows = rows.withColumn("c", F.crc32(F.concat_ws(":", F.col("click_id").cast("string"), F.col("j").cast("string"))))
    hour = F.col("arrived") + 6 * F.col("j") * (F.col("c") % 10)
    hash_ = F.unhex(F.sha2(F.concat_ws("|", "content", (F.col("c") % 3).cast("string")), 256))
    return rows.select("click_id", hour.alias("hour"), (hour + F.floor(F.col("c") / 10) % 200).alias("place"), hash_.alias("hash"))


def _packed(columns: dict[str, np.ndarray]) -> tuple:
    return tuple(np.ascontiguousarray(columns[c]).tobytes() for c in PACKED)


def _unpacked(row: tuple | None) -> dict[str, np.ndarray]:
    held = dict(zip(PACKED, row if row is not None else (b"",) * len(PACKED), strict=True))
    out = {c: np.frombuffer(held[c], np.int64) for c in PACKED[:-1]}
    return out | {"hash": np.frombuffer(held["hash"], np.uint8).reshape(-1, 32)}


def _take(columns: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {c: x[which] for c, x in columns.items()}


def _crc(hashes: np.ndarray) -> np.ndarray:
    """crc32 of each hash as lowercase hexadecimal text."""
    return np.array([zlib.crc32(h.tobytes().hex().encode()) for h in hashes], np.int64)


def fold(held: dict[str, np.ndarray], ids: np.ndarray, hours: np.ndarray, hashes: np.ndarray, n: np.ndarray, gap: int) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(windows closed, windows open) after the rows of some ids, of which n are alike, met the open windows held.

    All ids advance together: in each round each id's rows up to the end of its window are taken, and
    the next row opens its next window. There are as many rounds as the most windows of one id.
    """
    parts = np.ascontiguousarray(hashes).view(">u8").reshape(-1, 4)
    order = np.lexsort((*parts.T[::-1], hours, ids))
    ids, hours, hashes, n = ids[order], hours[order], hashes[order], n[order]
    names, first, rank = np.unique(ids, return_index=True, return_inverse=True)
    last = np.append(first[1:], len(ids))
    base, span = int(hours.min()), int(hours.max() - hours.min()) + 2
    place = rank * span + (hours - base)
    # the window of each id as it is now: its number among `opened`, or -1
    touched = np.isin(held["click_id"], names)
    opened = [_take(held, touched)]
    now = np.full(len(names), -1)
    now[np.searchsorted(names, opened[0]["click_id"])] = np.arange(touched.sum())
    start = np.zeros(len(names), np.int64)
    start[now >= 0] = opened[0]["start"][now[now >= 0]]
    of_row, count, at = np.empty(len(ids), np.int64), int(touched.sum()), first.copy()
    opener, ended = np.zeros(len(ids), bool), [np.zeros(0, np.int64)]
    while True:
        # rows within the window that is open
        going = np.flatnonzero((now >= 0) & (at < last))
        reach = np.clip(start[going] + gap - base, -1, span - 1)
        upto = np.maximum(at[going], np.searchsorted(place, going * span + reach, side="right"))
        taken = upto - at[going]
        of_row[np.repeat(at[going] - np.cumsum(taken) + taken, taken) + np.arange(taken.sum())] = np.repeat(now[going], taken)
        at[going] = upto
        # the next row of each id closes it and opens another
        new = np.flatnonzero(at < last)
        if not len(new):
            break
        ended.append(now[new][now[new] >= 0])
        row = at[new]
        zero = np.zeros(len(new), np.int64)
        opened.append({"click_id": names[new], "start": hours[row], "repeats": zero, "conflicts": zero, "crc": zero, "hash": hashes[row]})
        now[new] = of_row[row] = count + np.arange(len(new))
        opener[row] = True
        start[new], count = hours[row], count + len(new)
        at[new] += 1
    windows = {c: np.concatenate([o[c] for o in opened]) for c in PACKED}
    unlike = np.flatnonzero((hashes != windows["hash"][of_row]).any(1))
    windows["repeats"] = windows["repeats"] + np.bincount(of_row, n - opener, count).astype(np.int64)
    windows["conflicts"] = windows["conflicts"] + np.bincount(of_row[unlike], n[unlike], count).astype(np.int64)
    crc = np.zeros(count, np.int64)
    np.add.at(crc, of_row[unlike], _crc(hashes[unlike]) * n[unlike])
    windows["crc"] = windows["crc"] + crc
    closed = np.zeros(count, bool)
    closed[np.concatenate(ended)] = True
    still = _take(windows, ~closed)
    left = _take(held, ~touched)
    still = {c: np.concatenate([left[c], still[c]]) for c in PACKED}
    return _take(windows, closed), _take(still, np.argsort(still["click_id"], kind="stable"))


def _result(windows: dict[str, np.ndarray], overdue: bool) -> pd.DataFrame:
    hashes = pd.Series([h.tobytes() for h in windows["hash"]], dtype=object)
    return pd.DataFrame({"click_id": windows["click_id"], "start_hour": windows["start"], "n_repeats": windows["repeats"], "n_conflicts": windows["conflicts"], "conflict_crc": windows["crc"], "hash": hashes, "overdue": overdue})


def _expiring(gap: int, last: bool) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The step of a bucket: its rows meet its open windows. last: no rows follow, so all of them close."""

    def expiry(start: np.ndarray) -> np.ndarray:
        return (start + gap) * HOUR_MS + HOUR_MS // 2

    def run(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Spark itself drops only what is behind the watermark of the step before
        late = state.getCurrentWatermarkMs()
        parts = [(p["click_id"].to_numpy(np.int64), p["hour"].to_numpy(np.int64), np.frombuffer(b"".join(p["hash"]), np.uint8).reshape(-1, 32), p["n"].to_numpy(np.int64)) for p in (p[p["hash"].notna() & (p["hour"] * HOUR_MS > late)] for p in rows if len(p)) if len(p)]
        held = _unpacked(state.getOption)
        due = expiry(held["start"]) <= late
        yield _result(_take(held, due), True)
        still = _take(held, ~due)
        if parts:
            closed, still = fold(still, *(np.concatenate(x) for x in zip(*parts, strict=True)), gap)
            yield _result(closed, False)
        if last:
            yield _result(still, False)
        if not last and len(still["click_id"]):
            state.update(_packed(still))
            state.setTimeoutTimestamp(int(expiry(still["start"]).min()))
        elif state.exists:
            state.remove()

    return run


def _streaming(spark: SparkSession) -> SparkSession:
    """A session with settings of its own, which streams beside the given one."""
    own = spark.newSession()
    for k, v in (STREAMING | {"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}).items():
        own.conf.set(k, v)
    return own


def _start(own: SparkSession, folder: str, seen: list[int], last: bool, gap: int, late: int) -> None:
    """One start of the query on its checkpoint: it finds the folder of one more batch, the last of seen.

    Its step is numbered as its batch in seen. Windows overdue in it get the number of the batch before.
    """
    fed = own.readStream.schema(FED).parquet(f"{folder}/fed/batch={{{','.join(map(str, seen))}}}")
    # a row just `late` hours behind the latest is still in time
    timed = fed.withWatermark("event_time", f"{late * HOUR_MS + 1} milliseconds")
    closed = timed.groupBy("bucket").applyInPandasWithState(_expiring(gap, last), CLOSED, OPEN, "append", GroupStateTimeout.EventTimeTimeout)

    def write(rows: DataFrame, step: int) -> None:
        number = F.when(F.col("overdue"), seen[max(0, step - 1)]).otherwise(seen[-1])
        rows.withColumn("closed_batch", number.cast("long")).drop("overdue").write.mode("overwrite").parquet(f"{folder}/closed/step={step}")

    closed.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def expiring_windows(events: DataFrame, batches: int = 8, gap: int = 24, late: int = 96, bucket_rows: int = 8_192) -> DataFrame:
    """click_id, start_hour, closed_batch, n_repeats, n_conflicts, conflict_crc and hash (hexadecimal) of each window.

    events: click_id, hour, place, hash (32 bytes). They are dealt to batches by place, over equal
    ranges of it. A new folder under spark.checkpoint.dir holds batches, checkpoint and result.
    """
    spark = events.sparkSession
    facts = events.agg(F.count("*").alias("n"), F.min("place").alias("low"), F.max("place").alias("high"), F.max("hour").alias("latest")).first()
    schema = "click_id long, start_hour long, n_repeats long, n_conflicts long, conflict_crc long, hash string, closed_batch long"
    if not facts.n:
        return spark.createDataFrame([], schema)
    folder = f"{shared_folder(spark)}/clicks-{uuid.uuid4().hex}"
    buckets = -(-facts.n // (batches * bucket_rows))
    batch = F.floor((F.col("place") - facts.low) * batches / F.lit(facts.high - facts.low + 1)).cast("int")
    bucket = F.pmod(F.xxhash64("click_id"), F.lit(buckets)).cast("int")
    event_time = F.timestamp_seconds(F.col("hour") * 3_600)
    counted = events.groupBy(batch.alias("batch"), "click_id", "hour", "hash").agg(F.count("*").alias("n"))
    counted.select(bucket.alias("bucket"), "click_id", "hour", "hash", "n", event_time.alias("event_time"), "batch").write.partitionBy("batch").parquet(f"{folder}/fed")
    # in time in each batch, as no click is later
    sentinel = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(None).cast("long").alias("click_id"), F.lit(facts.latest).cast("long").alias("hour"), F.lit(None).cast("binary").alias("hash"), F.lit(0).cast("long").alias("n"))
    sentinel.withColumn("event_time", event_time).write.mode("append").parquet(f"{folder}/fed/batch={batches - 1}")
    filled = sorted(r[0] for r in spark.read.parquet(f"{folder}/fed").select("batch").distinct().collect())  # `batches` numbers at most
    own = _streaming(spark)
    for i in range(len(filled)):
        _start(own, folder, filled[: i + 1], i == len(filled) - 1, gap, late)
    closed = spark.read.schema(schema.replace("hash string", "hash binary")).parquet(f"{folder}/closed").drop("step")
    return closed.withColumn("hash", F.lower(F.hex("hash")))
