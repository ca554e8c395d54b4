"""Ordered lists, op logs, coverage, versions, caches, quarantine, marked measures and the counting stream."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keystrata.functions import measures, rules, text
from keystrata.operators import ordered, quarantine
from keystrata.plans import queries as plans
from keystrata.sources import cache, documents, store
from keystrata.streaming import hits


@pytest.fixture
def many_ranges(spark):
    """More ranges than a group's rows would make by themselves."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    given = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "7")
    spark.conf.set(names[1], "false")
    yield
    for n, v in given.items():
        spark.conf.set(n, v)


def replay_loop(log):
    """The list of each session, operation by operation."""
    lists, barred = {}, set()
    for session, _, key, op in sorted(log, key=lambda r: (r[0], r[1])):
        held = lists.setdefault(session, [])
        if op == "append" and key is not None and session not in barred and all(k != key for k, _ in held):
            held.append((key, 1))
        elif op == "delete":
            held[:] = [e for e in held if e[0] != key]
            barred.add(session)
        elif op == "disable":
            held[:] = [(k, 0 if k == key else s) for k, s in held]
        elif op == "restart":
            barred.discard(session)
    return sorted((s, k, i, status) for s, held in lists.items() for i, (k, status) in enumerate(held))


def test_replay_equals_the_loop(spark, many_ranges):
    rng = random.Random(4)
    log = [(rng.choice("aaaab"), i, rng.choice([*range(12), None]), rng.choices(["append", "delete", "disable", "restart", "other"], [8, 2, 3, 2, 1])[0]) for i in range(600)]
    df = spark.createDataFrame(log, "session string, seq long, k long, op string").repartition(5)
    got = sorted(map(tuple, ordered.replayed(df, "session", ["seq"], "k", "op").select("session", "k", "pos", "status").collect()))
    assert got == replay_loop(log) and got
    assert ordered.replayed(df.where("false"), "session", ["seq"], "k", "op").count() == 0


def test_numbers_are_dense_over_ranges_and_ties(spark, many_ranges):
    rows = spark.range(500).select((F.col("id") % 3).alias("tie"), "id", F.lit("x").alias("pos"))
    got = ordered.numbered(rows.drop("pos"), ["tie", "id"], start=5).collect()
    assert [r.pos for r in sorted(got, key=lambda r: (r.tie, r.id))] == list(range(5, 505))
    assert ordered.numbered(rows.where("false").drop("pos"), ["tie", "id"]).count() == 0


def test_running_values_of_a_group_in_many_ranges(spark, many_ranges):
    rows = [(None if i % 50 == 0 else "hot" if i % 5 else f"g{i % 7}", i, (i * 37) % 101) for i in range(400)]
    placed = ordered.ranged(spark.createDataFrame(rows, "g string, i long, v long").repartition(3), ["g", "i"])
    assert placed.where("g = 'hot'").select(F.shiftright("#at", 33)).distinct().count() > 2
    got = {(r.g, r.i): (r.total, r.top) for r in ordered.running(placed, ["g"], {"total": F.col("v")}, {"top": F.col("v")}).collect()}
    for g, i, _ in rows:
        before = [v for h, j, v in rows if h == g and j < i]
        assert got[g, i] == (sum(before), max(before, default=None))


def test_append_gives_status_and_next_positions(spark):
    rows = spark.createDataFrame([("a", 0, 0), ("b", 7, 1), (None, None, 1)], "k string, pos long, status int")
    new = spark.createDataFrame([("b", 1), ("d", 2), ("c", 3), ("d", 4), (None, 5)], "k string, i long")
    got = {(r.k, r.i): (r.pos, r.status) for r in ordered.appended(rows, new, "k", ["i"]).collect()}
    assert got == {("a", None): (0, 0), ("b", None): (7, 1), (None, None): (None, 1), ("d", 2): (8, 1), ("c", 3): (9, 1), (None, 5): (10, 1)}
    assert [r.pos for r in ordered.appended(rows.where("false"), new, "k", ["i"]).orderBy("i").collect()] == [0, 1, 2, 3]


def test_moved_rows_are_renumbered(spark):
    rows = spark.createDataFrame([(c, i) for i, c in enumerate("abcdef")], "k string, pos long")
    order = lambda df: "".join(r.k for r in df.orderBy("pos").collect())
    assert order(ordered.moved(rows, "pos", F.col("k").isin("a", "f"), F.col("k") == "c")) == "bcafde"
    assert order(ordered.moved(rows, "pos", F.col("k").isin("a", "f"), F.col("k") == "c", before=True)) == "bafcde"
    assert order(ordered.moved(rows, "pos", F.col("k") == "a", F.col("k") == "absent")) == "abcdef"


def test_coverage_matches_points(spark, many_ranges):
    rng = random.Random(5)
    rows = [("hot" if i % 4 else f"g{i % 3}", a, a + rng.randint(-2, 6)) for i in range(300) for a in [rng.randint(0, 2_000)]]
    got = ordered.coverage(spark.createDataFrame(rows, "g string, low long, high long"), "g", "low", "high").collect()
    for g in {r[0] for r in rows}:
        points = {p for h, a, b in rows if h == g for p in range(a, b + 1)}
        held = [(r.low, r.high) for r in got if r.g == g and r.covered]
        free = [(r.low, r.high) for r in got if r.g == g and not r.covered]
        assert sorted(p for a, b in held for p in range(a, b + 1)) == sorted(points)
        assert {p for a, b in free for p in range(a, b + 1)} == set(range(min(points), max(points))) - points
        assert len(free) == len(held) - 1  # adjacent intervals are merged


def test_coverage_of_repeated_intervals(spark, many_ranges):
    """Equal intervals, also ones that open a merged interval, change nothing."""
    rows = [(g, a, a + n) for g in ("g", "h") for a, n in [(0, 7), (4, 3), (10, 0), (11, 5), (30, 2), (31, 9)]]
    once, often = (sorted(map(tuple, ordered.coverage(spark.createDataFrame(x, "g string, low long, high long"), "g", "low", "high").collect())) for x in (rows, rows * 60))
    assert once == often == sorted((g, *x) for g in ("g", "h") for x in [(True, 0, 7), (False, 8, 9), (True, 10, 16), (False, 17, 29), (True, 30, 40)])


def test_coverage_query_matches_days(spark, tmp_path):
    """Sales given three times in several files against their days counted one by one: no order among equal intervals is asked for."""
    sales = spark.read.parquet("/root/testdata/sf0.001/sales.parquet")
    sales.unionByName(sales).unionByName(sales).repartition(5, "sale_id").write.parquet(f"{tmp_path}/sales.parquet")
    days = {}
    for r in sales.where("client_id is not null and sold_at is not null and priority is not null").collect():
        low = (r.sold_at.date() - dt.date(2024, 1, 1)).days
        days.setdefault(r.client_id, set()).update(range(low, low + r.priority * 2 - 2))
    want = set()
    for client, held in days.items():
        lows, highs = sorted(d for d in held if d - 1 not in held), sorted(d for d in held if d + 1 not in held)
        want |= {(client, True, a, b) for a, b in zip(lows, highs)} | {(client, False, b + 1, a - 1) for a, b in zip(lows[1:], highs)}
    got = [(r.client_id, r.covered, r.low, r.high) for r in plans.interval_coverage(spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_versions_switch_and_may_read_their_source(spark, tmp_path):
    path, schema = f"{tmp_path}/store", "k string, n long"
    assert store.current(spark, path, schema).count() == 0
    store.publish(spark.createDataFrame([("a", 1), ("b", 2)], schema), path)
    first = store.current(spark, path, schema)
    store.publish(first.where("k = 'a'").unionByName(spark.createDataFrame([("c", 3)], schema)), path)
    assert sorted(map(tuple, store.current(spark, path, schema).collect())) == [("a", 1), ("c", 3)]
    assert first.count() == 2  # a reader that has begun
    with pytest.raises(Exception, match="broken"):
        store.publish(store.current(spark, path, schema).select("k", F.raise_error(F.lit("broken")).cast("long").alias("n")), path)
    assert store.current(spark, path, schema).count() == 2
    assert store.publish(store.current(spark, path, schema).limit(1), path) == 3
    assert len(list((tmp_path / "store/current").glob("[0-9]*"))) == 2


def test_month_cache_replaces_evicts_and_prunes(spark, tmp_path):
    path, days = f"{tmp_path}/months", [dt.datetime(2024, m, d) for m in (1, 2, 3, 4) for d in (1, 2)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(days)] + [(99, None)], "id long, ts timestamp")
    cache.put_months(rows, path, "ts")
    cache.put_months(rows.where("id = 3").withColumn("id", F.lit(33).cast("long")), path, "ts")
    assert cache.months(spark, path) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert cache.evict(spark, path, "2024-03", 2) == ["2024-01", "2024-04"]
    held = cache.read_months(spark, path, "id long, ts timestamp", "2024-02")
    assert sorted(r.id for r in held.collect()) == [4, 5, 33]
    plan = cache.read_months(spark, path, "id long, ts timestamp", "2024-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert cache.evict(spark, f"{tmp_path}/none", "2024-01") == []


def test_quarantine_counts_what_it_writes(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (-3, "x"), (-4, None), (None, "x")], "n long, t string")
    good, bad, counts = quarantine.quarantined(rows, {"negative": F.col("n") < 0, "no text": F.col("t").isNull()})
    assert counts == {"rows": 5, "negative": 2, "no text": 1}
    assert {(r.n, r.reason) for r in bad.collect()} == {(-3, "negative"), (-4, "negative"), (2, "no text")}
    assert {r.n for r in good.collect()} == {1, None} and good.columns == rows.columns
    assert quarantine.quarantined(rows.where("false"), {"negative": F.col("n") < 0})[2] == {"rows": 0, "negative": 0}


def test_marked_measures_are_not_added(spark):
    df = spark.createDataFrame([(1, 2.0, 5), (1, 3.0, 6)], "k long, share double, n long")
    df = df.select("k", measures.non_additive(F.col("share"), "share", "a share"), "n")
    kept = df.join(df.select("k").distinct(), "k").where("n > 0").select("k", "share", "n")
    assert measures.reason(kept, "share") == "a share" and measures.reason(kept, "n") is None
    with pytest.raises(ValueError, match="share"):
        measures.totals(kept, ["k"], ["n", "share"])
    out = measures.summary(kept, ["k"], ["n", "share"])
    assert tuple(out.first()) == (1, 11, 3.0) and measures.reason(out, "share") == "a share"


def test_suffix_is_reproducible(spark):
    df = spark.range(50).select(text.suffix(F.col("id"), seed="s").alias("a"), text.suffix(F.col("id"), seed="s").alias("b"), text.suffix(F.col("id"), seed="t").alias("c"))
    rows = df.collect()
    assert all(r.a == r.b and r.a != r.c and int(r.a, 36) < 1 << 48 for r in rows) and len({r.a for r in rows}) == 50


@pytest.mark.parametrize(
    ("link", "want"),
    [("https://A.example:8443/o", "/o"), ("/other?x=1", "/other?x=1"), ("z", "/a/z"), ("../z?q#f", "/z?q"), ("../../../z", "/z"), ("?q", "/a/b?q"), ("#f", "/a/b?own"), ("//www.a.example/s", "/s"), ("//b.example/s", "/a/b?own"), ("", "/a/b?own"), ("a/..", "/a/"), (None, "/a/b?own"), ("mailto:x", "/a/b?own")],
)
def test_canonical_links(spark, link, want):
    df = spark.createDataFrame([(link, "https://www.a.example/a/b?own#f")], "l string, u string")
    assert df.select(text.canonical_path(F.col("l"), F.col("u"))).first()[0] == want


def test_null_switches_and_half_percents(spark):
    no, yes = F.lit(None).cast("boolean"), F.lit(True)
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(rules.reject_reason(no, yes, no, no, no, no, no)) == "frame"
    assert one(rules.reject_reason(no, no, yes, no, no, no, no)) == "localhost"
    assert one(rules.reject_reason(no, no, no, no, no, no, no)) is None
    assert one(F.array(rules.progress(F.lit(0.5), 100.0), rules.remaining(F.lit(0.5), 100.0))) == [1, 100]
    assert one(F.array(rules.progress(F.lit(None).cast("double"), 100.0), rules.remaining(F.lit(200.0), 100.0))) == [None, 0]


def test_unified_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features": [{"parent_id": "7", "evidence": ["x", "y"], "n": "bad"}, {"parent_id": null}]}')
    (tmp_path / "b.json").write_text('{\n "features": [{"parentId": 8, "evidence": "[plain", "n": 2}]\n}')
    fields = {"parent": (["parent_id", "parentId"], "long"), "evidence": (["evidence"], "array<string>"), "n": (["n"], "int")}
    got = documents.unified(spark, [f"{tmp_path}/a.json", f"{tmp_path}/b.json"], "features", fields).orderBy("parent")
    assert [(r.parent, r.evidence, r.n) for r in got.collect()] == [(None, None, None), (7, ["x", "y"], None), (8, ["[plain"], 2)]


def test_stream_counts_a_session_once(spark, tmp_path):
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "2")
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    batches = [
        [("a", at(0), False), ("b", at(1), True), ("c", at(2), None), (None, at(3), True)],
        [("a", at(5), True), ("a", at(6), True), ("b", at(4), True), ("c", at(7), False)],
        [("d", at(90), True)],  # a and b have been quiet for long
        [("b", at(95), True), ("d", at(96), True)],
    ]
    for i, rows in enumerate(batches):
        own.createDataFrame(rows, "session string, ts timestamp, visible boolean").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = own.readStream.schema("session string, ts timestamp, visible boolean").parquet(f"{tmp_path}/in/*")
        hits.first_visible(stream, "session", "ts", "visible").writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/{n}")).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/*").collect()
    assert sorted((r.session, r.counted_at) for r in got) == [("a", at(5)), ("b", at(1)), ("b", at(95)), ("d", at(90))]
