"""Edge cases of the surveyed operators."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from keystrata.functions import geometry, rules, text, timing
from keystrata.operators import events, inventory, keyed, lookup
from keystrata.sources import documents, store
from keystrata.streaming import hits

LIST = "pos int, url string, status int"


def column(spark, expr, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(expr.alias("x")).first().x


def test_remove_key_keeps_null_and_takes_duplicates(spark):
    rows = spark.createDataFrame([(0, "a", 1), (1, "b", 1), (2, None, 1), (3, "a", 1)], LIST)
    left = keyed.remove_key(rows, "url", "a")
    assert [r.url for r in left.orderBy("pos").collect()] == ["b", None]
    assert keyed.remove_key(left, "url", "a").count() == 2


def test_status_first_wins_missing_is_active_absent_is_error(spark):
    rows = spark.createDataFrame([(0, "a", 0), (1, "a", 1), (0, "b", None), (0, None, 1)], LIST)
    entries = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "url string")
    got = {r.url: r.status for r in keyed.status_tristate(entries, rows, "url", ["pos"], "status").collect()}
    assert got == {"a": "disabled", "b": "active", "c": "error", None: "error"}
    assert keyed.status_binary(entries, rows, "url").count() == 4


def test_append_twice_is_append_once(spark):
    rows = spark.createDataFrame([(0, "a", 1)], LIST)
    new = spark.createDataFrame([(1, "b", 1), (2, "b", 0), (3, "a", 1)], LIST)
    once = keyed.guarded_append(rows, new, "url", ["pos"])
    assert sorted((r.pos, r.url) for r in once.collect()) == [(0, "a"), (1, "b")]
    assert keyed.guarded_append(once, new, "url", ["pos"]).count() == 2


def test_barrier_holds_after_a_delete_only(spark):
    log = spark.createDataFrame([("s", 1, "add"), ("s", 2, "delete"), ("s", 3, "add"), ("t", 1, "add")], "session string, seq int, op string")
    got = keyed.write_barrier(log, "session", ["seq"], F.col("op") == "delete").orderBy("session", "seq").collect()
    assert [r.barred for r in got] == [False, False, True, False]


def test_fold_later_wins_over_seed(spark):
    rows = spark.createDataFrame([("g", "a", "1", 0), ("g", "a", "2", 1)], "g string, k string, v string, pos int")
    got = keyed.fold_to_map(rows, "g", "k", "v", ["pos"], {"a": "0", "none": "-"}).first().entries
    assert got == {"a": "2", "none": "-"}


@pytest.mark.parametrize(("given", "want"), [("x/old/old", "x/new/old"), ("x", "x"), (None, None), ("old", "new")])
def test_replace_first(spark, given, want):
    assert column(spark, text.replace_first(F.col("u"), "old", "new"), u=given) == want


def test_migration_marker_without_target(spark):
    url, marked = text.migrate(F.col("u"), "old", "old/long", "new")
    assert column(spark, url, u="x/old/") == "x/old/"
    assert column(spark, marked, u="x/old/") is True
    assert column(spark, marked, u=None) is False
    assert column(spark, text.rewrite_both(F.col("u"), ("a", "b"), ("c", "d"), compat=True), u=None) == "undefined"


def test_decision_table_misses(spark):
    rules_table = lookup.inline(spark, ["k", "url"], [("one", "u1"), ("<default>", "u0")])
    rows = spark.createDataFrame([(1, "one"), (2, "absent"), (3, None), (4, "")], "id int, sel string")
    assert {r.id: r.url for r in lookup.decision_overlay(rows, rules_table, "sel", "k", "<default>").collect()} == {1: "u1", 3: "u0", 4: "u0"}
    assert [r.id for r in lookup.lookup(rows, rules_table, "sel", "k").collect()] == [1]


def test_health_versions(spark):
    rows = spark.createDataFrame([(200, False, 1), (204, False, 1), (401, False, 1), (500, False, 1), (None, True, 1), (200, False, 3000)], "s int, f boolean, l int")
    got = rows.select(rules.health_v1(F.col("s"), F.col("f"), F.col("l")).alias("a"), rules.health_v2(F.col("s"), F.col("f")).alias("b")).collect()
    assert [r.a for r in got] == ["alive", None, "dead", None, "dead", "dead"]
    assert [r.b for r in got] == ["alive", "alive", "dead", None, "dead", "alive"]


def test_query_strings(spark):
    q = text.query_string([("b", F.lit(0)), ("e", F.lit(False)), ("t", F.lit("")), ("n", F.lit(None).cast("string")), ("p", F.lit("/a b"))])
    assert column(spark, q) == "?b=0&p=%2Fa%20b"
    assert column(spark, text.query_string([("s", F.lit("false")), ("b", F.lit(False))])) == "?s=false"
    assert column(spark, text.widget_url("x", F.lit("/a"), F.lit(""), F.lit(False), [])) == "xer/%2Fa.html?"
    assert column(spark, text.widget_url("x", F.lit(""), F.lit("png"), F.lit(True), [], F.lit("/here"))) == "xer/%2Fhere.png?&no_branding=1"
    assert column(spark, text.encode_component(F.col("x")), x="a b!'()*~-_.é/+") == "a%20b!'()*~-_.%C3%A9%2F%2B"
    assert column(spark, text.query_param(F.col("q"), "a"), q="?A=1&a=2") == "1"
    assert column(spark, text.query_param(F.col("q"), "z"), q="?A=1") is None


def test_private_hosts_and_codes(spark):
    hosts = ["localhost", "notlocalhost", "172.15.0.1", "172.16.0.1", "10.0.0.1"]
    assert [column(spark, text.private_host(F.col("h")), h=h) for h in hosts] == [True, True, False, True, True]
    assert column(spark, rules.first_true_code([F.lit(None).cast("boolean"), F.lit(True), F.lit(True)])) == 151
    assert column(spark, rules.truthy(F.lit(None).cast("string"))) is False
    assert column(spark, rules.dispatch(F.lit("x"), {"png": "img"})) is None


def test_ring_is_invariant_under_rotation_and_reversal(spark):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]
    for ring in (square, square[1:] + square[:1], square[::-1]):
        assert column(spark, geometry.ring_area(F.lit(ring))) == 1
        assert tuple(column(spark, geometry.bbox(F.lit(ring)))) == (0, 0, 1, 1)
    twice = geometry.axis_swap(geometry.axis_swap(F.lit([[1.0, 2.0]]), F.lit("Y(E), X(N)")), F.lit("Y(E), X(N)"))
    assert column(spark, twice) == [[1.0, 2.0]]
    assert round(column(spark, geometry.circle_radius(F.lit(6000.0))), 2) == 1381.98


def test_ranges_ids_and_override(spark):
    ranges = spark.createDataFrame([("1-160",), ("161-395",), ("odd",)], "r string")
    points = inventory.range_expand(ranges, "r")
    assert (points.count(), points.select("point").distinct().count()) == (395, 395)
    assert inventory.id_split(spark.createDataFrame([("A/B/C",)], "c string"), "c").count() == 3
    value, _ = inventory.override(F.col("o"), F.lit(11.0))
    assert column(spark, value, o=10.0) == 10
    assert column(spark, inventory.override(F.lit(None).cast("double"), F.lit(11.0))[0]) == 11


def test_orphans_and_reconcile(spark):
    sites = spark.createDataFrame([(1,), (2,)], "id int")
    features = spark.createDataFrame([(1,), (3,), (None,)], "parent int")
    assert sorted((r.parent or 0) for r in inventory.orphans(features, sites, "parent", "id").collect()) == [0, 3]
    assert [r.id for r in inventory.childless(sites, features, "id", "parent").collect()] == [2]
    left, right = spark.createDataFrame([(1, None), (2, 5)], "id int, v int"), spark.createDataFrame([(1, None), (3, 5)], "id int, v int")
    assert {r.id: (r.side, r.same_v) for r in inventory.reconcile(left, right, "id", ["v"]).collect()} == {1: ("both", True), 2: ("left", False), 3: ("right", False)}


def test_layers_and_presentation(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, class string"), spark.createDataFrame([(2, "y", 3.0)], "id int, class string, area double")
    assert inventory.layer_union({"a": a, "b": b}, ["x", "y"], "class").count() == 2
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, label string")
    moved = keyed.move_after(rows, "pos", F.col("label") == "a", F.col("label") == "b")
    assert [r.label for r in moved.orderBy("sort_key", "pos").collect()] == ["b", "a", "c"]
    assert keyed.guarded_drop(rows, "label", ["a"], "absent").count() == 3
    assert keyed.guarded_drop(rows, "label", ["a"], "c").count() == 2


def test_months_and_throttle(spark):
    log = spark.sql("select 'k' as k, id as n, timestamp_millis(id * 30) as ts from range(4)")
    assert sorted(r.n for r in events.throttled(log, "k", "ts", ["ts"], 40, ["n"]).collect()) == [0, 2, 3]
    assert column(spark, timing.month_key(F.lit("2024-03-05").cast("timestamp"), "c")) == "c-2024-03"


def test_json_documents_and_store(spark, tmp_path):
    for name, rows in (("a.json", [{"parentId": "p", "evidence": "one"}]), ("b.json", [{"parentId": "q", "evidence": ["x", "y"]}, {"parentId": "r"}])):
        (tmp_path / name).write_text(json.dumps({"schema": "s", "features": rows}, indent=1))
    (tmp_path / "index.json").write_text(json.dumps({"files": ["data/b.json", "data/a.json"]}, indent=1))
    docs = documents.from_manifest(spark, str(tmp_path / "index.json"), f"schema string, features array<struct<{documents.FEATURE.replace(' STRING', ':STRING').replace(' BIGINT', ':BIGINT').replace(' DOUBLE', ':DOUBLE')}>>")
    got = documents.exploded(docs, "features", "file_no").withColumn("e", documents.evidence_list(F.col("evidence"))).orderBy("file_no", "pos").collect()
    assert [(r.parentId, r.e) for r in got] == [("q", ["x", "y"]), ("r", None), ("p", ["one"])]
    kv = spark.createDataFrame([("a", "1"), ("b", None)], "key string, value string")
    assert [store.get(kv, k, "d").first().value for k in "abc"] == ["1", "d", "d"]
    path = str(tmp_path / "kv")
    store.put(kv, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="being read"):
        store.put(spark.read.parquet(path), path)


def test_streaming_bind_once(spark, tmp_path):
    rows = spark.sql("select id % 3 as k, timestamp_millis(id) as ts from range(9)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = hits.bind_once(stream, "k", "ts").writeStream.format("memory").queryName("bound").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("bound").count() == 3


def test_lookup_takes_the_first_rule_of_a_repeated_key(spark):
    rules_table = spark.createDataFrame([("k", 2, "late"), ("k", 1, "soon"), ("<default>", 2, "a"), ("<default>", 1, "z")], "k string, at int, url string")
    rows = spark.createDataFrame([(1, "k"), (2, None), (3, "none")], "id int, sel string")
    assert [(r.id, r.url) for r in lookup.lookup(rows, rules_table, "sel", "k", ["at"]).collect()] == [(1, "soon")]
    assert {(r.id, r.url) for r in lookup.decision_overlay(rows, rules_table, "sel", "k", "<default>").collect()} == {(1, "soon"), (2, "z")}
    assert lookup.decision_overlay(rows, rules_table, "sel", "k", "<default>", ["url"]).where("id = 2").first().url == "a"


def test_endpoint_keys(spark):
    own, fixed = {"mine_j": "jackett", "mine_p": "prowlarr"}, {"h2.example": "2"}

    def url(host, kind, key, selector):
        return column(spark, text.endpoint_url("https://", F.lit(host), F.lit(kind), F.lit(key), F.lit(selector), own, fixed))

    first, second = "/api/v1/health?apikey=", "/api/v2.0/indexers/status:healthy/results?apikey="
    assert url("h.example", "prowlarr", "k", "other") == f"https://h.example{first}k"
    assert url("http://h.example", "prowlarr", "k", "mine_p") == f"http://h.example{first}k"
    assert url("h.example", "jackett", "k", "other") == f"https://h.example{second}"
    assert url("http://h.example", "jackett", "k", "mine_j") == f"http://h.example{second}k"
    assert url("h2.example", "jackett", "k", "mine_j") == f"h2.example{second}2"
    assert url("h.example", "jackett", None, None) == f"https://h.example{second}"


def test_hook_gets_the_environment_and_may_reject(spark):
    chain = lambda hook: rules.coalesce_chain(F.lit("arg"), F.lit(None), F.lit("env"), hook)
    assert column(spark, chain(None)) == "arg"
    assert column(spark, chain(F.upper)) == "ENV"
    assert column(spark, chain(lambda x: F.nullif(x, F.lit("env")))) is None


#: An open ring in metres, its area in dka and its box.
RING = [
    (4524101.82, 9431680.69), (4523654.81, 9432386.93), (4523652.11, 9434282.66), (4523858.87, 9434800.91), (4524503.3, 9434806.23),
    (4524506.01, 9436001.18), (4523144.74, 9437999.2), (4522026.7, 9437668.02), (4521795.83, 9435270.99), (4519788.19, 9435482.92),
    (4519617.69, 9435100.29), (4520201.71, 9434306.81), (4521926.99, 9434306.67), (4522557.74, 9431667.52),
]


def test_golden_ring(spark):
    ring = F.lit([list(p) for p in RING])
    assert column(spark, geometry.ring_area_dka(ring)) == 13700.769
    assert tuple(column(spark, geometry.bbox(ring))) == (4519617.69, 9431667.52, 4524506.01, 9437999.2)
    assert column(spark, F.size(ring)) == 14
    swapped = geometry.axis_swap(F.lit([[y, x] for x, y in RING]), F.lit("Y(E), X(N)"))
    assert column(spark, geometry.ring_area_dka(swapped)) == 13700.769
    assert [round(column(spark, u), 2) for u in geometry.km2_units(F.lit(467.7558))] == [46775.58, 467755.8]


def test_range_join_matches_brute_force(spark):
    rng = random.Random(3)
    made = [(i, a := rng.randint(-50, 300), a + rng.choice([-1, 0, 1, 7, 64, 500])) for i in range(60)] + [(99, None, 5)]
    values = [None, *(rng.randint(-60, 900) for _ in range(200))]
    points, ranges = spark.createDataFrame([(v,) for v in values], "v long"), spark.createDataFrame(made, "i int, low long, high long")
    got = sorted((r.v, r.i) for r in inventory.in_ranges(points, "v", ranges, "low", "high").collect())
    assert got == sorted((v, i) for v in values if v is not None for i, low, high in made if low is not None and low <= v <= high)
    assert inventory.in_ranges(points, "v", ranges.where("false"), "low", "high").count() == 0


def test_tiling_of_contours(spark):
    rows = spark.createDataFrame([("c", 1, 160), ("c", 161, 395), ("d", 1, 193), ("d", 150, 160), ("d", 200, 210), ("e", 3, 1)], "g string, low int, high int")
    got = {r.g: tuple(r)[1:] for r in inventory.range_tiling(rows, "g", "low", "high").collect()}
    assert got == {"c": (395, 1, 395, 0, 0), "d": (215, 1, 210, 1, 1)}


def test_curated_rows_replace_others_once(spark):
    rows = spark.createDataFrame([("way", 1, "old"), ("way", 1, "old too"), ("way", 2, "kept"), (None, 3, "free")], "t string, i int, n string")
    curated = spark.createDataFrame([("way", 1, "b"), ("way", 1, "a"), ("node", 9, "new"), (None, 3, "x"), (None, 3, "x")], "t string, i int, n string")
    got = inventory.curated_overlay(rows, curated, ["t", "i"], ["n"]).collect()
    assert sorted(r.n for r in got) == ["a", "free", "kept", "new", "x", "x"]


def test_secondary_counts_are_those_of_the_join(spark):
    rng = random.Random(1)
    left, right = (spark.createDataFrame([(rng.choice([1, 2, None]), rng.randrange(3)) for _ in range(40)], "a int, b int") for _ in range(2))
    want = {r.a: r["count"] for r in inventory.secondary_match(left, right, ["a", "b"]).groupBy("a").count().collect()}
    assert {r.a: r.n for r in inventory.secondary_counts(left, right, ["a", "b"], "a").collect()} == want


def test_store_column_and_written_documents(spark, tmp_path):
    values = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None).cast("string"))
    assert [column(spark, store.get_column(values, k, "d")) for k in "abc"] == ["1", "d", "d"]
    one = spark.range(1).select(F.lit("x").alias("name"))
    documents.write_documents(str(tmp_path / "docs"), {"one.json": one, "two.json": one})
    documents.write_documents(str(tmp_path / "docs"), {"one.json": one.withColumn("name", F.lit("y"))})
    found = documents.documents(spark, [str(tmp_path / "docs" / n) for n in ("one.json", "two.json")], "name string")
    assert sorted(r.name for r in found.collect()) == ["x", "y"]


def test_streaming_throttle(spark, tmp_path):
    rows = spark.sql("select 'k' as k, timestamp_millis(id * 30) as ts from range(4)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = hits.throttled(stream, "k", "ts").writeStream.format("memory").outputMode("complete").queryName("throttled").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.n for r in spark.table("throttled").collect()) == [1, 1, 2]
