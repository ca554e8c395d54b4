"""Queries over the synthetic tables, one or more for each surveyed operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, measures, rules, text, timing
from ..operators import events as ev
from ..operators import inventory as inv
from ..operators import keyed, lookup, ordered, quarantine
from ..sources import cache, store
from ..sources import documents as docs_
from ..sources.store import table


def _events(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events")


def remove_key_nullsafe(s: SparkSession, d: str) -> DataFrame:
    rows = _events(s, d).select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return keyed.remove_key(rows, "event_type", "view")


def _urgent(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")


def contains_key(s: SparkSession, d: str) -> DataFrame:
    return keyed.containing(table(s, d, "customer"), _urgent(s, d), "c_custkey").select("c_custkey", "c_name")


def status_binary(s: SparkSession, d: str) -> DataFrame:
    return keyed.status_binary(table(s, d, "customer").select("c_custkey", "c_name"), _urgent(s, d), "c_custkey")


def status_tristate(s: SparkSession, d: str) -> DataFrame:
    # status 0 stands for pending; a missing status, made of orders with status O, is active
    installed = _urgent(s, d).select("c_custkey", "o_orderdate", "o_orderkey", F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "F", 1).alias("status"))
    return keyed.status_tristate(table(s, d, "customer").select("c_custkey", "c_name"), installed, "c_custkey", ["o_orderdate", "o_orderkey"], "status")


def guarded_append(s: SparkSession, d: str) -> DataFrame:
    part = table(s, d, "part").select("p_partkey", "p_name", "p_size")
    return keyed.guarded_append(part.where("p_size <= 30"), part.where("p_size > 20").withColumn("p_name", F.upper("p_name")), "p_partkey", ["p_name", "p_size"])


def append_outcome(s: SparkSession, d: str) -> DataFrame:
    return status_tristate(s, d).select("c_custkey", keyed.append_outcome(F.col("status")).alias("outcome"))


def load_guard(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", "lang")
    return keyed.lacking(docs, table(s, d, "labels"), "doc_id")


def write_barrier(s: SparkSession, d: str) -> DataFrame:
    log = _events(s, d).select("user_id", "ts", "event_id", "event_type")
    return keyed.write_barrier(log, "user_id", ["ts", "event_id"], F.col("event_type") == "error").select("user_id", "event_id", "barred")


def replace_first(s: SparkSession, d: str) -> DataFrame:
    url, marked = text.migrate(F.col("url"), "example", "example", "sample")
    return table(s, d, "pages").select("page_id", url.alias("url"), marked.alias("written"))


def chained_rewrite(s: SparkSession, d: str) -> DataFrame:
    url = F.nullif(F.col("url"), F.when(F.col("page_id") % 10 == 0, F.col("url")))
    return table(s, d, "pages").select("page_id", text.rewrite_both(url, ("https://www.", "https://"), ("http://", "https://"), compat=True).alias("url"), text.rewrite_both(url, ("https://www.", "https://"), ("http://", "https://")).alias("strict_url"))


#: Fixed values of the checks: endpoints by selector.
ENDPOINTS = [("view", "base-view", "v"), ("click", "base-click", "c"), ("<default>", "base-default", "d")]


def _rules(s: SparkSession) -> DataFrame:
    return lookup.inline(s, ["k", "base", "code"], ENDPOINTS)


def _selected(s: SparkSession, d: str) -> DataFrame:
    return _events(s, d).select("event_id", F.nullif("event_type", F.lit("error")).alias("selector"))


#: Fixed values of the checks: rules with repeated keys, by position.
REPEATED = [(2, "view", "late"), (1, "view", "first"), (3, "click", "only"), (0, "<default>", "default"), (5, "<default>", "never")]


def lookup_first(s: SparkSession, d: str) -> DataFrame:
    rules_ = lookup.inline(s, ["pos", "k", "base"], REPEATED)
    return lookup.lookup(_selected(s, d), rules_, "selector", "k", ["pos"]).select("event_id", "base")


def default_first(s: SparkSession, d: str) -> DataFrame:
    rules_ = lookup.inline(s, ["pos", "k", "base"], REPEATED)
    return lookup.decision_overlay(_selected(s, d), rules_, "selector", "k", "<default>", ["pos"]).select("event_id", "base")


def decision_overlay(s: SparkSession, d: str) -> DataFrame:
    chosen = lookup.decision_overlay(_selected(s, d), _rules(s), "selector", "k", "<default>")
    return lookup.unpivot(chosen, [(F.lit("url"), F.col("base")), (F.lit("key"), F.col("code"))], "event_id")


def settings_unpivot(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("s_acctbal") < 0, "debit").otherwise("credit")
    pairs = [(F.lit("type"), kind), (F.concat(kind, F.lit("_name")), F.col("s_name")), (F.concat(kind, F.lit("_nation")), F.col("s_nationkey"))]
    return lookup.unpivot(table(s, d, "supplier"), pairs, "s_suppkey")


def fold_to_map(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "nation").select("n_regionkey", F.substring("n_name", 1, 1).alias("k"), "n_name", "n_nationkey")
    folded = keyed.fold_to_map(rows, "n_regionkey", "k", "n_name", ["n_nationkey"], {"A": "seed", "_": "none"})
    pairs = F.array_sort(F.transform(F.map_entries("entries"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return folded.select("n_regionkey", F.array_join(pairs, ",").alias("entries"), F.size("entries").cast("long").alias("n"))


def health_classify(s: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 204).when(F.col("event_type") == "purchase", 401).otherwise(500)
    failed, latency = F.col("event_type") == "error", F.col("value") * 20
    return _events(s, d).select("event_id", rules.health_v1(status, failed, latency).alias("v1"), rules.health_v2(status, failed).alias("v2"))


def callback_hook(s: SparkSession, d: str) -> DataFrame:
    """A hook in the place of the path: it gets the environment's, and its null rejects the hit."""
    e = _events(s, d)
    hooked = rules.coalesce_chain(F.lit(None), F.lit(None), F.concat(F.lit("/"), "event_type"), lambda p: F.when(F.col("user_id") % 3 != 0, F.upper(p)))
    return e.select("event_id", hooked.alias("p")).where("p is not null")


def zip_positions(s: SparkSession, d: str) -> DataFrame:
    rows = lookup.zip_positions(table(s, d, "embeddings"), F.slice("embedding", 1, 32), F.slice("embedding", 33, 32), "vec_id")
    return rows.select("vec_id", "pos", "ui_row", F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b"))


def coalesce_chain(s: SparkSession, d: str) -> DataFrame:
    e = _events(s, d)
    chosen = rules.coalesce_chain(F.nullif("event_type", F.lit("error")), F.get_json_object("props", "$.missing"), F.when(F.col("user_id") % 2 == 0, F.lit("environment")))
    return e.select("event_id", chosen.alias("p")).where("p is not null")


def first_true_code(s: SparkSession, d: str) -> DataFrame:
    flags = [F.col("event_type") == "error", F.col("value") > 150, F.col("user_id") % 3 == 0, F.nullif(F.col("value"), F.col("value")) > 0, F.col("event_type") == "click"]
    return _events(s, d).select("event_id", rules.first_true_code(flags).alias("code"))


def reject_reason(s: SparkSession, d: str) -> DataFrame:
    """Flags and switches are null in some rows: each has a different one of 11, 13, 17, ..."""
    kind, user, event = F.col("event_type"), F.col("user_id"), F.col("event_id")
    known = lambda flag, n: F.when(event % n != 0, flag)
    reason = rules.reject_reason(known(kind == "error", 11), known(user % 5 == 0, 13), known(F.col("value") < 5, 17), known(F.col("value") < 10, 19), known(user % 7 == 0, 23), known(user % 2 == 0, 3), known(user % 3 == 0, 4))
    return _events(s, d).select("event_id", reason.alias("reason"), reason.isNull().alias("counted"))


def private_host(s: SparkSession, d: str) -> DataFrame:
    made = F.element_at(F.array(*map(F.lit, ("localhost", "notlocalhost", "172.15.0.1", "172.16.0.1", "10.0.0.1", "a.example"))), (F.col("page_id") % 6 + 1).cast("int"))
    return table(s, d, "pages").select("page_id", made.alias("host"), text.private_host(made).alias("private"))


def query_string(s: SparkSession, d: str) -> DataFrame:
    pairs = [("p", F.concat(F.lit("/a b'(é)~*!/"), F.col("event_type"))), ("e", F.col("event_type") == "click"), ("b", F.col("user_id") % 2), ("t", F.when(F.col("user_id") % 3 == 0, "").otherwise(F.col("props"))), ("f", F.when(F.col("user_id") % 2 == 0, "false").otherwise("true"))]
    return _events(s, d).select("event_id", text.query_string(pairs).alias("q"))


def query_param(s: SparkSession, d: str) -> DataFrame:
    query = text.query_of(F.col("url"))
    return table(s, d, "pages").select("page_id", text.query_param(query, "UTM_source").alias("source"), text.query_param(query, "page").alias("page"))


def canonical_path(s: SparkSession, d: str) -> DataFrame:
    """Links with the page's host less www., in capitals, with a port, with another host, and six relative ones."""
    url, n = F.col("url"), F.col("page_id") % 12
    host = F.lower(text.host_of(url))
    cases = [
        F.regexp_replace(url, "://www\\.", "://"),
        F.concat(F.lit("HTTPS://"), F.upper(host), F.lit("/Capitals?x=1#f")),
        F.concat(F.lit("https://"), host, F.lit(":8443/port")),
        F.lit("https://elsewhere.example/other?x=1"),
        F.lit("/root?x=1"),
        F.lit("beside?x=2"),
        F.lit("../up/./here"),
        F.lit("?q=3"),
        F.lit("#part"),
        F.concat(F.lit("//"), host, F.lit("/scheme")),
        F.concat(F.lit("https://user@www."), F.regexp_replace(host, "^www\\.", ""), F.lit("?only=query")),
    ]
    canonical = F.get(F.array(*cases), n.cast("int"))
    return table(s, d, "pages").select("page_id", text.canonical_path(canonical, url).alias("path"), text.canonical_path(F.lit("https://a.example"), F.lit("https://www.a.example/x")).alias("root"))


def json_allowlist(s: SparkSession, d: str) -> DataFrame:
    props = F.when(F.col("event_id") % 10 == 0, F.lit("{bad")).otherwise(F.col("props"))
    allowed = rules.allowlist(props, ["k", "other"])
    return _events(s, d).select("event_id", F.try_element_at(allowed, F.lit("k")).alias("k"), F.try_element_at(allowed, F.lit("z")).alias("z"))


def bind_once(s: SparkSession, d: str) -> DataFrame:
    return keyed.bind_once(_events(s, d).select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"]).drop("ts")


def first_visible(s: SparkSession, d: str) -> DataFrame:
    return ev.first_visible(_events(s, d), "user_id", ["ts", "event_id"], F.col("event_type") == "view", ["event_id", "value"])


def toggle_parity(s: SparkSession, d: str) -> DataFrame:
    return ev.toggle_parity(_events(s, d), "user_id", F.col("event_type") == "click")


def _ring(of: str = "embedding"):
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(of) / 2).cast("int") - 1), lambda i: F.array(F.get(F.col(of), 2 * i).cast("double"), F.get(F.col(of), 2 * i + 1).cast("double")))


def ring_area(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings").select("vec_id", F.round(geometry.ring_area(_ring()), 6).alias("area"), F.size(_ring()).alias("points"))


def ring_bbox(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings").select("vec_id", geometry.bbox(_ring()).alias("b")).select("vec_id", "b.min_x", "b.min_y", "b.max_x", "b.max_y")


def axis_swap(s: SparkSession, d: str) -> DataFrame:
    order = F.when(F.col("label") % 2 == 0, "Y(E), X(N)").otherwise("X(N), Y(E)")
    swapped = table(s, d, "embeddings").select("vec_id", geometry.axis_swap(_ring(), order).alias("ring"))
    return swapped.select("vec_id", F.col("ring")[0][0].alias("x0"), F.col("ring")[0][1].alias("y0"), F.element_at("ring", -1)[0].alias("x_last"))


def point_check(s: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("partial__"), F.col("p_size").cast("string"), F.lit("_of_50__points"))).otherwise("complete")
    n, m = geometry.declared_points(status)
    return table(s, d, "part").select("p_partkey", n.alias("n"), m.alias("m"), (n == F.col("p_size")).alias("agrees"))


def circle_radius(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", F.round(geometry.circle_radius(F.col("p_retailprice")), 6).alias("radius"))


def unit_convert(s: SparkSession, d: str) -> DataFrame:
    ha, dka = geometry.km2_units(F.col("p_retailprice"))
    return table(s, d, "part").select("p_partkey", F.round(ha, 2).alias("ha"), F.round(dka, 1).alias("dka"))


#: Fixed values of the checks: irregular, overlapping, empty and odd ranges.
SIZES = [("low", "1-7"), ("mid", "5-20"), ("one", "20-20"), ("wide", "13-49"), ("none", "9-3"), ("odd", "x"), ("far", "48-4000"), ("below", "0-2")]


def range_expand(s: SparkSession, d: str) -> DataFrame:
    ranges = lookup.inline(s, ["name", "r"], SIZES)
    low, high = inv.range_bounds(F.col("r"))
    placed = inv.in_ranges(table(s, d, "part").select("p_partkey", "p_size"), "p_size", ranges.select("name", low.alias("low"), high.alias("high")), "low", "high")
    return placed.groupBy("name", "low", "high").agg(F.count("*").alias("n"), F.sum("p_size").alias("total"))


def range_tiling(s: SparkSession, d: str) -> DataFrame:
    orders = table(s, d, "orders").select("o_custkey", (F.col("o_orderkey") % 1000).cast("long").alias("low"))
    return inv.range_tiling(orders.withColumn("high", F.col("low") + F.col("o_custkey") % 40 - 3), "o_custkey", "low", "high")


def range_tiles(s: SparkSession, d: str) -> DataFrame:
    """Ranges of vendors, as text, some empty: how many cover each point."""
    low = F.col("vendor_id") % 90 + 1
    ranges = table(s, d, "vendors").select(F.concat_ws("-", low, low + F.col("vendor_id") % 37 - 2).alias("r"))
    return inv.range_expand(ranges, "r").groupBy("point").agg(F.count("*").alias("covers"))


def interval_coverage(s: SparkSession, d: str) -> DataFrame:
    """Days from sale to a few days later, by client: merged intervals and the stretches between."""
    day = F.expr("datediff(sold_at, date'2024-01-01')").cast("long")
    sales = table(s, d, "sales").where("client_id is not null and sold_at is not null").select("client_id", day.alias("low"), (day + F.col("priority") * 2 - 3).alias("high"))
    return ordered.coverage(sales, "client_id", "low", "high")


def id_split(s: SparkSession, d: str) -> DataFrame:
    return inv.id_split(table(s, d, "part").select("p_partkey", "p_name"), "p_name", " ").select("p_partkey", "part_no", "part")


def orphans(s: SparkSession, d: str) -> DataFrame:
    return inv.orphans(table(s, d, "customer").select("c_custkey", "c_name"), _urgent(s, d).withColumnRenamed("c_custkey", "id"), "c_custkey", "id")


def childless(s: SparkSession, d: str) -> DataFrame:
    labels = table(s, d, "labels").select(F.col("doc_id").alias("parent"))
    return inv.childless(table(s, d, "documents").select("doc_id", "source"), labels, "doc_id", "parent")


def parent_child(s: SparkSession, d: str) -> DataFrame:
    suppliers = table(s, d, "supplier").select("s_suppkey", "s_nationkey")
    return inv.children_with_parent(suppliers, table(s, d, "nation").select("n_nationkey", "n_name"), "s_nationkey", "n_nationkey").select("s_suppkey", "n_name")


def secondary_match(s: SparkSession, d: str) -> DataFrame:
    left = table(s, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.floor("c_acctbal").alias("bal"))
    right = table(s, d, "supplier").select("s_suppkey", F.nullif("s_nationkey", F.lit(3)).alias("nation"), F.floor("s_acctbal").alias("bal"))
    return inv.secondary_counts(left.withColumn("bal", F.col("bal") % 50), right.withColumn("bal", F.col("bal") % 50), ["nation", "bal"], "nation")


def reconcile(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", (F.char_length("text") > 200).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    return inv.reconcile(docs, table(s, d, "labels"), "doc_id", ["quality", "toxic"])


def authority_override(s: SparkSession, d: str) -> DataFrame:
    official = F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice"))
    value, off = inv.override(official, F.round(F.col("p_retailprice") * 1.5, 2))
    return table(s, d, "part").select("p_partkey", F.round(value, 2).alias("area"), F.round(off, 4).alias("deviation"))


def publish_gate(s: SparkSession, d: str) -> DataFrame:
    return inv.publish_split(table(s, d, "part").select("p_partkey", "p_type"), F.col("p_partkey") % 4 == 0).select("p_partkey", "route")


def status_counts(s: SparkSession, d: str) -> DataFrame:
    return inv.status_counts(table(s, d, "orders"), "o_orderstatus", "o_orderpriority")


def layer_union(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("class"), F.col("c_acctbal").alias("area"))
    b = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_nationkey") < 12, "BUILDING").otherwise("LEGAL").alias("class"))
    return inv.layer_union({"customer": a, "supplier": b}, ["BUILDING", "MACHINERY"], "class")


def curated_overlay(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "part").select(F.col("p_brand").alias("osm_type"), F.col("p_partkey").alias("osm_id"), F.lit("feature").alias("origin"))
    # of every fifth part one that is there and one that isn't, both twice, and some without a key
    curated = rows.where("osm_id % 5 = 0").withColumn("osm_id", F.explode(F.array("osm_id", F.col("osm_id") + 10_000_000))).withColumn("origin", F.explode(F.array(F.lit("late"), F.lit("early"))))
    curated = curated.withColumn("osm_id", F.nullif("osm_id", F.when(F.col("osm_id") % 3 == 0, F.col("osm_id"))))
    return inv.curated_overlay(rows, curated, ["osm_type", "osm_id"], ["origin"])


def month_key(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").groupBy(timing.month_key(F.col("o_orderdate"), "gis").alias("month")).agg(F.count("*").alias("n"))


def month_evict(s: SparkSession, d: str) -> DataFrame:
    cache = table(s, d, "orders").select("o_orderkey", timing.month_key(F.col("o_orderdate"), "gis").alias("month"))
    return ev.evicted(cache, "month", "gis-1998-03")


def throttle_first(s: SparkSession, d: str) -> DataFrame:
    return ev.throttled(_events(s, d), "user_id", "ts", ["ts", "event_id"], 86_400_000, ["event_id"])


def truthy_fallback(s: SparkSession, d: str) -> DataFrame:
    token = F.element_at(F.array(*map(F.lit, ("T", "true", "0", "", "TRUE", "yes"))), (F.col("doc_id") % 6 + 1).cast("int"))
    title = text.fallback(F.nullif("lang", F.lit("en")), F.when(F.col("doc_id") % 2 == 0, F.lit("")), F.col("text"))
    return table(s, d, "documents").select("doc_id", rules.truthy(token).alias("truthy"), title.alias("title"))


def enum_dispatch(s: SparkSession, d: str) -> DataFrame:
    tag = rules.dispatch(F.col("role"), {"user": "img", "assistant": "iframe"})
    return table(s, d, "conversations").select("conv_id", "turn", tag.alias("tag")).where("tag is not null")


def url_builder(s: SparkSession, d: str) -> DataFrame:
    params = [("style", F.when(F.col("turn") == 1, "a&b=c")), ("start", F.nullif("role", F.lit("user")))]
    url = text.widget_url("https://a.example/count", F.concat(F.lit("/a b/"), F.col("role")), F.when(F.col("turn") > 2, "png").when(F.col("turn") == 2, ""), F.col("turn") == 0, params)
    return table(s, d, "conversations").select("conv_id", "turn", url.alias("url"))


def endpoint_url(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("s_acctbal") < 0, "prowlarr").otherwise("jackett")
    selector = F.when(F.col("s_nationkey") % 3 == 0, F.concat(F.lit("own_"), kind)).otherwise(F.col("s_nationkey").cast("string"))
    host = F.concat(F.lit("h"), (F.col("s_suppkey") % 5).cast("string"), F.lit(".example"))
    key = F.nullif("s_name", F.when(F.col("s_suppkey") % 4 == 0, F.col("s_name")))
    url = text.endpoint_url("https://", host, kind, key, selector, {"own_jackett": "jackett", "own_prowlarr": "prowlarr"}, {"h2.example": "2"})
    return table(s, d, "supplier").select("s_suppkey", url.alias("url"))


def clamp_progress(s: SparkSession, d: str) -> DataFrame:
    """Half percents and missing values among them."""
    elapsed = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 5 == 0, F.col("event_id") % 200 * 0.75).otherwise(F.col("value"))
    return _events(s, d).select("event_id", rules.progress(elapsed, 150.0).alias("percent"), rules.remaining(elapsed, 150.0).alias("left"))


def append_positions(s: SparkSession, d: str) -> DataFrame:
    """A list of done sales in their order of arrival, to which open ones and some that are there are appended."""
    sales = table(s, d, "sales").where("sale_id is not null").dropDuplicates(["sale_id"]).select("sale_id", "arrived_at", "status", "priority")
    listed = ordered.numbered(sales.where("priority <= 2").select("sale_id", "arrived_at"), ["arrived_at", "sale_id"]).withColumn("status", F.lit(0))
    return ordered.appended(listed, sales.where("priority >= 2").select("sale_id", "arrived_at"), "sale_id", ["arrived_at", "sale_id"]).select("sale_id", "pos", "status")


def move_positions(s: SparkSession, d: str) -> DataFrame:
    """Items of two kinds moved before the item at place 40, all renumbered."""
    listed = ordered.numbered(table(s, d, "items").select("item_id", "kind", "brand").distinct(), ["item_id", "kind", "brand"])
    return ordered.moved(listed, "pos", F.col("kind").isin("home", "tools"), F.col("pos") == 40, before=True).select("item_id", "kind", "brand", "pos")


def oplog_replay(s: SparkSession, d: str) -> DataFrame:
    """Changes of clients as operations on lists, a session for each source."""
    op = F.when(F.col("change_id") % 41 == 0, "restart").when(F.col("op") == "D", "delete").when((F.col("op") == "U") & (F.col("change_id") % 3 == 0), "disable").otherwise("append")
    log = table(s, d, "client_changes").select(F.coalesce("source", F.lit("-")).alias("source"), "change_id", (F.col("client_id") % 500).alias("entry"), op.alias("op"))
    return ordered.replayed(log.dropDuplicates(["source", "change_id"]), "source", ["change_id"], "entry", "op")


def store_versions(s: SparkSession, d: str) -> DataFrame:
    """A store of totals by client, then a version made of the one it replaces."""
    path, schema = store.scratch(s), "client_id long, n long"
    store.publish(table(s, d, "sales").groupBy("client_id").agg(F.count("*").alias("n")), path)
    store.publish(store.current(s, path, schema).where("n > 1").withColumn("n", F.col("n") * 10), path)
    return store.current(s, path, schema)


def month_cache(s: SparkSession, d: str) -> DataFrame:
    """Sales cached by month; April comes again with other totals; the last two months to April stay."""
    path = store.scratch(s)
    sales = table(s, d, "sales").select("sale_id", "sold_at", F.col("total").cast("double").alias("total"))
    cache.put_months(sales, path, "sold_at")
    cache.put_months(sales.where("sold_at >= '2024-04-01' and sold_at < '2024-05-01' and sale_id % 2 = 0").withColumn("total", F.lit(1.0)), path, "sold_at")
    cache.evict(s, path, "2024-04", months_kept=2)
    return cache.read_months(s, path, "sale_id long, sold_at timestamp_ntz, total double", "2024-03").select("sale_id", "month", "total")


def json_unified(s: SparkSession, d: str) -> DataFrame:
    """Documents of vendors of two shapes: evidence as text or as a list, names in snake or camel case."""
    path, vendors = store.scratch(s), table(s, d, "vendors")
    old = vendors.where("vendor_id % 2 = 0").select("vendor_id", F.struct(F.col("vendor_id").alias("parent_id"), F.col("balance").alias("area_dka"), F.concat(F.lit("["), "name").alias("evidence")).alias("f"))
    new = vendors.where("vendor_id % 2 = 1").select("vendor_id", F.struct(F.col("vendor_id").cast("string").alias("parentId"), F.col("balance").cast("string").alias("areaDka"), F.array("name", F.lit("map")).alias("evidence")).alias("f"))
    for name, rows in (("old", old), ("new", new)):  # a document for each hundred ids
        rows.groupBy(F.floor(F.col("vendor_id") / 100).alias("part")).agg(F.collect_list("f").alias("features")).drop("part").write.json(f"{path}/{name}")
    fields = {"parent_id": (["parent_id", "parentId"], "long"), "area": (["area_dka", "areaDka"], "double"), "evidence": (["evidence"], "array<string>")}
    return docs_.unified(s, [f"{path}/old", f"{path}/new"], "features", fields, lines=True).select("parent_id", "area", F.array_join("evidence", ",").alias("evidence"))


def lookup_quarantine(s: SparkSession, d: str) -> DataFrame:
    """Clicks matched to rules: those without a rule, with broken properties or without a time are kept apart, all are counted."""
    rules_ = lookup.inline(s, ["k", "base"], [("view", "v"), ("click", "c")])
    clicks = table(s, d, "clicks").select("click_id", "kind", "ts", "props").join(rules_, F.col("kind") == F.col("k"), "left")
    broken = F.col("props").isNotNull() & F.try_parse_json("props").isNull()
    good, bad, counts = quarantine.quarantined(clicks, {"no rule": F.col("base").isNull(), "bad json": broken, "no time": F.col("ts").isNull()})
    kept = good.groupBy("base").agg(F.count("*").alias("n")).select(F.lit("good").alias("route"), F.col("base").alias("what"), "n")
    apart = bad.groupBy("reason").agg(F.count("*").alias("n")).select(F.lit("bad").alias("route"), F.col("reason").alias("what"), "n")
    seen = s.range(1).select(F.inline(F.array(*(F.struct(F.lit("counted").alias("route"), F.lit(k).alias("what"), F.lit(n).cast("long").alias("n")) for k, n in counts.items()))))
    return kept.unionByName(apart).unionByName(seen)


def additive_summary(s: SparkSession, d: str) -> DataFrame:
    """Amounts of sale lines are added, discounts (marked) aren't."""
    lines = table(s, d, "sale_lines").select("vendor_id", F.col("quantity").cast("long").alias("quantity"), measures.non_additive(F.col("discount"), "discount", "a rate"))
    named = lines.join(table(s, d, "vendors").select("vendor_id", "nation_id").dropDuplicates(["vendor_id"]), "vendor_id")
    return measures.summary(named.where("quantity > 0"), ["vendor_id"], ["quantity", "discount"])


def suffix_key(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "clicks").select("click_id", text.suffix(F.col("click_id"), F.col("kind"), seed="a").alias("rnd"))


#: Fixed values of the checks: labels by language and locale.
LABELS = [("en", "en", "English"), ("en", "bg", "Английски"), ("de", "en", "German"), ("fr", "bg", "Френски")]


def dictionary_lookup(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("bg").alias("locale"))
    return lookup.localised(rows, lookup.inline(s, ["key", "locale", "text"], LABELS), "lang", "locale")


def provenance(s: SparkSession, d: str) -> DataFrame:
    sources = lookup.inline(s, ["source", "kind"], [("src0", "register"), ("src1", "map")])
    return table(s, d, "documents").select("doc_id", "source").join(sources, "source")


def reorder(s: SparkSession, d: str) -> DataFrame:
    return keyed.move_after(table(s, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", F.col("n_name").isin("NATION_3", "NATION_17"), F.col("n_nationkey") == 10)


def guarded_drop(s: SparkSession, d: str) -> DataFrame:
    region = table(s, d, "nation").select("n_nationkey", F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("label"))
    with_marker = keyed.guarded_drop(region, "label", ["n1", "n2", "n3", "n4"], "n20").withColumn("marked", F.lit(True))
    without = keyed.guarded_drop(region, "label", ["n1", "n2"], "absent").withColumn("marked", F.lit(False))
    return with_marker.unionByName(without)


def route_live(s: SparkSession, d: str) -> DataFrame:
    return inv.route_live(_events(s, d).select("event_id", "event_type"), F.col("event_type") == "view").select("event_id", "route")


def _written(s: SparkSession, d: str) -> str:
    """A (key, value) store, written twice as a whole: the second replaces the first."""
    path = store.scratch(s)
    store.put(table(s, d, "nation").select(F.col("n_name").alias("key"), F.lit("old").alias("value")), path)
    nation = table(s, d, "nation").where("n_nationkey < 20").select(F.col("n_name").alias("key"), F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.lit("v"), F.col("n_regionkey").cast("string"))).alias("value"))
    store.put(nation, path)
    return path


def store_sink(s: SparkSession, d: str) -> DataFrame:
    return s.read.schema("key string, value string").parquet(_written(s, d))


def store_scan(s: SparkSession, d: str) -> DataFrame:
    """A key that is there, one without a value, one absent, and one absent without a default."""
    held = s.read.schema("key string, value string").parquet(_written(s, d))
    asked = [("NATION_7", "d"), ("NATION_5", "d"), ("NATION_21", "d"), ("NATION_22", None)]
    parts = [store.get(held, key, default).select(F.lit(key).alias("key"), "value") for key, default in asked]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_INVENTORY = "version int, region bigint, features array<struct<id:bigint, name:string, note:string>>"


def _inventory(s: SparkSession, d: str) -> str:
    """A document a region, and an index that lists three of them in an order of its own."""
    path = store.scratch(s)
    nation = table(s, d, "nation")
    feature = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "even").alias("note"))
    docs = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(feature)).alias("features")).select(F.lit(1).alias("version"), F.col("n_regionkey").alias("region"), "features")
    docs_.write_documents(path, {f"region-{i}.json": docs.where(F.col("region") == i) for i in range(5)})
    index = s.range(1).select(F.array(*(F.lit(f"data/region-{i}.json") for i in (3, 0, 4))).alias("files"))
    docs_.write_documents(path, {"index.json": index})
    return path


def json_documents(s: SparkSession, d: str) -> DataFrame:
    path = _inventory(s, d)
    found = docs_.documents(s, [f"{path}/region-{i}.json" for i in range(5)], _INVENTORY)
    return docs_.exploded(found, "features", "region").select("region", "pos", "id", "name", "note")


def manifest_scan(s: SparkSession, d: str) -> DataFrame:
    found = docs_.from_manifest(s, f"{_inventory(s, d)}/index.json", _INVENTORY)
    return found.select("file_no", "version", "region", F.size("features").alias("n"))


def queries() -> dict:
    own = (
        store_scan, store_sink, json_documents, manifest_scan, callback_hook, default_first, range_tiling,
        remove_key_nullsafe, contains_key, status_binary, status_tristate, guarded_append, append_outcome, load_guard, write_barrier,
        replace_first, chained_rewrite, lookup_first, decision_overlay, settings_unpivot, fold_to_map, health_classify, zip_positions,
        coalesce_chain, first_true_code, reject_reason, private_host, query_string, query_param, canonical_path, json_allowlist,
        bind_once, first_visible, toggle_parity, ring_area, ring_bbox, axis_swap, point_check, circle_radius, unit_convert,
        range_expand, range_tiles, id_split, orphans, childless, parent_child, secondary_match, reconcile, authority_override,
        publish_gate, status_counts, layer_union, curated_overlay, month_key, month_evict, throttle_first, truthy_fallback,
        enum_dispatch, url_builder, endpoint_url, clamp_progress, dictionary_lookup, provenance, reorder, guarded_drop, route_live,
        append_positions, move_positions, oplog_replay, interval_coverage, store_versions, month_cache, json_unified, lookup_quarantine,
        additive_summary, suffix_key,
    )
    return {f.__name__: f for f in own}
