"""DuckDB SQL for the queries of this package."""

from __future__ import annotations

_URGENT = "SELECT o_custkey AS c_custkey, * FROM orders WHERE o_orderpriority = '1-URGENT'"
_RING = "list_transform(range(0, len(embedding) // 2), lambda i: [embedding[2 * i + 1]::DOUBLE, embedding[2 * i + 2]::DOUBLE])"
_RULES = "(VALUES ('view', 'base-view', 'v'), ('click', 'base-click', 'c'), ('<default>', 'base-default', 'd')) r(k, base, code)"
_TRISTATE = f"""
SELECT c.c_custkey, c_name, CASE WHEN f.c_custkey IS NULL THEN 'error' WHEN o_orderstatus = 'P' THEN 'disabled' ELSE 'active' END AS status
FROM customer c LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM ({_URGENT})
) f ON c.c_custkey = f.c_custkey AND rn = 1
"""


def enc(value: str) -> str:
    """Percent-encoding as a browser does it."""
    out = f"url_encode({value})"
    for code, mark in (("%21", "!"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*")):
        out = f"replace({out}, '{code}', '{mark}')"
    return out


def _first(url: str, old: str, new: str) -> str:
    return f"CASE WHEN instr({url}, '{old}') > 0 THEN substr({url}, 1, instr({url}, '{old}') - 1) || '{new}' || substr({url}, instr({url}, '{old}') + {len(old)}) ELSE {url} END"


def _param(name: str) -> str:
    query = r"regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)"
    return f"substr(list_filter(string_split(substr({query}, 2), '&'), lambda x: starts_with(lower(x), '{name}='))[1], {len(name) + 2})"


_PATH = "coalesce(nullif(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1), ''), '/')"
_PAIRS = [
    ("p", "'/a b''(é)~*!/' || event_type", "TRUE"),
    ("e", "'true'", "event_type = 'click'"),
    ("b", "(user_id % 2)::VARCHAR", "TRUE"),
    ("t", "props", "user_id % 3 <> 0 AND props IS NOT NULL AND props <> ''"),
    ("f", "CASE WHEN user_id % 2 = 0 THEN 'false' ELSE 'true' END", "TRUE"),
]
_QUERY = "'?' || array_to_string(list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{k}=' || {enc(v)} END" for k, v, cond in _PAIRS) + "], lambda x: x IS NOT NULL), '&')"
_HOSTS = "['localhost', 'notlocalhost', '172.15.0.1', '172.16.0.1', '10.0.0.1', 'a.example'][page_id % 6 + 1]"


def oracle_sql() -> dict[str, str]:
    return {
        "remove_key_nullsafe": "SELECT event_id, nullif(event_type, 'error') AS event_type FROM events WHERE nullif(event_type, 'error') IS DISTINCT FROM 'view'",
        "contains_key": f"SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM ({_URGENT}) u WHERE u.c_custkey = c.c_custkey)",
        "status_binary": f"SELECT c_custkey, c_name, CASE WHEN EXISTS (SELECT 1 FROM ({_URGENT}) u WHERE u.c_custkey = c.c_custkey) THEN 'active' ELSE 'error' END AS status FROM customer c",
        "status_tristate": _TRISTATE,
        "guarded_append": """
            SELECT p_partkey, p_name, p_size FROM part WHERE p_size <= 30
            UNION ALL SELECT p_partkey, upper(p_name), p_size FROM part n WHERE p_size > 20
              AND NOT EXISTS (SELECT 1 FROM part o WHERE o.p_size <= 30 AND o.p_partkey = n.p_partkey)""",
        "append_outcome": f"SELECT c_custkey, CASE status WHEN 'active' THEN 'already_active' WHEN 'disabled' THEN 'already_disabled' ELSE 'installed' END AS outcome FROM ({_TRISTATE})",
        "load_guard": "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "write_barrier": "SELECT user_id, event_id, coalesce(max(event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS barred FROM events",
        "replace_first": "SELECT page_id, regexp_replace(url, 'example', 'sample') AS url, contains(url, 'example') AS written FROM pages",
        "chained_rewrite": f"""
            WITH a AS (SELECT page_id, CASE WHEN page_id % 10 <> 0 THEN url END AS s, CASE WHEN page_id % 10 <> 0 THEN url ELSE 'undefined' END AS c FROM pages),
            b AS (SELECT page_id, {_first("s", "https://www.", "https://")} AS s, {_first("c", "https://www.", "https://")} AS c FROM a)
            SELECT page_id, {_first("c", "http://", "https://")} AS url, {_first("s", "http://", "https://")} AS strict_url FROM b""",
        "lookup_first": "SELECT event_id, CASE event_type WHEN 'view' THEN 'first' ELSE 'only' END AS base FROM events WHERE event_type IN ('view', 'click')",
        "default_first": "SELECT event_id, CASE event_type WHEN 'view' THEN 'first' WHEN 'click' THEN 'only' ELSE 'default' END AS base FROM events WHERE event_type IN ('view', 'click', 'error')",
        "callback_hook": "SELECT event_id, '/' || upper(event_type) AS p FROM events WHERE user_id % 3 <> 0",
        "store_sink": "SELECT n_name AS key, CASE WHEN n_nationkey % 5 <> 0 THEN 'v' || n_regionkey END AS value FROM nation WHERE n_nationkey < 20",
        "store_scan": "SELECT 'NATION_7' AS key, 'v' || n_regionkey AS value FROM nation WHERE n_nationkey = 7 UNION ALL SELECT * FROM (VALUES ('NATION_5', 'd'), ('NATION_21', 'd'), ('NATION_22', NULL))",
        "json_documents": """
            SELECT n_regionkey::BIGINT AS region, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INTEGER AS pos, n_nationkey::BIGINT AS id, n_name AS name,
              CASE WHEN n_nationkey % 2 = 0 THEN 'even' END AS note FROM nation""",
        "manifest_scan": "SELECT file_no, 1 AS version, region::BIGINT AS region, count(*)::INTEGER AS n FROM nation JOIN (VALUES (0, 3), (1, 0), (2, 4)) f(file_no, region) ON n_regionkey = region GROUP BY file_no, region",
        "decision_overlay": f"""
            WITH j AS (SELECT event_id, base, code FROM events JOIN {_RULES} ON coalesce(nullif(nullif(event_type, 'error'), ''), '<default>') = k)
            SELECT event_id, 'url' AS key, base AS value FROM j UNION ALL SELECT event_id, 'key', code FROM j""",
        "settings_unpivot": """
            WITH t AS (SELECT *, CASE WHEN s_acctbal < 0 THEN 'debit' ELSE 'credit' END AS kind FROM supplier)
            SELECT s_suppkey, 'type' AS key, kind AS value FROM t UNION ALL SELECT s_suppkey, kind || '_name', s_name FROM t
            UNION ALL SELECT s_suppkey, kind || '_nation', s_nationkey::VARCHAR FROM t""",
        "fold_to_map": """
            WITH t AS (SELECT n_regionkey, substr(n_name, 1, 1) AS k, n_name AS v, row_number() OVER (PARTITION BY n_regionkey, substr(n_name, 1, 1) ORDER BY n_nationkey DESC) AS rn FROM nation),
            l AS (SELECT n_regionkey, k, v FROM t WHERE rn = 1),
            s AS (SELECT DISTINCT n_regionkey, x.k, x.v FROM nation, (VALUES ('A', 'seed'), ('_', 'none')) x(k, v)),
            u AS (SELECT * FROM l UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.n_regionkey = s.n_regionkey AND l.k = s.k))
            SELECT n_regionkey, string_agg(k || '=' || v, ',' ORDER BY k || '=' || v) AS entries, count(*) AS n FROM u GROUP BY n_regionkey""",
        "health_classify": """
            SELECT event_id, CASE WHEN event_type = 'error' OR value * 20 > 2000 THEN 'dead' WHEN event_type = 'view' THEN 'alive' WHEN event_type = 'purchase' THEN 'dead' END AS v1,
              CASE WHEN event_type = 'error' THEN 'dead' WHEN event_type IN ('view', 'click') THEN 'alive' WHEN event_type = 'purchase' THEN 'dead' END AS v2 FROM events""",
        "zip_positions": "SELECT vec_id, i::INTEGER AS pos, (i + 2)::INTEGER AS ui_row, embedding[i + 1]::DOUBLE AS a, embedding[i + 33]::DOUBLE AS b FROM embeddings, range(0, 32) r(i)",
        "coalesce_chain": "SELECT * FROM (SELECT event_id, coalesce(nullif(event_type, 'error'), CASE WHEN user_id % 2 = 0 THEN 'environment' END) AS p FROM events) WHERE p IS NOT NULL",
        "first_true_code": "SELECT event_id, CASE WHEN event_type = 'error' THEN 150 WHEN value > 150 THEN 151 WHEN user_id % 3 = 0 THEN 152 WHEN event_type = 'click' THEN 154 ELSE 0 END AS code FROM events",
        "reject_reason": """
            WITH f AS (SELECT event_id, event_type = 'error' AND event_id % 11 <> 0 AS prerender, user_id % 5 = 0 AND event_id % 13 <> 0 AS frame, value < 5 AND event_id % 17 <> 0 AS host,
              value < 10 AND event_id % 19 <> 0 AS file, user_id % 7 = 0 AND event_id % 23 <> 0 AS off, user_id % 2 = 0 AND event_id % 3 <> 0 AS may_frame, user_id % 3 = 0 AND event_id % 4 <> 0 AS may_local FROM events),
            t AS (SELECT event_id, CASE WHEN prerender THEN 'prerender' WHEN frame AND NOT may_frame THEN 'frame' WHEN host AND NOT may_local THEN 'localhost'
              WHEN file AND NOT may_local THEN 'localfile' WHEN off THEN 'disabled' END AS reason FROM f)
            SELECT event_id, reason, reason IS NULL AS counted FROM t""",
        "private_host": rf"SELECT page_id, {_HOSTS} AS host, regexp_matches({_HOSTS}, '(localhost$|^127\.|^10\.|^172\.(1[6-9]|2[0-9]|3[0-1])\.|^192\.168\.|^0\.0\.0\.0$)') AS private FROM pages",
        "query_string": f"SELECT event_id, {_QUERY} AS q FROM events",
        "query_param": f"SELECT page_id, {_param('utm_source')} AS source, {_param('page')} AS page FROM pages",
        "canonical_path": f"""
            WITH t AS (SELECT page_id, {_PATH.format("url")} AS own, coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/') AS p FROM pages)
            SELECT page_id, CASE page_id % 12 WHEN 1 THEN '/Capitals?x=1' WHEN 2 THEN '/port' WHEN 4 THEN '/root?x=1' WHEN 5 THEN regexp_replace(p, '[^/]*$', '') || 'beside?x=2'
              WHEN 6 THEN coalesce(nullif(regexp_extract(regexp_replace(p, '/[^/]*$', ''), '^(.*)/[^/]*$', 1), ''), '') || '/up/here' WHEN 7 THEN p || '?q=3'
              WHEN 9 THEN '/scheme' WHEN 10 THEN '?only=query' ELSE own END AS path, '/' AS root FROM t""",
        "json_allowlist": "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN json_extract_string(props, '$.k') END AS k, NULL::VARCHAR AS z FROM events",
        "bind_once": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1",
        "first_visible": "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'view') WHERE rn = 1",
        "toggle_parity": "SELECT user_id, count(*) FILTER (event_type = 'click') % 2 = 1 AS flag FROM events GROUP BY user_id",
        "ring_area": f"""
            WITH t AS (SELECT vec_id, {_RING} AS r FROM embeddings)
            SELECT vec_id, round(abs(list_sum(list_transform(range(1, len(r) + 1), lambda i: r[i][1] * r[i % len(r) + 1][2] - r[i % len(r) + 1][1] * r[i][2]))) / 2, 6) AS area, len(r)::INTEGER AS points FROM t""",
        "ring_bbox": f"""
            WITH t AS (SELECT vec_id, {_RING} AS r FROM embeddings), u AS (SELECT vec_id, list_transform(r, lambda p: p[1]) AS x, list_transform(r, lambda p: p[2]) AS y FROM t)
            SELECT vec_id, list_min(x) AS min_x, list_min(y) AS min_y, list_max(x) AS max_x, list_max(y) AS max_y FROM u""",
        "axis_swap": """
            SELECT vec_id, CASE WHEN label % 2 = 0 THEN embedding[2] ELSE embedding[1] END::DOUBLE AS x0, CASE WHEN label % 2 = 0 THEN embedding[1] ELSE embedding[2] END::DOUBLE AS y0,
              CASE WHEN label % 2 = 0 THEN embedding[len(embedding)] ELSE embedding[len(embedding) - 1] END::DOUBLE AS x_last FROM embeddings""",
        "point_check": "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size END AS n, CASE WHEN p_size % 2 = 0 THEN 50 END AS m, CASE WHEN p_size % 2 = 0 THEN TRUE END AS agrees FROM part",
        "circle_radius": "SELECT p_partkey, round(sqrt(p_retailprice * 1000 / pi()), 6) AS radius FROM part",
        "unit_convert": "SELECT p_partkey, round(p_retailprice * 100, 2) AS ha, round(p_retailprice * 1000, 1) AS dka FROM part",
        "range_expand": """
            SELECT name, low, high, count(*) AS n, sum(p_size)::BIGINT AS total
            FROM part JOIN (VALUES ('low', 1, 7), ('mid', 5, 20), ('one', 20, 20), ('wide', 13, 49), ('far', 48, 4000), ('below', 0, 2)) r(name, low, high) ON p_size BETWEEN low AND high GROUP BY ALL""",
        "range_tiling": """
            WITH r AS (SELECT o_custkey, o_orderkey % 1000 AS low, o_orderkey % 1000 + o_custkey % 40 - 3 AS high FROM orders),
            s AS (SELECT *, max(high) OVER (PARTITION BY o_custkey ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r WHERE low <= high)
            SELECT o_custkey, sum(high - low + 1)::BIGINT AS points, min(low) AS first, max(high) AS last, count(*) FILTER (low > reach + 1) AS gaps, count(*) FILTER (low <= reach) AS overlaps FROM s GROUP BY o_custkey""",
        "range_tiles": """
            WITH r AS (SELECT vendor_id % 90 + 1 AS lo, vendor_id % 90 + vendor_id % 37 - 1 AS hi FROM vendors)
            SELECT p::INTEGER AS point, count(*) AS covers FROM r JOIN range(1, 200) t(p) ON p BETWEEN lo AND hi GROUP BY p""",
        "interval_coverage": """
            WITH i AS (SELECT client_id, datediff('day', DATE '2024-01-01', sold_at::DATE) AS low, datediff('day', DATE '2024-01-01', sold_at::DATE) + priority * 2 - 3 AS high FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
            s AS (SELECT *, max(high) OVER (PARTITION BY client_id ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i WHERE low <= high),
            n AS (SELECT *, count(*) FILTER (reach IS NULL OR low > reach + 1) OVER (PARTITION BY client_id ORDER BY low, high ROWS UNBOUNDED PRECEDING) AS no FROM s),
            m AS (SELECT client_id, no, min(low) AS low, max(high) AS high FROM n GROUP BY client_id, no)
            SELECT client_id, TRUE AS covered, low, high FROM m
            UNION ALL SELECT client_id, FALSE, high + 1, next - 1 FROM (SELECT *, lead(low) OVER (PARTITION BY client_id ORDER BY no) AS next FROM m) WHERE next IS NOT NULL""",
        "id_split": "WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS s FROM part) SELECT p_partkey, (unnest(range(1, len(s) + 1)) - 1)::INTEGER AS part_no, unnest(s) AS part FROM t",
        "orphans": f"SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM ({_URGENT}) u WHERE u.c_custkey = c.c_custkey)",
        "childless": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "parent_child": "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "secondary_match": """
            SELECT c_nationkey AS nation, count(*) AS n FROM customer JOIN supplier ON nullif(c_nationkey, 3) = nullif(s_nationkey, 3)
              AND floor(c_acctbal)::BIGINT % 50 = floor(s_acctbal)::BIGINT % 50 GROUP BY c_nationkey""",
        "reconcile": """
            WITH d AS (SELECT doc_id, (length(text) > 200)::INTEGER AS quality, 0 AS toxic FROM documents)
            SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left' WHEN d.doc_id IS NULL THEN 'right' ELSE 'both' END AS side,
              d.quality IS NOT DISTINCT FROM l.quality AS same_quality, d.toxic IS NOT DISTINCT FROM l.toxic AS same_toxic FROM d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id""",
        "authority_override": """
            WITH t AS (SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS o, round(p_retailprice * 1.5::DOUBLE, 2) AS q FROM part)
            SELECT p_partkey, round(coalesce(o, q), 2) AS area, round((q - o) / o * 100, 4) AS deviation FROM t""",
        "publish_gate": "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'published' ELSE 'pending' END AS route FROM part",
        "status_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
        "layer_union": """
            SELECT c_custkey AS id, c_mktsegment AS class, c_acctbal AS area, 'customer' AS layer FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
            UNION ALL SELECT s_suppkey, 'BUILDING', NULL, 'supplier' FROM supplier WHERE s_nationkey < 12""",
        "curated_overlay": """
            WITH r AS (SELECT p_brand AS osm_type, p_partkey AS osm_id, 'feature' AS origin FROM part), x AS (SELECT osm_type, osm_id + a AS osm_id FROM r, (VALUES (0), (10000000)) v(a) WHERE osm_id % 5 = 0)
            SELECT osm_type, osm_id, CASE WHEN osm_id % 5 = 0 AND osm_id % 3 <> 0 THEN 'early' ELSE origin END AS origin FROM r
            UNION ALL SELECT osm_type, osm_id, 'early' FROM x WHERE osm_id % 3 <> 0 AND osm_id >= 10000000
            UNION ALL SELECT osm_type, NULL, o FROM x, (VALUES ('early'), ('late')) w(o) WHERE osm_id % 3 = 0""",
        "month_key": "SELECT 'gis-' || strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY ALL",
        "month_evict": "SELECT o_orderkey, 'gis-1998-03' AS month FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-03'",
        "throttle_first": """
            WITH t AS (SELECT user_id, epoch_ms(ts) // 86400000 AS bucket, event_id, row_number() OVER (PARTITION BY user_id, epoch_ms(ts) // 86400000 ORDER BY ts, event_id) AS rn FROM events)
            SELECT user_id, bucket, event_id FROM t WHERE rn = 1""",
        "truthy_fallback": """
            SELECT doc_id, doc_id % 6 IN (0, 1, 4) AS truthy, coalesce(nullif(lang, 'en'), substr(text, 1, 200), '') AS title FROM documents""",
        "enum_dispatch": "SELECT * FROM (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'img' WHEN 'assistant' THEN 'iframe' END AS tag FROM conversations) WHERE tag IS NOT NULL",
        "url_builder": f"""
            SELECT conv_id, turn, 'https://a.example/counter/' || {enc("'/a b/' || role")} || '.' || CASE WHEN turn > 2 THEN 'png' ELSE 'html' END || '?' || CASE WHEN turn = 0 THEN '&no_branding=1' ELSE '' END
              || CASE WHEN turn = 1 THEN '&style=a%26b%3Dc' ELSE '' END || CASE WHEN role <> 'user' THEN '&start=' || role ELSE '' END AS url FROM conversations""",
        "endpoint_url": """
            SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN '' ELSE 'https://' END || 'h' || s_suppkey % 5 || '.example' || CASE
                WHEN s_acctbal < 0 THEN '/api/v1/health?apikey=' || CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END
                ELSE '/api/v2.0/indexers/status:healthy/results?apikey=' || CASE WHEN s_suppkey % 5 = 2 THEN '2' WHEN s_nationkey % 3 = 0 AND s_suppkey % 4 <> 0 THEN s_name ELSE '' END
              END AS url FROM supplier""",
        "clamp_progress": """
            WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN event_id % 200 * 0.75::DOUBLE ELSE value END / 150 * 100 AS p FROM events)
            SELECT event_id, CASE WHEN p > 100 THEN 100 ELSE floor(p + 0.5) END::INTEGER AS percent, CASE WHEN p > 100 THEN 0 ELSE floor(100 - p + 0.5) END::INTEGER AS left FROM t""",
        "append_positions": """
            WITH s AS (SELECT DISTINCT sale_id, arrived_at, priority FROM sales WHERE sale_id IS NOT NULL),
            l AS (SELECT sale_id, row_number() OVER (ORDER BY arrived_at NULLS FIRST, sale_id) - 1 AS pos FROM s WHERE priority <= 2)
            SELECT sale_id, pos, 0 AS status FROM l
            UNION ALL SELECT sale_id, (SELECT coalesce(max(pos), -1) FROM l) + row_number() OVER (ORDER BY arrived_at NULLS FIRST, sale_id), 1 FROM s WHERE priority > 2""",
        "move_positions": """
            WITH l AS (SELECT item_id, kind, brand, row_number() OVER (ORDER BY item_id NULLS FIRST, kind NULLS FIRST, brand NULLS FIRST) - 1 AS pos FROM (SELECT DISTINCT item_id, kind, brand FROM items))
            SELECT item_id, kind, brand, row_number() OVER (ORDER BY CASE WHEN kind IN ('home', 'tools') THEN 39.5 ELSE pos END, pos) - 1 AS pos FROM l""",
        "oplog_replay": """
            WITH l AS (SELECT DISTINCT coalesce(source, '-') AS source, change_id, client_id % 500 AS entry,
              CASE WHEN change_id % 41 = 0 THEN 'restart' WHEN op = 'D' THEN 'delete' WHEN op = 'U' AND change_id % 3 = 0 THEN 'disable' ELSE 'append' END AS op FROM client_changes),
            b AS (SELECT *, coalesce(max(change_id) FILTER (op = 'delete') OVER w > coalesce(max(change_id) FILTER (op = 'restart') OVER w, -1), FALSE) AS barred FROM l
              WINDOW w AS (PARTITION BY source ORDER BY change_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            k AS (SELECT *, coalesce(max(change_id) FILTER (op = 'delete') OVER (PARTITION BY source, entry), -1) AS gone FROM b WHERE entry IS NOT NULL),
            a AS (SELECT source, entry, min(change_id) FILTER (op = 'append' AND NOT barred) AS added, max(change_id) FILTER (op = 'disable') AS off FROM k WHERE change_id > gone GROUP BY source, entry)
            SELECT source, entry, row_number() OVER (PARTITION BY source ORDER BY added) - 1 AS pos, CASE WHEN off > added THEN 0 ELSE 1 END AS status FROM a WHERE added IS NOT NULL""",
        "store_versions": "SELECT client_id, count(*) * 10 AS n FROM sales GROUP BY client_id HAVING count(*) > 1",
        "month_cache": """
            SELECT sale_id, strftime(sold_at, '%Y-%m') AS month, CASE WHEN month(sold_at) = 4 THEN 1.0 ELSE total END::DOUBLE AS total FROM sales
            WHERE sold_at >= TIMESTAMP '2024-03-01' AND sold_at < TIMESTAMP '2024-05-01' AND (month(sold_at) = 3 OR sale_id % 2 = 0)""",
        "json_unified": "SELECT vendor_id AS parent_id, balance AS area, CASE WHEN vendor_id % 2 = 0 THEN '[' || name ELSE array_to_string(list_filter([name, 'map'], lambda x: x IS NOT NULL), ',') END AS evidence FROM vendors WHERE vendor_id IS NOT NULL",
        "lookup_quarantine": """
            WITH c AS (SELECT CASE kind WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' END AS base, CASE WHEN kind NOT IN ('view', 'click') OR kind IS NULL THEN 'no rule' WHEN NOT json_valid(props) THEN 'bad json' WHEN ts IS NULL THEN 'no time' END AS reason FROM clicks)
            SELECT 'good' AS route, base AS what, count(*) AS n FROM c WHERE reason IS NULL GROUP BY base
            UNION ALL SELECT 'bad', reason, count(*) FROM c WHERE reason IS NOT NULL GROUP BY reason
            UNION ALL SELECT 'counted', w, CASE w WHEN 'rows' THEN (SELECT count(*) FROM c) ELSE (SELECT count(*) FROM c WHERE reason = w) END FROM (VALUES ('rows'), ('no rule'), ('bad json'), ('no time')) v(w)""",
        "additive_summary": "SELECT vendor_id, sum(quantity)::BIGINT AS quantity, max(discount) AS discount FROM sale_lines WHERE quantity > 0 AND vendor_id IN (SELECT vendor_id FROM vendors) GROUP BY vendor_id",
        "suffix_key": """
            WITH h AS (SELECT click_id, ('0x' || substr(md5('a|' || coalesce(click_id::VARCHAR, '') || '|' || coalesce(kind, '')), 1, 12))::BIGINT AS v FROM clicks)
            SELECT click_id, coalesce(nullif(ltrim(array_to_string(list_transform(range(9, -1, -1), lambda i: substr('0123456789abcdefghijklmnopqrstuvwxyz', ((v // (36 ** i)::BIGINT) % 36 + 1)::INTEGER, 1)), ''), '0'), ''), '0') AS rnd FROM h""",
        "dictionary_lookup": """
            SELECT doc_id, d.lang, CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'bg' END AS locale, t.label FROM documents d
            LEFT JOIN (VALUES ('en', 'en', 'English'), ('en', 'bg', 'Английски'), ('de', 'en', 'German'), ('fr', 'bg', 'Френски')) t(lang, locale, label)
              ON d.lang = t.lang AND t.locale = CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'bg' END""",
        "provenance": "SELECT doc_id, source, CASE source WHEN 'src0' THEN 'register' ELSE 'map' END AS kind FROM documents WHERE source IN ('src0', 'src1')",
        "reorder": "SELECT n_nationkey, n_name, CASE WHEN n_name IN ('NATION_3', 'NATION_17') THEN 10.5 ELSE n_nationkey END::DOUBLE AS sort_key FROM nation",
        "guarded_drop": """
            SELECT n_nationkey, 'n' || n_nationkey AS label, TRUE AS marked FROM nation WHERE NOT (n_nationkey IN (1, 2, 3, 4) AND EXISTS (SELECT 1 FROM nation WHERE n_nationkey = 20))
            UNION ALL SELECT n_nationkey, 'n' || n_nationkey, FALSE FROM nation""",
        "route_live": "SELECT event_id, CASE WHEN event_type = 'view' THEN 'live' ELSE 'cached' END AS route FROM events",
    }
