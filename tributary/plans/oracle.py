"""Independent DuckDB SQL for every registered query (the correctness oracle).

The adapter views follow FIXTURES.md §2.  The oracle is written the obvious way
(per-visitor window functions, COUNT DISTINCT, joins with BETWEEN) and shares no code
with the Spark side, which is written for scale instead.
"""

from __future__ import annotations

from tributary.functions.timefmt import duration_ms
from tributary.plans.warehouse import QUERY_AS_OF, QUERY_WINDOW, QUERY_WITHIN

S = duration_ms(QUERY_WINDOW)      # tumbling window, ms
W = duration_ms(QUERY_WITHIN)      # bounce pattern window, ms
TS_FMT = "'%Y-%m-%d %H:%M:%S'"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_log": ((), """
SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, 'mid_' || user_id AS mid,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_id % 3 = 0 THEN '1' ELSE '0' END AS is_new,
       'v' || (user_id % 3) AS vc, 'ch' || (user_id % 4) AS ch, 'ar' || (user_id % 5) AS ar,
       CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN '' WHEN 'view' THEN 'search'
                       WHEN 'click' THEN 'good_list' ELSE 'cart' END AS last_page_id,
       CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'good_list'
                       WHEN 'purchase' THEN 'trade' ELSE 'home' END AS page_id,
       CASE event_type WHEN 'click' THEN 'sku_id' WHEN 'view' THEN 'keyword' END AS item_type,
       CAST(round(value * 1000) AS BIGINT) AS during_time,
       event_id % 50 = 0 AS is_dirty, event_id % 50 <> 0 AND event_id % 11 = 1 AS is_start,
       event_type
FROM events"""),
    "log_fixed": (("raw_log",), """
SELECT event_id, ts_ms, mid, k, vc, ch, ar, last_page_id, page_id, item_type, during_time,
       is_start, event_type,
       CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new
                                                   ORDER BY ts_ms, event_id) > 1
            THEN '0' ELSE is_new END AS is_new
FROM raw_log WHERE NOT is_dirty"""),
    "page_log": (("log_fixed",), """
SELECT r.*, CASE r.event_type WHEN 'click' THEN CAST(r.k AS VARCHAR)
                 WHEN 'view' THEN CASE WHEN r.k % 7 = 0 THEN NULL ELSE p.p_name END END AS item,
       CAST(CASE WHEN r.event_type IN ('click', 'view') THEN r.k % 4 ELSE 0 END AS INTEGER) AS n_displays
FROM log_fixed r LEFT JOIN part p ON p.p_partkey = r.k
WHERE NOT r.is_start"""),
    "display_log": (("page_log",), """
SELECT event_id, ts_ms, page_id, k + i AS sku, CAST(k + i AS VARCHAR) AS item,
       CASE WHEN i % 2 = 0 THEN 'sku_id' ELSE 'activity_id' END AS item_type
FROM (SELECT *, unnest(range(n_displays)) AS i FROM page_log WHERE n_displays > 0)"""),
    "uv": (("page_log",), """
SELECT * FROM (
  SELECT *, strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS visit_day,
         row_number() OVER (PARTITION BY mid, strftime(epoch_ms(ts_ms), '%Y-%m-%d')
                            ORDER BY ts_ms, event_id) AS rn
  FROM page_log WHERE last_page_id IS NULL OR last_page_id = '') WHERE rn = 1"""),
    "bounce": (("page_log",), f"""
SELECT * FROM (
  SELECT *, (last_page_id IS NULL OR last_page_id = '') AS entry,
         lead(ts_ms) OVER w AS next_ts,
         lead(last_page_id IS NULL OR last_page_id = '') OVER w AS next_entry
  FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts_ms, event_id))
WHERE entry AND (next_ts IS NULL OR next_ts - ts_ms >= {W} OR next_entry)"""),
    "vev": (("uv", "bounce", "page_log"), """
SELECT vc, ch, ar, is_new, CAST(1 AS BIGINT) AS uv_ct, CAST(0 AS BIGINT) AS pv_ct,
       CAST(0 AS BIGINT) AS sv_ct, CAST(0 AS BIGINT) AS uj_ct, CAST(0 AS BIGINT) AS dur_sum,
       ts_ms AS ts FROM uv
UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts_ms FROM bounce
UNION ALL SELECT vc, ch, ar, is_new, 0, 1,
       CASE WHEN last_page_id IS NULL OR last_page_id = '' THEN 1 ELSE 0 END, 0,
       coalesce(during_time, 0), ts_ms FROM page_log"""),
    "vst": (("vev",), f"""
SELECT strftime(epoch_ms(ws), {TS_FMT}) AS stt, strftime(epoch_ms(ws + {S}), {TS_FMT}) AS edt,
       vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
       CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
       CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM (SELECT *, ts - ts % {S} AS ws FROM vev) GROUP BY ws, vc, ch, ar, is_new"""),
    "order_info": ((), """
SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id, o_custkey AS user_id,
       o_orderstatus AS order_status, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
       epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000 + 123 AS create_ms
FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "order_detail": ((), """
SELECT l_orderkey * 100 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
       CAST(l_quantity AS BIGINT) AS sku_num, CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS split_total_amount,
       epoch_ms(o_orderdate) + (o_orderkey % 86400 + l_partkey % 13 - 6) * 1000 AS create_ms
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "ow_base": (("order_info", "order_detail"), f"""
SELECT d.id AS detail_id, i.id AS order_id, d.sku_id, d.order_price, d.sku_num, i.province_id,
       i.order_status, i.user_id, i.total_amount, d.split_total_amount,
       CAST(i.create_ms AS VARCHAR) AS create_time, i.create_ms,
       strftime(epoch_ms(i.create_ms // 1000 * 1000), '%Y-%m-%d') AS create_date,
       strftime(epoch_ms(i.create_ms // 1000 * 1000), '%H') AS create_hour
FROM order_info i JOIN order_detail d
  ON i.id = d.order_id AND d.create_ms // 1000 BETWEEN i.create_ms // 1000 - 5 AND i.create_ms // 1000 + 5"""),
    "payment_info": ((), """
SELECT o_orderkey + 1000000 AS id, o_orderkey AS order_id, o_custkey AS user_id,
       CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, '110' || (o_orderkey % 3 + 1) AS payment_type,
       epoch_ms(o_orderdate) + (o_orderkey % 86400 + o_orderkey % 1001) * 1000 AS create_ms
FROM orders WHERE o_orderstatus = 'F'"""),
    "pw": (("payment_info", "ow_base"), """
SELECT p.id AS payment_id, p.payment_type, CAST(p.create_ms AS VARCHAR) AS payment_create_time,
       ow.create_time AS order_create_time, ow.detail_id, p.order_id, ow.sku_id, ow.order_price,
       p.user_id, p.total_amount, ow.province_id, ow.order_status, p.create_ms AS pay_ms
FROM payment_info p JOIN ow_base ow
  ON p.order_id = ow.order_id AND ow.create_ms BETWEEN p.create_ms - 900000 AND p.create_ms + 5000"""),
    "dim_user_info": ((), """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CAST(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS VARCHAR) AS birthday
FROM customer WHERE c_custkey % 97 <> 0"""),
    "dim_base_province": ((), """
SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, r_name AS area_code,
       'N-' || n_nationkey AS iso_code, 'NN-' || n_nationkey AS iso_3166_2
FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "dim_sku_info": ((), """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name,
       CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS price,
       CAST(p_size AS VARCHAR) AS category3_id, CAST(p_partkey // 10 AS VARCHAR) AS spu_id,
       replace(p_brand, 'Brand#', '') AS tm_id
FROM part"""),
    "dim_spu_info": ((), """
SELECT CAST(p_partkey // 10 AS VARCHAR) AS id, 'spu_' || (p_partkey // 10) AS spu_name
FROM part GROUP BY p_partkey // 10"""),
    "dim_base_trademark": ((), """
SELECT DISTINCT replace(p_brand, 'Brand#', '') AS id, p_brand AS tm_name FROM part"""),
    "dim_base_category3": ((), """
SELECT DISTINCT CAST(p_size AS VARCHAR) AS id, 'category_' || p_size AS name FROM part"""),
    "ow_full": (("ow_base", "dim_user_info", "dim_base_province", "dim_sku_info", "dim_spu_info",
                 "dim_base_trademark", "dim_base_category3"), f"""
SELECT ow.detail_id, ow.order_id, ow.sku_id, s.sku_name, ow.order_price, ow.sku_num,
       ow.province_id, ow.order_status, ow.user_id, ow.total_amount, ow.split_total_amount,
       ow.create_time, ow.create_date, ow.create_hour, pr.name AS province_name,
       pr.area_code AS province_area_code, pr.iso_code AS province_iso_code,
       pr.iso_3166_2 AS province_3166_2_code,
       CAST(floor((epoch_ms(TIMESTAMP '{QUERY_AS_OF}') - epoch_ms(CAST(u.birthday AS TIMESTAMP)))
                  / 31536000000.0) AS INTEGER) AS user_age,
       u.gender AS user_gender, TRY_CAST(s.spu_id AS BIGINT) AS spu_id,
       TRY_CAST(s.tm_id AS BIGINT) AS tm_id, TRY_CAST(s.category3_id AS BIGINT) AS category3_id,
       spu.spu_name, tm.tm_name, c3.name AS category3_name
FROM ow_base ow
LEFT JOIN dim_user_info u ON u.id = CAST(ow.user_id AS VARCHAR)
LEFT JOIN dim_base_province pr ON pr.id = CAST(ow.province_id AS VARCHAR)
LEFT JOIN dim_sku_info s ON s.id = CAST(ow.sku_id AS VARCHAR)
LEFT JOIN dim_spu_info spu ON spu.id = CAST(TRY_CAST(s.spu_id AS BIGINT) AS VARCHAR)
LEFT JOIN dim_base_trademark tm ON tm.id = CAST(TRY_CAST(s.tm_id AS BIGINT) AS VARCHAR)
LEFT JOIN dim_base_category3 c3 ON c3.id = CAST(TRY_CAST(s.category3_id AS BIGINT) AS VARCHAR)"""),
    "pev": (("page_log", "display_log", "raw_log", "ow_base", "pw", "order_detail"), """
SELECT CAST(item AS BIGINT) AS sku_id, ts_ms AS ts, CAST(0 AS BIGINT) AS display_ct,
       CAST(1 AS BIGINT) AS click_ct, CAST(0 AS BIGINT) AS favor_ct, CAST(0 AS BIGINT) AS cart_ct,
       CAST(0 AS BIGINT) AS order_sku_num, CAST(0 AS DECIMAL(16,2)) AS order_amount,
       CAST(NULL AS BIGINT) AS order_id, CAST(0 AS DECIMAL(16,2)) AS payment_amount,
       CAST(NULL AS BIGINT) AS paid_order_id, CAST(0 AS DECIMAL(18,4)) AS refund_amount,
       CAST(NULL AS BIGINT) AS refund_order_id, CAST(0 AS BIGINT) AS comment_ct,
       CAST(0 AS BIGINT) AS good_comment_ct
FROM page_log WHERE page_id = 'good_detail' AND item_type = 'sku_id'
UNION ALL SELECT sku, ts_ms, 1, 0, 0, 0, 0, 0, NULL, 0, NULL, 0, NULL, 0, 0
FROM display_log WHERE item_type = 'sku_id'
UNION ALL SELECT k, ts_ms, 0, 0, 1, 0, 0, 0, NULL, 0, NULL, 0, NULL, 0, 0
FROM raw_log WHERE event_type = 'view'
UNION ALL SELECT k, ts_ms, 0, 0, 0, 1, 0, 0, NULL, 0, NULL, 0, NULL, 0, 0
FROM raw_log WHERE event_type = 'purchase'
UNION ALL SELECT sku_id, create_ms, 0, 0, 0, 0, sku_num, order_price, order_id, 0, NULL, 0, NULL, 0, 0
FROM ow_base
UNION ALL SELECT sku_id, pay_ms, 0, 0, 0, 0, 0, 0, NULL, order_price, order_id, 0, NULL, 0, 0
FROM pw
UNION ALL SELECT sku_id, create_ms, 0, 0, 0, 0, 0, 0, NULL, 0, NULL, split_total_amount, order_id, 0, 0
FROM order_detail WHERE sku_num % 5 = 0
UNION ALL SELECT k, ts_ms, 0, 0, 0, 0, 0, 0, NULL, 0, NULL, 0, NULL, 1,
       CASE WHEN '120' || (event_id % 4 + 1) = '1201' THEN 1 ELSE 0 END
FROM raw_log WHERE event_type = 'signup'"""),
    "st": (("page_log",), """
SELECT event_id, item AS full_word, ts_ms FROM page_log
WHERE last_page_id = 'search' AND item IS NOT NULL"""),
    "kw": (("st",), """
SELECT event_id, ts_ms, unnest(regexp_extract_all(lower(full_word), '[a-z0-9]+')) AS word FROM st"""),
    "changes": ((), """
SELECT c_custkey * 3 AS seq, 'user_info' AS table_name, 'insert' AS type, c_custkey AS id,
       c_name AS name, c_mktsegment AS segment,
       CAST(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS VARCHAR) AS birthday,
       CAST(NULL AS VARCHAR) AS b_name, CAST(NULL AS VARCHAR) AS b_segment FROM customer
UNION ALL SELECT c_custkey * 3 + 1, 'user_info', 'update', c_custkey, NULL, 'S' || c_nationkey,
       NULL, c_name, c_mktsegment FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey * 3 + 2, 'user_info', 'delete', c_custkey, NULL, NULL, NULL, c_name,
       CASE WHEN c_custkey % 3 = 0 THEN 'S' || c_nationkey ELSE c_mktsegment END
FROM customer WHERE c_custkey % 11 = 0
UNION ALL SELECT o_orderkey * 3, 'order_info', 'insert', o_orderkey, o_orderstatus, o_orderpriority,
       NULL, NULL, NULL FROM orders"""),
    "rules": ((), """
SELECT * FROM (VALUES ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name,segment'),
                      ('user_info', 'update', 'hbase', 'dim_user_info', 'id,segment'),
                      ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id, name'))
  AS t(source_table, operate_type, sink_type, sink_table, sink_columns)"""),
    "rule_versions": ((), """
SELECT *, lead(rule_seq) OVER (PARTITION BY source_table, operate_type ORDER BY rule_seq) AS valid_to
FROM (VALUES (0, 'user_info', 'insert', 'hbase', 'dim_user_info', 'id,name,segment'),
             (0, 'order_info', 'insert', 'kafka', 'dwd_order_info', 'id, name'),
             (0, 'user_info', 'read', 'clickhouse', 'ck_user_info', 'id'),
             (1500, 'user_info', 'update', 'hbase', 'dim_user_info', 'id,segment'),
             (3000, 'user_info', 'insert', 'hbase', 'dim_user_info', 'id,name'),
             (20000, 'order_info', 'insert', 'kafka', 'dwd_order_info', 'id,name,segment'))
  AS t(rule_seq, source_table, operate_type, sink_type, sink_table, sink_columns)"""),
    "routed": (("changes", "rules"), """
SELECT c.*, r.sink_type, r.sink_table, r.sink_columns, string_split(r.sink_columns, ',') AS cols
FROM changes c JOIN rules r ON c.table_name = r.source_table AND c.type = r.operate_type
WHERE c.type <> 'delete'"""),
    "routed_v": (("changes", "rule_versions"), """
SELECT c.*, r.rule_seq, r.sink_type, r.sink_table, r.sink_columns,
       string_split(r.sink_columns, ',') AS cols
FROM changes c JOIN rule_versions r
  ON c.table_name = r.source_table AND c.type = r.operate_type AND r.rule_seq < c.seq
 AND (r.valid_to IS NULL OR c.seq <= r.valid_to)
WHERE c.type <> 'delete'"""),
}

KEPT_KEYS = """concat_ws(',',
    CASE WHEN birthday IS NOT NULL AND list_contains(cols, 'birthday') THEN 'birthday' END,
    CASE WHEN list_contains(cols, 'id') THEN 'id' END,
    CASE WHEN name IS NOT NULL AND list_contains(cols, 'name') THEN 'name' END,
    CASE WHEN segment IS NOT NULL AND list_contains(cols, 'segment') THEN 'segment' END) AS kept_keys"""


def _window_text(ws: str) -> str:
    return (f"strftime(epoch_ms({ws}), {TS_FMT}) AS stt, "
            f"strftime(epoch_ms({ws} + {S}), {TS_FMT}) AS edt")


BODIES: dict[str, tuple[tuple[str, ...], str]] = {
    "log_valid": (("raw_log",), """
SELECT event_id AS "offset", mid, is_new, ts_ms AS ts FROM raw_log WHERE NOT is_dirty"""),
    "log_dirty": (("raw_log",), """
SELECT event_id AS "offset", 'malformed' AS dirty_reason FROM raw_log WHERE is_dirty"""),
    "log_start": (("log_fixed",), """
SELECT event_id AS "offset", mid, is_new, ts_ms AS ts, 'icon' AS start_entry,
       during_time AS loading_time FROM log_fixed WHERE is_start"""),
    "log_page": (("page_log",), """
SELECT event_id AS "offset", mid, is_new, vc, ch, ar, page_id, last_page_id, item, item_type,
       during_time, n_displays, ts_ms AS ts FROM page_log"""),
    "log_display": (("display_log",), """
SELECT event_id AS "offset", page_id, item, item_type FROM display_log"""),
    "visitor_new_flag": (("log_fixed",), """
SELECT event_id AS "offset", mid, is_new FROM log_fixed"""),
    "unique_visit": (("uv",), """
SELECT event_id AS "offset", mid, visit_day, ts_ms AS ts FROM uv"""),
    "bounce_detail": (("bounce",), """
SELECT event_id AS "offset", mid, ts_ms AS ts FROM bounce"""),
    "visitor_events": (("vev",), "SELECT * FROM vev"),
    "visitor_stats": (("vst",), "SELECT * FROM vst"),
    "daily_active": (("vst",), """
SELECT substr(stt, 1, 10) AS day, CAST(sum(uv_ct) AS BIGINT) AS dau FROM vst GROUP BY 1"""),
    "bounce_rate": (("vst",), """
SELECT day, sv_ct, uj_ct,
       CASE WHEN sv_ct = 0 THEN NULL ELSE CAST(uj_ct AS DOUBLE) / CAST(sv_ct AS DOUBLE) END AS bounce_rate
FROM (SELECT substr(stt, 1, 10) AS day, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
             CAST(sum(uj_ct) AS BIGINT) AS uj_ct FROM vst GROUP BY 1)"""),
    "order_times": (("order_info",), """
SELECT id, strftime(epoch_ms(create_ms // 1000 * 1000), '%Y-%m-%d') AS create_date,
       strftime(epoch_ms(create_ms // 1000 * 1000), '%H') AS create_hour,
       create_ms // 1000 * 1000 AS create_ts FROM order_info"""),
    "time_errors": (("order_info",), """
SELECT id, user_id, CASE WHEN id % 100 <> 0 THEN 'at ' || CAST(create_ms AS VARCHAR) END AS create_time
FROM order_info WHERE id % 50 = 0"""),
    "order_wide_base": (("ow_base",), """
SELECT detail_id, order_id, sku_id, order_price, sku_num, province_id, order_status, user_id,
       total_amount, split_total_amount, create_time, create_date, create_hour FROM ow_base"""),
    "dim_user": (("ow_full",), "SELECT detail_id, user_id, user_gender, user_age FROM ow_full"),
    "dim_province": (("ow_full",), """
SELECT detail_id, province_id, province_name, province_area_code, province_iso_code,
       province_3166_2_code FROM ow_full"""),
    "dim_sku": (("ow_full",), """
SELECT detail_id, sku_id, sku_name, category3_id, spu_id, tm_id FROM ow_full"""),
    "order_wide": (("ow_full",), "SELECT * FROM ow_full"),
    "dim_join": (("ow_base", "dim_user_info"), """
SELECT ow.detail_id, ow.user_id, u.gender AS user_gender
FROM ow_base ow JOIN dim_user_info u ON u.id = CAST(ow.user_id AS VARCHAR)"""),
    "order_wide_merge": (("ow_base",), """
SELECT detail_id, order_id, sku_id, order_price, sku_num, province_id, order_status, user_id,
       total_amount, split_total_amount, create_time, create_date, create_hour FROM ow_base"""),
    "payment_wide": (("pw",), """
SELECT payment_id, payment_type, payment_create_time, order_create_time, detail_id, order_id,
       sku_id, order_price, user_id, total_amount, province_id, order_status FROM pw"""),
    "province_stats": (("ow_base", "dim_base_province"), f"""
SELECT {_window_text('ws')}, province_id, province_name, province_area_code, province_iso_code,
       province_3166_2_code, CAST(sum(total_amount) AS DECIMAL(38,2)) AS order_amount,
       CAST(count(DISTINCT order_id) AS BIGINT) AS order_count
FROM (SELECT ow.*, pr.name AS province_name, pr.area_code AS province_area_code,
             pr.iso_code AS province_iso_code, pr.iso_3166_2 AS province_3166_2_code,
             ow.create_ms - ow.create_ms % {S} AS ws
      FROM ow_base ow LEFT JOIN dim_base_province pr ON pr.id = CAST(ow.province_id AS VARCHAR))
GROUP BY ws, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code"""),
    "product_clicks": (("page_log",), """
SELECT CAST(item AS BIGINT) AS sku_id, ts_ms AS ts FROM page_log
WHERE page_id = 'good_detail' AND item_type = 'sku_id'"""),
    "product_displays": (("display_log",), """
SELECT sku AS sku_id, ts_ms AS ts FROM display_log WHERE item_type = 'sku_id'"""),
    "product_events": (("pev",), "SELECT * FROM pev"),
    "product_stats": (("pev", "dim_sku_info", "dim_spu_info", "dim_base_trademark",
                       "dim_base_category3"), f"""
SELECT {_window_text('p.ws')}, p.sku_id, s.sku_name, CAST(s.price AS DECIMAL(16,2)) AS sku_price,
       TRY_CAST(s.spu_id AS BIGINT) AS spu_id, spu.spu_name, TRY_CAST(s.tm_id AS BIGINT) AS tm_id,
       tm.tm_name, TRY_CAST(s.category3_id AS BIGINT) AS category3_id, c3.name AS category3_name,
       p.display_ct, p.click_ct, p.favor_ct, p.cart_ct, p.order_sku_num, p.order_amount, p.order_ct,
       p.payment_amount, p.paid_order_ct, p.refund_order_ct, p.refund_amount, p.comment_ct,
       p.good_comment_ct, p.ts
FROM (SELECT ws, sku_id, CAST(sum(display_ct) AS BIGINT) AS display_ct,
             CAST(sum(click_ct) AS BIGINT) AS click_ct, CAST(sum(favor_ct) AS BIGINT) AS favor_ct,
             CAST(sum(cart_ct) AS BIGINT) AS cart_ct, CAST(sum(order_sku_num) AS BIGINT) AS order_sku_num,
             CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount,
             CAST(count(DISTINCT order_id) AS BIGINT) AS order_ct,
             CAST(sum(payment_amount) AS DECIMAL(38,2)) AS payment_amount,
             CAST(count(DISTINCT paid_order_id) AS BIGINT) AS paid_order_ct,
             CAST(count(DISTINCT refund_order_id) AS BIGINT) AS refund_order_ct,
             CAST(sum(refund_amount) AS DECIMAL(38,4)) AS refund_amount,
             CAST(sum(comment_ct) AS BIGINT) AS comment_ct,
             CAST(sum(good_comment_ct) AS BIGINT) AS good_comment_ct, min(ts) AS ts
      FROM (SELECT *, ts - ts % {S} AS ws FROM pev) GROUP BY ws, sku_id) p
LEFT JOIN dim_sku_info s ON s.id = CAST(p.sku_id AS VARCHAR)
LEFT JOIN dim_spu_info spu ON spu.id = CAST(TRY_CAST(s.spu_id AS BIGINT) AS VARCHAR)
LEFT JOIN dim_base_category3 c3 ON c3.id = CAST(TRY_CAST(s.category3_id AS BIGINT) AS VARCHAR)
LEFT JOIN dim_base_trademark tm ON tm.id = CAST(TRY_CAST(s.tm_id AS BIGINT) AS VARCHAR)"""),
    "search_terms": (("st",), 'SELECT event_id AS "offset", full_word, ts_ms AS ts FROM st'),
    "keyword_split": (("kw",), 'SELECT event_id AS "offset", word FROM kw'),
    "keyword_tokens": (("st",), """
SELECT event_id AS "offset", full_word, CAST(len(toks) AS BIGINT) AS n_words,
       array_to_string(toks, ' ') AS words
FROM (SELECT *, regexp_extract_all(lower(full_word), '[a-z0-9]+') AS toks FROM st)"""),
    "keyword_dictionary": (("st",), """
, t AS (SELECT event_id, translate(replace(full_word, ' ', ''), 'abcdefghijklmnopqrstuvwxyz', '一二三四五六七八九十百千天地人水火木金土日月山川田石') AS run FROM st),
d AS (SELECT DISTINCT translate(string_split(p_name, ' ')[1], 'abcdefghijklmnopqrstuvwxyz', '一二三四五六七八九十百千天地人水火木金土日月山川田石') AS word FROM part),
place AS (SELECT event_id, run, unnest(range(1, length(run) + 1)) AS i FROM t),
hit AS (SELECT p.event_id, p.i, d.word FROM place p JOIN d ON substr(p.run, p.i, length(d.word)) = d.word),
bare AS (SELECT p.event_id, p.i, substr(p.run, p.i, 1) AS c FROM place p
         WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.event_id = p.event_id AND h.i <= p.i AND p.i < h.i + length(h.word))),
rest AS (SELECT event_id, string_agg(c, '' ORDER BY i) AS word
         FROM (SELECT *, i - row_number() OVER (PARTITION BY event_id ORDER BY i) AS island FROM bare) GROUP BY event_id, island)
SELECT event_id AS "offset", word, count(*) AS n
FROM (SELECT event_id, word FROM hit UNION ALL SELECT event_id, word FROM rest) GROUP BY event_id, word"""),
    "keyword_stats": (("kw",), f"""
SELECT word AS keyword, CAST(count(*) AS BIGINT) AS ct, 'search' AS source, {_window_text('ws')}
FROM (SELECT *, (ts_ms // 1000 * 1000) - (ts_ms // 1000 * 1000) % {S} AS ws FROM kw)
GROUP BY ws, word"""),
    "cdc_normalize": (("changes",), """
SELECT seq AS "offset", 'shop' AS database, table_name, type,
       CASE WHEN type <> 'delete' THEN CAST(id AS VARCHAR) END AS after_id,
       name AS after_name, segment AS after_segment, birthday AS after_birthday,
       CASE WHEN type <> 'insert' THEN CAST(id AS VARCHAR) END AS before_id,
       b_segment AS before_segment
FROM changes"""),
    "cdc_table_filter": (("changes",), """
SELECT seq AS "offset", table_name, type FROM changes WHERE table_name = 'user_info'"""),
    "cdc_initial": (("changes",), """
SELECT c_custkey - 10000000000 AS "offset", 'user_info' AS table_name, 'read' AS type,
       CAST(c_custkey AS VARCHAR) AS id FROM customer
UNION ALL SELECT seq, table_name, type, CAST(id AS VARCHAR) FROM changes"""),
    "cdc_no_delete": (("changes",), """
SELECT seq AS "offset", table_name, type FROM changes WHERE type <> 'delete'"""),
    "route_columns": (("routed",), f"""
SELECT seq AS "offset", sink_type, sink_table, {KEPT_KEYS} FROM routed"""),
    "route_facts": (("routed",), f"""
SELECT seq AS "offset", sink_table AS topic,
       CASE WHEN list_contains(cols, 'id') THEN CAST(id AS VARCHAR) END AS id,
       CASE WHEN list_contains(cols, 'name') THEN name END AS name, {KEPT_KEYS}
FROM routed WHERE sink_type = 'kafka'"""),
    "route_dims": (("routed",), f"""
SELECT seq AS "offset", sink_table,
       CASE WHEN list_contains(cols, 'id') THEN CAST(id AS VARCHAR) END AS id,
       CASE WHEN list_contains(cols, 'name') THEN name END AS name,
       CASE WHEN list_contains(cols, 'segment') THEN segment END AS segment, {KEPT_KEYS}
FROM routed WHERE sink_type = 'hbase'"""),
    "route_unmatched": (("changes", "routed_v"), """
SELECT c.seq AS "offset", c.table_name, c.type FROM changes c
WHERE c.type <> 'delete' AND c.seq NOT IN (SELECT seq FROM routed_v)"""),
    "route_rules": (("routed_v",), f"""
SELECT seq AS "offset", table_name, type, CAST(rule_seq AS BIGINT) AS rule_version, sink_type,
       sink_table, {KEPT_KEYS} FROM routed_v"""),
    "route_dropped": ((), """
SELECT c_custkey - 10000000000 AS "offset", 'user_info' AS table_name, 'read' AS type, 'clickhouse' AS sink_type,
       'ck_user_info' AS sink_table FROM customer"""),
    "dim_upsert_pk": (("changes",), """
SELECT 'dim_segment' AS sink_table, segment AS pk, arg_max(CAST(id AS VARCHAR), seq) AS last_id, arg_max(name, seq) FILTER (WHERE name IS NOT NULL) AS last_name
FROM changes WHERE table_name = 'user_info' AND type IN ('insert', 'update') GROUP BY segment"""),
    "dim_read": (("ow_base",), """
SELECT ow.detail_id, ow.province_id, n.n_name AS nation_name, CAST(n.n_regionkey AS VARCHAR) AS region_key
FROM ow_base ow LEFT JOIN nation n ON n.n_nationkey = ow.province_id"""),
    "bounce_untimed": (("raw_log",), """
SELECT event_id AS "offset", mid FROM raw_log WHERE NOT is_dirty AND NOT is_start AND event_id % 9 = 0"""),
    "dim_upsert": (("routed",), """
SELECT sink_table, CAST(id AS VARCHAR) AS pk,
       arg_max(CASE WHEN list_contains(cols, 'name') THEN name END, seq)
         FILTER (WHERE name IS NOT NULL AND list_contains(cols, 'name')) AS name,
       arg_max(CASE WHEN list_contains(cols, 'segment') THEN segment END, seq)
         FILTER (WHERE segment IS NOT NULL AND list_contains(cols, 'segment')) AS segment
FROM routed WHERE sink_type = 'hbase' GROUP BY sink_table, id"""),
    "cdc_snapshot": (("changes",), """
SELECT table_name, CAST(id AS VARCHAR) AS pk,
       last.name AS name, last.segment AS segment
FROM (SELECT table_name, id, arg_max({'type': type, 'name': name, 'segment': segment}, seq) AS last
      FROM changes GROUP BY table_name, id) AS k WHERE last.type <> 'delete'"""),
    "cdc_retract": (("changes",), """
SELECT seq, table_name, CAST(0 AS BIGINT) AS pos, true AS flag, CAST(id AS VARCHAR) AS id, name, segment
FROM changes WHERE type = 'insert'
UNION ALL SELECT seq, table_name, 0, false, CAST(id AS VARCHAR), b_name, b_segment
FROM changes WHERE type IN ('update', 'delete')
UNION ALL SELECT seq, table_name, 1, true, CAST(id AS VARCHAR), name, segment
FROM changes WHERE type = 'update'"""),
}


def _resolve(deps: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)
    for d in deps:
        visit(d)
    return order


def build_body(deps: tuple[str, ...], body: str) -> str:
    ctes = _resolve(deps)
    if not ctes:
        return body.strip()
    with_clause = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in ctes)
    return f"WITH {with_clause}\n{body.strip()}"


def build(name: str) -> str:
    return build_body(*BODIES[name])


# Largest event time (ms) seen by each streaming job's watermark operator.
STREAM_MAX: dict[str, tuple[tuple[str, ...], str]] = {
    "keyword_stats": (("kw",), "SELECT max(ts_ms // 1000 * 1000) FROM kw"),
    "visitor_stats": (("vev",), "SELECT max(ts) FROM vev"),
    "province_stats": (("ow_base",), "SELECT max(create_ms) FROM ow_base"),
    "product_stats": (("pev",), "SELECT max(ts) FROM pev"),
}


def closed_windows(name: str, delay_ms: int, end_col: str = "edt") -> str:
    """The batch oracle of ``name`` restricted to windows closed by the final watermark."""
    return (f"SELECT * FROM ({build(name)}) AS q WHERE q.{end_col} <= "
            f"(SELECT strftime(epoch_ms(m - {delay_ms}), {TS_FMT}) "
            f"FROM ({build_body(*STREAM_MAX[name])}) AS mx(m))")


def dim_freshness(chunks: int) -> str:
    """Orders with their user's segment as it was after the changes of the same chunk: both topics
    are cut into ``chunks`` equal ranges of their order key."""
    cut = "(max({0}) - min({0})) // {1} + 1 AS width, min({0}) AS lo"
    return build_body(("changes", "ow_base"), f"""
SELECT o.detail_id, o.order_id, o.user_id, o.chunk AS batch_id,
       (SELECT arg_max(g.segment, g.seq) FROM
          (SELECT id, segment, seq, (seq - lo) // width AS chunk
           FROM changes, (SELECT {cut.format('seq', chunks)} FROM changes)
           WHERE table_name = 'user_info' AND type IN ('insert', 'update') AND segment IS NOT NULL) AS g
        WHERE g.id = o.user_id AND g.chunk <= o.chunk) AS user_segment
FROM (SELECT ow_base.*, CAST((create_ms - lo) // width AS BIGINT) AS chunk
      FROM ow_base, (SELECT {cut.format('create_ms', chunks)} FROM ow_base)) AS o""")


def route_live(chunks: int) -> str:
    """Facts under the rules in force in each chunk: orders lose nothing when their rule is deleted,
    users become facts from the third chunk on."""
    return build_body(("changes",), f"""
SELECT seq AS "offset", CASE table_name WHEN 'user_info' THEN 'dwd_user_info' ELSE 'dwd_order_info' END AS topic,
       CAST(id AS VARCHAR) AS id,
       CASE WHEN table_name = 'order_info' AND chunk >= 2 THEN name END AS name,
       concat_ws(',', 'id', CASE WHEN table_name = 'order_info' AND chunk >= 2 AND name IS NOT NULL THEN 'name' END,
                 CASE WHEN table_name = 'user_info' AND segment IS NOT NULL THEN 'segment' END) AS kept_keys
FROM (SELECT changes.*, (seq - lo) // width AS chunk FROM changes,
        (SELECT (max(seq) - min(seq)) // {chunks} + 1 AS width, min(seq) AS lo FROM changes))
WHERE type = 'insert' AND (table_name = 'order_info' OR (table_name = 'user_info' AND chunk >= 2))""")


def dim_tables() -> str:
    """Declared columns of the created dimension tables (the rule's list, in order) and their values."""
    return f"""WITH d AS ({build("dim_upsert")})
SELECT sink_table, 'id' AS column_name, CAST(0 AS BIGINT) AS position, true AS is_key, count(pk) AS n_values FROM d GROUP BY ALL
UNION ALL SELECT sink_table, 'name', 1, false, count(name) FROM d GROUP BY ALL
UNION ALL SELECT sink_table, 'segment', 2, false, count(segment) FROM d GROUP BY ALL"""


def cdc_handoff(chunks: int) -> str:
    """Events of a snapshot in ``chunks`` chunks of ids: chunk c begins after the c-th stretch of the log and is
    read half way through the next one.  Keys that change in that stretch are told by their changes alone."""
    return build_body(("changes",), f"""
, u AS (SELECT *, min(seq) OVER () AS lo, (max(seq) OVER () - min(seq) OVER ()) // {chunks} + 1 AS width, id % {chunks} AS c
        FROM changes WHERE table_name = 'user_info'),
last AS (SELECT id, arg_max({{'type': type, 'segment': segment}}, seq) AS l FROM u
         WHERE seq <= lo + width * c + width // 2 GROUP BY id)
SELECT 'user_info' AS table_name, 'read' AS type, CAST(NULL AS BIGINT) AS "offset", CAST(id AS VARCHAR) AS id, l.segment AS segment
FROM last WHERE l.type <> 'delete' AND id NOT IN (SELECT id FROM u WHERE (seq - lo) // width = c)
UNION ALL
SELECT table_name, type, seq, CAST(id AS VARCHAR), segment FROM u WHERE (seq - lo) // width >= c""")


def log_source() -> str:
    """Offsets of a topic in four partitions: the place of a record among those of its partition."""
    return build_body(("raw_log",), """
SELECT "partition", "offset", mid, ts FROM (
  SELECT CAST(event_id % 4 AS INTEGER) AS "partition", mid, ts_ms AS ts, is_dirty,
         row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS "offset" FROM raw_log)
WHERE NOT is_dirty""")


def log_split() -> str:
    """The four topics of the log split, with a field each that no schema names."""
    return build_body(("raw_log", "log_fixed", "page_log", "display_log"), """
SELECT 'start' AS topic, event_id AS "offset", mid, substr(mid, 5) AS uid, is_new, NULL AS page_id, NULL AS item,
       'icon' AS extra FROM log_fixed WHERE is_start
UNION ALL SELECT 'page', event_id, mid, substr(mid, 5), is_new, page_id, item,
       CASE WHEN n_displays > 0 THEN '1' END FROM page_log
UNION ALL SELECT 'display', event_id, NULL, NULL, NULL, page_id, item, CAST(sku - k + 1 AS VARCHAR)
FROM (SELECT d.*, p.k FROM display_log d JOIN page_log p USING (event_id))
UNION ALL SELECT 'dirty', event_id, NULL, NULL, NULL, NULL, NULL, NULL FROM raw_log WHERE is_dirty""")


def closed_bounces(delay_ms: int) -> str:
    """Bounces whose pattern window the final watermark has passed (their timer fired)."""
    return (f"SELECT * FROM ({build('bounce_detail')}) AS q WHERE q.ts + {W} <= "
            f"(SELECT max(ts_ms) - {delay_ms} FROM ({build_body(('page_log',), 'SELECT ts_ms FROM page_log')}) AS p)")


def oracle_sql() -> dict[str, str]:
    out = {name: build(name) for name in BODIES}
    # the SQL-path jobs compute the same tables as their DataFrame twins
    out["keyword_stats_sql"] = out["keyword_stats"]
    out["province_stats_sql"] = out["province_stats"]
    return out
