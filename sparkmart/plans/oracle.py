"""The registered queries in ANSI SQL over the same tables, for checking results."""

from __future__ import annotations

from sparkmart.plans.fixtures import AS_OF
from sparkmart.plans.queries import BOUNCE_SECONDS, ORDER_DETAIL_SECONDS

TEXT_TIME = "'%Y-%m-%d %H:%M:%S'"
AMOUNT = "DECIMAL(16,2)"


def text(ts: str) -> str:
    return f"strftime({ts}, {TEXT_TIME})"


def bucket(step: str, ts: str) -> str:
    return f"time_bucket(INTERVAL '{step}', {ts}, TIMESTAMP '1970-01-01')"


def bounds(step: str, start: str = "w") -> str:
    return f"{text(start)} AS stt, {text(f'{start} + INTERVAL {chr(39)}{step}{chr(39)}')} AS edt"


# Common table expressions, each with those it builds on.
CTES = {
    "ev": (
        [],
        """SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
           epoch_us(ts) // 1000 AS ts_ms, (SELECT count(*) FROM part) AS np FROM events""",
    ),
    "logs": (
        ["ev"],
        """SELECT event_id, CAST(user_id AS VARCHAR) AS mid, 'v' || (k % 3) AS vc, 'ch' || (k % 4) AS ch,
           CAST(user_id % 25 AS VARCHAR) AS ar, CASE WHEN k < 50 THEN '1' ELSE '0' END AS flag,
           CASE WHEN event_type = 'click' THEN 'good_detail' ELSE event_type END AS page_id,
           CASE WHEN event_type IN ('view', 'signup') THEN NULL ELSE 'home' END AS last_page_id,
           CAST(user_id % np AS VARCHAR) AS item, CAST(round(value * 1000) AS BIGINT) AS during_time,
           event_type = 'signup' AND k % 2 = 0 AS is_start, k, user_id, np, ts_ms, ts FROM ev""",
    ),
    "customers_kept": (
        [],
        """SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey, coalesce('name ' || o.last, c_name) AS name, c_mktsegment AS segment
           FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, (o_orderstatus <> 'F', o_orderkey)) AS last
             FROM orders GROUP BY o_custkey) o ON o.o_custkey = c_custkey""",
    ),
    "repaired": (
        ["logs"],
        """SELECT *, CASE WHEN flag = '1' AND CAST(ts AS DATE) <>
             CAST(min(CASE WHEN flag = '1' THEN ts END) OVER (PARTITION BY mid) AS DATE)
           THEN '0' ELSE flag END AS is_new FROM logs""",
    ),
    "pages": (["repaired"], "SELECT * FROM repaired WHERE NOT is_start"),
    "shown": (
        ["pages"],
        """SELECT event_id, page_id, ts_ms, ts, i, CAST((user_id + i) % np AS VARCHAR) AS item,
             CASE WHEN i % 2 = 0 THEN 'sku_id' ELSE 'promotion' END AS item_type
           FROM (SELECT *, unnest(range(k % 4)) AS i FROM pages)""",
    ),
    # A log has 6 fields, and 7 with actions or an error; a display has 4 and gets 2.
    "messages": (
        ["repaired", "shown"],
        """SELECT event_id, CASE WHEN is_start THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic, ts_ms AS ts, is_new,
             'u' || mid AS uid, 'os' || event_id % 7 AS os, page_id, 'query' AS source_type,
             CASE WHEN event_id % 7 = 1 THEN 'get' END AS action, CASE WHEN event_id % 7 = 2 THEN event_id % 100 END AS error,
             CAST(NULL AS VARCHAR) AS item, CAST(NULL AS VARCHAR) AS item_type, CAST(NULL AS BIGINT) AS shown_order,
             CAST(NULL AS VARCHAR) AS display_type, CAST(CASE WHEN event_id % 7 IN (1, 2) THEN 7 ELSE 6 END AS BIGINT) AS n_fields
           FROM repaired
           UNION ALL SELECT event_id, 'dwd_display_log', ts_ms, NULL, NULL, NULL, page_id, NULL, NULL, NULL, item, item_type,
             i + 1, 'query', 6 FROM shown""",
    ),
    "visits": (
        ["pages"],
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts_ms, event_id) AS rn
           FROM pages WHERE last_page_id IS NULL) WHERE rn = 1""",
    ),
    "followed": (
        ["pages"],
        """SELECT *, lead(ts_ms) OVER o AS next_ms, lead(event_id) OVER o AS next_id, lead(page_id) OVER o AS next_page
           FROM pages WINDOW o AS (PARTITION BY mid ORDER BY ts_ms, event_id)""",
    ),
    "bounced": (
        ["followed"],
        f"""SELECT * FROM followed WHERE last_page_id IS NULL
            AND (next_ms IS NULL OR next_ms - ts_ms >= {BOUNCE_SECONDS * 1000})""",
    ),
    "info": (
        [],
        f"""SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id, o_orderstatus AS order_status,
            o_custkey AS user_id, CAST(o_totalprice AS {AMOUNT}) AS total_amount, CAST(5 AS {AMOUNT}) AS feight_fee,
            {text("o_orderdate")} AS create_time, strftime(o_orderdate, '%Y-%m-%d') AS create_date, o_orderdate AS create_ts
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    ),
    "detail": (
        [],
        f"""SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
            CAST(l_extendedprice AS {AMOUNT}) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
            'sku ' || l_partkey AS sku_name, l_shipdate AS create_ts,
            CAST(CAST(l_extendedprice AS {AMOUNT}) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {AMOUNT}) AS split_total_amount
            FROM lineitem""",
    ),
    "joined": (
        ["info", "detail"],
        f"""SELECT d.id AS detail_id, o.id AS order_id, o.order_status, o.create_time, o.create_date,
            CAST(NULL AS DOUBLE) AS activity_reduce_amount, CAST(NULL AS DOUBLE) AS coupon_reduce_amount,
            CAST(o.total_amount AS DOUBLE) AS original_total_amount, CAST(o.feight_fee AS DOUBLE) AS feight_fee,
            CAST(o.total_amount AS DOUBLE) AS total_amount, o.province_id, o.user_id, d.sku_id, d.sku_name,
            CAST(d.order_price AS DOUBLE) AS order_price, d.sku_num, CAST(NULL AS DOUBLE) AS split_activity_amount,
            CAST(NULL AS DOUBLE) AS split_coupon_amount, CAST(d.split_total_amount AS DOUBLE) AS split_total_amount,
            CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS operate_time,
            CAST(NULL AS VARCHAR) AS create_hour, CAST(NULL AS DOUBLE) AS split_feight_fee,
            o.create_ts, d.split_total_amount AS amount
            FROM info o JOIN detail d ON o.id = d.order_id
            AND d.create_ts BETWEEN o.create_ts - INTERVAL {ORDER_DETAIL_SECONDS} SECOND
                                AND o.create_ts + INTERVAL {ORDER_DETAIL_SECONDS} SECOND""",
    ),
    "payment": (
        [],
        f"""SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
            CAST(o_totalprice AS {AMOUNT}) + 1 AS total_amount, 'order ' || o_orderkey AS subject, '1101' AS payment_type,
            {text("o_orderdate")} AS create_time, o_orderdate + to_minutes(CAST(o_orderkey % 60 AS BIGINT)) AS callback_ts
            FROM orders WHERE o_orderstatus = 'F'""",
    ),
    "users": (
        [],
        f"""SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
            CAST(date_diff('day', DATE '1960-01-01' + CAST(c_custkey * 37 % 14000 AS INT), DATE '{AS_OF}') // 365 AS INT) AS age
            FROM customer""",
    ),
    "provinces": (
        [],
        """SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS area_code, 'N' || n_nationkey AS iso_code,
           'ISO-' || n_nationkey AS iso_3166_2 FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "skus": (
        [],
        f"""SELECT p_partkey AS id, p_name AS sku_name, CAST(CAST(p_retailprice AS {AMOUNT}) AS DOUBLE) AS price,
            CAST(ascii(substr(p_type, 2, 1)) AS BIGINT) AS spu_id, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS tm_id,
            CAST(p_size AS BIGINT) AS category3_id FROM part WHERE p_partkey % 10 <> 0""",
    ),
    "spus": ([], "SELECT DISTINCT CAST(ascii(substr(p_type, 2, 1)) AS BIGINT) AS id, p_type AS spu_name FROM part"),
    "tms": ([], "SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS id, p_brand AS tm_name FROM part"),
    "cats": (
        [],
        "SELECT DISTINCT CAST(p_size AS BIGINT) AS id, 'category ' || p_size AS name FROM part WHERE p_size <> 1",
    ),
    "full_skus": (
        ["skus", "spus", "tms", "cats"],
        """SELECT s.*, spu_name, tm_name, c.name AS category3_name FROM skus s LEFT JOIN spus u ON s.spu_id = u.id
           LEFT JOIN cats c ON s.category3_id = c.id LEFT JOIN tms t ON s.tm_id = t.id""",
    ),
    "wide": (
        ["joined", "users", "provinces", "full_skus"],
        """SELECT j.*, p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
           p.iso_3166_2 AS province_3166_2_code, u.age AS user_age, u.gender AS user_gender, s.spu_id, s.tm_id,
           s.category3_id, s.spu_name, s.tm_name, s.category3_name
           FROM joined j LEFT JOIN users u ON j.user_id = u.id LEFT JOIN provinces p ON j.province_id = p.id
           LEFT JOIN full_skus s ON j.sku_id = s.id""",
    ),
    "paid": (
        ["joined", "payment"],
        """SELECT j.sku_id, j.order_id, j.amount, p.callback_ts FROM payment p JOIN joined j ON p.order_id = j.order_id
           AND j.create_ts BETWEEN p.callback_ts - INTERVAL 1800 SECOND AND p.callback_ts""",
    ),
    "measures": (
        ["ev", "pages", "shown", "joined", "paid"],
        """SELECT ts_ms, date_trunc('millisecond', ts) AS t, CAST(item AS BIGINT) AS sku_id, 0 AS display_ct, 1 AS click_ct,
             0 AS favor_ct, 0 AS cart_ct, 0 AS order_sku_num, 0.00 AS order_amount, 0.00 AS payment_amount, 0.00 AS refund_amount,
             0 AS comment_ct, 0 AS good_comment_ct, CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS BIGINT) AS paid_order_id,
             CAST(NULL AS BIGINT) AS refund_order_id FROM pages WHERE page_id = 'good_detail'
           UNION ALL SELECT ts_ms, ts, CAST(item AS BIGINT), 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL
             FROM shown WHERE item_type = 'sku_id'
           UNION ALL SELECT ts_ms, ts, user_id % np, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL FROM ev WHERE event_type = 'view'
           UNION ALL SELECT ts_ms, ts, user_id % np, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL FROM ev WHERE event_type = 'purchase'
           UNION ALL SELECT epoch_ms(create_ts), create_ts, sku_id, 0, 0, 0, 0, sku_num, amount, 0, 0, 0, 0, order_id, NULL, NULL FROM joined
           UNION ALL SELECT epoch_ms(callback_ts), callback_ts, sku_id, 0, 0, 0, 0, 0, 0, amount, 0, 0, 0, NULL, order_id, NULL FROM paid
           UNION ALL SELECT epoch_ms(l_shipdate), l_shipdate, l_partkey, 0, 0, 0, 0, 0, 0, 0, CAST(l_extendedprice AS DECIMAL(16,2)),
             0, 0, NULL, NULL, l_orderkey FROM lineitem WHERE l_returnflag = 'R'
           UNION ALL SELECT epoch_ms(l_shipdate), l_shipdate, l_partkey, 0, 0, 0, 0, 0, 0, 0, 0, 1,
             CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END, NULL, NULL, NULL FROM lineitem WHERE l_returnflag = 'A'""",
    ),
    "idle_measures": (["measures"], "SELECT * FROM measures WHERE refund_order_id IS NULL AND comment_ct = 0"),
    "pstats": (
        ["measures"],
        f"""SELECT w, sku_id, {", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"))},
            {", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in ("order_amount", "payment_amount", "refund_amount"))},
            count(DISTINCT order_id) AS order_ct, count(DISTINCT paid_order_id) AS paid_order_ct,
            count(DISTINCT refund_order_id) AS refund_order_ct
            FROM (SELECT *, {bucket("1 day", "t")} AS w FROM measures) GROUP BY w, sku_id""",
    ),
    "change": (
        [],
        f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'payments' ELSE 'orders' END AS tbl,
            CASE o_orderpriority[1] WHEN '1' THEN 'bootstrap-insert' WHEN '2' THEN 'insert' WHEN '3' THEN 'update'
              WHEN '4' THEN 'delete' ELSE 'insert' END AS kind, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
            CAST(CAST(o_totalprice AS {AMOUNT}) AS VARCHAR) AS total, 'n''' || o_custkey AS note, o_orderpriority[1] = '5' AS empty
            FROM orders""",
    ),
    "cleaned": (["change"], "SELECT * FROM change WHERE tbl <> '' AND NOT empty"),
    "routed": (
        ["cleaned"],
        """SELECT o_orderkey, tbl, CASE WHEN kind = 'bootstrap-insert' THEN 'insert' ELSE kind END AS kind, id, status, total, note,
           r.sink_type, r.sink_table FROM cleaned LEFT JOIN (VALUES ('orders', 'insert', 'kafka', 'dwd_orders'),
             ('orders', 'update', 'hbase', 'dim_orders'), ('payments', 'insert', 'clickhouse', 'ck_payments'))
             AS r(source_table, op, sink_type, sink_table)
           ON tbl = r.source_table AND CASE WHEN kind = 'bootstrap-insert' THEN 'insert' ELSE kind END = r.op""",
    ),
}

WIDE_COLUMNS = (
    "detail_id, order_id, sku_id, order_price, sku_num, sku_name, province_id, order_status, user_id, total_amount, "
    "activity_reduce_amount, coupon_reduce_amount, original_total_amount, feight_fee, split_feight_fee, "
    "split_activity_amount, split_coupon_amount, split_total_amount, expire_time, create_time, operate_time, "
    "create_date, create_hour, province_name, province_area_code, province_iso_code, province_3166_2_code, "
    "user_age, user_gender, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name"
)
PSTATS_COLUMNS = (
    "sku_id, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount, payment_amount, refund_amount, "
    "comment_ct, good_comment_ct, order_ct, paid_order_ct, refund_order_ct"
)
# Codes and labels of the source data model, written out for the comparison.
LABEL_ROWS = """
    ('1001', 'order unpaid'),
    ('1002', 'order paid'),
    ('1003', 'order cancelled'),
    ('1004', 'order finished'),
    ('1005', 'order refunding'),
    ('1006', 'order refunded'),
    ('1101', 'alipay'),
    ('1102', 'wechat'),
    ('1103', 'unionpay'),
    ('1201', 'good'),
    ('1202', 'neutral'),
    ('1203', 'bad'),
    ('1204', 'automatic'),
    ('1301', 'bad goods'),
    ('1302', 'wrong description'),
    ('1303', 'sold out'),
    ('1304', 'wrong size'),
    ('1305', 'ordered by mistake'),
    ('1306', 'no reason'),
    ('1307', 'other reason'),
    ('1401', 'coupon unused'),
    ('1402', 'coupon in use'),
    ('1403', 'coupon used'),
    ('1501', 'money only'),
    ('1502', 'money and goods'),
    ('2401', 'user search'),
    ('2402', 'promotion'),
    ('2403', 'recommendation'),
    ('2404', 'campaign'),
    ('3101', 'activity full reduction'),
    ('3102', 'activity quantity discount'),
    ('3103', 'activity discount'),
    ('3201', 'coupon full reduction'),
    ('3202', 'coupon quantity discount'),
    ('3203', 'coupon voucher'),
    ('3301', 'range category'),
    ('3302', 'range trademark'),
    ('3303', 'range product')"""
SKU_LINES = "(SELECT d.id, d.sku_id, s.spu_id, s.tm_id, s.category3_id FROM detail d LEFT JOIN skus s ON d.sku_id = s.id)"

# Each query: the expressions it needs and its final SELECT.
SELECTS = {
    "parse_log_json": (
        ["logs"],
        """SELECT CASE WHEN ok THEN mid END AS mid, CASE WHEN ok THEN flag END AS is_new, CASE WHEN ok THEN page_id END AS page_id,
           CASE WHEN ok THEN last_page_id END AS last_page_id, CASE WHEN ok THEN during_time END AS during_time,
           CASE WHEN ok THEN k % 4 END AS n_displays, CASE WHEN ok AND k % 4 > 0 THEN item END AS first_item,
           CASE WHEN ok THEN CASE WHEN is_start THEN 1 ELSE 0 END END AS n_start, CASE WHEN ok THEN ts_ms END AS ts,
           CASE WHEN NOT ok THEN substr('{"common":{"mid":"' || mid || '","vc":"', 1, 20) END AS corrupt
           FROM (SELECT *, during_time % 50 <> 49 AS ok FROM logs)""",
    ),
    "parse_orders": (
        ["info"],
        """SELECT id, province_id, user_id, order_status, CAST(total_amount AS DOUBLE) AS total_amount,
           CAST(NULL AS DOUBLE) AS coupon_reduce_amount, create_time, epoch_ms(create_ts) AS create_ts FROM info""",
    ),
    "scalar_time": (
        ["ev"],
        f"""SELECT event_id, strftime(ts, '%Y%m%d') AS day, {text("ts")} AS text, epoch_ms(date_trunc('second', ts)) AS text_ms,
            CAST((ts_ms - epoch_ms(TIMESTAMP '1990-06-15')) // 31536000000 AS INT) AS age FROM ev""",
    ),
    "code_labels": (
        [],
        f"""WITH c(code, label) AS (VALUES {LABEL_ROWS}), used AS (
              SELECT l_orderkey, l_linenumber, unnest(['100', '110', '120', '130', '140', '150', '240', '310', '320', '330'])
                || l_linenumber AS code FROM lineitem)
            SELECT l_orderkey, l_linenumber, used.code, label FROM used LEFT JOIN c ON c.code = used.code""",
    ),
    "dim_lookup": (
        [],
        """SELECT c_nationkey, c_mktsegment, c_custkey, c_name FROM (SELECT *, row_number() OVER
           (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS rn FROM customer) WHERE rn = 1""",
    ),
    "to_json_rows": (
        ["ev"],
        f"""SELECT '{{"sku_id":' || (user_id % np) || ',"create_time":"' || {text("ts")} || '"}}' AS value
            FROM ev WHERE event_type = 'purchase'""",
    ),
    "cdc_decode": (
        [],
        """SELECT o_orderkey, 'shop' AS "database", 'user_info' AS "table",
           CASE p WHEN '1' THEN 'read' WHEN '2' THEN 'insert' WHEN '4' THEN 'delete' ELSE 'update' END AS "type",
           CASE WHEN p = '4' THEN 0 ELSE 3 END AS n_data, CASE WHEN p <> '4' THEN CAST(o_custkey AS VARCHAR) END AS id,
           CASE WHEN p <> '4' THEN 'name ' || o_orderkey END AS name,
           CASE WHEN p = '4' THEN CAST(o_custkey AS VARCHAR) END AS before_id, o_orderkey AS ts
           FROM (SELECT *, o_orderpriority[1] AS p FROM orders)""",
    ),
    "cdc_current_table": (
        [],
        """SELECT id, balance, seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM (
             SELECT c_custkey AS id, c_acctbal AS balance, -1 AS seq, 'r' AS op FROM customer
             UNION ALL SELECT o_custkey, o_totalprice, o_orderkey, CASE WHEN o_orderpriority[1] = '4' THEN 'd' ELSE 'u' END FROM orders))
           WHERE rn = 1 AND op <> 'd'""",
    ),
    "cdc_sql_view": (
        [],
        """SELECT CAST(o_custkey AS INT) AS id, 'name ' || o_orderkey AS name, CAST(o_orderkey % 90 AS INT) AS age FROM (
             SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
           WHERE rn = 1 AND o_orderpriority[1] <> '4'""",
    ),
    "cdc_clean_filter": (["cleaned"], 'SELECT o_orderkey, tbl AS "table", kind AS "type", 4 AS n_data FROM cleaned'),
    "cdc_route": (
        ["routed"],
        """SELECT o_orderkey, tbl AS "table", kind AS "type", sink_type, sink_table,
           CASE sink_type WHEN 'hbase' THEN 'dim' WHEN 'kafka' THEN 'fact' ELSE 'rejected' END AS route,
           CASE WHEN sink_type IS NULL THEN 'no rule' WHEN sink_type = 'clickhouse' THEN 'unsupported sink type' END AS reason
           FROM routed""",
    ),
    "cdc_column_filter": (
        ["routed"],
        """SELECT o_orderkey, CASE WHEN sink_type IS NULL THEN 4 ELSE 2 END AS n_data, id,
           CASE WHEN sink_type IS NULL OR sink_type = 'hbase' THEN status END AS status,
           CASE WHEN sink_type IS NULL OR sink_type <> 'hbase' THEN total END AS total,
           CASE WHEN sink_type IS NULL THEN note END AS note FROM routed""",
    ),
    "cdc_rules_current": (
        [],
        """SELECT source_table, operate_type, CASE WHEN p = '1' THEN 'hbase' ELSE 'kafka' END AS sink_type,
           'sink_' || o_orderkey AS sink_table, 'id,status' AS sink_columns, 'id' AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend
           FROM (SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY o_orderkey DESC) AS rn FROM (
             SELECT o_orderkey, o_orderpriority[1] AS p, 't' || o_custkey AS source_table,
               CASE WHEN o_orderstatus = 'F' THEN 'insert' ELSE 'update' END AS operate_type FROM orders
             WHERE NOT (o_orderpriority[1] = '4' AND o_orderkey % 2 = 1))) WHERE rn = 1 AND p <> '4'""",
    ),
    "fact_payloads": (
        ["routed"],
        """SELECT sink_table AS topic, '{"id":' || id || ',"total":"' || total || '"}' AS value FROM routed WHERE sink_type = 'kafka'""",
    ),
    "dim_upsert": (["customers_kept"], "SELECT id, name, segment FROM customers_kept"),
    # Deleted rows are gone, or have only what came after the deletion.
    "dim_upsert_deletes": (
        ["customers_kept"],
        """SELECT id, CASE WHEN c_custkey % 3 <> 0 THEN name END AS name, CASE WHEN c_custkey % 3 <> 0 THEN segment END AS segment,
             CASE WHEN c_custkey % 2 = 0 THEN id END AS balance
           FROM customers_kept WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""",
    ),
    "new_visitor_repair": (["repaired"], "SELECT event_id, mid, is_new FROM repaired"),
    "log_split": (["messages"], "SELECT * FROM messages"),
    "display_explode": (["shown"], "SELECT item, item_type, page_id, ts_ms AS ts, event_id FROM shown"),
    "unique_visitors": (["visits"], "SELECT mid, strftime(ts, '%Y%m%d') AS day, event_id, is_new FROM visits"),
    "user_bounce": (["bounced"], "SELECT event_id, mid, page_id, ts_ms AS ts FROM bounced"),
    "pattern_match": (
        ["followed"],
        f"""SELECT event_id, next_id AS next_event_id, next_ms - ts_ms AS gap_ms FROM followed
            WHERE last_page_id IS NULL AND next_page = 'good_detail' AND next_ms - ts_ms < {BOUNCE_SECONDS * 1000}""",
    ),
    "order_wide_join": (["joined"], "SELECT * EXCLUDE (create_ts, amount) FROM joined"),
    "dim_join_left": (
        ["detail", "skus"],
        """SELECT d.id, d.sku_id, d.sku_num, upper(s.sku_name) AS name, s.price FROM detail d LEFT JOIN skus s ON d.sku_id = s.id""",
    ),
    "enrich_user": (
        ["info", "users"],
        "SELECT i.id, i.user_id, u.age AS user_age, u.gender AS user_gender FROM info i LEFT JOIN users u ON i.user_id = u.id",
    ),
    "enrich_province": (
        ["info", "provinces"],
        """SELECT i.id, i.province_id, p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
           p.iso_3166_2 AS province_3166_2_code FROM info i LEFT JOIN provinces p ON i.province_id = p.id""",
    ),
    "enrich_sku": (
        ["detail", "skus"],
        """SELECT d.id, d.sku_id, s.spu_id, s.tm_id, s.category3_id, s.sku_name, s.price AS sku_price
           FROM detail d LEFT JOIN skus s ON d.sku_id = s.id""",
    ),
    "enrich_spu": (
        ["detail", "skus", "spus"],
        f"SELECT l.id, l.spu_id, u.spu_name FROM {SKU_LINES} l LEFT JOIN spus u ON l.spu_id = u.id",
    ),
    "enrich_category3": (
        ["detail", "skus", "cats"],
        f"SELECT l.id, l.category3_id, c.name AS category3_name FROM {SKU_LINES} l LEFT JOIN cats c ON l.category3_id = c.id",
    ),
    "enrich_trademark": (
        ["detail", "skus", "tms"],
        f"SELECT l.id, l.tm_id, t.tm_name FROM {SKU_LINES} l LEFT JOIN tms t ON l.tm_id = t.id",
    ),
    "order_wide": (["wide"], f"SELECT {WIDE_COLUMNS} FROM wide"),
    "payment_wide": (
        ["wide", "payment"],
        f"""SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time,
            {text("p.callback_ts")} AS callback_time, p.order_id, p.user_id, CAST(p.total_amount AS DOUBLE) AS total_amount,
            w.create_time AS order_create_time,
            {", ".join("w." + c for c in WIDE_COLUMNS.split(", ") if c not in ("order_id", "user_id", "total_amount", "create_time", "expire_time", "operate_time", "create_date", "create_hour"))}
            FROM payment p JOIN wide w ON p.order_id = w.order_id
            AND w.create_ts BETWEEN p.callback_ts - INTERVAL 1800 SECOND AND p.callback_ts""",
    ),
    "merge_partial_rows": (
        ["info"],
        """SELECT coalesce(a.id, b.id) AS order_id, coalesce(a.order_status, b.order_status) AS order_status, a.user_id,
           CAST(coalesce(a.total_amount, b.total_amount) AS DOUBLE) AS total_amount, coalesce(a.create_time, b.create_time) AS create_time
           FROM (SELECT id, order_status, user_id, create_time, CASE WHEN order_status <> 'P' THEN total_amount END AS total_amount
                 FROM info WHERE order_status <> 'O') a
           FULL OUTER JOIN (SELECT id, '1001' AS order_status, total_amount, create_time FROM info WHERE order_status <> 'F') b ON a.id = b.id""",
    ),
    "tumbling_counts": (
        ["ev"],
        f"""SELECT {bounds("1 hour")}, event_type, count(*) AS events, CAST(sum(during) AS BIGINT) AS during FROM (
              SELECT *, {bucket("1 hour", "ts")} AS w, CAST(round(value * 1000) AS BIGINT) AS during FROM ev) GROUP BY w, event_type""",
    ),
    "visitor_stats": (
        ["pages", "visits", "bounced"],
        f"""SELECT {bounds("1 hour")}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
            CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct, CAST(sum(dur) AS BIGINT) AS dur_sum FROM (
              SELECT *, {bucket("1 hour", "ts")} AS w FROM (
                SELECT ts, vc, ch, ar, is_new, 0 AS uv, 1 AS pv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv, 0 AS uj,
                  during_time AS dur FROM pages
                UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM visits
                UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM bounced)) GROUP BY w, vc, ch, ar, is_new""",
    ),
    "product_clicks": (
        ["pages"],
        f"""SELECT {bounds("1 day")}, CAST(item AS BIGINT) AS sku_id, count(*) AS click_ct FROM (
              SELECT *, {bucket("1 day", "ts")} AS w FROM pages WHERE page_id = 'good_detail') GROUP BY w, item""",
    ),
    "product_displays": (
        ["shown"],
        f"""SELECT {bounds("1 day")}, CAST(item AS BIGINT) AS sku_id, count(*) AS display_ct FROM (
              SELECT *, {bucket("1 day", "ts")} AS w FROM shown WHERE item_type = 'sku_id') GROUP BY w, item""",
    ),
    "product_comments": (
        [],
        f"""SELECT {bounds("1 day")}, l_partkey AS sku_id, count(*) AS comment_ct,
            count(*) FILTER (WHERE l_linestatus = 'F') AS good_comment_ct FROM (
              SELECT *, {bucket("1 day", "l_shipdate")} AS w FROM lineitem WHERE l_returnflag = 'A') GROUP BY w, l_partkey""",
    ),
    "product_orders": (
        ["joined"],
        f"""SELECT {bounds("1 day")}, sku_id, CAST(sum(sku_num) AS BIGINT) AS order_sku_num, CAST(sum(amount) AS DOUBLE) AS order_amount,
            count(DISTINCT order_id) AS order_ct FROM (SELECT *, {bucket("1 day", "create_ts")} AS w FROM joined) GROUP BY w, sku_id""",
    ),
    "distinct_orders": (
        ["detail"],
        f"""SELECT {bounds("1 day")}, sku_id, CAST(sum(sku_num) AS BIGINT) AS sku_num, count(DISTINCT order_id) AS order_ct FROM (
              SELECT *, {bucket("1 day", "create_ts")} AS w FROM detail) GROUP BY w, sku_id""",
    ),
    "product_union": (
        ["measures"],
        """SELECT ts_ms AS ts, * EXCLUDE (ts_ms, t) REPLACE (CAST(order_amount AS DOUBLE) AS order_amount,
           CAST(payment_amount AS DOUBLE) AS payment_amount, CAST(refund_amount AS DOUBLE) AS refund_amount) FROM measures""",
    ),
    "product_stats": (["pstats"], f"SELECT {bounds('1 day')}, {PSTATS_COLUMNS} FROM pstats"),
    "product_stats_wide": (
        ["pstats", "full_skus"],
        f"""SELECT {bounds("1 day")}, {PSTATS_COLUMNS}, sku_name, price AS sku_price, spu_id, spu_name, tm_id, tm_name,
            category3_id, category3_name FROM pstats LEFT JOIN full_skus s ON sku_id = s.id""",
    ),
}


SELECTS["cdc_rules_tied"] = SELECTS["cdc_rules_current"]
SELECTS["dim_upsert_tied"] = (
    [],
    """SELECT CAST(o_custkey AS VARCHAR) AS id, 'name ' || max(o_orderkey) AS name,
       'by ' || max(o_orderkey) FILTER (o_orderkey % 2 = 0) AS segment, 'by ' || max(o_orderkey) FILTER (o_orderkey % 2 = 1) AS note
       FROM orders GROUP BY o_custkey""",
)
SELECTS["stream_raw_landing"] = (
    [],
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS messages, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1",
)
SELECTS["stream_unusable"] = (
    ["ev"],
    """SELECT CAST(event_id % 3 AS INT) AS batch, reason, count(*) AS n FROM (
         SELECT event_id, CASE WHEN CAST(round(value * 1000) AS BIGINT) % 50 = 49 THEN 'no JSON object'
           WHEN event_id % 7 = 0 THEN 'no event time' END AS reason FROM ev) WHERE reason IS NOT NULL GROUP BY ALL""",
)
SELECTS["stream_pattern_match"] = SELECTS["pattern_match"]
SELECTS["stream_captured_table"] = SELECTS["cdc_sql_view"]
SELECTS["stream_base_db"] = (
    ["cleaned"],
    """SELECT target, id, detail FROM (
         SELECT *, CASE WHEN tbl <> 'orders' OR op = 'delete' OR (op = 'update' AND third = 2) THEN 'rejected'
             WHEN op = 'update' THEN 'dim_orders' WHEN third = 0 THEN 'dwd_orders' ELSE 'dwd_later' END AS target,
           CASE WHEN tbl <> 'orders' OR op = 'delete' OR (op = 'update' AND third = 2) THEN 'no rule'
             WHEN op = 'update' THEN status WHEN third = 0 THEN total END AS detail
         FROM (SELECT *, CASE WHEN kind = 'bootstrap-insert' THEN 'insert' ELSE kind END AS op,
                 least(2, 3 * o_orderkey // ((SELECT max(o_orderkey) FROM orders) + 1)) AS third FROM cleaned))""",
)
# No refunds and no comments come.
CTES["idle_pstats"] = (["idle_measures"], CTES["pstats"][1].replace("FROM measures", "FROM idle_measures"))
_needs, _select = SELECTS["product_stats_wide"]
SELECTS["stream_product_stats_idle"] = (["idle_pstats", "full_skus"], _select.replace("FROM pstats", "FROM idle_pstats"))
SELECTS["stream_log_split"] = (["messages"], "SELECT * EXCLUDE (event_id) FROM messages")
# The streaming replays give what the batch queries give.
for _name in ("unique_visitors", "user_bounce", "visitor_stats", "order_wide", "payment_wide", "product_stats_wide"):
    SELECTS[f"stream_{_name}"] = SELECTS[_name]


def _needed(names: list[str], found: list[str]) -> list[str]:
    for name in names:
        if name not in found:
            _needed(CTES[name][0], found)
            found.append(name)
    return found


def oracle_sql() -> dict[str, str]:
    sql = {}
    for name, (needs, select) in SELECTS.items():
        parts = ",\n".join(f"{cte} AS (\n{CTES[cte][1]}\n)" for cte in _needed(needs, []))
        sql[name] = f"WITH {parts}\n{select}" if parts else select
    return sql
