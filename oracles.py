"""DuckDB SQL oracles, one per registered query.

Written from the driver's source columns and the semantics of each operator, not
from our Spark output.  Tables `lineitem orders part events ...` are views in the
DuckDB session that runs these.
"""

from __future__ import annotations

V_ORDERS = """
v_orders AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
           || CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS event_id,
         'order_created' AS event_type,
         o.o_orderdate AS event_ts,
         o.o_orderdate AS ingestion_ts,
         CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_custkey AS VARCHAR) AS user_id,
         CASE WHEN l.l_orderkey % 43 = 0 THEN 'X' ELSE '' END || CAST(l.l_partkey AS VARCHAR) AS product_id,
         'SKU-' || CAST(l.l_partkey AS VARCHAR) AS sku,
         CAST(l.l_suppkey AS VARCHAR) AS store_id,
         o.o_orderpriority AS channel,
         CAST(trunc(l.l_quantity) AS INTEGER) AS quantity,
         l.l_extendedprice / l.l_quantity AS unit_price,
         l.l_extendedprice AS order_total,
         'USD' AS currency,
         o.o_orderstatus AS status,
         l.l_orderkey AS okey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

V_CATALOG = """
v_catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS brand, p_retailprice AS cost, p_size AS catalog_reorder_point
  FROM part)"""

ENRICHED = """
enriched AS (
  SELECT o.*, c.product_name, c.category, c.brand, c.cost, c.catalog_reorder_point,
         round((o.unit_price - c.cost) * o.quantity, 2) AS gross_margin
  FROM v_orders o LEFT JOIN v_catalog c ON o.product_id = c.product_id)"""

FACT = """
fact AS (
  SELECT order_id, CAST(event_ts AS DATE) AS order_date, event_ts, user_id, product_id, product_name,
         category, brand, store_id, channel, quantity, unit_price, order_total, gross_margin, status
  FROM enriched)"""

ORDERS_CTE = "WITH " + ",".join([V_ORDERS, V_CATALOG, ENRICHED, FACT])
# silver rows with an order key divisible by 47 are flagged invalid
VALID_ORDERS_CTE = ORDERS_CTE.replace("FROM v_orders o", "FROM (SELECT * FROM v_orders WHERE okey % 47 <> 0) o")

REVENUE_DAILY = """
revenue AS (
  SELECT order_date, category, channel, count(DISTINCT order_id) AS orders,
         CAST(sum(quantity) AS BIGINT) AS units_sold, round(sum(order_total), 2) AS revenue,
         round(sum(gross_margin), 2) AS gross_margin
  FROM fact GROUP BY order_date, category, channel)"""

TOP_PRODUCTS = """
top AS (
  SELECT product_id, product_name, category, brand, CAST(sum(quantity) AS BIGINT) AS units_sold,
         round(sum(order_total), 2) AS revenue, count(DISTINCT order_id) AS orders
  FROM fact GROUP BY product_id, product_name, category, brand)"""

V_INVENTORY = """
v_inventory AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS event_id,
         'inventory_update' AS event_type,
         l.l_shipdate AS event_ts,
         l.l_shipdate AS ingestion_ts,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         'SKU-' || CAST(l.l_partkey AS VARCHAR) AS sku,
         CAST(l.l_suppkey AS VARCHAR) AS store_id,
         CAST(trunc(l.l_quantity) AS INTEGER) AS on_hand,
         CAST(trunc(l.l_quantity) AS INTEGER) - l.l_linenumber AS available_to_promise,
         p.p_size AS reorder_point,
         CAST(trunc(l.l_quantity) AS INTEGER) - 25 AS change_quantity,
         'sale' AS reason
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

V_PRICING = """
v_pricing AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS event_id,
         'price_change' AS event_type, l.l_shipdate AS event_ts,
         CAST(l.l_partkey AS VARCHAR) AS product_id, 'SKU-' || CAST(l.l_partkey AS VARCHAR) AS sku,
         p.p_retailprice AS old_price, l.l_extendedprice / l.l_quantity AS new_price,
         'USD' AS currency, 'markdown' AS reason
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

LATEST_INV = """
latest AS (
  SELECT * EXCLUDE (rn),
         available_to_promise <= reorder_point AS is_low_inventory,
         CASE WHEN available_to_promise <= 0 THEN 'stockout'
              WHEN available_to_promise <= reorder_point THEN 'reorder'
              ELSE 'healthy' END AS inventory_risk_level
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id
                                     ORDER BY event_ts DESC, event_id DESC) AS rn
        FROM v_inventory) WHERE rn = 1)"""

INV_CTE = "WITH " + ",".join([V_INVENTORY, LATEST_INV])
VALID_INVENTORY = V_INVENTORY.replace("l.l_partkey = p.p_partkey)", "l.l_partkey = p.p_partkey WHERE l.l_orderkey % 47 <> 0)")
VALID_INV_CTE = "WITH " + ",".join([VALID_INVENTORY, LATEST_INV])

# Clickstream fixture: payload text as Spark's to_json writes it (no spaces, null fields omitted).
CLICK = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
         event_id % 19 = 0 AS is_trunc, event_id % 17 = 0 AS no_user, event_id % 23 = 0 AS bad_time
  FROM events),
click AS (
  SELECT *,
         '{"event_id":"' || CAST(event_id AS VARCHAR) || '","event_type":"' || event_type
           || '","event_ts":"' || (CASE WHEN bad_time THEN 'not-a-time' ELSE iso END)
           || '","ingestion_ts":"' || iso || '","session_id":"S' || CAST(user_id AS VARCHAR) || '"'
           || (CASE WHEN no_user THEN '' ELSE ',"user_id":"U' || CAST(user_id AS VARCHAR) || '"' END)
           || ',"product_id":"P' || CAST(event_id % 50 AS VARCHAR) || '","page":"p' || CAST(event_id % 5 AS VARCHAR)
           || '","device":"d' || CAST(event_id % 4 AS VARCHAR) || '","referrer":"direct"}' AS full_payload
  FROM ev),
parsed AS (
  SELECT event_id AS kafka_offset,
         CAST(event_id % 4 AS INTEGER) AS kafka_partition,
         CASE WHEN is_trunc THEN substr(full_payload, 1, 15) ELSE full_payload END AS payload,
         CASE WHEN is_trunc THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
         CASE WHEN is_trunc THEN NULL ELSE event_type END AS event_type,
         CASE WHEN is_trunc OR bad_time THEN NULL ELSE ts END AS event_ts,
         CASE WHEN is_trunc THEN NULL ELSE ts END AS ingestion_ts,
         CASE WHEN is_trunc THEN NULL ELSE 'S' || CAST(user_id AS VARCHAR) END AS session_id,
         CASE WHEN is_trunc OR no_user THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN is_trunc THEN NULL ELSE 'P' || CAST(event_id % 50 AS VARCHAR) END AS product_id,
         CAST(NULL AS VARCHAR) AS sku,
         CASE WHEN is_trunc THEN NULL ELSE 'p' || CAST(event_id % 5 AS VARCHAR) END AS page,
         CAST(NULL AS VARCHAR) AS search_term,
         CASE WHEN is_trunc THEN NULL ELSE 'd' || CAST(event_id % 4 AS VARCHAR) END AS device,
         CASE WHEN is_trunc THEN NULL ELSE 'direct' END AS referrer
  FROM click),
checked AS (
  SELECT *,
         concat_ws(',',
           CASE WHEN event_id IS NULL THEN 'event_id:null' END,
           CASE WHEN event_type IS NULL THEN 'event_type:null' END,
           CASE WHEN event_ts IS NULL THEN 'event_ts:null' END,
           CASE WHEN session_id IS NULL THEN 'session_id:null' END,
           CASE WHEN user_id IS NULL THEN 'user_id:null' END,
           CASE WHEN page IS NULL THEN 'page:null' END,
           CASE WHEN device IS NULL THEN 'device:null' END) AS _dq_errors,
         event_ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 60 MINUTE AS _dq_is_late
  FROM parsed)"""

CLICK_CTE = "WITH " + CLICK
SILVER_COLS = ("event_id, event_type, event_ts, ingestion_ts, session_id, user_id, product_id, sku, page, "
               "search_term, device, referrer, kafka_offset, kafka_partition")

# Order payload fixture corruption, by order key.
ORDER_STRICT = """
strict AS (
  SELECT * EXCLUDE (sku, order_total), event_id AS kafka_key,
         CASE WHEN okey % 59 <> 0 THEN sku END AS sku,
         CASE WHEN okey % 61 = 0 THEN 10.0::DOUBLE ELSE order_total END AS order_total,
         CASE WHEN okey % 53 = 0 THEN 'C' || order_id END AS coupon,
         concat_ws(',',
           CASE WHEN okey % 41 = 0 THEN 'user_id:expected_string' END,
           CASE WHEN okey % 29 = 0 THEN 'quantity:expected_int' END,
           CASE WHEN okey % 31 = 0 THEN 'unit_price:null' END,
           CASE WHEN okey % 37 = 0 THEN 'event_ts:invalid_timestamp' END) AS _strict_errors
  FROM v_orders)"""

STRICT_CTE = "WITH " + ",".join([V_ORDERS, ORDER_STRICT])

DATA_TEST_ROWS = """
      SELECT 'orders_gold' AS model, 'order_id' AS column_name, 'not_null' AS test,
             count(*) FILTER (WHERE order_id IS NULL) AS failures FROM fact
      UNION ALL SELECT 'orders_gold', 'order_total', 'not_null', count(*) FILTER (WHERE order_total IS NULL) FROM fact
      UNION ALL SELECT 'orders_gold', 'order_total', 'non_negative', count(*) FILTER (WHERE order_total < 0) FROM fact
      UNION ALL SELECT 'revenue_daily', 'order_date', 'not_null', count(*) FILTER (WHERE order_date IS NULL) FROM revenue
      UNION ALL SELECT 'revenue_daily', 'revenue', 'non_negative', count(*) FILTER (WHERE revenue < 0) FROM revenue
      UNION ALL SELECT 'top_products', 'product_id', 'not_null', count(*) FILTER (WHERE product_id IS NULL) FROM top
      UNION ALL SELECT 'top_products', 'revenue', 'non_negative', count(*) FILTER (WHERE revenue < 0) FROM top
      UNION ALL SELECT 'inventory_risk', 'inventory_risk_level', 'accepted_values',
             count(*) FILTER (WHERE inventory_risk_level IS NULL
                              OR inventory_risk_level NOT IN ('stockout', 'reorder', 'healthy')) FROM latest"""

_GOLD_ROLLUPS = "," + REVENUE_DAILY + "," + TOP_PRODUCTS + ","
DATA_TESTS = ORDERS_CTE + _GOLD_ROLLUPS + V_INVENTORY + "," + LATEST_INV + DATA_TEST_ROWS
VALID_DATA_TESTS = VALID_ORDERS_CTE + _GOLD_ROLLUPS + VALID_INVENTORY + "," + LATEST_INV + DATA_TEST_ROWS

# The copy that a batch dedupe keeps.
ONCE = """
once AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id, event_ts ORDER BY event_id) AS rn FROM v_orders)
  WHERE rn = 1)"""

# Faulty order payloads as silver sees them: quantity as text, no price and a bad time are nulls.
VALID_PAYLOADS = "okey % 29 <> 0 AND okey % 31 <> 0 AND okey % 37 <> 0"
DRAINED = "WITH " + ",".join([V_ORDERS, V_CATALOG, ENRICHED, V_INVENTORY, V_PRICING, CLICK]) + f""",
  good AS (SELECT * FROM v_orders WHERE {VALID_PAYLOADS}),
  good_keys AS (SELECT DISTINCT order_id, product_id, event_ts, channel FROM good)"""

ORACLES: dict[str, str] = {
    "catalog_scan": f"WITH {V_CATALOG} SELECT * FROM v_catalog",
    "catalog_csv_scan": f"WITH {V_CATALOG} SELECT * FROM v_catalog",

    "catalog_seed": f"""WITH {V_CATALOG}
      SELECT category, count(*) AS products, max(cost) AS max_cost,
             CAST(sum(catalog_reorder_point) AS BIGINT) AS reorder_points FROM v_catalog GROUP BY category""",

    "jsonl_orders": f"""WITH {V_ORDERS}
      SELECT * EXCLUDE (okey) REPLACE (strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_ts,
                                       strftime(ingestion_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingestion_ts) FROM v_orders""",

    "bronze_envelope": CLICK_CTE + """
      SELECT 'S' || CAST(e.user_id AS VARCHAR) AS kafka_key, p.payload, 'clickstream' AS kafka_topic,
             p.kafka_partition, p.kafka_offset, e.ts AS kafka_timestamp, 'clickstream' AS topic
      FROM parsed p JOIN ev e ON e.event_id = p.kafka_offset""",

    "parse_clickstream": CLICK_CTE + f" SELECT {SILVER_COLS} FROM parsed",

    "dq_errors": CLICK_CTE + " SELECT kafka_offset, _dq_errors, _dq_errors = '' AS _dq_is_valid FROM checked",

    "silver_clickstream": CLICK_CTE + f" SELECT {SILVER_COLS}, _dq_is_late FROM checked WHERE _dq_errors = ''",

    "quarantine_clickstream": CLICK_CTE + """
      SELECT kafka_offset, payload, event_ts, _dq_errors FROM checked WHERE _dq_errors <> ''""",

    "late_flag": CLICK_CTE + " SELECT kafka_offset, event_ts, _dq_is_late FROM checked",

    "dedupe_orders": "WITH " + V_ORDERS + """
      SELECT * EXCLUDE (okey, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id, product_id, event_ts ORDER BY event_id) AS rn
        FROM v_orders) WHERE rn = 1""",

    "enrich_orders": ORDERS_CTE + " SELECT * EXCLUDE (okey) FROM enriched",

    "stg_orders": VALID_ORDERS_CTE + """
      SELECT order_id, event_ts, order_date, user_id, product_id, product_name, category, brand, store_id,
             channel, quantity, unit_price, order_total, gross_margin, status FROM fact""",

    "orders_gold": ORDERS_CTE + " SELECT * FROM fact",

    "revenue_daily": ORDERS_CTE + "," + REVENUE_DAILY + " SELECT * FROM revenue",

    "top_products": ORDERS_CTE + "," + TOP_PRODUCTS + " SELECT * FROM top",

    "revenue_increment": ORDERS_CTE + """
      SELECT okey % 4 AS _batch_id, CAST(event_ts AS DATE) AS order_date, product_id, product_name, category,
             channel, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
             round(sum(order_total), 2) AS revenue, round(sum(gross_margin), 2) AS gross_margin
      FROM enriched GROUP BY ALL""",

    "orders_by_channel": ORDERS_CTE + " SELECT channel, count(DISTINCT order_id) AS orders FROM fact GROUP BY channel",

    "revenue_trend": ORDERS_CTE + "," + REVENUE_DAILY + """
      SELECT order_date, category, round(sum(revenue), 2) AS revenue, round(sum(gross_margin), 2) AS gross_margin
      FROM revenue GROUP BY order_date, category""",

    "top_products_table": ORDERS_CTE + "," + TOP_PRODUCTS + " SELECT product_name, category, units_sold, revenue FROM top",

    "stg_inventory": "WITH " + VALID_INVENTORY + """
      SELECT product_id, sku, store_id, event_ts, on_hand, available_to_promise, reorder_point, change_quantity,
             reason FROM v_inventory""",

    "inventory_latest": INV_CTE + " SELECT * FROM latest",

    "inventory_risk": INV_CTE + """
      SELECT product_id, sku, store_id, event_ts, on_hand, available_to_promise, reorder_point,
             inventory_risk_level FROM latest""",

    "inventory_alerts": INV_CTE + " SELECT * FROM latest WHERE inventory_risk_level <> 'healthy'",

    "low_inventory_table": INV_CTE + """
      SELECT product_id, store_id, available_to_promise, reorder_point, inventory_risk_level
      FROM latest WHERE inventory_risk_level <> 'healthy'""",

    # the sequential fold itself, one step per event, as a recursive query
    "stock_ledger": "WITH RECURSIVE " + V_INVENTORY + """,
      seq AS (
        SELECT event_id, product_id, store_id, event_ts, change_quantity, reorder_point,
               row_number() OVER (PARTITION BY product_id, store_id ORDER BY event_ts, event_id) AS rn
        FROM v_inventory),
      fold AS (
        SELECT product_id, store_id, rn, CAST(greatest(0, reorder_point + change_quantity) AS BIGINT) AS bal
        FROM seq WHERE rn = 1
        UNION ALL
        SELECT s.product_id, s.store_id, s.rn, CAST(greatest(0, f.bal + s.change_quantity) AS BIGINT)
        FROM fold f JOIN seq s ON s.product_id = f.product_id AND s.store_id = f.store_id AND s.rn = f.rn + 1)
      SELECT s.event_id, s.product_id, s.store_id, s.event_ts, s.change_quantity, f.bal AS ledger_on_hand
      FROM seq s JOIN fold f ON s.product_id = f.product_id AND s.store_id = f.store_id AND s.rn = f.rn""",

    "check_not_null": ORDERS_CTE + " SELECT * FROM fact WHERE category IS NULL",

    "check_non_negative": ORDERS_CTE + " SELECT * FROM fact WHERE gross_margin < 0",

    "check_accepted_values": ORDERS_CTE + """
      SELECT status, count(*) AS n_rows FROM fact
      WHERE status IS NULL OR status NOT IN ('F', 'O') GROUP BY status""",

    "data_tests": DATA_TESTS,
    "sql_model_tests": VALID_DATA_TESTS,
    "strict_type_errors": STRICT_CTE + """
      SELECT kafka_key, _strict_errors, _strict_errors = '' AS _strict_is_valid FROM strict""",

    "timestamp_errors": STRICT_CTE + """
      SELECT kafka_key, CASE WHEN okey % 37 = 0 THEN NULL ELSE event_ts END AS _event_time,
             CASE WHEN okey % 37 = 0 THEN 'event_ts:invalid_timestamp' END AS _time_error FROM strict""",

    "is_late": STRICT_CTE + """
      SELECT kafka_key,
             CASE WHEN okey % 37 = 0 THEN NULL
                  ELSE event_ts < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 120 MINUTE END AS _is_late
      FROM strict""",

    "event_fingerprint": "WITH " + V_ORDERS + """
      SELECT event_id,
             sha256('{"event_ts": "' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '", "order_id": "'
                    || order_id || '", "product_id": "' || product_id || '"}') AS fingerprint
      FROM v_orders""",

    "publish_gate": STRICT_CTE + """
      SELECT * EXCLUDE (okey, _strict_errors) REPLACE (
               sha256('{"event_id": "' || kafka_key || '"}') AS kafka_key,
               strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_ts,
               strftime(ingestion_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingestion_ts),
             'orders' AS topic, event_ts AS kafka_timestamp, CAST(order_total AS VARCHAR) AS total_text,
             concat_ws(',', 'channel', CASE WHEN coupon IS NOT NULL THEN 'coupon' END, 'currency', 'event_id', 'event_ts',
               'event_type', 'ingestion_ts', 'order_id', 'order_total', 'product_id', 'quantity',
               CASE WHEN sku IS NOT NULL THEN 'sku' END, 'status', 'store_id', 'unit_price', 'user_id') AS fields
      FROM strict WHERE _strict_errors = ''""",

    "stream_bronze": CLICK_CTE + """
      SELECT 'S' || CAST(e.user_id AS VARCHAR) AS kafka_key, p.payload, 'clickstream' AS kafka_topic,
             p.kafka_partition, p.kafka_offset, e.ts AS kafka_timestamp, 'clickstream' AS topic
      FROM parsed p JOIN ev e ON e.event_id = p.kafka_offset""",

    "stream_silver_clickstream": CLICK_CTE + """
      SELECT DISTINCT session_id, event_type, event_ts FROM checked WHERE _dq_errors = ''""",

    "stream_quarantine": CLICK_CTE + " SELECT kafka_offset, event_ts, _dq_errors FROM checked WHERE _dq_errors <> ''",

    "stream_silver_inventory": "WITH " + V_INVENTORY + " SELECT DISTINCT product_id, store_id, event_ts FROM v_inventory",
    "stream_silver_pricing": "WITH " + V_PRICING + " SELECT DISTINCT product_id, event_ts FROM v_pricing",

    "stream_topic_subset": """
      SELECT 'clickstream' AS topic, count(*) AS n_rows FROM events
      UNION ALL SELECT 'pricing', count(*) FROM lineitem JOIN part ON l_partkey = p_partkey""",

    "stream_gold_increment": "WITH " + ",".join([V_ORDERS, ONCE, V_CATALOG, ENRICHED.replace("v_orders o", "once o"), FACT]) + """
      SELECT event_ts < TIMESTAMP '1998-01-01' AS first_drain, order_date, product_id, product_name, category, channel,
             count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
             round(sum(order_total), 2) AS revenue, round(sum(gross_margin), 2) AS gross_margin
      FROM fact GROUP BY ALL""",

    "stream_watermark_drops": CLICK_CTE + """,
      valid AS (SELECT * FROM checked WHERE _dq_errors = ''),
      first AS (SELECT time_bucket(INTERVAL 1 MILLISECOND, max(event_ts)) - INTERVAL 60 MINUTE AS mark
                FROM valid WHERE kafka_offset % 2 = 0),
      judged AS (SELECT v.*, kafka_offset % 2 = 1 AND event_ts <= mark AS late FROM valid v, first)
      SELECT count(*) FILTER (late) AS rows_dropped,
             (SELECT count(*) FROM (SELECT DISTINCT session_id, event_type, event_ts FROM judged WHERE NOT late)) AS silver_rows
      FROM judged""",

    # one drain is batch 0; a deduping query runs a second, empty batch once its watermark has moved
    "layer_health": """
      WITH topics(t, shared) AS (VALUES ('orders', true), ('inventory', false), ('pricing', false), ('clickstream', false)),
      out AS (
        SELECT kind, layer, t AS "table", CASE WHEN layer = 'silver' THEN 2 ELSE 1 END AS commits,
               CASE WHEN layer = 'silver' THEN '1' ELSE '0' END AS latest_batch
        FROM topics, (VALUES ('table'), ('checkpoint')) k(kind), (VALUES ('bronze'), ('silver'), ('quarantine')) l(layer)
        WHERE NOT (shared AND layer = 'quarantine')
        UNION ALL SELECT 'table', 'quarantine', 'orders', 1, ''
        UNION ALL SELECT 'table', 'gold', 'orders_gold_incremental', 1, ''
        UNION ALL SELECT 'table', 'gold', 'revenue_daily_incremental', 1, '')
      SELECT * REPLACE (commits::BIGINT AS commits), TIMESTAMP '2024-01-15 00:00:00' AS checked_at FROM out""",

    "layer_contents": DRAINED + """
      SELECT 'bronze' AS layer, 'orders' AS "table", count(*) AS "rows", CAST(NULL AS TIMESTAMP) AS max_event_ts FROM v_orders
      UNION ALL SELECT 'bronze', 'inventory', count(*), NULL FROM v_inventory
      UNION ALL SELECT 'bronze', 'pricing', count(*), NULL FROM v_pricing
      UNION ALL SELECT 'bronze', 'clickstream', count(*), NULL FROM events
      UNION ALL SELECT 'silver', 'orders', count(*), max(event_ts) FROM good_keys
      UNION ALL SELECT 'silver', 'inventory', count(*), max(event_ts)
        FROM (SELECT DISTINCT product_id, store_id, event_ts FROM v_inventory)
      UNION ALL SELECT 'silver', 'pricing', count(*), max(event_ts) FROM (SELECT DISTINCT product_id, event_ts FROM v_pricing)
      UNION ALL SELECT 'silver', 'clickstream', count(*), max(event_ts)
        FROM (SELECT DISTINCT session_id, event_type, event_ts FROM checked WHERE _dq_errors = '')
      UNION ALL SELECT 'quarantine', 'orders', count(*), max(CASE WHEN okey % 37 <> 0 THEN event_ts END)
        FROM v_orders WHERE NOT (""" + VALID_PAYLOADS + """)
      UNION ALL SELECT 'quarantine', 'clickstream', count(*), max(event_ts) FROM checked WHERE _dq_errors <> ''
      UNION ALL SELECT 'gold', 'orders_gold_incremental', count(*), max(event_ts) FROM good_keys
      UNION ALL SELECT 'gold', 'revenue_daily_incremental', count(*), NULL
        FROM (SELECT DISTINCT CAST(event_ts AS DATE), product_id, channel FROM good_keys)""",

    "sql_revenue_daily": VALID_ORDERS_CTE + "," + REVENUE_DAILY + " SELECT * FROM revenue",

    "sql_inventory_risk": VALID_INV_CTE + """
      SELECT product_id, sku, store_id, event_ts, on_hand, available_to_promise, reorder_point,
             inventory_risk_level FROM latest""",

    "silver_pricing": "WITH " + V_PRICING + """
      SELECT event_id, event_type, event_ts, product_id, sku, old_price, new_price, currency, reason,
             event_ts < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 240 MINUTE AS _dq_is_late
      FROM (SELECT *, row_number() OVER (PARTITION BY product_id, event_ts ORDER BY event_id) AS rn FROM v_pricing)
      WHERE rn = 1""",

    "silver_inventory": "WITH " + V_INVENTORY + """
      SELECT event_id, event_ts, product_id, store_id, on_hand, available_to_promise, reorder_point,
             change_quantity, event_ts < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 180 MINUTE AS _dq_is_late
      FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id, event_ts ORDER BY event_id) AS rn
            FROM v_inventory)
      WHERE rn = 1""",

    "revenue_daily_ordered": ORDERS_CTE + "," + REVENUE_DAILY + " SELECT * FROM revenue ORDER BY order_date, category, channel",

    "stream_dedupe_orders": "WITH " + V_ORDERS + " SELECT DISTINCT order_id, product_id, event_ts FROM v_orders",

    "stream_shared_dedupe_orders": "WITH " + V_ORDERS + " SELECT DISTINCT order_id, product_id, event_ts FROM v_orders",

    "stream_collapsed_clickstream": CLICK_CTE + """
      SELECT DISTINCT session_id, event_type, event_ts FROM checked WHERE _dq_errors = ''""",

    "refresh_revenue_daily": VALID_ORDERS_CTE + "," + REVENUE_DAILY + " SELECT * FROM revenue",

    "refresh_inventory_risk": VALID_INV_CTE + """
      SELECT product_id, sku, store_id, event_ts, on_hand, available_to_promise, reorder_point,
             inventory_risk_level FROM latest""",

    "additive_revenue_daily": ORDERS_CTE + "," + REVENUE_DAILY + " SELECT * FROM revenue",

    "stream_additive_revenue": "WITH " + ",".join([V_ORDERS, ONCE, V_CATALOG, ENRICHED.replace("v_orders o", "once o"), FACT]) + """
      SELECT order_date, category, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
             round(sum(order_total), 2) AS revenue, round(sum(gross_margin), 2) AS gross_margin
      FROM fact GROUP BY order_date, category""",

    "stream_late_rows": CLICK_CTE + """,
      valid AS (SELECT * FROM checked WHERE _dq_errors = ''),
      first AS (SELECT max(event_ts) - INTERVAL 60 MINUTE AS mark FROM valid WHERE kafka_offset % 2 = 0),
      judged AS (SELECT v.*, kafka_offset % 2 = 1 AND event_ts <= mark AS late FROM valid v, first)
      SELECT session_id, event_type, event_ts, 1::BIGINT AS n_rows, 'silver' AS layer
      FROM (SELECT DISTINCT session_id, event_type, event_ts FROM judged WHERE NOT late)
      UNION ALL
      SELECT session_id, event_type, event_ts, count(*), 'late' FROM judged WHERE late GROUP BY ALL""",

    "stream_inventory_latest": INV_CTE + " SELECT * FROM latest",
}
ORACLES["stock_ledger_continued"] = ORACLES["stock_ledger"]
ORACLES["data_tests_observed"] = ORACLES["sql_model_tests"]
ORACLES["refresh_changed_days"] = ORACLES["refresh_revenue_daily"]
# an order of the first commit has no brand, of the first two no margin
ORACLES["evolving_orders"] = ORDERS_CTE + """
  SELECT * REPLACE (CASE WHEN CAST(store_id AS BIGINT) % 3 > 0 THEN brand END AS brand, CAST(quantity AS BIGINT) AS quantity,
                    CASE WHEN CAST(store_id AS BIGINT) % 3 = 2 THEN gross_margin END AS gross_margin) FROM fact"""
ORACLES["stream_state_rows"] = "WITH " + CLICK + "," + V_PRICING + """,
  keys AS (
    SELECT DISTINCT 'clickstream' AS t, event_ts, session_id AS a, event_type AS b, INTERVAL 60 MINUTE AS delay
    FROM checked WHERE _dq_errors = ''
    UNION ALL SELECT DISTINCT 'pricing', event_ts, product_id, '', INTERVAL 240 MINUTE FROM v_pricing),
  marks AS (SELECT t, time_bucket(INTERVAL 1 MILLISECOND, max(event_ts)) - any_value(delay) AS mark FROM keys GROUP BY t)
  SELECT 'silver' AS layer, t AS "table", 'dedupe' AS operator, count(*) FILTER (event_ts > mark) AS state_rows
  FROM keys JOIN marks USING (t) GROUP BY t"""
