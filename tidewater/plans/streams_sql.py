"""DuckDB oracles for ``plans.streams``: what the tables say without any stream."""

from tidewater.plans.clickstream_sql import SQL as CLICKSTREAM
from tidewater.plans.clickstream_sql import K, W
from tidewater.plans.oracle_base import SIMPLE_SQL, mavg, msum
from tidewater.plans.orders_sql import CHAIN
from tidewater.plans.orders_sql import SQL as ORDERS

# Purchases name two products (their own and that of key k mod 100 + 1); each named
# product is a row, and the order value stays with the first.
PRODUCT_ROWS = W + """,
names AS (SELECT p_name AS product_name, min(p_type) AS category FROM part GROUP BY 1),
listed AS (
  SELECT e.event_id, e.hour, e.revenue, p1.p_name AS n1, p2.p_name AS n2
  FROM enriched e LEFT JOIN part p1 ON p1.p_partkey = e.product_id LEFT JOIN part p2 ON p2.p_partkey = e.product_id % 100 + 1
  WHERE event_type = 'purchase'),
product_rows AS (
  SELECT product_category, product_name, hour, 0 AS is_purchase, is_add_to_cart, 0.0 AS revenue
  FROM enriched WHERE event_type <> 'purchase' AND product_name IS NOT NULL
  UNION ALL
  SELECT n.category, l.n1, l.hour, 1, 0, l.revenue FROM listed l JOIN names n ON n.product_name = l.n1
  UNION ALL
  SELECT n.category, l.n2, l.hour, 1, 0, CASE WHEN l.n1 IS NULL THEN l.revenue ELSE 0.0 END
  FROM listed l JOIN names n ON n.product_name = l.n2)"""

# The watermark when the data ends (milliseconds), and the events planted to be late.
MARK = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)"
LATE = "event_id % 97 = 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL 10 DAY"

SQL = {
    "stream_business_metrics": W + f"""
SELECT event_type, hour, minute, COUNT(*) AS event_count, COUNT(*) AS events_per_minute, {msum('revenue')} AS total_revenue,
       COUNT(DISTINCT user_id) AS unique_users, COUNT(DISTINCT session_id) AS active_sessions, {mavg('revenue')} AS avg_order_value
FROM enriched GROUP BY event_type, hour, minute""",

    "stream_user_activity": W + f"""
SELECT CAST(user_id AS INTEGER) AS user_id, user_segment, age_group, COUNT(*) AS total_events,
       CAST(SUM(is_purchase) AS BIGINT) AS purchase_count, CAST(SUM(is_add_to_cart) AS BIGINT) AS add_to_cart_count,
       {msum('revenue')} AS daily_revenue, COUNT(DISTINCT session_id) AS unique_sessions,
       arg_min(country, (event_timestamp, event_id)) AS country
FROM enriched GROUP BY user_id, user_segment, age_group""",

    "stream_product_performance": PRODUCT_ROWS + f"""
SELECT product_category, product_name, hour, COUNT(*) AS view_count, CAST(SUM(is_add_to_cart) AS BIGINT) AS cart_adds,
       CAST(SUM(is_purchase) AS BIGINT) AS purchases, {msum('revenue')} AS revenue_generated
FROM product_rows GROUP BY product_category, product_name, hour""",

    "stream_geographic_metrics": W + f"""
SELECT country, hour, COUNT(*) AS event_count, CAST(SUM(is_purchase) AS BIGINT) AS purchases, {msum('revenue')} AS revenue,
       COUNT(DISTINCT user_id) AS unique_users
FROM enriched WHERE country IS NOT NULL GROUP BY country, hour""",

    "stream_platform_metrics": W + f"""
SELECT device_type, browser, operating_system, hour, COUNT(*) AS event_count, {msum('revenue')} AS revenue,
       COUNT(DISTINCT user_id) AS unique_users, {mavg("CASE WHEN event_type = 'purchase' THEN revenue END")} AS avg_purchase_value
FROM enriched GROUP BY device_type, browser, operating_system, hour""",

    "stream_enriched_events": W + """
SELECT e.event_id, e.event_type, e.event_timestamp, e.hour, e.minute, e.is_purchase, e.is_add_to_cart, e.revenue,
       CASE WHEN e.event_type = 'purchase'
            THEN CAST(p1.p_name IS NOT NULL AS INTEGER) + CAST(p2.p_name IS NOT NULL AS INTEGER) ELSE 0 END AS product_count,
       e.user_segment, e.age_group
FROM enriched e LEFT JOIN part p1 ON p1.p_partkey = e.product_id LEFT JOIN part p2 ON p2.p_partkey = e.product_id % 100 + 1""",

    "stream_quarantine": """
SELECT CASE WHEN event_type <> 'purchase' THEN 'not_a_purchase' WHEN value < 50 THEN 'small' ELSE 'kept' END AS reason,
       COUNT(*) AS rows FROM events GROUP BY 1""",

    "stream_sliding_kpis": "WITH " + SIMPLE_SQL + f"""
SELECT time_bucket(INTERVAL 1 MINUTE, timestamp) - i * INTERVAL 1 MINUTE AS window_start,
       time_bucket(INTERVAL 1 MINUTE, timestamp) - i * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS window_end,
       action, location, COUNT(*) AS event_count, {msum('amount')} AS total_amount
FROM simple, range(0, 5) r(i) GROUP BY 1, 2, action, location""",

    "stream_tumbling_kpis": "WITH " + SIMPLE_SQL + f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, timestamp) AS window_start, time_bucket(INTERVAL 1 HOUR, timestamp) + INTERVAL 1 HOUR AS window_end,
         action, COUNT(*) AS event_count, {msum('amount')} AS total_amount
  FROM simple GROUP BY 1, 2, action) WHERE window_end <= {MARK}""",

    "stream_gap_sessions": f"SELECT * FROM ({CLICKSTREAM['gap_sessions']}) t WHERE session_end <= {MARK}",

    "stream_dedup": f"""
SELECT event_type AS action, COUNT(*) AS rows, COUNT(DISTINCT event_id) AS events FROM events WHERE NOT ({LATE}) GROUP BY 1""",

    "stream_progress": f"""
SELECT 2 * COUNT(*) AS rows_read, 2 * COUNT(*) FILTER (WHERE {LATE}) AS late_rows, COUNT(*) FILTER (WHERE NOT ({LATE})) AS kept_rows,
       2 * COUNT(*) FILTER (WHERE {LATE}) AS late_stored, 2 * COUNT(*) FILTER (WHERE NOT ({LATE})) AS on_time_stored
FROM events""",

    "stream_late_events": f"SELECT event_id, CAST(2 AS BIGINT) AS deliveries FROM events WHERE {LATE}",

    "stream_restart": f"""
SELECT 'article' AS kind, CAST({K} AS VARCHAR) AS id, COUNT(*) AS value FROM events WHERE {K} IS NOT NULL GROUP BY 2
UNION ALL SELECT 'raw', strftime(ts, '%Y-%m-%d'), COUNT(*) FROM events GROUP BY 2
UNION ALL SELECT 'history', strftime(ts, '%Y-%m-%d'), COUNT(*) FROM events GROUP BY 2""",

    "stream_article_views": CLICKSTREAM["article_views"],

    "stream_page_history": """
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, COUNT(*) AS raw_rows, COUNT(*) AS history_rows FROM events GROUP BY 1""",

    "ingest_model": CLICKSTREAM["daily_action_counts"],

    "ingest_snapshot": "SELECT COUNT(*) AS rows, COUNT(DISTINCT event_id) AS events, COUNT(*) AS stamped FROM events",

    "stream_chain_stock": "SELECT product_id, available FROM (" + ORDERS["inventory_snapshot"] + ") t",

    "stream_chain_log": CHAIN + "SELECT order_id, step, event_type, amount, reason FROM log",

    "stream_order_status": ORDERS["order_status"],

    "stream_status_rejects": CHAIN + """
SELECT CASE order_id % 50 WHEN 0 THEN 'SHIPMENT_CREATED' ELSE 'PAYMENT_COMPLETED' END AS event_type,
       CASE order_id % 50 WHEN 0 THEN 'unknown or closed order' ELSE 'PAYMENT_COMPLETED after ORDER_CREATED' END AS reason,
       COUNT(*) AS events
FROM log WHERE event_type = 'ORDER_CREATED' AND order_id % 50 < 2 GROUP BY 1, 2""",

    "stream_state_rows": f"""
SELECT 'sessions' AS state, COUNT(*) AS rows FROM ({CLICKSTREAM['gap_sessions']}) t WHERE session_end > {MARK}
UNION ALL SELECT 'orders', 0""",

    "csv_round_trip": "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer",

    "zones": "SELECT p_partkey, upper(p_name) AS p_name, p_type FROM part",

    "published_events": CHAIN + """
SELECT CAST(order_id AS VARCHAR) AS key, 'order-events' AS topic, order_id, step, event_type FROM log""",

    "replayed_upserts": f"""
SELECT 'article' AS kind, {K} AS id, COUNT(*) AS value FROM events WHERE {K} IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'user', user_id, COALESCE(MIN(event_id) FILTER (WHERE event_id % 2 = 0), MIN(event_id)) FROM events GROUP BY 2""",

    "landed_documents": """
SELECT CAST(c_custkey // 250 AS INTEGER) AS doc,
       CASE WHEN (c_custkey // 250) % 5 = 2 THEN 0 ELSE COUNT(*) END AS customers,
       CASE WHEN (c_custkey // 250) % 5 = 2 THEN 0 ELSE COUNT(c_name) END AS names,
       CASE WHEN (c_custkey // 250) % 5 = 2 THEN 0.0 ELSE CAST(SUM(CAST(c_acctbal AS DECIMAL(15,2))) AS DOUBLE) END AS balance,
       (c_custkey // 250) % 5 = 2 AS corrupt
FROM customer GROUP BY c_custkey // 250""",

    "catalog_model": CLICKSTREAM["daily_action_counts"],

    "processing_stamps": "SELECT event_type, COUNT(*) AS stamped, COUNT(*) AS within_run FROM events GROUP BY 1",
}
