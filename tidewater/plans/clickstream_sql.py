"""DuckDB oracles for ``plans.clickstream`` (same column names and types)."""

from tidewater.plans.oracle_base import RICH_SQL, SIMPLE_SQL, mavg, msum, rate

W = "WITH " + RICH_SQL
WS = "WITH " + SIMPLE_SQL
K = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"

SQL = {
    "business_metrics": W + f"""
SELECT event_type, hour, minute, COUNT(event_id) AS event_count,
       {msum('revenue')} AS total_revenue, COUNT(DISTINCT user_id) AS unique_users,
       {mavg('revenue')} AS avg_order_value, COUNT(DISTINCT session_id) AS active_sessions,
       COUNT(event_id) AS events_per_minute, {msum('revenue')} AS revenue_per_minute
FROM enriched GROUP BY event_type, hour, minute""",

    "business_metrics_by_date": W + f"""
SELECT CAST(date AS TIMESTAMP) AS date, event_type, hour, minute, COUNT(event_id) AS event_count,
       {msum('revenue')} AS total_revenue, COUNT(DISTINCT user_id) AS unique_users,
       {mavg('revenue')} AS avg_order_value, COUNT(DISTINCT session_id) AS active_sessions,
       COUNT(event_id) AS events_per_minute, {msum('revenue')} AS revenue_per_minute
FROM enriched GROUP BY enriched.date, event_type, hour, minute""",

    "user_activity": W + f"""
SELECT user_id, CAST(date AS TIMESTAMP) AS date, user_segment, age_group, COUNT(event_id) AS total_events,
       CAST(SUM(is_purchase) AS BIGINT) AS purchase_count,
       CAST(SUM(is_add_to_cart) AS BIGINT) AS add_to_cart_count,
       {msum('revenue')} AS daily_revenue, COUNT(DISTINCT session_id) AS unique_sessions,
       arg_min(country, (event_timestamp, event_id)) AS country
FROM enriched GROUP BY user_id, enriched.date, user_segment, age_group""",

    "product_performance": W + f"""
SELECT *, {rate('purchases', 'view_count')} AS conversion_rate,
       {rate('purchases', 'cart_adds')} AS cart_to_purchase_rate
FROM (
  SELECT product_category, product_name, hour, COUNT(event_id) AS view_count,
         CAST(SUM(is_add_to_cart) AS BIGINT) AS cart_adds,
         CAST(SUM(is_purchase) AS BIGINT) AS purchases,
         {msum('revenue')} AS revenue_generated, {mavg('product_price')} AS avg_price
  FROM enriched WHERE product_name IS NOT NULL
  GROUP BY product_category, product_name, hour) t""",

    "geographic_metrics": W + f"""
SELECT country, hour, COUNT(event_id) AS event_count, {msum('revenue')} AS revenue,
       COUNT(DISTINCT user_id) AS unique_users, CAST(SUM(is_purchase) AS BIGINT) AS purchases
FROM enriched GROUP BY country, hour""",

    "platform_metrics": W + f"""
SELECT device_type, browser, operating_system, hour, COUNT(event_id) AS event_count,
       {msum('revenue')} AS revenue, COUNT(DISTINCT user_id) AS unique_users,
       {mavg("CASE WHEN event_type = 'purchase' THEN revenue END")} AS avg_purchase_value
FROM enriched GROUP BY device_type, browser, operating_system, hour""",

    "batch_summary": W + f"""
SELECT COUNT(DISTINCT user_id) AS users, COUNT(*) AS events,
       COALESCE({msum('revenue')}, 0.0) AS revenue
FROM enriched""",

    "segments_and_bands": W + """
SELECT event_id, user_id, CAST(date AS TIMESTAMP) AS date, hour, minute, user_segment, age_group, is_purchase,
       is_add_to_cart, revenue, product_count, device_type, browser, operating_system
FROM enriched""",

    "dashboard_last_hour": W + f"""
SELECT date_trunc('minute', event_timestamp) AS minute_window, COUNT(*) AS activity_rows,
       CAST(SUM(is_purchase) AS BIGINT) AS total_purchases, {msum('revenue')} AS total_revenue,
       COUNT(DISTINCT user_id) AS active_users
FROM enriched
WHERE event_timestamp >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
  AND event_timestamp <= (SELECT max(ts) FROM events)
GROUP BY 1""",

    "daily_action_counts": """
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day,
       COUNT(*) FILTER (WHERE event_type = 'view') AS views,
       COUNT(*) FILTER (WHERE event_type = 'click') AS carts,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM events GROUP BY 1 ORDER BY 1""",

    "article_views": f"""
SELECT {K} AS article_id, COUNT(*) AS views
FROM events WHERE {K} IS NOT NULL GROUP BY 1""",

    "daily_article_views": f"""
SELECT {K} AS article_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, COUNT(*) AS daily_views
FROM events WHERE {K} IS NOT NULL GROUP BY 1, 2""",

    "top_articles": f"""
SELECT {K} AS article_id, COUNT(*) AS views
FROM events WHERE {K} IS NOT NULL GROUP BY 1 ORDER BY views DESC, article_id ASC LIMIT 10""",

    "daily_sales_union": f"""
WITH combined AS (
  SELECT o_orderkey AS sale_id, o_orderdate AS date, o_totalprice AS sales_amount FROM orders
  UNION ALL BY NAME
  SELECT c_custkey, c_name FROM customer)
SELECT CAST(CAST(date AS DATE) AS TIMESTAMP) AS date, COALESCE({msum('sales_amount')}, 0.0) AS daily_sales
FROM combined WHERE date IS NOT NULL GROUP BY 1""",

    "revenue_by_hour": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS orders, {msum('value')} AS revenue
FROM events WHERE event_type = 'purchase' GROUP BY 1""",

    "sliding_kpis": WS + f"""
SELECT time_bucket(INTERVAL 1 MINUTE, timestamp) - i * INTERVAL 1 MINUTE AS window_start,
       time_bucket(INTERVAL 1 MINUTE, timestamp) - i * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS window_end,
       action, location, COUNT(*) AS event_count, {msum('amount')} AS total_amount,
       COUNT(DISTINCT user_id) AS unique_users
FROM simple, range(0, 5) r(i)
GROUP BY 1, 2, action, location""",

    "tumbling_kpis": WS + f"""
SELECT time_bucket(INTERVAL 1 MINUTE, timestamp) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, timestamp) + INTERVAL 1 MINUTE AS window_end,
       action, COUNT(*) AS event_count, {msum('amount')} AS total_amount
FROM simple GROUP BY 1, 2, action""",

    "session_rollup": WS + f"""
SELECT session_id, min(user_id) AS user_id, min(timestamp) AS start_time,
       max(timestamp) AS end_time, COUNT(*) AS total_events, {msum('amount')} AS total_amount
FROM simple GROUP BY session_id""",

    "gap_sessions": WS + f""",
marked AS (
  SELECT *, CASE WHEN lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp) IS NULL
                   OR timestamp - lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp)
                      > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_session
  FROM simple),
numbered AS (
  SELECT *, SUM(new_session) OVER (PARTITION BY user_id ORDER BY timestamp
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM marked)
SELECT user_id, min(timestamp) AS session_start, max(timestamp) + INTERVAL 30 MINUTE AS session_end,
       COUNT(*) AS total_events, {msum('amount')} AS total_amount
FROM numbered GROUP BY user_id, sid""",

    "approx_users_bound": """
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, COUNT(DISTINCT user_id) AS exact,
       true AS direct_near, true AS merged_near
FROM events GROUP BY 1, 2""",

    "union_rows": """
SELECT o_orderkey AS sale_id, o_orderdate AS date, o_totalprice AS sales_amount,
       CAST(NULL AS BIGINT) AS c_custkey, CAST(NULL AS VARCHAR) AS c_name FROM orders
UNION ALL
SELECT NULL, NULL, NULL, c_custkey, c_name FROM customer""",

    "routed_events": """
SELECT event_id, user_id AS customer_id, event_type AS action,
       CASE WHEN event_type = 'purchase' AND value IS NOT NULL THEN value ELSE 0.0 END AS value
FROM events WHERE event_type = 'purchase' OR event_type = 'click'""",

    "product_event_count": f"""
SELECT COUNT(*) AS events FROM events
WHERE {K} IS NOT NULL AND user_id IS NOT NULL AND event_type IN ('view', 'click', 'purchase')""",

    "event_preview": "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5",

    "epoch_events": """
SELECT event_id, ts AS event_timestamp, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events""",

    "event_table_checks": """
SELECT 'column_exists(' || c || ')' AS "check",
       EXISTS (SELECT 1 FROM (DESCRIBE events) d WHERE d.column_name = c) AS passed
FROM (VALUES ('event_id'), ('user_id'), ('ts'), ('no_such_column')) v(c)
UNION ALL SELECT 'row_count>=1', COUNT(*) >= 1 FROM events""",

    "handled_events": f"""
SELECT 'spent' AS handler, user_id, {msum('value')} AS total, true AS agree
FROM events WHERE event_type = 'purchase' GROUP BY user_id
UNION ALL
SELECT 'seen', user_id, CAST(COUNT(*) AS DOUBLE), true FROM events WHERE event_type = 'view' GROUP BY user_id""",
}
