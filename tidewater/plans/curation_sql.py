"""DuckDB oracles for ``plans.curation``."""

K = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"

SQL = {
    "clean_dropna": f"""
SELECT * FROM (
  SELECT e.event_id AS id, p.p_name AS name,
         CASE WHEN e.event_type = 'purchase' THEN e.value END AS value, e.ts AS timestamp
  FROM events e LEFT JOIN part p ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT))
WHERE id IS NOT NULL AND name IS NOT NULL AND value IS NOT NULL AND timestamp IS NOT NULL""",

    "curated_upper": """
SELECT p_partkey AS id, upper(p_name) AS name, p_type AS category FROM part""",

    "quality_report": """
WITH a AS (SELECT user_id, CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS action,
                  ts AS processed_at FROM events),
c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE user_id IS NULL) AS u0,
             COUNT(*) FILTER (WHERE action IS NOT NULL AND action NOT IN ('view', 'purchase', 'cart')) AS u1,
             COUNT(*) FILTER (WHERE processed_at IS NULL) AS u2 FROM a)
SELECT 'expect_column_values_to_not_be_null(user_id)' AS rule, 'user_id' AS column_name,
       n AS element_count, u0 AS unexpected_count, u0 = 0 AS success FROM c
UNION ALL
SELECT 'expect_column_values_to_be_in_set(action)', 'action', n, u1, u1 = 0 FROM c
UNION ALL
SELECT 'expect_column_values_to_not_be_null(processed_at)', 'processed_at', n, u2, u2 = 0 FROM c""",

    "quarantine_split": """
SELECT event_id, CASE WHEN reason IS NULL THEN 'good' ELSE 'quarantine' END AS status, reason
FROM (
  SELECT event_id,
         CASE WHEN user_id IS NULL THEN 'missing_user'
              WHEN ts IS NULL THEN 'bad_timestamp'
              WHEN json_valid(props) IS NOT TRUE OR json_type(props) <> 'OBJECT' THEN 'malformed_props'
              WHEN event_type IS NOT NULL AND event_type NOT IN
                   ('view', 'click', 'purchase', 'add_to_cart', 'remove_from_cart') THEN 'unknown_event_type'
              WHEN value < 0 THEN 'negative_amount' END AS reason
  FROM events) t""",

    "dedup_first": """
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts
FROM events GROUP BY user_id, event_type""",

    "insert_if_absent": """
WITH target AS (SELECT event_id, user_id, event_type, ts FROM events
                WHERE ts < TIMESTAMP '2024-01-16'),
batch AS (SELECT event_id, user_id, event_type, ts FROM events WHERE ts >= TIMESTAMP '2024-01-09'),
first_in_batch AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1)
SELECT * FROM target
UNION ALL
SELECT * FROM first_in_batch b WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.event_id = b.event_id)""",

    "upsert_counts": f"""
WITH pv AS (SELECT {K} AS article_id, ts FROM events WHERE {K} IS NOT NULL),
old AS (SELECT article_id, COUNT(*) AS daily_views, max(ts) AS last_updated FROM pv
        WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
new AS (SELECT article_id, COUNT(*) AS daily_views, max(ts) AS last_updated FROM pv
        WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1)
SELECT article_id, CAST(SUM(daily_views) AS BIGINT) AS daily_views, max(last_updated) AS last_updated
FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY article_id""",
}
