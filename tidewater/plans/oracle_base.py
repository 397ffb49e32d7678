"""DuckDB text for the test-data mapping (mirrors ``plans.testdata``)."""

PROFILES_SQL = """
profiles AS (
  SELECT c.c_custkey AS user_id, c.c_name AS name,
         CAST(18 + c.c_custkey % 53 AS INTEGER) AS age,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'bronze' WHEN 'BUILDING' THEN 'silver'
              WHEN 'FURNITURE' THEN 'gold' WHEN 'HOUSEHOLD' THEN 'platinum'
              WHEN 'MACHINERY' THEN 'bronze' END AS loyalty_tier,
         n.n_name AS country, r.r_name AS region
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RICH_SQL = PROFILES_SQL + """,
ev AS (
  SELECT e.*, TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         e.event_type IN ('view', 'click', 'purchase') AS is_product
  FROM events e
),
rich AS (
  SELECT ev.event_id, ev.user_id, ev.event_type, ev.ts AS event_timestamp,
         CAST(ev.ts AS DATE) AS date, CAST(hour(ev.ts) AS INTEGER) AS hour,
         CAST(minute(ev.ts) AS INTEGER) AS minute,
         'session_' || CAST(ev.user_id AS VARCHAR) || '_' || strftime(ev.ts, '%Y%m%d') AS session_id,
         CASE WHEN ev.event_type = 'purchase' THEN ev.value END AS order_value,
         CASE WHEN ev.event_type = 'purchase' AND p.p_name IS NOT NULL THEN 1 ELSE 0 END AS product_count,
         pr.name, pr.age, pr.loyalty_tier, pr.country, pr.region,
         (['mobile', 'desktop', 'tablet'])[ev.user_id % 3 + 1] AS device_type,
         (['chrome', 'firefox', 'safari', 'edge'])[ev.user_id % 4 + 1] AS browser,
         (['windows', 'macos', 'linux', 'ios', 'android'])[ev.user_id % 5 + 1] AS operating_system,
         CASE WHEN ev.is_product THEN ev.k END AS product_id,
         CASE WHEN ev.is_product THEN p.p_name END AS product_name,
         CASE WHEN ev.is_product THEN p.p_type END AS product_category,
         CASE WHEN ev.is_product THEN p.p_retailprice END AS product_price
  FROM ev
  LEFT JOIN profiles pr ON pr.user_id = ev.user_id
  LEFT JOIN part p ON p.p_partkey = ev.k
),
enriched AS (
  SELECT *,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_add_to_cart,
         COALESCE(order_value, 0.0) AS revenue,
         CASE WHEN loyalty_tier IN ('gold', 'platinum') THEN 'premium'
              WHEN loyalty_tier = 'silver' THEN 'medium' ELSE 'basic' END AS user_segment,
         CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
              WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_group
  FROM rich
)"""

SIMPLE_SQL = PROFILES_SQL + """,
simple AS (
  SELECT e.event_id, e.user_id, TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id,
         e.event_type AS action, e.ts AS timestamp,
         'session_' || CAST(e.user_id AS VARCHAR) || '_' || strftime(e.ts, '%Y%m%d') AS session_id,
         CASE WHEN e.event_type = 'purchase' THEN e.value ELSE 0.0 END AS amount,
         (['mobile', 'desktop', 'tablet'])[e.user_id % 3 + 1] AS device,
         pr.region AS location
  FROM events e LEFT JOIN profiles pr ON pr.user_id = e.user_id
)"""


def msum(expr: str) -> str:
    """Exact money sum returned as double (matches ``money_sum``)."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(15,2))) AS DOUBLE)"


def mavg(expr: str) -> str:
    """Exact money average (matches ``money_avg``)."""
    return (f"CASE WHEN COUNT({expr}) = 0 THEN NULL ELSE "
            f"CAST(SUM(CAST({expr} AS DECIMAL(15,2))) AS DOUBLE) / COUNT({expr}) END")


def rate(num: str, den: str) -> str:
    return f"CASE WHEN {den} = 0 OR {den} IS NULL THEN NULL ELSE CAST({num} AS DOUBLE) / {den} END"
