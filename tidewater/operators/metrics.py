"""Clickstream metric tables.

Every aggregate is one ``groupBy().agg()`` so Catalyst plans a partial
(map-side) aggregate, one shuffle on the group keys and a final aggregate.
Money is summed as decimal(15,2) and returned as double: exact, so the
result does not depend on partitioning or row order.  ``exact=False``
swaps exact distinct counts for HyperLogLog++ (``approx_count_distinct``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import age_group, money, money_avg, money_sum, safe_rate, user_segment


def distinct_count(c: str, exact: bool = True, rsd: float = 0.05) -> Column:
    return F.count_distinct(F.col(c)) if exact else F.approx_count_distinct(c, rsd)


def user_activity(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per user, date, segment and age group (A1).  Country is the one of the
    user's earliest event (deterministic, unlike ``first``)."""
    return df.groupBy("user_id", "date", "user_segment", "age_group").agg(
        F.count("event_id").alias("total_events"),
        F.sum("is_purchase").alias("purchase_count"),
        F.sum("is_add_to_cart").alias("add_to_cart_count"),
        money_sum("revenue").alias("daily_revenue"),
        distinct_count("session_id", exact).alias("unique_sessions"),
        F.min_by(F.col("user_profile.location.country"),
                 F.struct("event_timestamp", "event_id")).alias("country"),
    )


def _hourly(keys, with_date: bool):
    """Hour-level group keys; ``with_date`` adds the date so days do not mix."""
    return (["date"] if with_date else []) + list(keys)


def business_metrics(df: DataFrame, exact: bool = True, with_date: bool = False) -> DataFrame:
    """Per event type, hour and minute (A2, with P20 aliases).

    Events are first combined per user and session, so the distinct counts copy
    those rows and not the events.
    """
    keys = _hourly(["event_type", "hour", "minute"], with_date)
    visits = df.groupBy(*keys, "user_id", "session_id").agg(
        F.count("event_id").alias("n"), F.sum(money("revenue")).alias("rev"), F.count("revenue").alias("paid"))
    revenue = F.sum("rev").cast("double")
    return (visits.groupBy(*keys).agg(
        F.sum("n").alias("event_count"),
        revenue.alias("total_revenue"),
        distinct_count("user_id", exact).alias("unique_users"),
        F.when(F.sum("paid") > 0, revenue / F.sum("paid")).alias("avg_order_value"),
        F.count_distinct("session_id").alias("active_sessions"),
    ).withColumn("events_per_minute", F.col("event_count"))
     .withColumn("revenue_per_minute", F.col("total_revenue")))


def product_performance(df: DataFrame, with_date: bool = False) -> DataFrame:
    """Per category, product and hour, over events that name a product.

    ``view_count`` counts every event with a product, as the reference does.
    """
    return (df.filter(F.col("product_name").isNotNull())
            .groupBy(*_hourly(["product_category", "product_name", "hour"], with_date)).agg(
                F.count("event_id").alias("view_count"),
                F.sum("is_add_to_cart").alias("cart_adds"),
                F.sum("is_purchase").alias("purchases"),
                money_sum("revenue").alias("revenue_generated"),
                money_avg("product_price").alias("avg_price"))
            .withColumn("conversion_rate", safe_rate("purchases", "view_count"))
            .withColumn("cart_to_purchase_rate", safe_rate("purchases", "cart_adds")))


def geographic_metrics(df: DataFrame, exact: bool = True, with_date: bool = False) -> DataFrame:
    """Per country and hour (A4)."""
    keys = _hourly([F.col("user_profile.location.country").alias("country"), "hour"], with_date)
    return df.groupBy(*keys).agg(
        F.count("event_id").alias("event_count"),
        money_sum("revenue").alias("revenue"),
        distinct_count("user_id", exact).alias("unique_users"),
        F.sum("is_purchase").alias("purchases"),
    )


def platform_metrics(df: DataFrame, exact: bool = True, with_date: bool = False) -> DataFrame:
    """Per device, browser, OS and hour; average value of purchases only (A5)."""
    purchase_rev = F.when(F.col("event_type") == "purchase", F.col("revenue"))
    keys = _hourly(["device_type", "browser", "operating_system", "hour"], with_date)
    return df.groupBy(*keys).agg(
        F.count("event_id").alias("event_count"),
        money_sum("revenue").alias("revenue"),
        distinct_count("user_id", exact).alias("unique_users"),
        money_avg(purchase_rev).alias("avg_purchase_value"),
    )


def user_sketches(df: DataFrame, keys, column: str = "user_id", lg_k: int = 12) -> DataFrame:
    """Distinct ``column`` per group as a mergeable HLL sketch (A11 across batches).

    Distinct counts of separate micro-batches cannot be added; sketches can:
    store ``users_sketch`` with each batch's metric row and combine them with
    ``merge_user_sketches``.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_k).alias("users_sketch"))


def merge_user_sketches(sketch_rows: DataFrame, keys) -> DataFrame:
    """Union the stored sketches per group and estimate the distinct count."""
    return (sketch_rows.groupBy(*keys).agg(F.hll_union_agg("users_sketch").alias("users_sketch"))
            .withColumn("unique_users", F.hll_sketch_estimate("users_sketch")))


#: What the streamed metric tables need beside their rows to be exact over batches:
#: group columns, distinct integer ids, distinct other keys, averaged value (SQL).
EXACT = {
    "user_activity_detailed": (["user_id", "user_segment", "age_group"], None, "session_id", None),
    "business_metrics_realtime": (["event_type", "hour", "minute"], "user_id", "session_id", "revenue"),
    "geographic_analytics": (["country", "hour"], "user_id", None, None),
    "platform_analytics": (["device_type", "browser", "operating_system", "hour"], "user_id", None,
                           "CASE WHEN event_type = 'purchase' THEN revenue END"),
}


def group_name(keys) -> Column:
    """A group's keys as one string, so that parts of several metrics share a table."""
    return F.to_json(F.struct(*keys)).alias("group")


def _groups(df: DataFrame, name: str):
    keys, users, members, value = EXACT[name]
    cols = [F.col("user_profile.location.country").alias("country") if k == "country" else F.col(k) for k in keys]
    return df.withColumn("group", group_name(cols)).withColumn("metric", F.lit(name)), users, members, value


def member_bitmaps(df: DataFrame) -> DataFrame:
    """Distinct integer ids per metric and group as bitmaps (A12 across batches): 32,768
    ids a row, combined map-side, and mergeable, so the count over any number of batches
    is exact."""
    out = None
    for name in EXACT:
        grouped, users, _, _ = _groups(df, name)
        if users:
            part = grouped.filter(F.col(users).isNotNull()).groupBy(
                "metric", "group", F.bitmap_bucket_number(F.col(users).cast("bigint")).alias("bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(F.col(users).cast("bigint"))).alias("bits"))
            out = part if out is None else out.unionByName(part)
    return out


def distinct_members(df: DataFrame) -> DataFrame:
    """Distinct keys that are no integers, per metric and group: one row each."""
    out = None
    for name in EXACT:
        grouped, _, members, _ = _groups(df, name)
        if members:
            part = grouped.select("metric", "group", F.col(members).alias("member")).filter("member IS NOT NULL").distinct()
            out = part if out is None else out.unionByName(part)
    return out


def value_sums(df: DataFrame) -> DataFrame:
    """Sum and count of each metric's averaged value per group."""
    out = None
    for name in EXACT:
        grouped, _, _, value = _groups(df, name)
        if value is not None:
            part = grouped.groupBy("metric", "group").agg(F.sum(money(F.expr(value))).alias("total"), F.count(F.expr(value)).alias("n"))
            out = part if out is None else out.unionByName(part)
    return out


def merged_bitmaps(rows: DataFrame) -> DataFrame:
    """(group, members) over all batches' bitmaps of one metric."""
    return (rows.groupBy("group", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            .groupBy("group").agg(F.sum(F.bitmap_count("bits")).alias("members")))


def merged_members(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group").agg(F.count_distinct("member").alias("members"))


def merged_averages(rows: DataFrame) -> DataFrame:
    """(group, average) as the exact sum by the count; null where nothing was averaged."""
    return rows.groupBy("group").agg(F.try_divide(F.sum("total").cast("double"), F.sum("n")).alias("average"))


def batch_summary(df: DataFrame) -> DataFrame:
    """Distinct users, events and revenue of a batch in one job."""
    return df.agg(
        F.count_distinct("user_id").alias("users"),
        F.count(F.lit(1)).alias("events"),
        F.coalesce(money_sum("revenue"), F.lit(0.0)).alias("revenue"),
    )


def dashboard(activity: DataFrame, as_of: Column, lookback: str = "1 hour",
              time_col: str = "created_at") -> DataFrame:
    """Per-minute dashboard over the last ``lookback`` before ``as_of``.

    ``activity_rows`` counts activity rows (the reference's ``total_events``).
    """
    t = F.col(time_col)
    recent = activity.filter((t >= as_of - F.expr(f"INTERVAL {lookback}")) & (t <= as_of))
    # date_trunc yields TIMESTAMP; keep the input's type (e.g. TIMESTAMP_NTZ)
    minute = F.date_trunc("minute", t).cast(activity.schema[time_col].dataType)
    return recent.groupBy(minute.alias("minute_window")).agg(
        F.count(F.lit(1)).alias("activity_rows"),
        F.sum("purchase_count").alias("total_purchases"),
        money_sum("daily_revenue").alias("total_revenue"),
        F.count_distinct("user_id").alias("active_users"),
    )


def daily_action_counts(df: DataFrame, time_col: str = "processed_at", action_col: str = "action",
                        actions=(("views", "view"), ("carts", "cart"),
                                 ("purchases", "purchase"))) -> DataFrame:
    """Pivoted daily counts, ``COUNT(*) FILTER (WHERE action = ..)``."""
    a = F.col(action_col)
    return (df.groupBy(F.to_date(F.col(time_col)).alias("day"))
            .agg(*[F.count_if(a == v).alias(name) for name, v in actions])
            .orderBy("day"))


def count_per_key(df: DataFrame, key: str, name: str = "views") -> DataFrame:
    """Rows per key; rows without a key are dropped."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def daily_views(df: DataFrame, key: str = "article_id", time_col: str = "timestamp") -> DataFrame:
    """Rows per key and day; rows without a key are dropped (L4)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key, F.to_date(F.col(time_col)).alias("day"))
            .agg(F.count(F.lit(1)).alias("daily_views")))


def sum_by_hour(df: DataFrame, time_col: str, value_col: str) -> DataFrame:
    """Rows and exact sum per hour of day."""
    return df.groupBy(F.hour(time_col).alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum(value_col).alias("revenue"))


def daily_sum(df: DataFrame, date_col: str, value_col: str, name: str = "daily_sales") -> DataFrame:
    """Sum per day; rows without a date are dropped (A10)."""
    return (df.filter(F.col(date_col).isNotNull())
            .groupBy(F.to_date(F.col(date_col)).alias("date"))
            .agg(F.coalesce(money_sum(value_col), F.lit(0.0)).alias(name)))


def user_activity_late(events: DataFrame, profiles: DataFrame, exact: bool = True) -> DataFrame:
    """A1 from events that know only the user's id: events are combined per user and
    day, and the profile (one row per ``user_id``: loyalty_tier, age, country) joins
    the result, so a busy user is a few rows when the join sees it."""
    per_day = events.groupBy("user_id", "date").agg(
        F.count("event_id").alias("total_events"),
        F.sum("is_purchase").alias("purchase_count"),
        F.sum("is_add_to_cart").alias("add_to_cart_count"),
        money_sum("revenue").alias("daily_revenue"),
        distinct_count("session_id", exact).alias("unique_sessions"))
    side = profiles.select("user_id", user_segment(F.col("loyalty_tier")).alias("user_segment"),
                           age_group(F.col("age")).alias("age_group"), "country")
    return (per_day.join(side, "user_id", "left")
            # unknown users: the segment and band that a missing profile gives
            .withColumn("user_segment", F.coalesce("user_segment", user_segment(F.lit(None).cast("string"))))
            .withColumn("age_group", F.coalesce("age_group", age_group(F.lit(None).cast("int"))))
            .select("user_id", "date", "user_segment", "age_group", "total_events", "purchase_count",
                    "add_to_cart_count", "daily_revenue", "unique_sessions", "country"))


def geographic_metrics_late(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """A4 with exact users from events that know only the user's id: combined per user
    and hour before the profile (``user_id``, country) joins."""
    per_user = events.groupBy("user_id", "hour").agg(
        F.count("event_id").alias("n"), F.sum(money("revenue")).alias("rev"), F.sum("is_purchase").alias("bought"))
    return (per_user.join(profiles.select("user_id", "country"), "user_id", "left").groupBy("country", "hour").agg(
        F.sum("n").alias("event_count"), F.sum("rev").cast("double").alias("revenue"),
        F.count("user_id").alias("unique_users"),  # one row per user and hour
        F.sum("bought").alias("purchases")))


def product_performance_late(events: DataFrame, products: DataFrame) -> DataFrame:
    """A3 from events that know only the product's id: combined per product and hour
    before names, category and price (``product_id``, product_name, product_category,
    product_price) join."""
    per_product = events.filter(F.col("product_id").isNotNull()).groupBy("product_id", "hour").agg(
        F.count("event_id").alias("n"), F.count(F.lit(1)).alias("rows"), F.sum("is_add_to_cart").alias("added"),
        F.sum("is_purchase").alias("bought"), F.sum(money("revenue")).alias("rev"))
    named = per_product.join(products.filter(F.col("product_name").isNotNull()), "product_id")
    priced = F.sum(F.when(F.col("product_price").isNotNull(), F.col("rows")))
    return (named.groupBy("product_category", "product_name", "hour").agg(
        F.sum("n").alias("view_count"), F.sum("added").alias("cart_adds"), F.sum("bought").alias("purchases"),
        F.sum("rev").cast("double").alias("revenue_generated"),
        F.try_divide(F.sum(money("product_price") * F.col("rows")).cast("double"), priced).alias("avg_price"))
        .withColumn("conversion_rate", safe_rate("purchases", "view_count"))
        .withColumn("cart_to_purchase_rate", safe_rate("purchases", "cart_adds")))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))
