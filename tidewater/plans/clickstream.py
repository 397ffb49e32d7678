"""Clickstream queries over the driver tables (pipelines A-E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.columns import json_key_long, money_sum
from tidewater.functions.registry import HandlerRegistry, square, square_pandas
from tidewater.operators import curate as C
from tidewater.operators import enrich as E
from tidewater.operators import metrics as M
from tidewater.operators import windows as W
from tidewater.operators import quality as Q
from tidewater.plans.testdata import action_events, enriched_events, flagged_events, locations, products, profiles
from tidewater.sources.tables import read_table

TOP_K = 10  # top-k report size (the limit is the feature)


def day_as_timestamp(df: DataFrame, col: str) -> DataFrame:
    """Registered outputs carry days as midnight TIMESTAMP_NTZ, the type the
    driver tables use for dates, so both engines hand back the same type."""
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def business_metrics(spark: SparkSession, base: str) -> DataFrame:
    return M.business_metrics(flagged_events(spark, base), exact=True)


def business_metrics_by_date(spark: SparkSession, base: str) -> DataFrame:
    """Business metrics with the date in the key, so days do not mix (2.12 #8)."""
    return day_as_timestamp(M.business_metrics(flagged_events(spark, base), exact=True, with_date=True),
                            "date")


def user_activity(spark: SparkSession, base: str) -> DataFrame:
    return day_as_timestamp(M.user_activity_late(flagged_events(spark, base), profiles(spark, base)), "date")


def product_performance(spark: SparkSession, base: str) -> DataFrame:
    return M.product_performance_late(flagged_events(spark, base), products(spark, base))


def geographic_metrics(spark: SparkSession, base: str) -> DataFrame:
    return M.geographic_metrics_late(flagged_events(spark, base), profiles(spark, base))


def platform_metrics(spark: SparkSession, base: str) -> DataFrame:
    return M.platform_metrics(flagged_events(spark, base), exact=True)


def batch_summary(spark: SparkSession, base: str) -> DataFrame:
    return M.batch_summary(flagged_events(spark, base))


APPROX_RSD = 0.05


def approx_users(spark: SparkSession, base: str) -> DataFrame:
    """The approximate distinct users per event type and hour."""
    ev = flagged_events(spark, base)
    return ev.groupBy("event_type", "hour").agg(
        M.distinct_count("user_id", exact=False, rsd=APPROX_RSD).alias("unique_users"))


def approx_users_bound(spark: SparkSession, base: str) -> DataFrame:
    """Approximate distinct users, directly and from sketches merged over days, held
    against the exact count: within four standard errors and one user (A11)."""
    ev = flagged_events(spark, base)
    keys = ["event_type", "hour"]
    direct = ev.groupBy(*keys).agg(M.distinct_count("user_id", exact=False, rsd=APPROX_RSD).alias("direct"),
                                   F.count_distinct("user_id").alias("exact"))
    merged = M.merge_user_sketches(M.user_sketches(ev, [*keys, "date"]), keys).withColumnRenamed("unique_users", "merged")

    def near(c):
        return F.abs(F.col(c) - F.col("exact")) <= 4 * APPROX_RSD * F.col("exact") + 1

    return direct.join(merged, keys).select(*keys, "exact", near("direct").alias("direct_near"), near("merged").alias("merged_near"))


def segments_and_bands(spark: SparkSession, base: str) -> DataFrame:
    return enriched_events(spark, base).withColumn("date", F.col("date").cast("timestamp_ntz")).select(
        "event_id", "user_id", "date", "hour", "minute", "user_segment", "age_group",
        "is_purchase", "is_add_to_cart", "revenue", "product_count",
        "device_type", "browser", "operating_system")


def dashboard_last_hour(spark: SparkSession, base: str) -> DataFrame:
    """Per-minute dashboard for the hour before the newest event."""
    ev = flagged_events(spark, base)
    activity = ev.select("user_id", F.col("is_purchase").alias("purchase_count"),
                         F.col("revenue").alias("daily_revenue"),
                         F.col("event_timestamp").alias("created_at"))
    newest = read_table(spark, base, "events", ["ts"]).agg(F.max("ts")).scalar()
    return M.dashboard(activity, newest)


def _actions(spark: SparkSession, base: str) -> DataFrame:
    """events as the ingest table ``(user_id, action, processed_at)``; click plays cart."""
    ev = read_table(spark, base, "events", ["user_id", "event_type", "ts"])
    action = F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
    return ev.select("user_id", action.alias("action"), F.col("ts").alias("processed_at"))


def daily_action_counts(spark: SparkSession, base: str) -> DataFrame:
    return day_as_timestamp(M.daily_action_counts(_actions(spark, base)), "day")


def _page_views(spark: SparkSession, base: str) -> DataFrame:
    """events as page views: the article is ``props.k``."""
    ev = read_table(spark, base, "events", ["user_id", "ts", "props"])
    return ev.select(json_key_long("props", "k").alias("article_id"), "user_id",
                     F.col("ts").alias("timestamp"))


def article_views(spark: SparkSession, base: str) -> DataFrame:
    return M.count_per_key(_page_views(spark, base), "article_id", "views")


def daily_article_views(spark: SparkSession, base: str) -> DataFrame:
    """True daily views per article (L4)."""
    return day_as_timestamp(M.daily_views(_page_views(spark, base)), "day")


def top_articles(spark: SparkSession, base: str) -> DataFrame:
    """Most viewed articles, ties by id (L3)."""
    return (article_views(spark, base)
            .orderBy(F.desc("views"), F.asc("article_id")).limit(TOP_K))


def _sales_and_users(spark: SparkSession, base: str) -> DataFrame:
    sales = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"]).select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("sales_amount"))
    return C.union_sources(sales, read_table(spark, base, "customer", ["c_custkey", "c_name"]))


def union_rows(spark: SparkSession, base: str) -> DataFrame:
    """All rows of the union of sales and users, whose columns differ."""
    return _sales_and_users(spark, base)


def daily_sales_union(spark: SparkSession, base: str) -> DataFrame:
    """Union of sales and users, then the daily sales sum."""
    return day_as_timestamp(M.daily_sum(_sales_and_users(spark, base), "date", "sales_amount", "daily_sales"), "date")


def revenue_by_hour(spark: SparkSession, base: str) -> DataFrame:
    """Purchase revenue per hour of day."""
    ev = read_table(spark, base, "events", ["ts", "event_type", "value"])
    return M.sum_by_hour(E.route(ev, "purchase"), "ts", "value")


def routed_events(spark: SparkSession, base: str) -> DataFrame:
    """Purchases and clicks, under warehouse names, missing values as 0."""
    ev = read_table(spark, base, "events", ["event_id", "user_id", "event_type", "value"])
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    routed = E.route(ev.withColumn("value", value), ["purchase", "click"])
    return E.with_defaults(E.rename_on_load(routed, {"user_id": "customer_id", "event_type": "action"}), {"value": 0.0})


def product_event_count(spark: SparkSession, base: str) -> DataFrame:
    """Events that name a product and a user."""
    return M.row_count(E.not_null(flagged_events(spark, base), "product_id", "user_id"), "events")


def event_preview(spark: SparkSession, base: str) -> DataFrame:
    """The first rows of the clickstream (L2)."""
    return E.preview(read_table(spark, base, "events", ["event_id", "user_id", "event_type", "value"]), 5, "event_id")


def epoch_events(spark: SparkSession, base: str) -> DataFrame:
    """Event time read back from seconds since the epoch."""
    ev = read_table(spark, base, "events", ["event_id", "ts"])
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    timed = E.add_event_time(ev.withColumn("event_time", micros / F.lit(1e6)), "event_time", ntz=True)
    return day_as_timestamp(timed.select("event_id", "event_timestamp", "date", "hour", "minute"), "date")


def event_table_checks(spark: SparkSession, base: str) -> DataFrame:
    """Column and row-count checks of the event table (Q4)."""
    return Q.schema_checks(read_table(spark, base, "events"), ["event_id", "user_id", "ts", "no_such_column"], 1)


def handled_events(spark: SparkSession, base: str) -> DataFrame:
    """Events through registered handlers: purchases summed, views counted, by user
    (X1), and the squared value as an expression and as a user function (X2)."""
    ev = read_table(spark, base, "events", ["user_id", "event_type", "value"])

    def spent(df):
        return df.groupBy("user_id").agg(money_sum("value").alias("total"), F.sum(square("value")).alias("squares"),
                                         F.sum(square_pandas("value")).alias("squares_udf"))

    def seen(df):
        return df.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("total"))

    made = HandlerRegistry().subscribe("purchase", spent).subscribe("view", seen).apply(ev)
    agree = F.abs(F.col("squares") - F.col("squares_udf")) <= 1e-9 * F.col("squares")
    return (made["spent"].select(F.lit("spent").alias("handler"), "user_id", "total", agree.alias("agree"))
            .unionByName(made["seen"].select(F.lit("seen").alias("handler"), "user_id", "total", F.lit(True).alias("agree"))))


def sliding_kpis(spark: SparkSession, base: str) -> DataFrame:
    """Panes per user first, then the user's location, then windows (M2)."""
    panes = W.user_panes(action_events(spark, base), keys=("action",))
    return W.windows_of_panes(E.join_profiles(panes, locations(spark, base)))


def tumbling_kpis(spark: SparkSession, base: str) -> DataFrame:
    return W.tumbling_counts(action_events(spark, base))


def session_rollup(spark: SparkSession, base: str) -> DataFrame:
    return W.session_rollup(action_events(spark, base))


def gap_sessions(spark: SparkSession, base: str) -> DataFrame:
    return W.gap_sessions(action_events(spark, base))


QUERIES = {
    "business_metrics": business_metrics,
    "business_metrics_by_date": business_metrics_by_date,
    "user_activity": user_activity,
    "product_performance": product_performance,
    "geographic_metrics": geographic_metrics,
    "platform_metrics": platform_metrics,
    "batch_summary": batch_summary,
    "approx_users": approx_users,
    "approx_users_bound": approx_users_bound,
    "union_rows": union_rows,
    "routed_events": routed_events,
    "product_event_count": product_event_count,
    "event_preview": event_preview,
    "epoch_events": epoch_events,
    "event_table_checks": event_table_checks,
    "handled_events": handled_events,
    "segments_and_bands": segments_and_bands,
    "dashboard_last_hour": dashboard_last_hour,
    "daily_action_counts": daily_action_counts,
    "article_views": article_views,
    "daily_article_views": daily_article_views,
    "top_articles": top_articles,
    "daily_sales_union": daily_sales_union,
    "revenue_by_hour": revenue_by_hour,
    "sliding_kpis": sliding_kpis,
    "tumbling_kpis": tumbling_kpis,
    "session_rollup": session_rollup,
    "gap_sessions": gap_sessions,
}
