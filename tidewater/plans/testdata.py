"""How the driver tables stand in for the reference's inputs.

``events`` plays the clickstream; ``customer``/``nation``/``region`` give the
user profile; ``part`` gives the product an event refers to (``props.k``);
``orders``/``lineitem`` are the orders and their items.  Every mapping is a
plain deterministic expression so the DuckDB oracle can state it too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.columns import default_zero, event_flag, json_key_long, pick_by_mod, session_key
from tidewater.operators.enrich import add_event_time, enrich_events, join_profiles
from tidewater.sources.tables import read_table

# The generators' device, browser and OS lists.
DEVICES = ["mobile", "desktop", "tablet"]
BROWSERS = ["chrome", "firefox", "safari", "edge"]
OPERATING_SYSTEMS = ["windows", "macos", "linux", "ios", "android"]

# Our own mapping of market segment → loyalty tier (5 segments, 4 tiers).
SEGMENT_TIER = [("AUTOMOBILE", "bronze"), ("BUILDING", "silver"), ("FURNITURE", "gold"),
                ("HOUSEHOLD", "platinum"), ("MACHINERY", "bronze")]

# Event types that refer to a product: view = product view, click = add to cart.
PRODUCT_EVENT_TYPES = ["view", "click", "purchase"]
CART_TYPE = "click"
AGE_BASE, AGE_SPAN = 18, 53


def _tier(seg):
    expr = None
    for s, t in SEGMENT_TIER:
        expr = F.when(seg == s, t) if expr is None else expr.when(seg == s, t)
    return expr


def profiles(spark: SparkSession, base: str) -> DataFrame:
    """One profile per customer (``c_custkey`` is the table's key, so it is not
    deduplicated again: a join with it can be split where a user is hot)."""
    cust = read_table(spark, base, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    # nation and region have a fixed size (25 and 5 rows) whatever the scale.
    nation = F.broadcast(read_table(spark, base, "nation", ["n_nationkey", "n_name", "n_regionkey"]))
    region = F.broadcast(read_table(spark, base, "region", ["r_regionkey", "r_name"]))
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
            .select(F.col("c_custkey").alias("user_id"),
                    F.col("c_name").alias("name"),
                    (F.lit(AGE_BASE) + F.pmod(F.col("c_custkey"), F.lit(AGE_SPAN))).cast("int")
                    .alias("age"),
                    _tier(F.col("c_mktsegment")).alias("loyalty_tier"),
                    F.col("n_name").alias("country"),
                    F.col("r_name").alias("region")))


def products(spark: SparkSession, base: str) -> DataFrame:
    """One product per part (``p_partkey`` is the table's key)."""
    return read_table(spark, base, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"]).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"), F.col("p_retailprice").alias("product_price"))


def flagged_events(spark: SparkSession, base: str) -> DataFrame:
    """The clickstream with time parts, flags and revenue, and nothing joined: what
    metrics that need only ids read."""
    ev = read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    is_product = F.col("event_type").isin(PRODUCT_EVENT_TYPES)
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return add_event_time(ev, "ts").select(
        "event_id", "user_id", "event_type", "event_timestamp", "date", "hour", "minute",
        session_key("user_id", "ts").alias("session_id"),
        pick_by_mod(F.col("user_id"), DEVICES).alias("device_type"),
        pick_by_mod(F.col("user_id"), BROWSERS).alias("browser"),
        pick_by_mod(F.col("user_id"), OPERATING_SYSTEMS).alias("operating_system"),
        F.when(is_product, json_key_long("props", "k")).alias("product_id"),
        event_flag("event_type", "purchase").alias("is_purchase"),
        event_flag("event_type", CART_TYPE).alias("is_add_to_cart"),
        default_zero(value).alias("revenue"))


def rich_events(spark: SparkSession, base: str) -> DataFrame:
    """The clickstream in the rich event shape (pipeline A), before enrichment."""
    ev = read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    part = products(spark, base).withColumnRenamed("product_id", "p_partkey").toDF("p_partkey", "p_name", "p_type", "p_retailprice")
    is_product = F.col("event_type").isin(PRODUCT_EVENT_TYPES)
    is_purchase = F.col("event_type") == "purchase"
    j = (join_profiles(add_event_time(ev.withColumn("k", json_key_long("props", "k")), "ts"), profiles(spark, base))
         .join(part, F.col("k") == part.p_partkey, "left"))
    return j.select(
        "event_id", "user_id", "event_type",
        "event_timestamp", "date", "hour", "minute",
        session_key("user_id", "ts").alias("session_id"),
        F.when(is_purchase, F.col("value")).alias("order_value"),
        F.when(is_purchase & F.col("p_name").isNotNull(), F.array("p_name")).alias("products"),
        F.struct(F.col("name"), F.col("age"), F.col("loyalty_tier"),
                 F.struct(F.col("country").alias("country")).alias("location")).alias("user_profile"),
        F.col("region"),
        pick_by_mod(F.col("user_id"), DEVICES).alias("device_type"),
        pick_by_mod(F.col("user_id"), BROWSERS).alias("browser"),
        pick_by_mod(F.col("user_id"), OPERATING_SYSTEMS).alias("operating_system"),
        F.when(is_product, F.col("k")).alias("product_id"),
        F.when(is_product, F.col("p_name")).alias("product_name"),
        F.when(is_product, F.col("p_type")).alias("product_category"),
        F.when(is_product, F.col("p_retailprice")).alias("product_price"),
    )


def enriched_events(spark: SparkSession, base: str) -> DataFrame:
    """Rich events after P6-P10, with ``click`` in the add-to-cart role."""
    return enrich_events(rich_events(spark, base), cart_type=CART_TYPE)


def simple_events(spark: SparkSession, base: str) -> DataFrame:
    """The clickstream in the simple action shape (pipeline B); ``location`` is the
    user's region."""
    return join_profiles(action_events(spark, base), locations(spark, base))


def action_events(spark: SparkSession, base: str) -> DataFrame:
    """The clickstream in the simple action shape, without the user's location; ``amount`` is the value of purchases, else 0."""
    ev = read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return ev.select(
        "event_id", "user_id",
        json_key_long("props", "k").alias("product_id"),
        F.col("event_type").alias("action"),
        F.col("ts").alias("timestamp"),
        session_key("user_id", "ts").alias("session_id"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("amount"),
        pick_by_mod(F.col("user_id"), DEVICES).alias("device"))


def locations(spark: SparkSession, base: str) -> DataFrame:
    """Each user's location: the region."""
    return profiles(spark, base).select("user_id", F.col("region").alias("location"))
