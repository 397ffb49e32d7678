"""Decode, parse and enrich events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import (
    age_group, array_len_or_zero, default_zero, epoch_time, event_flag, parse_event_time, user_segment,
)


def decode_record(df: DataFrame) -> DataFrame:
    """Binary key/value → text; broker time kept as ``kafka_timestamp``."""
    cols = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
    if "timestamp" in df.columns:
        cols.append(F.col("timestamp").alias("kafka_timestamp"))
    if "topic" in df.columns:
        cols.append(F.col("topic"))
    return df.select(*cols)


def parse_payload(df: DataFrame, schema: T.StructType, value_col: str = "value",
                  keep=("key", "kafka_timestamp", "topic")) -> DataFrame:
    """``from_json`` the payload and flatten ``data.*``.

    A column ``_malformed`` is true when the text is not a JSON object, so a
    quarantine step (Q5) can route those rows instead of losing them as
    all-null records.
    """
    kept = [c for c in keep if c in df.columns]
    text = F.col(value_col).cast("string")
    parsed = df.select(*kept, F.from_json(text, schema).alias("data"),
                       F.json_object_keys(text).isNull().alias("_malformed"))
    return parsed.select(*kept, "data.*", "_malformed")


def add_event_time(df: DataFrame, ts_col: str = "timestamp", out: str = "event_timestamp",
                   ntz: bool = False) -> DataFrame:
    """Event time, date, hour, minute (P4).  Text is parsed, numbers are seconds since
    the epoch, timestamps pass through."""
    src = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.StringType):
        src = parse_event_time(src, ntz=ntz)
    elif isinstance(df.schema[ts_col].dataType, T.NumericType):
        src = epoch_time(src, ntz=ntz)
    return (df.withColumn(out, src)
            .withColumn("date", F.to_date(F.col(out)))
            .withColumn("hour", F.hour(F.col(out)))
            .withColumn("minute", F.minute(F.col(out))))


def add_processing_time(df: DataFrame, name: str = "processing_timestamp") -> DataFrame:
    """Wall-clock stamp of when the row was processed (P5)."""
    return df.withColumn(name, F.current_timestamp())


def enrich_events(df: DataFrame, purchase_type: str = "purchase",
                  cart_type: str = "add_to_cart") -> DataFrame:
    """Flags, revenue, product count, user segment, age group.

    Expects the rich event columns (``event_type``, ``order_value``,
    ``products``, ``user_profile``).  ``cart_type`` lets another action name
    play the add-to-cart role.
    """
    return (df
            .withColumn("is_purchase", event_flag("event_type", purchase_type))
            .withColumn("is_add_to_cart", event_flag("event_type", cart_type))
            .withColumn("revenue", default_zero("order_value"))
            .withColumn("product_count", array_len_or_zero("products"))
            .withColumn("user_segment", user_segment(F.col("user_profile.loyalty_tier")))
            .withColumn("age_group", age_group(F.col("user_profile.age"))))


def explode_purchase_products(df: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """One row per product for purchases that list products but no single product.

    Purchases name their products in ``products``; without this, product
    metrics never see a purchase.  The order value stays on the first
    product so revenue is not counted twice.  One pass, no union: other rows
    explode a one-element array of their own product name.

    ``categories`` (product_name, product_category; one row per name) gives the
    category of the products so named, which the purchase itself does not carry.
    """
    needs = (F.col("product_name").isNull() & F.col("products").isNotNull()
             & (F.size("products") > 0))
    names = F.when(needs, F.col("products")).otherwise(F.array(F.col("product_name")))
    out = (df.select("*", F.posexplode(names).alias("_pos", "_product"))
           .withColumn("product_name", F.col("_product"))
           .withColumn("revenue", F.when(F.col("_pos") == 0, F.col("revenue"))
                       .otherwise(F.lit(0.0)))
           .drop("_pos", "_product"))
    if categories is None:
        return out
    named = categories.select(F.col("product_name").alias("_name"), F.col("product_category").alias("_category"))
    return (out.join(named, F.col("product_name") == F.col("_name"), "left")
            .withColumn("product_category", F.coalesce("product_category", "_category")).drop("_name", "_category"))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose given columns are all present."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def route(df: DataFrame, event_type, type_col: str = "event_type") -> DataFrame:
    """Rows of one event type or a list of types."""
    if isinstance(event_type, (list, tuple, set)):
        return df.filter(F.col(type_col).isin(list(event_type)))
    return df.filter(F.col(type_col) == event_type)


def rename_on_load(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename source fields to warehouse names, e.g. ``user`` → ``user_id``."""
    for old, new in mapping.items():
        df = df.withColumnRenamed(old, new)
    return df


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Missing-field defaults."""
    for c, v in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return df


def monitor_view(df: DataFrame, payload_col: str = "data", amount_key: str = "total_amount") -> DataFrame:
    """Monitor projection: topic, type, order id or ``N/A``, time, amount if present."""
    payload = F.col(payload_col)
    return df.select(
        "topic", "event_type",
        F.coalesce(F.get_json_object(payload, "$.order_id"), F.lit("N/A")).alias("order_id"),
        F.col("timestamp").alias("time"),
        F.get_json_object(payload, f"$.{amount_key}").try_cast("double").alias("amount"),
    )


def join_profiles(events: DataFrame, profiles: DataFrame, key: str = "user_id") -> DataFrame:
    """Attach the user profile to each event.

    Left join: unknown users keep their events with a null profile.  The planner
    decides from sizes whether the profiles are broadcast; otherwise both sides are
    shuffled, and a hot user's partition can be split.
    """
    return events.join(profiles, key, "left")


def preview(df: DataFrame, rows: int, order_cols) -> DataFrame:
    """The first ``rows`` rows by ``order_cols`` (L2; the limit is the feature)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.orderBy(*order_cols).limit(rows)
