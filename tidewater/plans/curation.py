"""File-ETL, quality and idempotent-load queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.columns import json_key_long
from tidewater.operators import curate as C
from tidewater.operators import quality as Q
from tidewater.sources.tables import read_table

# Split point between "already loaded" and "incoming" data, and the overlap
# the incoming batch re-sends (idempotent loads must absorb it).
LOADED_BEFORE = "2024-01-16"
RESENT_FROM = "2024-01-09"
ACTIONS = ["view", "purchase", "cart"]
KNOWN_ACTIONS = ["view", "click", "purchase", "add_to_cart", "remove_from_cart"]


def _raw_records(spark: SparkSession, base: str) -> DataFrame:
    """``(id, name, value, timestamp)`` raw rows: events with their product name and,
    for purchases only, the value, so many rows have a gap."""
    ev = read_table(spark, base, "events", ["event_id", "ts", "event_type", "value", "props"])
    part = read_table(spark, base, "part", ["p_partkey", "p_name"])
    j = ev.join(part, json_key_long("props", "k") == part.p_partkey, "left")
    return j.select(F.col("event_id").alias("id"), F.col("p_name").alias("name"),
                    F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
                    F.col("ts").alias("timestamp"))


def clean_dropna(spark: SparkSession, base: str) -> DataFrame:
    return C.drop_incomplete(_raw_records(spark, base))


def curated_upper(spark: SparkSession, base: str) -> DataFrame:
    """Raw zone (part) → curated zone with the name upper-cased."""
    raw = read_table(spark, base, "part", ["p_partkey", "p_name", "p_type"]).select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"))
    return C.upper_column(raw, "name")


def _actions(spark: SparkSession, base: str) -> DataFrame:
    ev = read_table(spark, base, "events", ["user_id", "event_type", "ts"])
    action = F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
    return ev.select("user_id", action.alias("action"), F.col("ts").alias("processed_at"))


def quality_report(spark: SparkSession, base: str) -> DataFrame:
    rules = [Q.expect_not_null("user_id"), Q.expect_in_set("action", ACTIONS),
             Q.expect_not_null("processed_at")]
    return Q.validation_report(_actions(spark, base), rules)


def quarantine_split(spark: SparkSession, base: str) -> DataFrame:
    """Every event tagged good or quarantined with its first failing reason (Q5)."""
    ev = read_table(spark, base, "events", ["event_id", "user_id", "event_type", "ts", "value", "props"])
    checks = [
        ("missing_user", F.col("user_id").isNull()),
        ("bad_timestamp", F.col("ts").isNull()),
        ("malformed_props", F.json_object_keys(F.col("props")).isNull()),
        ("unknown_event_type", ~F.col("event_type").isin(KNOWN_ACTIONS)),
        ("negative_amount", F.col("value") < 0),
    ]
    tagged = Q.tag_quarantine(ev, checks)
    return tagged.select("event_id", F.when(F.col("reason").isNull(), "good")
                         .otherwise("quarantine").alias("status"), "reason")


def _keyed_events(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events", ["event_id", "user_id", "event_type", "ts"])


def dedup_first(spark: SparkSession, base: str) -> DataFrame:
    """First event of each type per user."""
    return C.first_per_key(_keyed_events(spark, base), ["user_id", "event_type"], ["ts", "event_id"])


def insert_if_absent(spark: SparkSession, base: str) -> DataFrame:
    """Load a batch that re-sends a week already in the table."""
    ev = _keyed_events(spark, base)
    target = ev.filter(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    batch = ev.filter(F.col("ts") >= F.lit(RESENT_FROM).cast("timestamp_ntz"))
    return C.insert_if_absent(target, batch, "event_id", ["ts"])


def upsert_counts(spark: SparkSession, base: str) -> DataFrame:
    """Running per-article counts: stored counts + a new batch's counts (K4)."""
    ev = read_table(spark, base, "events", ["ts", "props"]).select(
        json_key_long("props", "k").alias("article_id"), "ts").filter(
        F.col("article_id").isNotNull())
    cut = F.lit(LOADED_BEFORE).cast("timestamp_ntz")

    def counts(df):
        return df.groupBy("article_id").agg(F.count(F.lit(1)).alias("daily_views"),
                                            F.max("ts").alias("last_updated"))
    return C.accumulate_counts(counts(ev.filter(F.col("ts") < cut)),
                               counts(ev.filter(F.col("ts") >= cut)),
                               "article_id", "daily_views", "last_updated")


QUERIES = {
    "clean_dropna": clean_dropna,
    "curated_upper": curated_upper,
    "quality_report": quality_report,
    "quarantine_split": quarantine_split,
    "dedup_first": dedup_first,
    "insert_if_absent": insert_if_absent,
    "upsert_counts": upsert_counts,
}
