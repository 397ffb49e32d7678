"""Streams and sinks over the driver tables: each query runs its pipeline to the end
of the data (``availableNow``) in the shared folder and returns what the sinks hold.

A pipeline runs once per session and state of the input files; the queries that
read its tables share it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.functions.columns import json_key_long, money_sum, pick_by_mod, session_key
from tidewater.operators import curate as C
from tidewater.operators import enrich as E
from tidewater.operators import metrics as M
from tidewater.operators import orders as O
from tidewater.operators import quality as Q
from tidewater.plans import orders as chain_plan
from tidewater.plans.clickstream import day_as_timestamp
from tidewater.plans.testdata import (
    BROWSERS, CART_TYPE, DEVICES, OPERATING_SYSTEMS, PRODUCT_EVENT_TYPES, locations, products, profiles,
)
from tidewater.schemas import RICH_EVENT
from tidewater.session import CLUSTER_CONF, materialise, scratch_generation, shared_path
from tidewater.sinks import writers as K
from tidewater.sinks.keyed import KeyedTable
from tidewater.sources.files import (
    inline_rows, read_bounded, read_csv, read_event_stream, read_json_documents, stored_files, write_in_order,
)
from tidewater.sources.tables import read_table
from tidewater.streaming import pipelines as S

NOW = {"availableNow": True}
#: Rows of a topic's file and bytes of a micro-batch (the admission control), order lines
#: of a micro-batch of the chain, rows of a keyed table's bucket: their numbers follow
#: the data.  A cluster names larger ones in the session (``session.CLUSTER_CONF``).  Where
#: none are named, a batch grows with its topic up to a cluster's: see ``batch_share``.
SETTINGS = {"spark.tidewater.stream.fileRows": "20000", "spark.tidewater.stream.bytesPerTrigger": "4000000",
            "spark.tidewater.stream.orderLines": "250000",
            "spark.tidewater.stream.bucketRows": "64"}
#: Micro-batches that a topic makes where the session names no sizes.  A batch has a cost of
#: its own (some thirty jobs, and listings of all batches before it), which would otherwise
#: grow with the square of the topic.
BATCHES = 4
#: Buckets that the keys of ``replayed_upserts`` fill at about most (a bucket is a folder).
BUCKETS = 64
#: How late a row may be.  Topics are written in the order of time, so what is later was
#: planted: every 97th event from more than ten days before the end comes last.
DELAY = "10 minutes"
PLANTED = "event_id % 97 = 0 AND ts < last_ts - INTERVAL 10 DAYS"
SECOND_PRODUCTS = 100
#: Neighbouring order ids whose open orders share a state row.
ORDERS_PER_BLOCK = 256

_RUNS: dict[tuple, object] = {}


def once(name: str, tables: tuple[str, ...]):
    """Run a pipeline once per session and state of its input files."""
    def wrap(make):
        def run(spark: SparkSession, base: str):
            key = (name, spark.sparkContext.applicationId, scratch_generation(), base, chain_plan.input_stamp(spark, base, tables))
            if key not in _RUNS:
                for old in [k for k in _RUNS if k[0] == name]:
                    del _RUNS[old]
                _RUNS[key] = make(spark, base)
            return _RUNS[key]
        return run
    return wrap


def setting(spark: SparkSession, name: str) -> str:
    name = f"spark.tidewater.stream.{name}"
    return spark.conf.get(name, SETTINGS[name])


def batch_share(spark: SparkSession, name: str, whole: int, least: int, most: int) -> int:
    """What a micro-batch takes of a topic of ``whole`` bytes or files: ``least`` where the
    session names the setting, else what makes ``BATCHES`` of them, from ``least`` to ``most``."""
    if spark.conf.get(f"spark.tidewater.stream.{name}", None) is not None:
        return least
    return max(least, min(most, -(-whole // BATCHES)))


def files_per_batch(spark: SparkSession, path: str, name: str, least: int) -> int:
    """Files of the topic's folder that a micro-batch takes; ``name`` is the setting of a file's rows."""
    files = sum(n.endswith(".parquet") for n, _ in stored_files(spark, path))
    grows = int(CLUSTER_CONF[f"spark.tidewater.stream.{name}"]) // int(SETTINGS[f"spark.tidewater.stream.{name}"])
    return batch_share(spark, name, files, least, least * grows)


def bytes_per_batch(spark: SparkSession, paths: list[str]) -> int:
    """Bytes that a micro-batch takes of each of the topics' folders (the largest one counts)."""
    whole = max(sum(size for _, size in stored_files(spark, p)) for p in paths)
    return batch_share(spark, "bytesPerTrigger", whole, int(setting(spark, "bytesPerTrigger")),
                       int(CLUSTER_CONF["spark.tidewater.stream.bytesPerTrigger"]))


def land(df: DataFrame, path: str) -> None:
    """Rows as files of a topic: Spark's own partitions write them, cut by rows."""
    df.write.option("maxRecordsPerFile", setting(df.sparkSession, "fileRows")).mode("append").parquet(path)


def land_in_order(df: DataFrame, path: str, order_cols, rows: str = "fileRows", least: int = 4) -> None:
    """Rows as files of a topic that a stream reads in order; as many files as the rows
    fill, ``least`` of them at least."""
    df = df.persist()
    try:
        files = max(least, -(-df.count() // int(setting(df.sparkSession, rows))))
        write_in_order(df, path, order_cols, files)
    finally:
        df.unpersist()


def follow(spark: SparkSession, topics, path: str, schema=None, **limits) -> DataFrame:
    """A stream of file topics, by default as many bytes a batch as the settings or the
    topics say."""
    names = [topics] if isinstance(topics, str) else list(topics)
    return read_event_stream(spark, topics, fmt="parquet", path=path, schema=schema,
                             **(limits or {"max_bytes": bytes_per_batch(spark, [f"{path}/{t}" for t in names])}))


def stored_schema(spark: SparkSession, path: str):
    return spark.read.parquet(path).schema


class collected:
    """The progress of queries that run inside, from a listener (M17): a query's own
    ``recentProgress`` keeps only the last batches."""

    def __init__(self, spark: SparkSession):
        self.spark, self.progress = spark, S.ProgressCollector()

    def __enter__(self) -> S.ProgressCollector:
        self.spark.streams.addListener(self.progress)
        return self.progress

    def __exit__(self, *_) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.spark.streams.removeListener(self.progress)


def publish_topics(df: DataFrame, path: str, topic_of) -> None:
    """Write ``key``, JSON ``value`` and time as records of file topics, a folder each."""
    for topic, condition in topic_of.items():
        land(df.filter(condition)
             .select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                     F.lit(topic).alias("topic"), F.col("time").cast("timestamp").alias("timestamp")), f"{path}/{topic}")


def _rich_records(spark: SparkSession, base: str) -> DataFrame:
    """events as rich JSON records; purchases carry a list of two products and no
    product of their own, as the producers send them."""
    ev = read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    part = products(spark, base)
    first = part.select(F.col("product_id").alias("k"), "product_name", "product_category", "product_price")
    second = part.select(F.col("product_id").alias("k2"), F.col("product_name").alias("second_name"))
    k = json_key_long("props", "k")
    j = (E.join_profiles(ev.withColumn("k", k).withColumn("k2", F.pmod(k, F.lit(SECOND_PRODUCTS)) + 1), profiles(spark, base))
         .join(first, "k", "left").join(second, "k2", "left"))
    bought = F.col("event_type") == "purchase"
    seen = F.col("event_type").isin([t for t in PRODUCT_EVENT_TYPES if t != "purchase"])
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("int").alias("user_id"), "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), session_key("user_id", "ts").alias("session_id"),
        F.struct("name", "age", "loyalty_tier", F.struct("country").alias("location")).alias("user_profile"),
        pick_by_mod(F.col("user_id"), DEVICES).alias("device_type"), pick_by_mod(F.col("user_id"), BROWSERS).alias("browser"),
        pick_by_mod(F.col("user_id"), OPERATING_SYSTEMS).alias("operating_system"),
        F.when(bought, F.array_compact(F.array("product_name", "second_name"))).alias("products"),
        F.when(bought, F.col("value")).alias("order_value"),
        F.when(seen, F.col("k").cast("string")).alias("product_id"), F.when(seen, F.col("product_name")).alias("product_name"),
        F.when(seen, F.col("product_category")).alias("product_category"),
        F.when(seen, F.col("product_price")).alias("product_price"))
    return j.select(F.col("user_id").cast("string").alias("key"), F.to_json(payload).alias("value"), F.col("ts").alias("time"),
                    bought.alias("bought"))


def _categories(spark: SparkSession, base: str) -> DataFrame:
    """One category per product name, the first by name."""
    return products(spark, base).groupBy("product_name").agg(F.min("product_category").alias("product_category"))


def _enriched(stream: DataFrame) -> DataFrame:
    parsed = E.parse_payload(E.decode_record(stream), RICH_EVENT).filter(~F.col("_malformed"))
    return E.enrich_events(E.add_event_time(parsed, "timestamp", ntz=True), cart_type=CART_TYPE)


@once("metrics", ("events", "part", "customer"))
def _metric_tables(spark: SparkSession, base: str) -> str:
    """Pipeline A on two topics."""
    path = shared_path(spark, "stream-metrics")
    publish_topics(_rich_records(spark, base), f"{path}/topics", {"purchases": F.col("bought"), "views": ~F.col("bought")})
    stream = follow(spark, ["purchases", "views"], f"{path}/topics")
    for q in S.start_metric_queries(_enriched(stream), f"{path}/out", f"{path}/checkpoints", trigger=NOW, contracts=True,
                                    categories=_categories(spark, base), exact=True):
        q.awaitTermination()
    return f"{path}/out"


def _summed(df: DataFrame, keys, counts, money=()) -> DataFrame:
    """The batches' rows of a metric table added up."""
    return df.groupBy(*keys).agg(*(F.sum(c).cast("bigint").alias(c) for c in counts),
                                 *(F.sum(c).cast("double").alias(c) for c in money))


def _over_batches(spark, base, metric: str, counts, money, **parts: str) -> DataFrame:
    """A metric over all batches: sums of its rows, and exact distinct counts and
    averages (named in ``parts``) from the tables beside them (A11, A12)."""
    out = _metric_tables(spark, base)
    keys = M.EXACT[metric][0]
    total = _summed(spark.read.parquet(f"{out}/{metric}"), keys, counts, money).withColumn("group", M.group_name(keys))
    exact = S.exact_parts(spark, out, metric)
    for part, name in parts.items():
        value = exact[part].columns[1]
        total = total.join(exact[part].withColumnRenamed(value, name), "group", "left")
        if part != "averages":
            total = total.withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))
    return total.drop("group")


def stream_business_metrics(spark, base):
    return _over_batches(spark, base, "business_metrics_realtime", ["event_count", "events_per_minute"], ["total_revenue"],
                         users="unique_users", members="active_sessions", averages="avg_order_value")


def stream_user_activity(spark, base):
    total = _over_batches(spark, base, "user_activity_detailed", ["total_events", "purchase_count", "add_to_cart_count"],
                          ["daily_revenue"], members="unique_sessions")
    rows = spark.read.parquet(f"{_metric_tables(spark, base)}/user_activity_detailed")
    country = rows.groupBy("user_id", "user_segment", "age_group").agg(F.min_by("country", "date").alias("country"))
    return total.join(country, ["user_id", "user_segment", "age_group"])


def stream_product_performance(spark, base):
    """Product metrics whose purchases name products only in a list."""
    t = spark.read.parquet(f"{_metric_tables(spark, base)}/product_performance")
    return _summed(t, ["product_category", "product_name", "hour"], ["view_count", "cart_adds", "purchases"], ["revenue_generated"])


def stream_geographic_metrics(spark, base):
    return _over_batches(spark, base, "geographic_analytics", ["event_count", "purchases"], ["revenue"], users="unique_users")


def stream_platform_metrics(spark, base):
    return _over_batches(spark, base, "platform_analytics", ["event_count"], ["revenue"], users="unique_users",
                         averages="avg_purchase_value")


def stream_enriched_events(spark, base):
    """The raw enriched events that run beside the metrics (P1-P10 on a stream, M15)."""
    t = spark.read.parquet(f"{_metric_tables(spark, base)}/enriched_events")
    return t.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "event_timestamp", "hour", "minute",
                    "is_purchase", "is_add_to_cart", "revenue", "product_count", "user_segment", "age_group")


@once("quarantine", ("events",))
def _split_tables(spark, base):
    path = shared_path(spark, "stream-split")
    land(read_table(spark, base, "events", ["event_id", "user_id", "event_type", "value"]), f"{path}/in/events")
    stream = follow(spark, "events", f"{path}/in", stored_schema(spark, f"{path}/in/events"))
    checks = [("not_a_purchase", F.col("event_type") != "purchase"), ("small", F.col("value") < 50)]
    S.start_query(stream, name="split", checkpoint=f"{path}/checkpoint", mode="append", trigger=NOW,
                  sink=S.split_writer(checks, f"{path}/good", f"{path}/bad")).awaitTermination()
    return path


def stream_quarantine(spark, base):
    """Rows per reason that the stream set aside, and those it kept (Q5, M6)."""
    path = _split_tables(spark, base)
    both = spark.read.parquet(f"{path}/good").withColumn("reason", F.lit("kept")).unionByName(spark.read.parquet(f"{path}/bad"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def _simple(spark: SparkSession, base: str) -> DataFrame:
    """events in the simple shape, and whether each is one of those planted to be late."""
    ev = read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    last = ev.agg(F.max("ts")).first()[0]
    return (E.join_profiles(ev, locations(spark, base)).withColumn("last_ts", F.lit(last)).select(
        "event_id", "user_id", F.col("event_type").alias("action"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("amount"), "location",
        F.expr(PLANTED).alias("planted")))


def _simple_stream(spark: SparkSession, base: str, path: str) -> DataFrame:
    """events in the simple shape as a file stream in the order of time."""
    land_in_order(_simple(spark, base).drop("planted"), f"{path}/in/events", ["timestamp", "event_id"])
    return follow(spark, "events", f"{path}/in", stored_schema(spark, f"{path}/in/events"))


@once("windows", ("events", "customer"))
def _window_table(spark, base):
    path = shared_path(spark, "stream-windows")
    agg = S.sliding_kpis_stream(_simple_stream(spark, base, path), delay=DELAY)
    S.start_query(agg, name="windows", checkpoint=f"{path}/checkpoint", trigger=NOW, rocksdb=True,
                  sink=S.window_upsert_writer(f"{path}/out")).awaitTermination()
    return f"{path}/out"


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def stream_sliding_kpis(spark, base):
    """Sliding windows kept up to date by an updating stream (M1, M2, K4 replace form)."""
    t = spark.read.parquet(_window_table(spark, base))
    return _ntz(t, "window_start", "window_end").select("window_start", "window_end", "action", "location", "event_count", "total_amount")


@once("tumbling", ("events", "customer"))
def _tumbling_table(spark, base):
    path = shared_path(spark, "stream-tumbling")
    agg = S.tumbling_stream(_simple_stream(spark, base, path), delay=DELAY, length="1 hour")
    S.start_query(agg, name="tumbling", checkpoint=f"{path}/checkpoint", mode="append", trigger=NOW, rocksdb=True,
                  sink=lambda df, batch_id: K.write_batch(df, f"{path}/out", batch_id)).awaitTermination()
    return f"{path}/out"


def stream_tumbling_kpis(spark, base):
    """Tumbling windows of a stream, each written once when the watermark has passed it (M1, M3)."""
    return _ntz(spark.read.parquet(_tumbling_table(spark, base)).drop("batch_id"), "window_start", "window_end")


@once("sessions", ("events", "customer"))
def _session_table(spark, base):
    path = shared_path(spark, "stream-sessions")
    agg = S.sessions_stream(_simple_stream(spark, base, path), delay=DELAY)
    with collected(spark) as progress:
        S.start_query(agg, name="sessions", checkpoint=f"{path}/checkpoint", mode="append", trigger=NOW, rocksdb=True,
                      sink=lambda df, batch_id: K.write_batch(df, f"{path}/out", batch_id)).awaitTermination()
    return f"{path}/out", progress.of("sessions")[-1]["state"]


def stream_gap_sessions(spark, base):
    """Gap sessions of a stream: each is written once, when the watermark has passed its
    end, and leaves the state (M4)."""
    return _ntz(spark.read.parquet(_session_table(spark, base)[0]).drop("batch_id"), "session_start", "session_end")


@once("dedup", ("events", "customer"))
def _dedup_table(spark, base):
    """Every event delivered twice.  The planted ones come after all others, when the
    stream is resumed: the deduplication drops and counts them as late, and a split
    ahead of it writes them to a table."""
    path = shared_path(spark, "stream-dedup")
    every = _simple(spark, base).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("copy")
    with collected(spark) as progress:
        for planted in (False, True):
            land_in_order(every.filter(F.col("planted") == planted).drop("planted"), f"{path}/in/events", ["timestamp", "event_id"])
            stream = follow(spark, "events", f"{path}/in", stored_schema(spark, f"{path}/in/events"))
            fresh = S.observed_batch(S.dedup_stream(stream, delay=DELAY).withColumn("revenue", F.col("amount")))
            split = S.late_split_writer(f"{path}/on_time", f"{path}/late", f"{path}/marks", "timestamp", DELAY)
            for q in (S.start_query(fresh, name="dedup", checkpoint=f"{path}/checkpoints/dedup", mode="append", fmt="parquet",
                                    path=f"{path}/out", trigger=NOW, rocksdb=True),
                      S.start_query(stream, name="late-split", checkpoint=f"{path}/checkpoints/split", mode="append", sink=split,
                                    trigger=NOW)):
                q.awaitTermination()
    return path, progress.of("dedup")


def stream_dedup(spark, base):
    """Every event in time delivered twice, kept once (M7)."""
    path, _ = _dedup_table(spark, base)
    return spark.read.parquet(f"{path}/out").groupBy("action").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"))


def stream_progress(spark, base):
    """What the stream's progress reports, and what the split stored: rows read, rows that
    came too late, rows after deduplication (M5, M17)."""
    path, progress = _dedup_table(spark, base)
    kept = sum(p["observed"].get("batch_metrics", {}).get("events", 0) for p in progress)
    stored = [spark.read.parquet(f"{path}/{table}").count() for table in ("late", "on_time")]
    return inline_rows(spark, [(sum(p["rows"] for p in progress), sum(p["late"] for p in progress), kept, *stored)],
                       "rows_read bigint, late_rows bigint, kept_rows bigint, late_stored bigint, on_time_stored bigint")


def stream_late_events(spark, base):
    """The rows that came too late, as the split ahead of the state stored them (M5)."""
    path, _ = _dedup_table(spark, base)
    return spark.read.parquet(f"{path}/late").groupBy("event_id").agg(F.count(F.lit(1)).alias("deliveries"))


@once("page-views", ("events",))
def _page_view_tables(spark, base):
    path = shared_path(spark, "stream-pages")
    ev = read_table(spark, base, "events", ["user_id", "ts", "props"])
    views = ev.select(json_key_long("props", "k").alias("article_id"), "user_id", F.col("ts").cast("timestamp").alias("timestamp"))
    land(views, f"{path}/in/page-views")
    stream = follow(spark, "page-views", f"{path}/in", stored_schema(spark, f"{path}/in/page-views"))
    S.start_query(stream, name="pages", checkpoint=f"{path}/checkpoint", mode="append", trigger=NOW,
                  sink=S.page_view_batch_writer(f"{path}/out")).awaitTermination()
    return f"{path}/out"


class Stopped(Exception):
    """Stands for a driver that is gone."""


@once("restart", ("events",))
def _restarted_tables(spark, base):
    """The page-view pipeline, stopped twice after its sink wrote a batch and before the
    checkpoint had it committed; every run resumes from the checkpoint (M16)."""
    path = shared_path(spark, "stream-restart")
    ev = read_table(spark, base, "events", ["event_id", "user_id", "ts", "props"])
    views = ev.select(json_key_long("props", "k").alias("article_id"), "user_id", F.col("ts").cast("timestamp").alias("timestamp"), "event_id")
    land_in_order(views, f"{path}/in/page-views", ["timestamp", "event_id"])
    schema = stored_schema(spark, f"{path}/in/page-views")
    files = files_per_batch(spark, f"{path}/in/page-views", "fileRows", 2)
    writer = S.page_view_batch_writer(f"{path}/out")
    stopped: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        if len(stopped) < 2 and batch_id not in stopped:
            stopped.append(batch_id)
            raise Stopped(f"after the sink, before the commit of batch {batch_id}")

    while True:
        stream = follow(spark, "page-views", f"{path}/in", schema, max_per_trigger=files)
        q = S.start_query(stream, name="restart", checkpoint=f"{path}/checkpoint", mode="append", trigger=NOW, sink=write)
        try:
            q.awaitTermination()
            break
        except StreamingQueryException as e:
            if "Stopped" not in str(e):
                raise
    return f"{path}/out", len(stopped)


def stream_restart(spark, base):
    """What an interrupted and resumed pipeline leaves: views per article, raw rows and
    history rows per day, all as after an undisturbed run (M16, K1, K4, K6)."""
    out, stops = _restarted_tables(spark, base)
    if stops != 2:
        raise RuntimeError(f"the pipeline was stopped {stops} times, not twice")
    counts = K.read_keyed(spark, f"{out}/article_aggregates").select(
        F.lit("article").alias("kind"), F.col("article_id").cast("string").alias("id"), F.col("daily_views").cast("bigint").alias("value"))
    per_day = [spark.read.parquet(f"{out}/{table}").groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("id"))
               .agg(F.count(F.lit(1)).alias("value")).select(F.lit(kind).alias("kind"), "id", "value")
               for kind, table in (("raw", "page_views_raw"), ("history", "history"))]
    return counts.unionByName(per_day[0]).unionByName(per_day[1])


def stream_article_views(spark, base):
    """Running counts per article, upserted batch by batch."""
    t = K.read_keyed(spark, f"{_page_view_tables(spark, base)}/article_aggregates")
    return t.select("article_id", F.col("daily_views").alias("views"))


def stream_page_history(spark, base):
    """The raw rows appended by batch and the history by date, counted per day (K1, K6)."""
    out = _page_view_tables(spark, base)
    raw = spark.read.parquet(f"{out}/page_views_raw").groupBy(F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("raw_rows"))
    history = spark.read.parquet(f"{out}/history").groupBy(F.col("date").alias("day")).agg(F.count(F.lit(1)).alias("history_rows"))
    return day_as_timestamp(raw.join(history, "day", "full"), "day")


@once("ingest", ("events",))
def _ingested(spark, base):
    path = shared_path(spark, "stream-ingest")
    ev = read_table(spark, base, "events", ["event_id", "user_id", "event_type", "ts"])
    action = F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
    rows = ev.select("event_id", "user_id", action.alias("action"), F.col("ts").cast("timestamp").alias("processed_at"))
    land(rows.unionByName(rows.filter(F.col("event_id") % 3 == 0)), f"{path}/in/events")
    stream = follow(spark, "events", f"{path}/in", stored_schema(spark, f"{path}/in/events"))
    rules = [Q.expect_not_null("user_id"), Q.expect_not_null("action")]
    S.ingest_validate_model(stream, f"{path}/out", f"{path}/checkpoint", "event_id", "processed_at", rules, M.daily_action_counts)
    return f"{path}/out"


def ingest_model(spark, base):
    """Re-sent events loaded once, validated, exported and modelled."""
    return day_as_timestamp(spark.read.parquet(f"{_ingested(spark, base)}/model"), "day")


def ingest_snapshot(spark, base):
    """The exported table: one row per event, stamped (K3, K5)."""
    t = spark.read.parquet(f"{_ingested(spark, base)}/snapshot")
    return t.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"),
                 F.count("exported_at").alias("stamped"))


@once("chain", chain_plan.TABLES)
def _chain_tables(spark, base):
    """All order lines, in the order of their orders, batch by batch through the whole
    chain (at least four).  What failed payments give back is booked, and sold again by
    later runs: so decisions are those of all orders at once."""
    path = shared_path(spark, "stream-chain")
    c = chain_plan.chain(spark, base)
    lines = (c.priced_lines().join(c.orders(), "order_id")
             .withColumn("order_date", F.col("order_date").cast("timestamp_ntz")))
    land_in_order(lines, f"{path}/in/lines", ["order_date", "order_id"], rows="orderLines")
    S.seed_stock(c.stock(), f"{path}/stock")
    stream = follow(spark, "lines", f"{path}/in", stored_schema(spark, f"{path}/in/lines"),
                    max_per_trigger=files_per_batch(spark, f"{path}/in/lines", "orderLines", 1))
    S.start_query(stream, name="chain", checkpoint=f"{path}/checkpoint", mode="append", trigger=NOW,
                  sink=S.order_chain_batch_writer(f"{path}/stock", f"{path}/log", chain_plan.PAYMENT_SUCCESS_RATE,
                                                  resell=False)).awaitTermination()
    return path


def stream_chain_stock(spark, base):
    """Stock left by the streamed chain: what failed payments held is back."""
    return S.stock_left(spark, f"{_chain_tables(spark, base)}/stock").select("product_id", F.col("stock").alias("available"))


def stream_chain_log(spark, base):
    """The streamed chain's events."""
    return spark.read.parquet(f"{_chain_tables(spark, base)}/log").select("order_id", "step", "event_type", "amount", "reason")


@once("status", chain_plan.TABLES)
def _status_tables(spark, base):
    """Chain events in order, with two kinds planted that must not count: a shipment of
    an order that is closed, and a payment before the reservation."""
    path = shared_path(spark, "stream-status")
    log = chain_plan.chain(spark, base).dated_log().select(
        "order_id", (F.col("step") * 10).alias("at"), "event_type", F.col("order_date").cast("timestamp").alias("timestamp"))
    created = log.filter("event_type = 'ORDER_CREATED'")
    planted = (created.filter("order_id % 50 = 0").select("order_id", F.lit(990).alias("at"), F.lit("SHIPMENT_CREATED").alias("event_type"), "timestamp")
               .unionByName(created.filter("order_id % 50 = 1").select(
                   "order_id", F.lit(15).alias("at"), F.lit("PAYMENT_COMPLETED").alias("event_type"), "timestamp")))
    land_in_order(log.unionByName(planted), f"{path}/in/log", ["timestamp", "order_id", "at"], rows="orderLines")
    stream = follow(spark, "log", f"{path}/in", stored_schema(spark, f"{path}/in/log"),
                    max_per_trigger=files_per_batch(spark, f"{path}/in/log", "orderLines", 1))
    with collected(spark) as progress:
        changes = S.order_status_machine(stream, block=F.floor(F.col("order_id") / ORDERS_PER_BLOCK))
        S.start_query(changes, name="status", checkpoint=f"{path}/checkpoint", mode="update", trigger=NOW, rocksdb=True,
                      sink=S.status_writer(f"{path}/out", f"{path}/rejects")).awaitTermination()
    return path, progress.of("status")[-1]["state"]


def stream_order_status(spark, base):
    """Current status per order, from the changes that the status machine wrote (M8)."""
    t = spark.read.parquet(f"{_status_tables(spark, base)[0]}/out")
    return t.groupBy("order_id").agg(F.max_by("status", "rank").alias("status"))


def stream_status_rejects(spark, base):
    """Events that may not follow what came before, by reason (M8)."""
    t = spark.read.parquet(f"{_status_tables(spark, base)[0]}/rejects")
    return t.groupBy("event_type", "reason").agg(F.count(F.lit(1)).alias("events"))


def stream_state_rows(spark, base):
    """Rows that stay in the state when the data ends: sessions whose end the watermark
    has not passed (M4), and orders that are not closed (M8)."""
    return inline_rows(spark, [("sessions", _session_table(spark, base)[1]), ("orders", _status_tables(spark, base)[1])],
                       "state string, rows bigint")


def csv_round_trip(spark, base):
    """Customers written as CSV with a header and read with a declared schema."""
    path = shared_path(spark, "csv")
    rows = read_table(spark, base, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    K.write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


def zones(spark, base):
    """Parts through the raw and the curated zone."""
    raw = read_table(spark, base, "part", ["p_partkey", "p_name", "p_type"])
    return K.write_zones(raw, lambda df: C.upper_column(df, "p_name"), shared_path(spark, "zones"))


def published_events(spark, base):
    """Event envelopes published as keyed JSON records and read back as a bounded
    topic (K10, S2, P1, P2)."""
    path = shared_path(spark, "published")
    log = chain_plan.chain(spark, base).log().select("order_id", "step", "event_type")
    K.publish_events(log, "order_id", fmt="parquet", topic="order-events", path=path)
    record = "key string, value string"
    back = E.decode_record(read_bounded(spark, "order-events", fmt="parquet", path=path, schema=record))
    parsed = E.parse_payload(back, log.schema)
    return parsed.filter(~F.col("_malformed")).select("key", "topic", "order_id", "step", "event_type")


def replayed_upserts(spark, base):
    """Counts per article from three batches, the table growing tenfold in the second
    and one of them applied twice (K4), and users inserted if absent from overlapping
    batches (K3).  Buckets are small here, so that they split."""
    path = shared_path(spark, "upserts")
    ev = read_table(spark, base, "events", ["event_id", "user_id", "ts", "props"]).withColumn("article_id", json_key_long("props", "k"))
    first, second = F.col("event_id") % 20 == 0, F.col("event_id") % 2 == 0
    held = ev.agg(F.greatest(F.approx_count_distinct("user_id"), F.approx_count_distinct("article_id"))).first()[0]
    most = max(int(setting(spark, "bucketRows")), -(-held // BUCKETS))
    table = KeyedTable(spark, f"{path}/counts", "article_id", {"n": "sum", "at": "max"}, bucket_rows=most, deltas=2)
    for batch, part in ((0, ev.filter(first)), (0, ev.filter(first)), (1, ev.filter(~first & second)), (2, ev.filter(~second))):
        table.append(M.count_per_key(part, "article_id", "n").withColumn("at", F.lit(batch)), batch)
    users = ev.select("user_id", "event_id")
    absent = KeyedTable(spark, f"{path}/users", "user_id", {"event_id": "any"}, bucket_rows=most)
    for part in (users.filter(second), users):
        absent.insert_absent(part, "event_id")
    for t in (table, absent):
        if max(b["rows"] for b in t.manifest()["buckets"]) > most:
            raise RuntimeError("a bucket holds more rows than it may")
    counts = table.read().select(F.lit("article").alias("kind"), F.col("article_id").alias("id"), F.col("n").alias("value"))
    firsts = absent.read().select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("event_id").alias("value"))
    return counts.unionByName(firsts)


def landed_documents(spark, base):
    """Customers landed as JSON documents, an array of up to 250 each, every fifth one
    cut short: customers and balance per document that could be read, and whether it
    was corrupt (S8)."""
    path = shared_path(spark, "documents")
    rows = read_table(spark, base, "customer", ["c_custkey", "c_name", "c_acctbal"]).withColumn(
        "doc", F.floor(F.col("c_custkey") / 250).cast("int"))
    array = F.to_json(F.sort_array(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal"))))  # 250 at most
    docs = rows.groupBy("doc").agg(array.alias("value")).withColumn(
        "value", F.when(F.col("doc") % 5 == 2, F.expr("left(value, length(value) - 20)")).otherwise(F.col("value")))
    docs.write.partitionBy("doc").text(path)
    back = read_json_documents(spark, path, "c_custkey bigint, c_name string, c_acctbal double, _corrupt_record string, doc int")
    good = F.col("_corrupt_record").isNull()
    return back.groupBy("doc").agg(F.count(F.when(good, F.col("c_custkey"))).alias("customers"),
                                   F.count(F.when(good, F.col("c_name"))).alias("names"),
                                   F.coalesce(money_sum(F.when(good, F.col("c_acctbal"))), F.lit(0.0)).alias("balance"),
                                   (F.count("_corrupt_record") > 0).alias("corrupt"))


def catalog_model(spark, base):
    """A catalog table replaced twice and the daily model built from it as a table."""
    raw, model = (f"tidewater_{n}_{uuid.uuid4().hex[:12]}" for n in ("events", "model"))
    ev = read_table(spark, base, "events", ["event_id", "user_id", "event_type", "ts"])
    action = F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
    rows = ev.select("event_id", "user_id", action.alias("action"), F.col("ts").cast("timestamp").alias("processed_at"))
    try:
        K.replace_table(rows.filter("event_id % 2 = 0"), raw)
        K.replace_table(rows, raw)
        K.create_table_as(M.daily_action_counts(spark.table(raw)), model)
        out = materialise(spark.table(model), "model")
    finally:
        for name in (raw, model):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return day_as_timestamp(out, "day")


def processing_stamps(spark, base):
    """Per event type, how many rows the processing stamp is set on, and on how many it
    lies within the run (P5)."""
    begun = spark.sql("SELECT current_timestamp() AS t").first().t
    ev = E.add_processing_time(read_table(spark, base, "events", ["event_id", "event_type"]))
    stamped = materialise(ev, "stamped")
    stamp = F.col("processing_timestamp")
    return stamped.groupBy("event_type").agg(F.count(stamp).alias("stamped"),
                                             F.count_if(stamp.between(F.lit(begun), F.current_timestamp())).alias("within_run"))


QUERIES = {
    "stream_business_metrics": stream_business_metrics,
    "stream_user_activity": stream_user_activity,
    "stream_product_performance": stream_product_performance,
    "stream_geographic_metrics": stream_geographic_metrics,
    "stream_platform_metrics": stream_platform_metrics,
    "stream_enriched_events": stream_enriched_events,
    "stream_quarantine": stream_quarantine,
    "stream_sliding_kpis": stream_sliding_kpis,
    "stream_tumbling_kpis": stream_tumbling_kpis,
    "stream_gap_sessions": stream_gap_sessions,
    "stream_dedup": stream_dedup,
    "stream_progress": stream_progress,
    "stream_late_events": stream_late_events,
    "stream_restart": stream_restart,
    "stream_article_views": stream_article_views,
    "stream_page_history": stream_page_history,
    "ingest_model": ingest_model,
    "ingest_snapshot": ingest_snapshot,
    "stream_chain_stock": stream_chain_stock,
    "stream_chain_log": stream_chain_log,
    "stream_order_status": stream_order_status,
    "stream_status_rejects": stream_status_rejects,
    "stream_state_rows": stream_state_rows,
    "csv_round_trip": csv_round_trip,
    "zones": zones,
    "published_events": published_events,
    "replayed_upserts": replayed_upserts,
    "landed_documents": landed_documents,
    "catalog_model": catalog_model,
    "processing_stamps": processing_stamps,
}
