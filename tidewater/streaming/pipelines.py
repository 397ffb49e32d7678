"""Structured Streaming forms of the operators.

The batch operators are reused unchanged on streaming DataFrames; this
module adds the watermark, the output mode, the trigger, one checkpoint
folder per query and idempotent ``foreachBatch`` writers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewater.operators import metrics as M
from tidewater.operators import orders as O
from tidewater.operators import windows as W
from tidewater.session import discard
from tidewater.sinks.keyed import KeyedTable
from tidewater.sinks.writers import _exists, console_sink, fan_out_writes, write_batch

__all__ = [
    "with_event_time_watermark", "sliding_kpis_stream", "tumbling_stream", "sessions_stream",
    "dedup_stream", "order_status_stream", "metrics_batch_writer", "start_query",
    "start_metric_queries", "late_rows", "ProgressCollector", "observed_batch",
    "page_view_batch_writer", "ingest_validate_model", "stream_reservation_writer",
    "window_upsert_writer", "order_chain_batch_writer", "split_writer", "seed_stock", "stock_left",
    "order_status_machine", "status_writer", "late_split_writer", "exact_parts",
]


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_event_time_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on event time (M1).  The column must be TIMESTAMP: text is parsed
    and TIMESTAMP_NTZ is converted first (a watermark on either is rejected)."""
    dtype = df.schema[ts].dataType.typeName()
    if dtype == "string":
        df = df.withColumn(ts, F.try_to_timestamp(F.col(ts)))
    elif dtype == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def sliding_kpis_stream(events: DataFrame, ts: str = "timestamp", delay: str = "1 minute",
                        length: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Sliding-window KPIs on a stream (M2).  Distinct users are approximate:
    exact distinct counts are not supported in streaming aggregations."""
    return W.sliding_kpis_approx(with_event_time_watermark(events, ts, delay), ts, length, slide)


def tumbling_stream(events: DataFrame, ts: str = "timestamp", delay: str = "1 minute",
                    length: str = "1 minute", keys=("action",)) -> DataFrame:
    """Tumbling buckets on a stream (M3)."""
    return W.tumbling_counts(with_event_time_watermark(events, ts, delay), ts, length, keys)


def sessions_stream(events: DataFrame, ts: str = "timestamp", delay: str = "10 minutes",
                    gap: str = "30 minutes", key: str = "user_id") -> DataFrame:
    """Gap sessions on a stream (M4); use append (rows appear once the watermark
    closes the session) or complete mode, update mode is rejected."""
    return W.session_windows(with_event_time_watermark(events, ts, delay), ts, gap, key)


def dedup_stream(events: DataFrame, key: str = "event_id", ts: str = "timestamp",
                 delay: str = "10 minutes") -> DataFrame:
    """Drop re-delivered events by id within the watermark (M7)."""
    return with_event_time_watermark(events, ts, delay).dropDuplicatesWithinWatermark([key])


def order_status_stream(log: DataFrame) -> DataFrame:
    """Current status per order on a stream of chain events (M8), update mode."""
    return O.current_status(log)


#: Events that may follow an event of an order, and those that close it, as the named
#: chains tell; nothing but the first one of a chain opens an order.
OPENS = {steps[0] for _, steps in O.CHAINS}
FOLLOWS = {a: {steps[i + 1] for _, steps in O.CHAINS for i, x in enumerate(steps[:-1]) if x == a}
           for _, steps in O.CHAINS for a in steps}
CLOSES = {steps[-1] for _, steps in O.CHAINS}
_STATUS = {event: (status, rank) for event, status, rank in O.STATUS_BY_EVENT}


def order_status_machine(log: DataFrame, ts: str = "timestamp", delay: str = "1 day", expiry: str = "7 days",
                         block: Column | None = None) -> DataFrame:
    """Status changes per order on a stream of chain events (M8): ``order_id, at,
    event_type, status, rank, reason``.

    ``log`` has ``order_id, at, event_type`` and event time ``ts``; ``at`` orders an
    order's events.  An event that may follow the last one is taken and shows the
    status (if it changes it); any other is set aside with a reason and changes nothing.
    The event that closes an order takes it out of the state, and one that stays open
    until the watermark is ``expiry`` past its last event is given up.  So state holds
    open orders only, and a batch writes what changed.

    State is kept per ``block`` of orders (a bigint; by default every order by itself):
    a call into Python costs far more than an event, so a block of a few hundred
    neighbouring ids is that many times cheaper, and its state stays as bounded.
    """
    order_type = log.schema["order_id"].dataType
    wait = int(expiry.split()[0]) * {"hour": 3_600_000, "day": 86_400_000}[expiry.split()[1].rstrip("s")]
    names = ["order_id", "at", "event_type", "status", "rank", "reason"]

    def step(key, frames, state):
        import json

        import pandas as pd
        # open orders of the block: [id, last event, time of it]
        held = {o: (last, at) for o, last, at in json.loads(state.get[0])} if state.exists else {}
        rows = []
        if state.hasTimedOut:
            now = state.getCurrentWatermarkMs()
            for order, (last, at) in list(held.items()):
                if at + wait <= now:
                    rows.append((order, 0, "", "", 0, f"expired after {last}"))
                    del held[order]
        else:
            events = sorted((e for f in frames for e in zip(f["order_id"].tolist(), f["at"].tolist(), f["event_type"].tolist(),
                                                           f["time"].tolist())), key=lambda e: e[:2])
            for order, at, event, time in events:
                last = held[order][0] if order in held else None
                if event not in (OPENS if last is None else FOLLOWS[last]):
                    rows.append((order, at, event, "", 0, "unknown or closed order" if last is None else f"{event} after {last}"))
                    continue
                rows.append((order, at, event, *_STATUS.get(event, ("", 0)), ""))
                if event in CLOSES:
                    held.pop(order, None)
                else:
                    held[order] = (event, time)
        if held:
            state.update((json.dumps([[o, *v] for o, v in held.items()]),))
            state.setTimeoutTimestamp(max(min(at for _, at in held.values()) + wait, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(rows, columns=names)

    events = with_event_time_watermark(log, ts, delay).select(
        (F.xxhash64("order_id") if block is None else block.cast("bigint")).alias("block"),
        "order_id", F.col("at").cast("int").alias("at"), "event_type", F.unix_millis(F.col(ts)).alias("time"), ts)
    out = events.groupBy("block").applyInPandasWithState(
        step, f"order_id {order_type.simpleString()}, at int, event_type string, status string, rank int, reason string",
        "orders string", "update", "EventTimeTimeout")
    return out.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("event_type", "status", "reason")})


def status_writer(status_path: str, rejects_path: str):
    """``foreachBatch`` body: status changes and rejected events, each under its batch id."""
    def write(changes: DataFrame, batch_id: int) -> None:
        changes = changes.persist()
        try:
            write_batch(changes.filter("reason IS NULL AND status IS NOT NULL").select("order_id", "status", "rank"), status_path, batch_id)
            write_batch(changes.filter("reason IS NOT NULL").drop("status", "rank"), rejects_path, batch_id)
        finally:
            changes.unpersist()
    return write


def late_split_writer(on_time_path: str, late_path: str, marks_path: str, ts: str, delay: str):
    """``foreachBatch`` body ahead of stateful work (M5): rows behind the watermark go to a
    table of their own instead of only being counted when they are dropped.

    The watermark of a batch is the latest time of the batches before it less ``delay``;
    every batch writes its latest time beside its rows, so a replay splits alike.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            mark = F.lit(False)
            if _exists(rows, marks_path):
                latest = rows.sparkSession.read.parquet(marks_path).filter(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]
                mark = F.coalesce(F.col(ts) <= F.lit(latest) - F.expr(f"INTERVAL {delay}"), F.lit(False)) if latest else mark
            write_batch(rows.filter(~mark), on_time_path, batch_id)
            write_batch(rows.filter(mark), late_path, batch_id)
            write_batch(rows.agg(F.max(ts).alias("latest")), marks_path, batch_id)
        finally:
            rows.unpersist()
    return write


def metrics_batch_writer(base: str, metric_fns: dict, contracts: bool = False, exact: bool = False):
    """``foreachBatch`` body computing several metric tables from one cached
    micro-batch and writing each under ``base/<name>`` keyed by batch id
    (M6, K1, K14).  Replays overwrite their own batch partition.

    With ``contracts`` each table is first conformed to the sink contract of
    the same name (K15): rows that break it go to ``base/_quarantine/<name>``
    with the reason (Q5) instead of failing the batch.

    Distinct counts and averages of separate batches don't add.  With ``exact`` each
    batch also writes bitmaps of its users, its distinct sessions, and sums and counts
    (A12), from which ``exact_parts`` gives the values over all batches.
    """
    from tidewater.sinks.writers import conform, write_if_not_empty

    def one(df: DataFrame, fn, name: str, batch_id: int) -> None:
        out = fn(df)
        if contracts:
            good, bad = conform(out, name)
            write_if_not_empty(bad, lambda b: write_batch(b, f"{base}/_quarantine/{name}", batch_id))
            out = good
        write_batch(out, f"{base}/{name}", batch_id)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        writers = {name: (lambda df, f=fn, n=name: one(df, f, n, batch_id))
                   for name, fn in metric_fns.items()}
        if exact:
            writers.update({f"_parts/{name}": (lambda df, f=fn, n=name: write_batch(f(df), f"{base}/_parts/{n}", batch_id))
                            for name, fn in PARTS.items()})
        fan_out_writes(batch_df, writers)
    return write


#: Tables beside the metric rows that make them exact over batches (see ``exact_parts``).
PARTS = {"users": M.member_bitmaps, "members": M.distinct_members, "averages": M.value_sums}


def exact_parts(spark: SparkSession, base: str, metric: str) -> dict[str, DataFrame]:
    """Distinct users, other distinct members and averages of a metric's groups over all
    batches: tables of (group, value) by name."""
    merge = {"users": M.merged_bitmaps, "members": M.merged_members, "averages": M.merged_averages}
    return {name: fn(spark.read.parquet(f"{base}/_parts/{name}").filter(F.col("metric") == metric)) for name, fn in merge.items()}


def split_writer(checks, good_path: str, bad_path: str):
    """``foreachBatch`` body routing each micro-batch to a clean table and a
    quarantine table carrying the first failing check (Q5 on a stream)."""
    from tidewater.operators.quality import tag_quarantine

    def write(batch_df: DataFrame, batch_id: int) -> None:
        tagged = tag_quarantine(batch_df, checks).persist()
        try:
            write_batch(tagged.filter(F.col("reason").isNull()).drop("reason"), good_path, batch_id)
            write_batch(tagged.filter(F.col("reason").isNotNull()), bad_path, batch_id)
        finally:
            tagged.unpersist()
    return write


def start_query(df: DataFrame, *, name: str, checkpoint: str, mode: str = "update",
                sink=None, fmt: str | None = None, path: str | None = None,
                trigger: dict | None = None, options: dict | None = None, rocksdb: bool = False):
    """Start one query with its own checkpoint folder.

    ``sink`` is a ``foreachBatch`` function; otherwise ``fmt``/``path`` name a
    built-in sink.  ``trigger`` is e.g. ``{'processingTime': '60 seconds'}``
    or ``{'availableNow': True}`` (K2: the trigger plus the source's
    ``max_per_trigger`` or ``max_bytes`` bound each micro-batch).  ``rocksdb`` keeps its
    state on disk beside the executors instead of in their heaps.
    """
    spark = df.sparkSession
    if rocksdb:
        before = spark.conf.get(STATE_STORE, None)
        spark.conf.set(STATE_STORE, ROCKSDB)
        try:  # a query keeps the settings it was started under
            return start_query(df, name=name, checkpoint=checkpoint, mode=mode, sink=sink, fmt=fmt, path=path,
                               trigger=trigger, options=options)
        finally:
            spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if sink is not None:
        w = w.foreachBatch(sink)
    elif fmt is not None:
        w = w.format(fmt)
    return w.start(path) if path else w.start()


def start_metric_queries(events: DataFrame, base: str, checkpoint_base: str, trigger=None,
                         preview: bool = False, contracts: bool = False, categories: DataFrame | None = None,
                         exact: bool = False):
    """Pipeline A: enriched stream → five metric tables per micro-batch, plus the
    raw enriched events and optionally a console preview, each its own query
    with its own checkpoint (M15, M16).  Returns the started queries; wait with
    ``spark.streams.awaitAnyTermination()`` so a failure of any one is seen.

    Purchases name their products in a list: product metrics see one row per
    product, and ``categories`` (product_name, product_category) names its category.
    """
    from tidewater.operators.enrich import explode_purchase_products
    fns = {
        "user_activity_detailed": M.user_activity,
        "business_metrics_realtime": M.business_metrics,
        "product_performance": lambda df: M.product_performance(explode_purchase_products(df, categories)),
        "geographic_analytics": M.geographic_metrics,
        "platform_analytics": M.platform_metrics,
    }
    metrics = start_query(events, name="metrics", checkpoint=f"{checkpoint_base}/metrics",
                          mode="append", sink=metrics_batch_writer(base, fns, contracts, exact),
                          trigger=trigger)
    raw = start_query(events, name="enriched_events", checkpoint=f"{checkpoint_base}/enriched_events",
                      mode="append", fmt="parquet", path=f"{base}/enriched_events", trigger=trigger)
    out = [metrics, raw]
    if preview:
        out.append(console_sink(events, rows=10, mode="append")
                   .option("checkpointLocation", f"{checkpoint_base}/console").start())
    return out


def page_view_batch_writer(base: str):
    """``foreachBatch`` body of the page-view counter (pipeline C): raw rows
    appended by batch id (K1), running per-article counts upserted (K4) and a
    date-partitioned history (K6); every step is safe to replay."""
    from tidewater.operators.metrics import count_per_key
    from tidewater.sinks.writers import append_history, upsert_counts_table

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            write_batch(batch_df, f"{base}/page_views_raw", batch_id)
            counts = (count_per_key(batch_df, "article_id", "daily_views")
                      .withColumn("last_updated", F.current_timestamp()))
            upsert_counts_table(counts, f"{base}/article_aggregates", batch_id, "article_id",
                                "daily_views", "last_updated")
            append_history(batch_df, f"{base}/history", "timestamp", batch_id=batch_id)
        finally:
            batch_df.unpersist()
    return write


def ingest_validate_model(source: DataFrame, base: str, checkpoint: str, key: str, order_cols,
                          rules, model):
    """Pipeline D as one bounded job: read everything available
    (``availableNow``), load it insert-if-absent (K3), gate on the validation
    report (Q3), then snapshot the table (K5) and rebuild the model (K12).

    Returns the validation report rows; raises if a rule fails, before the
    model is rebuilt."""
    from tidewater.operators.quality import validation_report
    from tidewater.sinks.writers import insert_if_absent_table, read_keyed, snapshot

    raw_path = f"{base}/raw"
    q = start_query(source, name="ingest", checkpoint=checkpoint, mode="append",
                    sink=lambda df, batch_id: insert_if_absent_table(df, raw_path, key, order_cols, batch_id),
                    trigger={"availableNow": True})
    q.awaitTermination()
    spark = source.sparkSession
    table = read_keyed(spark, raw_path)
    report = validation_report(table, rules).collect()  # one row per rule
    failed = [r.rule for r in report if not r.success]
    if failed:
        raise ValueError(f"validation failed: {failed}")
    snapshot(table, f"{base}/snapshot", stamp_col="exported_at")
    snapshot(model(spark.read.parquet(f"{base}/snapshot")), f"{base}/model")
    return report


def window_upsert_writer(path: str, keys=("window_start", "window_end", "action", "location")):
    """``foreachBatch`` body for windows aggregated in update mode (pipeline B):
    a window re-emitted by a later micro-batch replaces its earlier row."""
    from tidewater.sinks.writers import upsert_latest

    def write(batch_df: DataFrame, batch_id: int) -> None:
        upsert_latest(batch_df, path, list(keys), "window_day", F.to_date(F.col("window_start")))
    return write


def late_rows(query) -> int:
    """Rows dropped behind the watermark (M5): over all micro-batches of a query that
    a ``ProgressCollector`` has seen, or of the progress that a query still keeps."""
    if isinstance(query, ProgressCollector):
        return sum(e["late"] for e in query.events)
    return sum(_dropped(p.get("stateOperators", [])) for p in query.recentProgress)


def _dropped(operators) -> int:
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in operators)


def observed_batch(df: DataFrame, name: str = "batch_metrics") -> DataFrame:
    """Attach per-batch counters (events, distinct-free revenue) read from the
    query progress without extra jobs (A6 on a stream, M17)."""
    return df.observe(name, F.count(F.lit(1)).alias("events"),
                      F.sum(F.coalesce(F.col("revenue"), F.lit(0.0))).alias("revenue"))


class ProgressCollector(StreamingQueryListener):
    """Keeps the progress of every query (M17): rows in, batch duration, observed
    metrics.  Register with ``spark.streams.addListener``."""

    def __init__(self):
        self.events = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.events.append({"name": p.name, "batch": p.batchId, "rows": p.numInputRows,
                            "late": sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators),
                            "state": sum(int(op.numRowsTotal) for op in p.stateOperators),
                            "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}})

    def of(self, name: str) -> list[dict]:
        """The progress of one query, batch by batch (no-data batches included)."""
        return [e for e in self.events if e["name"] == name]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def seed_stock(stock: DataFrame, path: str) -> None:
    """The stock (``product_id, stock``) as a keyed table that micro-batches book into:
    each adds what it takes and gives back as its own rows, so a batch writes as much
    as it touches, and full buckets are compacted now and then."""
    rows = stock.select("product_id", F.col("stock").cast("double").alias("stock"), F.lit(0.0).alias("returned"))
    KeyedTable(stock.sparkSession, path, "product_id", {"stock": "sum", "returned": "sum"}).append(rows, -1)


def stock_left(spark: SparkSession, path: str) -> DataFrame:
    """``product_id, stock`` after the last batch, with what failed payments gave back."""
    return KeyedTable(spark, path).read().select("product_id", (F.col("stock") + F.col("returned")).alias("stock"))


def _stock_before(lines: DataFrame, stock_path: str, batch_id: int) -> DataFrame:
    """Stock of the products that the lines may ask for, as the batches before left it."""
    return KeyedTable(lines.sparkSession, stock_path).read(before=batch_id, touching=lines.select("product_id").distinct())


def _book(lines: DataFrame, taken: DataFrame, returned: DataFrame, stock_path: str, batch_id: int) -> None:
    """What the orders in ``taken`` took, and what those in ``returned`` gave back."""
    def amount(orders: DataFrame, sign: int, column: str) -> DataFrame:
        return lines.join(orders.select("order_id"), "order_id", "left_semi").select(
            "product_id", *(((F.col("quantity") * sign) if c == column else F.lit(0.0)).alias(c) for c in ("stock", "returned")))
    rows = amount(taken, -1, "stock").unionByName(amount(returned, 1, "returned"))
    KeyedTable(lines.sparkSession, stock_path).append(rows, batch_id)


def stream_reservation_writer(stock_path: str, decisions_path: str):
    """``foreachBatch`` body for M9 on a stream: each micro-batch's orders are
    reserved against what earlier batches left (``seed_stock`` begins the table at
    ``stock_path``).  A batch always starts from the table as it was *before* its own
    id, so a replayed batch makes the same decisions and overwrites its own partition;
    what it took is booked once."""
    from tidewater.operators.reservation import reserve_stock

    def write(lines: DataFrame, batch_id: int) -> None:
        lines = lines.persist()
        try:
            decided = reserve_stock(lines, _stock_before(lines, stock_path, batch_id))
            write_batch(decided, decisions_path, batch_id)
            held = decided.filter(F.col("decision") == "INVENTORY_RESERVED")
            _book(lines, held, held.limit(0), stock_path, batch_id)
            discard(decided)
        finally:
            lines.unpersist()
    return write


def order_chain_batch_writer(stock_path: str, log_path: str, success_rate: float = 0.8, resell: bool = True):
    """``foreachBatch`` body running the whole order chain on each micro-batch of
    order lines (``order_id, customer_id, order_date, pos, product_id,
    quantity, price``): reservation against the stock earlier batches left,
    payment, shipment, and the event log written under its batch id (M9-M14
    on a stream).  A failed payment releases its items: the log says so, and the
    stock that the next batch starts from holds them again.  Without ``resell`` they
    are booked as returned and counted by ``stock_left``, but not promised to later
    orders of the run, so decisions do not depend on where batches end.  Replays
    rewrite the same partitions."""
    from tidewater.operators.reservation import reserve_stock

    def write(lines: DataFrame, batch_id: int) -> None:
        lines = lines.persist()
        shared: list[DataFrame] = [lines]
        try:
            decided = reserve_stock(lines, _stock_before(lines, stock_path, batch_id))
            orders = lines.groupBy("order_id").agg(F.min("customer_id").alias("customer_id"))
            totals = O.order_totals(orders, lines.drop("customer_id"), items=True).persist()
            shared.append(totals)
            valid = O.validate_orders(totals).filter("is_valid")
            held = decided.filter(F.col("decision") == "INVENTORY_RESERVED")
            payments = O.payment_stage(held, totals, success_rate=success_rate).persist()
            shared.append(payments)
            log = O.event_log(valid, decided, payments, O.shipment_stage(payments))
            write_batch(log, log_path, batch_id)
            paid = payments.filter(F.col("status") == "PAYMENT_COMPLETED")
            failed = payments.filter(F.col("status") == "PAYMENT_FAILED")
            _book(lines, paid if resell else held, failed.limit(0) if resell else failed, stock_path, batch_id)
            discard(decided)
        finally:
            for table in shared:
                table.unpersist()
    return write
