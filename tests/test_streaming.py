"""Streaming forms: batch = stream on file streams, idempotent foreachBatch."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewater.operators import metrics as M
from tidewater.operators import windows as W
from tidewater.plans.testdata import enriched_events, simple_events
from tidewater.sinks import writers as K
from tidewater.streaming import pipelines as S


def _land(df, path, files=4):
    df.repartition(files).write.mode("overwrite").parquet(path)
    return df.schema


def test_sliding_kpis_stream_equals_batch(spark, tmp):
    batch = simple_events(spark, SF001)
    schema = _land(batch, f"{tmp}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp}/in")
    # watermark longer than the data's span: nothing is late
    agg = S.sliding_kpis_stream(stream, delay="40 days")
    q = S.start_query(agg, name="slide_t", checkpoint=f"{tmp}/ck", mode="complete", fmt="memory",
                      trigger={"availableNow": True})
    q.awaitTermination()
    got = {(r.window_start, r.action, r.location): (r.event_count, r.total_amount)
           for r in spark.table("slide_t").collect()}
    want = {(r.window_start, r.action, r.location): (r.event_count, r.total_amount)
            for r in W.sliding_kpis(batch.withColumn("timestamp", F.col("timestamp").cast("timestamp"))).collect()}
    assert got == want and len(got) > 100


def test_dedup_stream_and_late_rows(spark, tmp):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [("e1", t), ("e1", t + dt.timedelta(seconds=5)), ("e2", t + dt.timedelta(minutes=1))]
    df = spark.createDataFrame(rows, "event_id string, timestamp timestamp")
    schema = _land(df, f"{tmp}/in", 1)
    stream = spark.readStream.schema(schema).parquet(f"{tmp}/in")
    q = S.start_query(S.dedup_stream(stream, delay="10 minutes"), name="dedup_t", checkpoint=f"{tmp}/ck",
                      mode="append", fmt="memory", trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.event_id for r in spark.table("dedup_t").collect()) == ["e1", "e2"]
    assert S.late_rows(q) == 0


def test_order_status_stream(spark, tmp):
    rows = [("o1", 1, "ORDER_CREATED"), ("o1", 2, "INVENTORY_RESERVED"), ("o2", 1, "ORDER_CREATED"),
            ("o1", 5, "SHIPMENT_CREATED"), ("o1", 3, "PAYMENT_COMPLETED")]
    df = spark.createDataFrame(rows, "order_id string, step int, event_type string")
    schema = _land(df, f"{tmp}/in", 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    q = S.start_query(S.order_status_stream(stream), name="status_t", checkpoint=f"{tmp}/ck",
                      mode="complete", fmt="memory", trigger={"availableNow": True})
    q.awaitTermination()
    assert {r.order_id: r.status for r in spark.table("status_t").collect()} == {"o1": "shipped", "o2": "created"}


def test_metrics_foreach_batch_is_idempotent(spark, tmp):
    batch = enriched_events(spark, SF001).drop("user_profile").withColumn(
        "user_profile", F.struct(F.struct(F.lit("X").alias("country")).alias("location")))
    schema = _land(batch, f"{tmp}/in", 3)
    stream = spark.readStream.schema(schema).parquet(f"{tmp}/in")
    collector = S.ProgressCollector()
    spark.streams.addListener(collector)
    try:
        queries = S.start_metric_queries(S.observed_batch(stream), f"{tmp}/out", f"{tmp}/ck",
                                         trigger={"availableNow": True})
        for q in queries:
            q.awaitTermination()
    finally:
        spark.streams.removeListener(collector)
    out = spark.read.parquet(f"{tmp}/out/business_metrics_realtime").drop("batch_id")
    want = M.business_metrics(batch)
    assert out.count() == want.count()
    assert out.agg(F.sum("event_count")).first()[0] == batch.count()
    # replaying batch 0 through the writer leaves the same rows
    writer = S.metrics_batch_writer(f"{tmp}/out", {"business_metrics_realtime": M.business_metrics})
    writer(batch, 0)
    assert spark.read.parquet(f"{tmp}/out/business_metrics_realtime").count() == want.count()


def test_stream_reservation_writer_replay(spark, tmp):
    stock = spark.createDataFrame([("A", 5.0), ("B", 2.0)], "product_id string, stock double")
    S.seed_stock(stock, f"{tmp}/stock")
    lines = spark.createDataFrame([("o1", 1, 0, "A", 3.0), ("o2", 2, 0, "A", 3.0), ("o3", 3, 0, "B", 2.0)],
                                  "order_id string, order_date int, pos int, product_id string, quantity double")
    w = S.stream_reservation_writer(f"{tmp}/stock", f"{tmp}/dec")
    w(lines, 0)
    w(lines, 0)  # replay
    dec = {r.order_id: r.decision for r in spark.read.parquet(f"{tmp}/dec").collect()}
    assert dec == {"o1": "INVENTORY_RESERVED", "o2": "OUT_OF_STOCK", "o3": "INVENTORY_RESERVED"}
    left = S.stock_left(spark, f"{tmp}/stock")
    assert {r.product_id: r.stock for r in left.collect()} == {"A": 2.0, "B": 0.0}


def test_topic_readers_on_files(spark, tmp):
    from tidewater.operators.enrich import decode_record, parse_payload
    from tidewater.schemas import SIMPLE_EVENT
    from tidewater.sources.files import read_bounded, read_event_stream
    for topic, n in (("orders", 3), ("payments", 2)):
        rows = [(f"k{i}".encode(), f'{{"user_id": "u{i}", "action": "view", "amount": {i}.5}}'.encode(),
                 None, dt.datetime(2024, 1, 1)) for i in range(n)]
        df = spark.createDataFrame(rows, "key binary, value binary, topic string, timestamp timestamp")
        df.drop("topic").repartition(n).write.parquet(f"{tmp}/topics/{topic}")
    from pyspark.sql import types as T
    rec = T.StructType([f for f in spark.read.parquet(f"{tmp}/topics/orders").schema.fields])
    bounded = read_bounded(spark, ["orders", "payments"], fmt="parquet", path=f"{tmp}/topics", schema=rec)
    assert {r.topic: r.n for r in bounded.groupBy("topic").agg(F.count("*").alias("n")).collect()} == \
        {"orders": 3, "payments": 2}
    stream = read_event_stream(spark, ["orders", "payments"], fmt="parquet", path=f"{tmp}/topics",
                               schema=rec, max_per_trigger=1)
    parsed = parse_payload(decode_record(stream), SIMPLE_EVENT)
    q = S.start_query(parsed, name="topics_t", checkpoint=f"{tmp}/ck", mode="append", fmt="memory",
                      trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.table("topics_t").collect()
    assert len(out) == 5 and {r.topic for r in out} == {"orders", "payments"}
    assert sum(r.amount for r in out) == 0.5 + 1.5 + 2.5 + 0.5 + 1.5
    assert not any(r._malformed for r in out)


def test_late_rows_are_dropped_and_counted(spark, tmp):
    t = dt.datetime(2024, 1, 1, 12)
    first = spark.createDataFrame([("view", "EU", 1.0, t + dt.timedelta(hours=2), "u1")],
                                  "action string, location string, amount double, timestamp timestamp, user_id string")
    late = spark.createDataFrame([("view", "EU", 1.0, t, "u2")], first.schema)
    first.write.parquet(f"{tmp}/in/a")
    stream = spark.readStream.schema(first.schema).parquet(f"{tmp}/in/*")
    q = S.start_query(S.tumbling_stream(stream, delay="1 minute"), name="tumble_t", checkpoint=f"{tmp}/ck",
                      mode="update", fmt="memory", trigger={"processingTime": "0 seconds"})
    q.processAllAvailable()
    late.write.parquet(f"{tmp}/in/b")  # two hours behind the watermark
    q.processAllAvailable()
    dropped = S.late_rows(q)
    q.stop()
    assert dropped == 1
    assert spark.table("tumble_t").agg(F.sum("event_count")).first()[0] == 1


def test_sessions_stream_append_closes_sessions(spark, tmp):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [("u1", t, 1.0), ("u1", t + dt.timedelta(minutes=10), 2.0),
            ("u1", t + dt.timedelta(hours=5), 0.0)]  # the last event closes the first session
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp, amount double")
    df.write.parquet(f"{tmp}/in/a")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp}/in/*")
    q = S.start_query(S.sessions_stream(stream, delay="1 minute"), name="sess_t", checkpoint=f"{tmp}/ck",
                      mode="append", fmt="memory", trigger={"processingTime": "0 seconds"})
    q.processAllAvailable()
    q.processAllAvailable()  # a second batch applies the advanced watermark
    q.stop()
    out = spark.table("sess_t").collect()
    assert [(r.total_events, r.total_amount) for r in out] == [(2, 3.0)]


def test_page_view_writer_replay(spark, tmp):
    t = dt.datetime(2024, 1, 1, 12)
    pv = spark.createDataFrame([(1, 7, t), (1, 8, t), (2, 7, t + dt.timedelta(days=1))],
                               "article_id int, user_id int, timestamp timestamp")
    w = S.page_view_batch_writer(tmp)
    w(pv, 0)
    w(pv, 0)  # replay
    w(pv.filter("article_id = 1"), 1)
    counts = {r.article_id: r.daily_views for r in K.read_keyed(spark, f"{tmp}/article_aggregates").collect()}
    assert counts == {1: 4, 2: 1}
    assert spark.read.parquet(f"{tmp}/page_views_raw").count() == 5
    assert spark.read.parquet(f"{tmp}/history").count() == 5


def test_ingest_validate_model(spark, tmp):
    from tidewater.operators import metrics as M
    from tidewater.operators import quality as Q
    rows = [(1, "view", dt.datetime(2024, 1, 1)), (2, "cart", dt.datetime(2024, 1, 1)),
            (1, "view", dt.datetime(2024, 1, 1)), (3, "purchase", dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "id int, action string, processed_at timestamp")
    df.write.parquet(f"{tmp}/landing")
    src = spark.readStream.schema(df.schema).parquet(f"{tmp}/landing")
    rules = [Q.expect_not_null("id"), Q.expect_in_set("action", ["view", "purchase", "cart"])]
    rep = S.ingest_validate_model(src, f"{tmp}/lake", f"{tmp}/ck", "id", ["processed_at"], rules,
                                  M.daily_action_counts)
    assert all(r.success for r in rep)
    model = {str(r.day): (r.views, r.carts, r.purchases) for r in spark.read.parquet(f"{tmp}/lake/model").collect()}
    assert model == {"2024-01-01": (1, 1, 0), "2024-01-02": (0, 0, 1)}  # duplicate id 1 loaded once
    snap = spark.read.parquet(f"{tmp}/lake/snapshot")
    assert {"processed_at", "exported_at"} <= set(snap.columns)  # export time does not overwrite


def test_update_mode_windows_upserted_once(spark, tmp):
    batch = simple_events(spark, SF001).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    half = batch.agg(F.percentile_approx(F.unix_timestamp("timestamp"), 0.5)).first()[0]
    first = batch.filter(F.unix_timestamp("timestamp") < half)
    second = batch.filter(F.unix_timestamp("timestamp") >= half)
    first.write.parquet(f"{tmp}/in/a")
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmp}/in/*")
    agg = S.sliding_kpis_stream(stream, delay="40 days")
    q = S.start_query(agg, name="kpi_upsert", checkpoint=f"{tmp}/ck", mode="update",
                      sink=S.window_upsert_writer(f"{tmp}/kpis"), trigger={"processingTime": "0 seconds"})
    q.processAllAvailable()
    second.write.parquet(f"{tmp}/in/b")
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(f"{tmp}/kpis")
    keys = ["window_start", "action", "location"]
    assert got.groupBy(*keys).count().filter("count > 1").isEmpty()  # one row per window
    want = W.sliding_kpis(batch)
    assert {tuple(r[k] for k in keys): r.event_count for r in got.collect()} == \
        {tuple(r[k] for k in keys): r.event_count for r in want.collect()}


def test_order_chain_in_two_batches_equals_the_loop(spark, tmp):
    """Batch by batch: the plain reservation loop, the payment draw, and what failed
    payments held back in stock for the next batch."""
    import hashlib

    from tidewater.operators.reservation import sequential_reservation
    from tidewater.plans.orders import Chain
    c = Chain(spark, SF001)
    lines = c.priced_lines().join(c.orders(), "order_id")
    cut = lines.agg(F.percentile_approx(F.unix_timestamp("order_date"), 0.5)).first()[0]
    batches = [lines.filter(F.unix_timestamp("order_date") < cut), lines.filter(F.unix_timestamp("order_date") >= cut)]
    S.seed_stock(c.stock(), f"{tmp}/stock")
    w = S.order_chain_batch_writer(f"{tmp}/stock", f"{tmp}/log")
    w(batches[0], 0)
    w(batches[1], 1)
    w(batches[1], 1)  # replay of the last batch
    left = {r.product_id: float(r.stock) for r in c.stock().collect()}
    want = set()
    for batch in batches:
        by_order = {}
        for r in batch.collect():
            by_order.setdefault((r.order_date, r.order_id), []).append((r.product_id, r.quantity))
        accepted, _ = sequential_reservation([(k[1], v) for k, v in sorted(by_order.items())], left)
        for (_, oid), items in by_order.items():
            if not accepted[oid]:
                want.add((oid, "OUT_OF_STOCK"))
                continue
            want.add((oid, "INVENTORY_RESERVED"))
            if int(hashlib.md5(str(oid).encode()).hexdigest()[:8], 16) % 100 < 80:
                want.add((oid, "PAYMENT_COMPLETED"))
                for p, q in items:
                    left[p] -= q
            else:
                want |= {(oid, "PAYMENT_FAILED"), (oid, "INVENTORY_RELEASED")}
    log = spark.read.parquet(f"{tmp}/log")
    got = [(r.order_id, r.event_type) for r in log.collect()]
    kinds = {"OUT_OF_STOCK", "INVENTORY_RESERVED", "PAYMENT_COMPLETED", "PAYMENT_FAILED", "INVENTORY_RELEASED"}
    assert len(got) == len(set(got)) and {g for g in got if g[1] in kinds} == want
    stock = {r.product_id: r.stock for r in S.stock_left(spark, f"{tmp}/stock").collect()}
    assert stock == left


def test_failed_payments_give_stock_back(spark, tmp):
    """40 one-unit orders on 100 units: what failed payments held is there again."""
    rows = [(i, 1, i, 0, 7, 1.0, 5.0) for i in range(40)]
    lines = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_date int, pos int, product_id bigint, quantity double, price double")
    S.seed_stock(spark.createDataFrame([(7, 100.0)], "product_id bigint, stock double"), f"{tmp}/stock")
    S.order_chain_batch_writer(f"{tmp}/stock", f"{tmp}/log")(lines, 0)
    failed = spark.read.parquet(f"{tmp}/log").filter("event_type = 'PAYMENT_FAILED'").count()
    assert failed > 0
    assert S.stock_left(spark, f"{tmp}/stock").first().stock == 60.0 + failed


def test_metrics_writer_with_contracts_and_split_writer(spark, tmp):
    batch = enriched_events(spark, SF001)
    w = S.metrics_batch_writer(f"{tmp}/out", {"platform_analytics": M.platform_metrics,
                                              "business_metrics_realtime": M.business_metrics}, contracts=True)
    w(batch, 3)
    plat = spark.read.parquet(f"{tmp}/out/platform_analytics")
    assert dict(plat.dtypes)["revenue"] == "decimal(15,2)" and dict(plat.dtypes)["hour"] == "int"
    assert plat.count() == M.platform_metrics(batch).count()
    import os
    assert not os.path.exists(f"{tmp}/out/_quarantine/platform_analytics")  # nothing broke the contract
    rows = spark.createDataFrame([(1, 5.0), (None, 1.0), (3, -1.0)], "user_id int, amount double")
    split = S.split_writer([("missing_user", F.col("user_id").isNull()), ("negative", F.col("amount") < 0)],
                           f"{tmp}/good", f"{tmp}/bad")
    split(rows, 0)
    split(rows, 0)  # replay
    assert spark.read.parquet(f"{tmp}/good").count() == 1
    assert sorted(r.reason for r in spark.read.parquet(f"{tmp}/bad").collect()) == ["missing_user", "negative"]


def test_status_machine_over_batches(spark, tmp):
    """Events of an order over several batches: changes, rejected events, orders that close
    leave the state, and one that waits too long is given up."""
    from tidewater.sources.files import read_event_stream
    day = dt.datetime(2024, 1, 1)
    schema = "order_id bigint, at int, event_type string, timestamp timestamp"
    batches = [
        [(1, 1, "ORDER_CREATED", day), (2, 2, "INVENTORY_RESERVED", day), (2, 1, "ORDER_CREATED", day), (3, 1, "ORDER_CREATED", day),
         (4, 1, "PAYMENT_COMPLETED", day)],
        [(1, 2, "OUT_OF_STOCK", day), (2, 3, "SHIPMENT_CREATED", day), (2, 4, "PAYMENT_COMPLETED", day)],
        [(1, 3, "INVENTORY_RESERVED", day), (2, 5, "READY_FOR_SHIPMENT", day), (2, 6, "SHIPMENT_CREATED", day)],
        [(9, 1, "ORDER_CREATED", day + dt.timedelta(30))],
    ]
    progress = S.ProgressCollector()
    spark.streams.addListener(progress)
    try:
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp}/in/log")
            stream = read_event_stream(spark, "log", fmt="parquet", path=f"{tmp}/in", schema=spark.read.parquet(f"{tmp}/in/log").schema)
            S.start_query(S.order_status_machine(stream, block=F.col("order_id") % 2), name="machine", checkpoint=f"{tmp}/ck",
                          trigger={"availableNow": True}, rocksdb=True,
                          sink=S.status_writer(f"{tmp}/out", f"{tmp}/rejects")).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(progress)
    status = {r.order_id: r.status for r in spark.read.parquet(f"{tmp}/out").groupBy("order_id").agg(F.max_by("status", "rank").alias("status")).collect()}
    assert status == {1: "created", 2: "shipped", 3: "created", 9: "created"}
    rejects = {(r.order_id, r.event_type, r.reason) for r in spark.read.parquet(f"{tmp}/rejects").collect()}
    assert rejects == {(4, "PAYMENT_COMPLETED", "unknown or closed order"), (1, "INVENTORY_RESERVED", "unknown or closed order"),
                       (2, "SHIPMENT_CREATED", "SHIPMENT_CREATED after INVENTORY_RESERVED"), (3, None, "expired after ORDER_CREATED")}
    assert progress.of("machine")[-1]["state"] == 1  # the block of order 9


def test_late_split_is_the_same_when_replayed(spark, tmp):
    at = dt.datetime(2024, 1, 1, 12)
    minutes = [[0, 5, 30], [21, 19, 20, None], [60, 25]]
    w = S.late_split_writer(f"{tmp}/on", f"{tmp}/late", f"{tmp}/marks", "t", "10 minutes")
    for i, batch in enumerate(minutes):
        rows = spark.createDataFrame([(m, at + dt.timedelta(minutes=m) if m is not None else None) for m in batch], "m int, t timestamp")
        w(rows, i)
        w(rows, i)  # replay
    late = {(r.batch_id, r.m) for r in spark.read.parquet(f"{tmp}/late").collect()}
    assert late == {(1, 19), (1, 20)}
    assert spark.read.parquet(f"{tmp}/on").count() == 7


def test_ordered_topics_come_in_order_and_in_bounded_batches(spark, tmp):
    from tidewater.sources.files import read_event_stream, write_in_order
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"), F.lit("x" * 50).alias("pad"))
    write_in_order(rows.filter("n < 600"), f"{tmp}/in/t", ["n"], 6)
    write_in_order(rows.filter("n >= 600"), f"{tmp}/in/t", ["n"], 4)
    seen = []
    stream = read_event_stream(spark, "t", fmt="parquet", path=f"{tmp}/in", max_bytes=1, schema=rows.schema)
    S.start_query(stream, name="ordered", checkpoint=f"{tmp}/ck", mode="append", trigger={"availableNow": True},
                  sink=lambda df, _id: seen.append(df.agg(F.min("n"), F.max("n"), F.count("n")).first())).awaitTermination()
    assert len(seen) == 10 and sum(r[2] for r in seen) == 1000  # a file at least, whatever the limit
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_exact_parts_over_batches(spark, tmp):
    batch = enriched_events(spark, SF001)
    w = S.metrics_batch_writer(f"{tmp}/out", {"platform_analytics": M.platform_metrics}, exact=True)
    for i in range(3):
        w(batch.filter(F.col("user_id") % 3 != i), i)  # every user comes in two batches
    want = {M_key(r): (r.unique_users, r.avg_purchase_value) for r in M.platform_metrics(batch).collect()}
    parts = S.exact_parts(spark, f"{tmp}/out", "platform_analytics")
    got = parts["users"].join(parts["averages"], "group", "left").collect()
    assert len(got) == len(want) and all(want[r.group][0] == r.members for r in got)
    assert all((want[r.group][1] is None) == (r.average is None) for r in got)


def M_key(r):
    import json
    return json.dumps({c: r[c] for c in ("device_type", "browser", "operating_system", "hour") if r[c] is not None}, separators=(",", ":"))


def test_batches_do_not_grow_in_number(spark):
    from tidewater.plans import streams
    for name in ("fileRows", "orderLines", "bytesPerTrigger"):
        spark.conf.unset(f"spark.tidewater.stream.{name}")
    for whole in (10, 10_000, 10_000_000):
        share = streams.batch_share(spark, "orderLines", whole, 1, 10 ** 9)
        assert share >= 1 and -(-whole // share) <= streams.BATCHES
    assert streams.batch_share(spark, "orderLines", 3, 2, 10) == 2  # small topics as the defaults say
    assert streams.batch_share(spark, "orderLines", 10_000, 1, 10) == 10  # not beyond a cluster's batch
    spark.conf.set("spark.tidewater.stream.orderLines", "250000")
    try:
        assert streams.batch_share(spark, "orderLines", 10_000, 1, 10) == 1  # what the session names counts
    finally:
        spark.conf.unset("spark.tidewater.stream.orderLines")
