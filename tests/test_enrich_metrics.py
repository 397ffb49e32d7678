"""Parsing, enrichment, metrics and windows on small fixtures."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidewater.operators import enrich as E
from tidewater.operators import metrics as M
from tidewater.operators import windows as W
from tidewater.schemas import RICH_EVENT


def _event(eid, uid, etype, ts, **kw):
    d = {"event_id": eid, "user_id": uid, "event_type": etype, "timestamp": ts,
         "session_id": f"session_{uid}_20240101",
         "user_profile": {"age": kw.pop("age", 30), "loyalty_tier": kw.pop("tier", "gold"),
                          "location": {"country": kw.pop("country", "US")}},
         "device_type": "mobile", "browser": "chrome", "operating_system": "ios"}
    d.update(kw)
    return json.dumps(d)


def _records(spark, values):
    rows = [(f"k{i}".encode(), v.encode() if v is not None else None, "user-events",
             dt.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, timestamp timestamp")


def _enriched(spark, values):
    parsed = E.parse_payload(E.decode_record(_records(spark, values)), RICH_EVENT)
    return E.enrich_events(E.add_event_time(parsed.filter(~F.col("_malformed"))))


def test_parse_malformed_and_bad_timestamp(spark):
    vals = [_event("e1", 1, "page_view", "2024-01-01T10:00:00"),
            "{not json", _event("e2", 2, "purchase", "not-a-time", order_value=20.5, products=["a", "b"])]
    parsed = E.parse_payload(E.decode_record(_records(spark, vals)), RICH_EVENT)
    flags = [r._malformed for r in parsed.orderBy("key").collect()]
    assert flags == [False, True, False]
    en = E.add_event_time(parsed.filter(~F.col("_malformed")))
    times = {r.event_id: r.event_timestamp for r in en.collect()}
    assert times["e1"] is not None and times["e2"] is None  # bad time → NULL, row kept


def test_enrich_flags_and_defaults(spark):
    vals = [_event("e1", 1, "purchase", "2024-01-01T10:00:00", order_value=20.5, products=["a", "b"]),
            _event("e2", 1, "add_to_cart", "2024-01-01T10:01:00", products=[]),
            _event("e3", 2, "page_view", "2024-01-01T10:02:00", age=None, tier=None)]
    out = {r.event_id: r for r in _enriched(spark, vals).collect()}
    assert (out["e1"].is_purchase, out["e1"].revenue, out["e1"].product_count) == (1, 20.5, 2)
    assert (out["e2"].is_add_to_cart, out["e2"].revenue, out["e2"].product_count) == (1, 0.0, 0)
    assert (out["e3"].user_segment, out["e3"].age_group, out["e3"].product_count) == ("basic", "55+", 0)
    assert (out["e1"].hour, out["e1"].minute, str(out["e1"].date)) == (10, 0, "2024-01-01")


def test_purchase_products_reach_product_metrics(spark):
    vals = [_event("e1", 1, "purchase", "2024-01-01T10:00:00", order_value=30.0, products=["a", "b"]),
            _event("e2", 1, "product_view", "2024-01-01T10:01:00", product_name="a",
                   product_category="books", product_price=10.0)]
    pm = M.product_performance(E.explode_purchase_products(_enriched(spark, vals)))
    # purchases carry names only, so their rows have no category
    rows = {(r.product_category, r.product_name): r for r in pm.collect()}
    assert rows[(None, "a")].purchases == 1 and rows[(None, "b")].purchases == 1
    assert rows[(None, "a")].revenue_generated == 30.0 and rows[(None, "b")].revenue_generated == 0.0
    assert rows[("books", "a")].view_count == 1 and rows[("books", "a")].conversion_rate == 0.0
    assert rows[(None, "a")].cart_to_purchase_rate is None  # zero carts → NULL, no error


def test_metric_tables(spark):
    vals = [_event("e1", 1, "purchase", "2024-01-01T10:00:00", order_value=20.0, country="US"),
            _event("e2", 1, "page_view", "2024-01-01T10:00:30", country="UK"),
            _event("e3", 2, "purchase", "2024-01-01T10:00:40", order_value=10.0, country="DE")]
    en = _enriched(spark, vals)
    ua = {r.user_id: r for r in M.user_activity(en).collect()}
    assert (ua[1].total_events, ua[1].purchase_count, ua[1].daily_revenue, ua[1].country) == (2, 1, 20.0, "US")
    bm = {r.event_type: r for r in M.business_metrics(en).collect()}
    assert (bm["purchase"].event_count, bm["purchase"].avg_order_value, bm["purchase"].unique_users) == (2, 15.0, 2)
    assert bm["purchase"].events_per_minute == 2 and bm["purchase"].revenue_per_minute == 30.0
    pl = M.platform_metrics(en).first()
    assert pl.avg_purchase_value == 15.0 and pl.event_count == 3
    s = M.batch_summary(en).first()
    assert (s.users, s.events, s.revenue) == (2, 3, 30.0)
    geo = {r.country: r.event_count for r in M.geographic_metrics(en).collect()}
    assert geo == {"US": 1, "UK": 1, "DE": 1}


def test_batch_summary_of_empty_input(spark):
    empty = spark.createDataFrame([], "user_id int, revenue double")
    s = M.batch_summary(empty).first()
    assert (s.users, s.events, s.revenue) == (0, 0, 0.0)


def test_dashboard_last_hour(spark):
    t = dt.datetime(2024, 1, 1, 12, 0)
    rows = [(1, 1, 5.0, t), (2, 0, 0.0, t + dt.timedelta(seconds=20)), (1, 0, 1.0, t - dt.timedelta(hours=2))]
    act = spark.createDataFrame(rows, "user_id int, purchase_count int, daily_revenue double, created_at timestamp")
    out = M.dashboard(act, F.lit(t + dt.timedelta(minutes=5))).collect()
    assert len(out) == 1 and (out[0].activity_rows, out[0].total_purchases, out[0].active_users) == (2, 1, 2)


def test_daily_action_counts(spark):
    rows = [("view", dt.datetime(2024, 1, 1)), ("cart", dt.datetime(2024, 1, 1)),
            ("purchase", dt.datetime(2024, 1, 2)), ("view", dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "action string, processed_at timestamp")
    out = [(str(r.day), r.views, r.carts, r.purchases) for r in M.daily_action_counts(df).collect()]
    assert out == [("2024-01-01", 1, 1, 0), ("2024-01-02", 1, 0, 1)]


def _simple(spark, rows):
    return spark.createDataFrame(rows, "user_id string, action string, location string, amount double, "
                                       "timestamp timestamp, session_id string")


def test_sliding_windows_against_brute_force(spark):
    base = dt.datetime(2024, 1, 1, 0, 0)
    rows = [("u1", "view", "EU", 0.0, base + dt.timedelta(seconds=s), "s1") for s in (0, 59, 60, 301)]
    out = W.sliding_kpis(_simple(spark, rows)).collect()
    got = {(r.window_start, r.window_end): r.event_count for r in out}
    want = {}
    for s in (0, 59, 60, 301):
        ts = base + dt.timedelta(seconds=s)
        floor = ts.replace(second=0)
        for i in range(5):
            st = floor - dt.timedelta(minutes=i)
            want[(st, st + dt.timedelta(minutes=5))] = want.get((st, st + dt.timedelta(minutes=5)), 0) + 1
    assert got == want


def test_gap_sessions_and_rollup(spark):
    base = dt.datetime(2024, 1, 1, 0, 0)
    # minutes: gaps 10, 29, 31, 30 → sessions {0,10,39}, {70,100}: an event exactly one
    # gap after the last one still joins the session (session_window's inclusive bound)
    offs = [0, 10, 39, 70, 100]
    rows = [("u1", "view", "EU", 1.0, base + dt.timedelta(minutes=m), "s1") for m in offs]
    s = sorted((r.session_start, r.total_events) for r in W.gap_sessions(_simple(spark, rows)).collect())
    assert [n for _, n in s] == [3, 2]
    r = W.session_rollup(_simple(spark, rows)).first()
    assert (r.total_events, r.total_amount, r.start_time, r.end_time) == (5, 5.0, base, base + dt.timedelta(minutes=100))


def test_routing_and_monitor_view(spark):
    df = spark.createDataFrame([("orders", "ORDER_CREATED", '{"order_id": "o1", "total_amount": 5.5}', "t"),
                                ("inventory", "OUT_OF_STOCK", '{"reason": "x"}', "t")],
                               "topic string, event_type string, data string, timestamp string")
    assert E.route(df, "ORDER_CREATED").count() == 1
    mv = {r.topic: (r.order_id, r.amount) for r in E.monitor_view(df).collect()}
    assert mv == {"orders": ("o1", 5.5), "inventory": ("N/A", None)}


def test_rename_defaults_and_profile_join(spark):
    ev = spark.createDataFrame([("e1", "u1", None), ("e2", "u9", 3.0)], "id string, user string, amount double")
    ev = E.with_defaults(E.rename_on_load(ev, {"user": "user_id"}), {"amount": 0.0})
    prof = spark.createDataFrame([("u1", "gold")], "user_id string, tier string")
    out = {r.id: (r.amount, r.tier) for r in E.join_profiles(ev, prof).collect()}
    assert out == {"e1": (0.0, "gold"), "e2": (3.0, None)}


def test_gap_sessions_split_hot_keys_equals_plain(spark):
    import random
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1, 22, 0)
    rows = []
    t = {u: base for u in ("hot", "a")}
    for i in range(300):
        u = "hot" if i % 5 else "a"
        t[u] = t[u] + dt.timedelta(minutes=rnd.choice([1, 5, 20, 29, 30, 31, 45, 200]))
        rows.append((u, "view", "EU", float(i % 7), t[u], "s"))
    df = _simple(spark, rows)
    plain = sorted(tuple(r) for r in W.session_windows(df).collect())
    for bucket in ("20 minutes", "1 hour", "1 day"):
        assert sorted(tuple(r) for r in W.gap_sessions(df, bucket=bucket).collect()) == plain
    assert len(plain) > 10


def test_processing_time_and_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert E.not_null(df, "x", "y").count() == 1
    stamped = E.add_processing_time(df, "processed_at")
    assert stamped.filter(F.col("processed_at").isNull()).count() == 0
    assert M.row_count(df).first().rows == 3


def test_windows_and_metrics_on_empty_input(spark):
    empty = spark.createDataFrame([], "user_id string, action string, location string, amount double, "
                                      "timestamp timestamp, session_id string")
    assert W.sliding_kpis(empty).count() == 0
    assert W.gap_sessions(empty).count() == 0
    assert W.session_windows(empty).count() == 0
    assert W.session_rollup(empty).count() == 0


def test_hourly_metrics_with_date_keep_days_apart(spark):
    vals = [_event("e1", 1, "purchase", "2024-01-01T10:00:00", order_value=5.0),
            _event("e2", 2, "purchase", "2024-01-02T10:00:10", order_value=7.0)]
    en = _enriched(spark, vals)
    assert M.business_metrics(en).count() == 1  # faithful form: both days in one hour/minute
    by_day = {str(r.date): r.total_revenue for r in M.business_metrics(en, with_date=True).collect()}
    assert by_day == {"2024-01-01": 5.0, "2024-01-02": 7.0}
    assert M.platform_metrics(en, with_date=True).count() == 2
    assert M.geographic_metrics(en, with_date=True).count() == 2


def test_user_sketches_merge_across_batches(spark):
    b1 = spark.createDataFrame([("view", u) for u in range(0, 60)], "event_type string, user_id int")
    b2 = spark.createDataFrame([("view", u) for u in range(40, 100)], "event_type string, user_id int")
    stored = M.user_sketches(b1, ["event_type"]).unionByName(M.user_sketches(b2, ["event_type"]))
    est = M.merge_user_sketches(stored, ["event_type"]).first().unique_users
    assert abs(est - 100) <= 2  # adding the two batch counts would give 120
