"""Order chain: reservation against a sequential loop, scenarios, stages."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import orders as O
from tidewater.operators.reservation import reserve_stock, sequential_reservation
from tidewater.sources.tables import stock_seed

LINE_SCHEMA = "order_id string, order_date int, pos int, product_id string, quantity double, price double"


def _run(spark, orders, stock, ranges=None):
    rows = []
    for seq, (oid, items) in enumerate(orders):
        for pos, (p, q) in enumerate(items):
            rows.append((oid, seq, pos, p, float(q), 1.0))
    lines = spark.createDataFrame(rows, LINE_SCHEMA)
    st = stock_seed(spark, [(p, s) for p, s in stock.items()])
    out = reserve_stock(lines, st, seq_cols=("order_date", "order_id"), ranges=ranges)
    return {r.order_id: r for r in out.collect()}


@pytest.mark.parametrize("seed,ranges", [(0, 1), (1, None), (2, 3), (4, 20)])
def test_reservation_equals_sequential_loop(spark, seed, ranges):
    rnd = random.Random(seed)
    products = [f"P{i}" for i in range(rnd.randint(1, 6))]
    stock = {p: rnd.randint(0, 15) for p in products}
    orders = []
    for i in range(rnd.randint(1, 40)):
        items = [(rnd.choice(products + ["UNKNOWN"] if rnd.random() < 0.05 else products),
                  rnd.randint(1, 6)) for _ in range(rnd.randint(1, 4))]
        orders.append((f"O{i:03d}", items))
    want, _ = sequential_reservation(orders, stock)
    # many ranges split busy products into many chunks
    got = _run(spark, orders, stock, ranges)
    assert {k: v.decision == "INVENTORY_RESERVED" for k, v in got.items()} == want


def test_out_of_stock_reports_first_failing_item(spark):
    # ten units of a product with stock five: out of stock
    got = _run(spark, [("O1", [("PROD-004", 10)])], {"PROD-004": 5})
    r = got["O1"]
    assert (r.decision, r.failed_product, r.available, r.requested, r.reason) == \
        ("OUT_OF_STOCK", "PROD-004", 5.0, 10.0, "Insufficient stock")


def test_unknown_product_and_two_lines_of_one_product(spark):
    got = _run(spark, [("O1", [("NOPE", 1)]), ("O2", [("A", 3), ("A", 3)]), ("O3", [("A", 5)])],
               {"A": 5})
    assert got["O1"].reason == "Product not found"
    assert got["O2"].decision == "OUT_OF_STOCK"  # 3 + 3 > 5 although each line fits alone
    assert got["O3"].decision == "INVENTORY_RESERVED"


def test_reservation_on_driver_tables_equals_loop(spark):
    from tests.conftest import SF001
    from tidewater.plans.orders import Chain
    c = Chain(spark, SF001)
    lines = c.lines().select("order_id", "order_date", "product_id", "quantity").collect()
    stock = {r.product_id: r.stock for r in c.stock().collect()}
    by_order = {}
    for r in lines:
        by_order.setdefault((r.order_date, r.order_id), []).append((r.product_id, r.quantity))
    orders = [(k[1], v) for k, v in sorted(by_order.items())]
    want, left = sequential_reservation(orders, stock)
    got = {r.order_id: r.decision == "INVENTORY_RESERVED" for r in c.reservation().collect()}
    assert got == want
    assert 0 < sum(want.values()) < len(want)


def test_integration_scenario(spark):
    """Three orders of 1 laptop + 2 mice; amounts 1059.97, 599.98, 0 → two paid, one failed,
    stock ends laptop 8, mouse 46, keyboard 25 once the failed order releases its items."""
    rows = []
    for i, oid in enumerate(["ORD_10001", "ORD_10002", "ORD_10003"]):
        rows += [(oid, i, 0, "laptop", 1.0, 999.99), (oid, i, 1, "mouse", 2.0, 29.99)]
    lines = spark.createDataFrame(rows, LINE_SCHEMA)
    stock = stock_seed(spark, [("laptop", 10), ("mouse", 50), ("keyboard", 25)])
    res = reserve_stock(lines, stock)
    assert {r.decision for r in res.collect()} == {"INVENTORY_RESERVED"}
    amounts = spark.createDataFrame([("ORD_10001", 1059.97), ("ORD_10002", 599.98), ("ORD_10003", 0.0)],
                                    "order_id string, amount double")
    paid = O.payment_by_amount(amounts)
    assert {r.order_id: r.status for r in paid.collect()} == {
        "ORD_10001": "PAYMENT_PROCESSED", "ORD_10002": "PAYMENT_PROCESSED", "ORD_10003": "PAYMENT_FAILED"}
    payments = paid.withColumn("status", F.when(F.col("status") == "PAYMENT_PROCESSED", "PAYMENT_COMPLETED")
                               .otherwise(F.col("status")))
    snap = {r.product_id: r.available for r in O.inventory_snapshot(stock, lines, res, payments).collect()}
    assert snap == {"laptop": 8.0, "mouse": 46.0, "keyboard": 25.0}


def test_order_total_two_forms(spark):
    """Two of PROD-001 at 99.99 and one PROD-002 at 29.99 → 229.97."""
    orders = spark.createDataFrame(
        [("o1", [("PROD-001", 2, 99.99), ("PROD-002", 1, 29.99)])],
        "order_id string, items array<struct<product_id:string,quantity:int,price:double>>")
    assert orders.select(O.items_total().alias("t")).first().t == 229.97
    lines = O.explode_items(orders)
    tot = O.order_totals(orders.select("order_id"), lines).first()
    assert (tot.n_items, tot.total_amount) == (2, 229.97)


def test_validation_and_stock_check(spark):
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    lines = spark.createDataFrame([("o1", 0, "A", 2.0, 1.0)], "order_id string, pos int, product_id string, quantity double, price double")
    v = {r.order_id: (r.is_valid, r.reason) for r in O.validate_orders(O.order_totals(orders, lines)).collect()}
    assert v == {"o1": (True, None), "o2": (False, "no_items")}
    stock = stock_seed(spark, [("A", 1)])
    sc = O.stock_check(lines, stock).first()
    assert (sc.all_available, sc.failed_product, sc.reason) == (False, "A", "Insufficient stock")


def _log(spark):
    rows = [("o1", 1, "ORDER_CREATED", 7, 10.0, None, None, None),
            ("o1", 2, "INVENTORY_RESERVED", None, None, None, None, None),
            ("o1", 3, "PAYMENT_COMPLETED", None, 10.0, None, None, None),
            ("o1", 4, "READY_FOR_SHIPMENT", None, None, None, None, None),
            ("o1", 5, "SHIPMENT_CREATED", None, None, None, None, "TRK-1"),
            ("o2", 1, "ORDER_CREATED", 8, 5.0, None, None, None),
            ("o2", 2, "OUT_OF_STOCK", None, None, 4, "Insufficient stock", None),
            ("o3", 1, "ORDER_CREATED", 9, 2.5, None, None, None),
            ("o3", 2, "INVENTORY_RESERVED", None, None, None, None, None),
            ("o3", 3, "PAYMENT_FAILED", None, 2.5, None, "Insufficient funds", None),
            ("o3", 4, "INVENTORY_RELEASED", None, None, None, "Insufficient funds", None)]
    return spark.createDataFrame(rows, "order_id string, step int, event_type string, customer_id bigint, "
                                       "amount double, product_id bigint, reason string, tracking_number string")


def test_status_chains_kpis_notifications(spark):
    log = _log(spark)
    st = {r.order_id: r.status for r in O.current_status(log).collect()}
    assert st == {"o1": "shipped", "o2": "created", "o3": "inventory_reserved"}
    ch = {r.chain: r.orders for r in O.order_chains(log).collect()}
    assert ch == {"Normal Flow": 1, "Out of Stock": 1, "Payment Failure": 1}
    k = O.order_kpis(log).first()
    assert (k.total_orders, k.total_revenue, k.successful_payments, k.failed_payments) == (3, 17.5, 1, 1)
    assert k.success_rate == 0.5
    msgs = {(r.order_id, r.event_type): r.message for r in O.notifications(log).collect()}
    assert msgs[("o1", "SHIPMENT_CREATED")] == "Shipping info sent for o1 - Tracking: TRK-1"
    assert msgs[("o2", "OUT_OF_STOCK")] == "Out-of-stock alert for o2 - Product: 4"
    assert msgs[("o3", "PAYMENT_FAILED")] == "Payment failure for o3 - Reason: Insufficient funds"
    fan = O.fan_out(log, O.subscriptions(spark))
    assert fan.filter(F.col("event_type") == "READY_FOR_SHIPMENT").first().service == "ShippingService"


def test_kpis_with_no_payments(spark):
    log = _log(spark).filter(F.col("event_type") == "ORDER_CREATED")
    k = O.order_kpis(log).first()
    assert k.success_rate == 0.0  # max(1, ok + failed) keeps the denominator positive


def test_envelopes_and_known_orders(spark):
    log = _log(spark)
    env = O.envelopes(log).collect()
    assert len({r.event_id for r in env}) == len(env)
    known = spark.createDataFrame([("o1",)], "order_id string")
    assert {r.order_id for r in O.known_orders_only(log, known).collect()} == {"o1"}


def test_reservation_of_empty_input(spark):
    lines = spark.createDataFrame([], LINE_SCHEMA)
    stock = stock_seed(spark, [("A", 5)])
    assert reserve_stock(lines, stock).count() == 0


def test_reservation_all_unconstrained(spark):
    got = _run(spark, [("O1", [("A", 1)]), ("O2", [("A", 2)])], {"A": 5})
    assert {k: v.decision for k, v in got.items()} == {"O1": "INVENTORY_RESERVED", "O2": "INVENTORY_RESERVED"}


def test_product_on_nine_tenths_of_the_lines_is_split(spark):
    """Dates and ids are independent, and one product is on 90 % of the lines: no
    window partition holds more rows than about one range, and the result still
    equals the sequential loop."""
    from tidewater.operators.prefix import with_chunks
    rnd = random.Random(21)
    rows, orders = [], []
    for i in range(400):
        items = [("HOT", rnd.randint(1, 4))] + ([("B", 1)] if i % 9 == 0 else [])
        day = rnd.randint(0, 30)
        orders.append(((day, i), i, items))
        rows += [(i, day, pos, p, float(q), 1.0) for pos, (p, q) in enumerate(items)]
    lines = spark.createDataFrame(rows, "order_id bigint, order_date int, pos int, product_id string, "
                                        "quantity double, price double")
    chunked = with_chunks(lines, "product_id", ["order_date", "order_id"], ranges=16)
    largest = chunked.groupBy("product_id", "chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 3 * len(rows) / 16
    stats = {}
    out = reserve_stock(lines, stock_seed(spark, [("HOT", 200), ("B", 25)]), ranges=16, stats=stats)
    want, _ = sequential_reservation([(o, items) for _, o, items in sorted(orders)], {"HOT": 200, "B": 25})
    assert {r.order_id: r.decision == "INVENTORY_RESERVED" for r in out.collect()} == want
    assert 1 <= stats["rounds"] <= stats["blocks"] == 16 and stats["open_after"][-1] == 0
    assert len(stats["rows_written"]) == stats["rounds"] and stats["rows_written"][-1] < stats["rows_written"][0]


@pytest.mark.parametrize("seed", [5, 6])
def test_blocks_and_fractions_equal_the_loop(spark, seed):
    """Quantities in quarters, several products an order, many blocks: decisions and the
    stock that a rejected order's first failing item found."""
    rnd = random.Random(seed)
    stock = {f"P{i}": rnd.randint(2, 15) for i in range(8)}
    orders = [(f"O{i:03d}", [(p, rnd.randint(1, 12) / 4) for p in rnd.sample(sorted(stock), rnd.randint(1, 4))]) for i in range(120)]
    got = _run(spark, orders, stock, ranges=12)
    left = dict(stock)
    for oid, items in orders:
        lost = [(p, q) for p, q in items if q > left[p]]
        r = got[oid]
        if lost:
            assert (r.decision, r.failed_product, r.requested, r.available) == ("OUT_OF_STOCK", *lost[0], left[lost[0][0]])
        else:
            assert r.decision == "INVENTORY_RESERVED"
            for p, q in items:
                left[p] -= q


def test_reservation_leaves_only_its_result(spark):
    """One pass's table at most stands beside the result's sources, and nothing in the end."""
    import os

    from tidewater import session
    session.clear_scratch(spark)
    folder = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(folder))
    held = []
    keep = session.materialise

    def watch(df, name):
        held.append(sum(f.startswith("reservation-pass") for f in set(os.listdir(folder)) - before))
        return keep(df, name)

    from tidewater.operators import reservation as R
    R.materialise = watch
    try:
        rows = [(f"O{i:03d}", i, 0, f"P{i % 3}", 2.0, 1.0) for i in range(90)]
        out = reserve_stock(spark.createDataFrame(rows, LINE_SCHEMA), stock_seed(spark, [("P0", 21), ("P1", 33), ("P2", 7)]), ranges=6)
    finally:
        R.materialise = keep
    assert out.filter("decision = 'INVENTORY_RESERVED'").count() == 10 + 16 + 3
    assert max(held) <= 2 and len(set(os.listdir(folder)) - before) == 1  # the result itself
    session.clear_scratch(spark)
    assert set(os.listdir(folder)) <= before


def test_dependency_chain_settles_without_a_cap(spark):
    """Each order competes with the one before over another product: the longest
    possible chain still ends, one way or the other."""
    orders = [(f"O{i:02d}", [(f"P{i}", 1), (f"P{i + 1}", 1)]) for i in range(7)]
    stock = {f"P{i}": 1 for i in range(8)}
    got = _run(spark, orders, stock)
    want, _ = sequential_reservation(orders, stock)
    assert {k: v.decision == "INVENTORY_RESERVED" for k, v in got.items()} == want


def test_write_chain_tables_once(spark, tmp_path):
    from tests.conftest import SF001
    from tidewater.plans.orders import Chain, write_chain_tables
    paths = write_chain_tables(spark, SF001, str(tmp_path))
    cols = ["order_id", "step", "event_type", "customer_id", "amount", "product_id", "reason", "tracking_number", "items"]
    got = sorted(str(tuple(r)) for r in spark.read.parquet(paths["event_log"]).select(*cols).collect())
    want = sorted(str(tuple(r)) for r in Chain(spark, SF001).log().select(*cols).collect())
    assert got == want
    k = spark.read.parquet(paths["order_kpis"]).first()
    assert k.total_orders == spark.read.parquet(paths["order_status"]).count()


def test_stock_check_spreads_its_rows(spark):
    lines = spark.createDataFrame([(i, 0, f"p{i % 7}", float(i % 5)) for i in range(200)], "order_id int, pos int, product_id string, quantity double")
    stock = spark.createDataFrame([(f"p{i}", 2.0) for i in range(6)], "product_id string, stock double")
    many = O.stock_check(lines, stock, task_rows=2)
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().toString() and ", 100)" in many._jdf.queryExecution().toString()
    assert sorted(map(str, many.collect())) == sorted(map(str, O.stock_check(lines, stock).collect()))


def test_orders_that_ask_for_more_than_there_is_hold_up_nobody(spark):
    """Lost orders take nothing, so orders in later blocks are decided by the first pass."""
    rows = [(f"O{i:03d}", i, 0, "A", 11.0 if i % 4 else 1.0, 1.0) for i in range(40)]
    stats = {}
    out = reserve_stock(spark.createDataFrame(rows, LINE_SCHEMA), stock_seed(spark, [("A", 10)]), ranges=8, stats=stats)
    want, _ = sequential_reservation([(r[0], [("A", r[4])]) for r in rows], {"A": 10})
    assert {r.order_id: r.decision == "INVENTORY_RESERVED" for r in out.collect()} == want
    assert stats["blocks"] == 8 and stats["rounds"] == 1


def test_passes_move_a_row_per_block_and_bucket(spark, monkeypatch):
    """However many lines a block has, a pass deals packed rows."""
    from tidewater.operators import reservation
    kept = {}
    write = reservation.materialise

    def watched(df, name):
        out = write(df, name)
        kept.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(reservation, "materialise", watched)
    rows = [(f"O{i:04d}", i, p, f"P{(i * 7 + p) % 30}", float(1 + (i + p) % 5), 1.0) for i in range(600) for p in range(3)]
    stats = {}
    out = reserve_stock(spark.createDataFrame(rows, LINE_SCHEMA), stock_seed(spark, [(f"P{k}", 40) for k in range(30)]), ranges=3, stats=stats)
    orders = [(f"O{i:04d}", [(r[3], r[4]) for r in rows[3 * i:3 * i + 3]]) for i in range(600)]
    want, _ = sequential_reservation(orders, {f"P{k}": 40 for k in range(30)})
    assert {r.order_id: r.decision == "INVENTORY_RESERVED" for r in out.collect()} == want
    blocks = buckets = stats["blocks"]
    assert blocks == 3 and max(kept["reservation-pass"]) <= blocks * (1 + 2 * buckets) < stats["rows_written"][0]


def test_totals_and_items_come_from_one_grouping(spark, monkeypatch):
    rows = [("O1", 0, 1, "7", 2.0, 1.25), ("O1", 0, 0, "9", 1.0, None), ("O2", 1, 0, None, None, 3.0), (None, 2, 0, "7", 1.0, 2.0)]
    lines = spark.createDataFrame(rows, LINE_SCHEMA)
    orders = spark.createDataFrame([("O1", 1), ("O2", 2), ("O3", None), (None, 4)], "order_id string, customer_id int")
    both = O.order_totals(orders, lines, items=True)
    apart = O.order_totals(orders, lines).join(O.order_items(lines), "order_id", "left")
    assert both.columns == apart.columns and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    # the chain scans its lines once for both
    from tests.conftest import SF001
    from tidewater.plans import orders as plan
    made = []
    monkeypatch.setattr(plan, "materialise", lambda df, name: made.append(df) or df)
    plan.Chain(spark, SF001).totals()
    assert made[0]._jdf.queryExecution().optimizedPlan().toString().count("l_quantity#") > 0
    assert sum("Relation" in x and "l_orderkey" in x for x in made[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()) == 1


def test_a_product_that_the_stock_names_twice_is_one(spark):
    """Its lines come once per row of the stock, and all of them take from one product."""
    rows = [(f"O{i}", i, 0, "A", 2.0, 1.0) for i in range(6)]
    stock = stock_seed(spark, [("A", 7), ("A", 7)])
    for ranges in (1, 3):
        got = {r.order_id: r.decision for r in reserve_stock(spark.createDataFrame(rows, LINE_SCHEMA), stock, ranges=ranges).collect()}
        assert [k for k, v in sorted(got.items()) if v == "INVENTORY_RESERVED"] == ["O0", "O1"]
