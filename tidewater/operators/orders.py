"""Event-driven order processing as set-at-a-time transformations (J1-J4, A14-A19,
M10-M14, P16-P18, P21, W1, W3).

Each stage of the service chain is a DataFrame step over all
orders at once; stages append rows to one event log, and status, chains,
notifications and KPIs are aggregates over that log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import deterministic_id, money, money_sum, payment_draw
from tidewater.operators.prefix import running_sums, with_chunks
from tidewater.sources.files import inline_rows

# Fixed values from the reference's services.
CARRIER = "UPS"
ESTIMATED_DELIVERY = "3 business days"
PAYMENT_METHOD = "credit_card"
PAYMENT_FAILURE_REASON = "Insufficient funds"

# Event type → order status it sets, with the rank that orders the stages
# (statuses are the reference's; the ranks are ours).
STATUS_BY_EVENT = [("ORDER_CREATED", "created", 1), ("INVENTORY_RESERVED", "inventory_reserved", 2),
                   ("PAYMENT_COMPLETED", "payment_completed", 3), ("SHIPMENT_CREATED", "shipped", 4)]

# The named event chains.
CHAINS = [
    ("Normal Flow", ["ORDER_CREATED", "INVENTORY_RESERVED", "PAYMENT_COMPLETED",
                     "READY_FOR_SHIPMENT", "SHIPMENT_CREATED"]),
    ("Out of Stock", ["ORDER_CREATED", "OUT_OF_STOCK"]),
    ("Payment Failure", ["ORDER_CREATED", "INVENTORY_RESERVED", "PAYMENT_FAILED", "INVENTORY_RELEASED"]),
]
CHAIN_SEPARATOR = " → "

# Topic each event type is published to (orders, inventory and payments are
# the reference's topics; shipping is ours).
TOPIC_BY_EVENT = [("ORDER_CREATED", "orders"), ("INVENTORY_RESERVED", "inventory"),
                  ("OUT_OF_STOCK", "inventory"), ("INVENTORY_RELEASED", "inventory"),
                  ("PAYMENT_COMPLETED", "payments"), ("PAYMENT_FAILED", "payments"), ("READY_FOR_SHIPMENT", "shipping"),
                  ("SHIPMENT_CREATED", "shipping")]

# The event types each service subscribes to.
SERVICE_SUBSCRIPTIONS = {
    "OrderService": ["PAYMENT_COMPLETED", "INVENTORY_RESERVED", "SHIPMENT_CREATED"],
    "InventoryService": ["ORDER_CREATED", "PAYMENT_COMPLETED", "PAYMENT_FAILED"],
    "PaymentService": ["INVENTORY_RESERVED"],
    "ShippingService": ["READY_FOR_SHIPMENT"],
    "NotificationService": ["ORDER_CREATED", "PAYMENT_COMPLETED", "SHIPMENT_CREATED", "OUT_OF_STOCK",
                            "PAYMENT_FAILED"],
    "AnalyticsService": ["ORDER_CREATED", "PAYMENT_COMPLETED", "PAYMENT_FAILED", "SHIPMENT_CREATED"],
}
SUBSCRIPTIONS = [(etype, service) for service, types in SERVICE_SUBSCRIPTIONS.items() for etype in types]

# Notification text per event type, and the fields it names.
MESSAGES = {
    "ORDER_CREATED": ("Order confirmation sent for %s to customer %s", ["order_id", "customer_id"]),
    "PAYMENT_COMPLETED": ("Payment confirmation sent for %s", ["order_id"]),
    "SHIPMENT_CREATED": ("Shipping info sent for %s - Tracking: %s", ["order_id", "tracking_number"]),
    "OUT_OF_STOCK": ("Out-of-stock alert for %s - Product: %s", ["order_id", "product_id"]),
    "PAYMENT_FAILED": ("Payment failure for %s - Reason: %s", ["order_id", "reason"]),
}

LOG_SCHEMA_COLS = ["order_id", "step", "event_type", "customer_id", "amount", "product_id",
                   "reason", "tracking_number", "items"]
ITEM_TYPE = "array<struct<product_id: bigint, quantity: double, price: double>>"


# ---------------------------------------------------------------- items --

def explode_items(orders: DataFrame, items_col: str = "items", order_col: str = "order_id") -> DataFrame:
    """``items`` array → one row per item with its position (J1 input)."""
    return orders.select(order_col, F.posexplode(items_col).alias("pos", "_item")).select(
        order_col, "pos", "_item.*")


def items_total(items_col: str = "items", qty: str = "quantity", price: str = "price"):
    """Σ quantity × price inside the array, exact (A14, array form)."""
    zero = F.lit(0).cast("decimal(38,4)")
    return F.aggregate(F.col(items_col), zero,
                       lambda acc, x: (acc + money(x[qty]) * money(x[price])).cast("decimal(38,4)")
                       ).cast("double")


def order_totals(orders: DataFrame, lines: DataFrame, order_col: str = "order_id",
                 qty: str = "quantity", price: str = "price", items: bool = False) -> DataFrame:
    """Item count and Σ quantity × price per order; orders without lines get 0 (A14).  With
    ``items`` the order's items come along (see ``order_items``), from the same grouping."""
    per_order = lines.groupBy(order_col).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(money(qty) * money(price)).cast("double").alias("total_amount"),
        *([_items_in_order(qty=qty, price=price).alias("items")] if items else []))
    return (orders.join(per_order, order_col, "left")
            .withColumn("n_items", F.coalesce("n_items", F.lit(0)).cast("bigint"))
            .withColumn("total_amount", F.coalesce("total_amount", F.lit(0.0))))


def _items_in_order(product: str = "product_id", qty: str = "quantity", price: str = "price", pos: str = "pos") -> Column:
    item = F.struct(F.col(pos).alias("_pos"), F.col(product).cast("bigint").alias("product_id"),
                    F.col(qty).cast("double").alias("quantity"), F.col(price).cast("double").alias("price"))
    return F.transform(F.sort_array(F.collect_list(item)),
                       lambda x: F.struct(x["product_id"].alias("product_id"), x["quantity"].alias("quantity"), x["price"].alias("price")))


def order_items(lines: DataFrame, order_col: str = "order_id", product: str = "product_id", qty: str = "quantity",
                price: str = "price", pos: str = "pos") -> DataFrame:
    """The items of each order as an array in line order (J4): as long as an order."""
    return lines.groupBy(order_col).agg(_items_in_order(product, qty, price, pos).alias("items"))


def validate_orders(totals: DataFrame) -> DataFrame:
    """An order needs at least one item (P16); rejects keep a reason."""
    valid = F.col("n_items") > 0
    return totals.withColumn("is_valid", valid).withColumn(
        "reason", F.when(~valid, "no_items"))


#: Rows that one task of ``stock_check`` sorts or groups, about.
TASK_ROWS = 1_000_000


def stock_check(lines: DataFrame, stock: DataFrame, order_col: str = "order_id",
                product_col: str = "product_id", qty: str = "quantity",
                pos: str = "pos", task_rows: int = TASK_ROWS) -> DataFrame:
    """Each order against the initial stock, all items at once.

    Lines of one product are summed first, so two lines cannot each pass
    alone and oversell together.  Unknown products have 0 stock and the
    reason ``Product not found``.  The first failing item (by position) is
    reported.  Where the session's shuffle partitions would hold more than ``task_rows``
    rows each, there are as many more of them as that takes.
    """
    spark = lines.sparkSession
    tasks = -(-lines.count() // task_rows)

    def spread(df: DataFrame, by: str) -> DataFrame:
        return df.repartition(tasks, by) if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else df

    demand = spread(lines, order_col).groupBy(order_col, product_col).agg(F.sum(qty).alias("requested"),
                                                       F.min(pos).alias("pos"))
    s = stock.select(product_col, F.col("stock").cast("double").alias("available"))
    j = (spread(demand, product_col).join(spread(s, product_col), product_col, "left")
         .withColumn("found", F.col("available").isNotNull())
         .withColumn("available", F.coalesce("available", F.lit(0.0)))
         .withColumn("fails", F.col("requested") > F.col("available")))
    first = F.min_by(F.struct(F.col(product_col).alias("failed_product"), "available", "requested",
                              "found"),
                     F.when(F.col("fails"), F.struct("pos", product_col)))
    agg = spread(j, order_col).groupBy(order_col).agg(F.bool_and(~F.col("fails")).alias("all_available"),
                                   first.alias("f"))
    return agg.select(
        order_col, "all_available",
        F.col("f.failed_product").alias("failed_product"),
        F.col("f.available").alias("available"), F.col("f.requested").alias("requested"),
        F.when(F.col("all_available"), F.lit(None).cast("string"))
         .when(~F.col("f.found"), "Product not found").otherwise("Insufficient stock").alias("reason"))


# --------------------------------------------------------------- stages --

def payment_stage(reserved: DataFrame, totals: DataFrame, order_col: str = "order_id",
                  success_rate: float = 0.8) -> DataFrame:
    """Payment for reserved orders (M10): the amount comes from the order (J4),
    success is a deterministic draw at ``success_rate`` (P18)."""
    j = reserved.select(order_col).join(totals.select(order_col, "total_amount"), order_col, "inner")
    ok = payment_draw(F.col(order_col), success_rate)
    return j.select(
        order_col, F.col("total_amount").alias("amount"),
        F.when(ok, "PAYMENT_COMPLETED").otherwise("PAYMENT_FAILED").alias("status"),
        F.when(ok, deterministic_id("TXN-", F.col(order_col), 8)).alias("transaction_id"),
        F.when(ok, PAYMENT_METHOD).alias("payment_method"),
        F.when(~ok, PAYMENT_FAILURE_REASON).alias("reason"))


def payment_by_amount(reserved: DataFrame, amount_col: str = "amount") -> DataFrame:
    """Payment succeeds iff the amount is positive."""
    ok = F.col(amount_col) > 0
    return reserved.withColumn("status", F.when(ok, "PAYMENT_PROCESSED").otherwise("PAYMENT_FAILED"))


def shipment_stage(payments: DataFrame, order_col: str = "order_id") -> DataFrame:
    """Shipments for paid orders."""
    return payments.filter(F.col("status") == "PAYMENT_COMPLETED").select(
        order_col, deterministic_id("TRK-", F.col(order_col), 12).alias("tracking_number"),
        F.lit(CARRIER).alias("carrier"), F.lit(ESTIMATED_DELIVERY).alias("estimated_delivery"))


def _log(df: DataFrame, step: int, event_type, **cols) -> DataFrame:
    out = [F.col("order_id"), F.lit(step).alias("step"),
           (event_type if not isinstance(event_type, str) else F.lit(event_type)).alias("event_type")]
    types = {"customer_id": "bigint", "amount": "double", "product_id": "bigint",
             "reason": "string", "tracking_number": "string", "items": ITEM_TYPE}
    for c in LOG_SCHEMA_COLS[3:]:
        v = cols.get(c)
        out.append((v if v is not None else F.lit(None)).cast(types[c]).alias(c))
    return df.select(*out)


def event_log(valid_orders: DataFrame, reservation: DataFrame, payments: DataFrame,
              shipments: DataFrame) -> DataFrame:
    """The chain's events, one row per (order, step) (M14 content).

    If ``valid_orders`` carries ``items`` (see ``order_items``), they travel with
    the creation, the reservation and the release of the order (J4).  A failed
    payment releases what was reserved (M12).
    """
    items = F.col("items") if "items" in valid_orders.columns else F.lit(None)
    held = valid_orders.select("order_id", items.alias("items"))
    reserved_items = F.when(F.col("decision") == "INVENTORY_RESERVED", F.col("items"))
    failed = payments.filter(F.col("status") == "PAYMENT_FAILED").select("order_id", "reason").join(held, "order_id", "left")
    created = _log(valid_orders, 1, "ORDER_CREATED", customer_id=F.col("customer_id"),
                   amount=F.col("total_amount"), items=items)
    reserved = _log(reservation.join(held, "order_id", "left"), 2, F.col("decision"), product_id=F.col("failed_product"),
                    reason=F.col("reason"), items=reserved_items)
    paid = _log(payments, 3, F.col("status"), amount=F.col("amount"), reason=F.col("reason"))
    ready = _log(shipments, 4, "READY_FOR_SHIPMENT")
    released = _log(failed, 4, "INVENTORY_RELEASED", reason=F.col("reason"), items=F.col("items"))
    shipped = _log(shipments, 5, "SHIPMENT_CREATED", tracking_number=F.col("tracking_number"))
    return (created.unionByName(reserved).unionByName(paid).unionByName(ready).unionByName(released)
            .unionByName(shipped))


def envelopes(log: DataFrame, time_col=None) -> DataFrame:
    """Envelope rows (M14): deterministic event id, type, time, JSON payload, and a
    sequence: order id and step for numeric ids, else a hash of both (so that a
    replay gives the same numbers)."""
    # Null fields are written out, so every payload has the same keys.
    fields = [c for c in LOG_SCHEMA_COLS if c not in ("step", "event_type") and c in log.columns]
    payload = F.to_json(F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"})
    ts = F.date_format(time_col, "yyyy-MM-dd'T'HH:mm:ss") if time_col is not None else F.lit(None)
    numeric = log.schema["order_id"].dataType.typeName() in ("long", "integer", "short")
    seq = ((F.col("order_id").cast("bigint") * 10 + F.col("step")) if numeric
           else F.xxhash64("order_id", "step"))
    return log.select(
        deterministic_id("EVT-", F.concat_ws(":", F.col("order_id").cast("string"),
                                             F.col("event_type")), 12).alias("event_id"),
        "event_type", ts.cast("string").alias("timestamp"), payload.alias("data"),
        seq.alias("message_id"))


def with_topic(envelope: DataFrame) -> DataFrame:
    """Add the topic an envelope is published to (S3's topic column)."""
    topic = None
    for etype, t in TOPIC_BY_EVENT:
        c = F.col("event_type") == etype
        topic = F.when(c, t) if topic is None else topic.when(c, t)
    return envelope.withColumn("topic", topic)


def notifications(log: DataFrame) -> DataFrame:
    """One message per notified event."""
    expr = None
    for etype, (template, fields) in MESSAGES.items():
        # A missing field leaves the message null, as plain concatenation would.
        text = F.when(F.concat(*[F.col(f).cast("string") for f in fields]).isNotNull(),
                      F.format_string(template, *[F.col(f).cast("string") for f in fields]))
        cond = F.col("event_type") == etype
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return (log.filter(F.col("event_type").isin(list(MESSAGES)))
            .select("order_id", "event_type", expr.alias("message")))


def current_status(log: DataFrame, order_col: str = "order_id") -> DataFrame:
    """Latest status per order by stage rank (W1, M8 in batch).  ``max_by`` is a
    plain aggregate, so it combines map-side before the shuffle."""
    rank = None
    status = None
    for etype, st, r in STATUS_BY_EVENT:
        c = F.col("event_type") == etype
        rank = F.when(c, r) if rank is None else rank.when(c, r)
        status = F.when(c, st) if status is None else status.when(c, st)
    return (log.select(order_col, status.alias("status"), rank.alias("rank"))
            .filter(F.col("rank").isNotNull())
            .groupBy(order_col).agg(F.max_by("status", "rank").alias("status")))


def orders_by_status(status: DataFrame) -> DataFrame:
    """Orders per current status."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def order_chains(log: DataFrame, order_col: str = "order_id") -> DataFrame:
    """Ordered event path per order, named, counted per chain.

    One order has at most five events (the chain's length), so the per-order
    list is bounded.
    """
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "event_type"))),
                                    lambda x: x["event_type"]), CHAIN_SEPARATOR)
    per_order = log.groupBy(order_col).agg(path.alias("path"))
    name = None
    for chain, steps in CHAINS:
        c = F.col("path") == CHAIN_SEPARATOR.join(steps)
        name = F.when(c, chain) if name is None else name.when(c, chain)
    return (per_order.withColumn("chain", name.otherwise("Other"))
            .groupBy("chain", "path").agg(F.count(F.lit(1)).alias("orders")))


def order_kpis(log: DataFrame) -> DataFrame:
    """Orders, revenue, payments ok/failed and success rate."""
    t = F.col("event_type")
    ok = F.count_if(t == "PAYMENT_COMPLETED")
    failed = F.count_if(t == "PAYMENT_FAILED")
    return log.agg(
        F.count_if(t == "ORDER_CREATED").alias("total_orders"),
        F.coalesce(money_sum(F.when(t == "ORDER_CREATED", F.col("amount"))), F.lit(0.0))
        .alias("total_revenue"),
        ok.alias("successful_payments"), failed.alias("failed_payments"),
        (ok.cast("double") / F.greatest(F.lit(1), ok + failed)).alias("success_rate"))


def inventory_snapshot(stock: DataFrame, lines: DataFrame, reservation: DataFrame,
                       payments: DataFrame, order_col: str = "order_id",
                       product_col: str = "product_id", qty: str = "quantity") -> DataFrame:
    """Per product: stock, reserved (accepted orders, less failed payments, M12)
    and available = stock − reserved (A18)."""
    accepted = reservation.filter(F.col("decision") == "INVENTORY_RESERVED").select(order_col)
    failed = payments.filter(F.col("status") == "PAYMENT_FAILED").select(order_col, F.lit(True).alias("released"))
    held = (lines.join(accepted, order_col, "left_semi")
            .join(failed, order_col, "left")
            .groupBy(product_col).agg(
                F.sum(F.when(F.col("released").isNull(), F.col(qty)).otherwise(F.lit(0.0)))
                .alias("reserved")))
    return (stock.select(product_col, F.col("stock").cast("double").alias("stock"))
            .join(held, product_col, "left")
            .withColumn("reserved", F.coalesce("reserved", F.lit(0.0)))
            .withColumn("available", F.col("stock") - F.col("reserved")))


def inventory_totals(snapshot: DataFrame) -> DataFrame:
    """One row: how many products there are, and their units in stock and available."""
    return snapshot.agg(F.count(F.lit(1)).alias("total_products"),
                        F.coalesce(F.sum("stock"), F.lit(0.0)).alias("total_items"),
                        F.coalesce(F.sum("available"), F.lit(0.0)).alias("available_items"))


def stock_after_orders(lines: DataFrame, stock: DataFrame, reservation: DataFrame,
                       seq_cols=("order_date", "order_id"), order_col: str = "order_id",
                       product_col: str = "product_id", qty: str = "quantity",
                       ranges: int | None = None) -> DataFrame:
    """Stock left after each accepted order, per product."""
    seq_cols = list(seq_cols)
    accepted = reservation.filter(F.col("decision") == "INVENTORY_RESERVED").select(order_col)
    per = (lines.join(accepted, order_col, "left_semi")
           .groupBy(order_col, *[c for c in seq_cols if c != order_col], product_col)
           .agg(F.sum(qty).alias("quantity")))
    s = stock.select(product_col, F.col("stock").cast("double").alias("stock"))
    per = with_chunks(per, product_col, seq_cols, ranges=ranges).join(s, product_col, "inner")
    taken = running_sums(per, product_col, seq_cols, {"taken": F.col("quantity")}, inclusive=True)
    return taken.select(order_col, product_col, "quantity",
                        (F.col("stock") - F.col("taken")).alias("stock_left"))


def subscriptions(spark) -> DataFrame:
    return inline_rows(spark, SUBSCRIPTIONS, "event_type string, service string")


def fan_out(log: DataFrame, subs: DataFrame) -> DataFrame:
    """One row per (event, subscribed service) (J2).  The subscription table has a
    fixed size (services × event types), so it is broadcast."""
    return log.join(F.broadcast(subs), "event_type", "inner").select("order_id", "event_type", "service")


def known_orders_only(events: DataFrame, orders: DataFrame, order_col: str = "order_id") -> DataFrame:
    """Keep events of orders that exist."""
    return events.join(orders.select(order_col), order_col, "left_semi")
