"""Order-chain queries over ``orders`` / ``lineitem`` / ``part``.

Orders arrive in (order date, order key) order; an item is a lineitem with
the part's retail price as unit price; stock is ``p_size * STOCK_PER_SIZE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import orders as O
from tidewater.operators.reservation import reserve_stock
from tidewater.session import materialise, scratch_generation
from tidewater.sources.tables import read_table, stock_from_parts

STOCK_PER_SIZE = 10
PAYMENT_SUCCESS_RATE = 0.8
SEQ = ("order_date", "order_id")
TABLES = ("orders", "lineitem", "part")


def input_stamp(spark: SparkSession, base: str, tables: tuple[str, ...] = TABLES) -> tuple:
    """Names, sizes and times of the input files, as the file system tells them."""
    out = []
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{table}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    return tuple(sorted(out))


class Chain:
    """The stages of the order chain over one data folder.

    Totals, reservation, payments and the event log are written to the shared
    folder when first needed, each once, and every later stage reads them.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._stages: dict[str, DataFrame] = {}

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._stages:
            self._stages[name] = materialise(make(), f"chain-{name}")
        return self._stages[name]

    def orders(self) -> DataFrame:
        return read_table(self.spark, self.base, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"))

    def stock(self) -> DataFrame:
        part = read_table(self.spark, self.base, "part", ["p_partkey", "p_name", "p_size"])
        return stock_from_parts(part, STOCK_PER_SIZE)

    def lines(self) -> DataFrame:
        li = read_table(self.spark, self.base, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber",
                                                            "l_quantity"])
        o = read_table(self.spark, self.base, "orders", ["o_orderkey", "o_orderdate"])
        return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                .select(F.col("l_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
                        F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("product_id"),
                        F.col("l_quantity").alias("quantity")))

    def priced_lines(self) -> DataFrame:
        part = read_table(self.spark, self.base, "part", ["p_partkey", "p_retailprice"])
        li = read_table(self.spark, self.base, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
        return (li.join(part, li.l_partkey == part.p_partkey, "left")
                .select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("pos"),
                        F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
                        F.col("p_retailprice").alias("price")))

    def totals(self) -> DataFrame:
        return self._once("totals", lambda: O.order_totals(self.orders(), self.priced_lines(), items=True))

    def valid(self) -> DataFrame:
        return O.validate_orders(self.totals()).filter("is_valid")

    def reservation(self) -> DataFrame:
        if "reservation" not in self._stages:  # comes back written already
            self._stages["reservation"] = reserve_stock(self.lines(), self.stock(), seq_cols=SEQ)
        return self._stages["reservation"]

    def payments(self) -> DataFrame:
        return self._once("payments", lambda: O.payment_stage(
            self.reservation().filter(F.col("decision") == "INVENTORY_RESERVED"), self.totals(),
            success_rate=PAYMENT_SUCCESS_RATE))

    def shipments(self) -> DataFrame:
        return O.shipment_stage(self.payments())

    def log(self) -> DataFrame:
        return self._once("log", lambda: O.event_log(self.valid(), self.reservation(), self.payments(), self.shipments()))

    def dated_log(self) -> DataFrame:
        return self.log().join(self.orders().select("order_id", "order_date"), "order_id", "inner")


_CHAINS: dict[tuple, Chain] = {}


def chain(spark: SparkSession, base: str) -> Chain:
    """The chain over ``base``, one per session and state of the input files."""
    key = (spark.sparkContext.applicationId, scratch_generation(), base, input_stamp(spark, base))
    if key not in _CHAINS:
        _CHAINS.clear()  # tables of another input are no longer read
        _CHAINS[key] = Chain(spark, base)
    return _CHAINS[key]


def write_chain_tables(spark: SparkSession, base: str, out: str) -> dict:
    """Write every stage of the chain as a table under ``out``: reservation,
    payments, shipments, event log, then status, chains, KPIs and inventory."""
    from tidewater.sinks.writers import snapshot
    c = chain(spark, base)
    tables = {
        "reservation": c.reservation(), "payments": c.payments(), "shipments": c.shipments(), "event_log": c.log(),
        "order_status": O.current_status(c.log()), "order_chains": O.order_chains(c.log()),
        "order_kpis": O.order_kpis(c.log()),
        "inventory": O.inventory_snapshot(c.stock(), c.lines(), c.reservation(), c.payments()),
    }
    paths = {name: f"{out.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        snapshot(df, paths[name])
    return paths


def order_totals(spark, base):
    return chain(spark, base).totals().select("order_id", "customer_id", "n_items", "total_amount")


def order_validation(spark, base):
    return O.validate_orders(chain(spark, base).totals()).select("order_id", "n_items", "is_valid",
                                                                 "reason")


def stock_check(spark, base):
    c = chain(spark, base)
    return O.stock_check(c.lines(), c.stock())


def reservation(spark, base):
    return chain(spark, base).reservation()


def stock_after_orders(spark, base):
    c = chain(spark, base)
    return O.stock_after_orders(c.lines(), c.stock(), c.reservation(), seq_cols=SEQ)


def payment_outcomes(spark, base):
    return chain(spark, base).payments()


def shipments(spark, base):
    return chain(spark, base).shipments()


def notifications(spark, base):
    return O.notifications(chain(spark, base).log())


def order_status(spark, base):
    return O.current_status(chain(spark, base).log())


def orders_by_status(spark, base):
    return O.orders_by_status(O.current_status(chain(spark, base).log()))


def order_chains(spark, base):
    return O.order_chains(chain(spark, base).log())


def order_kpis(spark, base):
    return O.order_kpis(chain(spark, base).log())


def inventory_snapshot(spark, base):
    c = chain(spark, base)
    return O.inventory_snapshot(c.stock(), c.lines(), c.reservation(), c.payments())


def inventory_totals(spark, base):
    """Products and units of the whole inventory after all orders."""
    return O.inventory_totals(inventory_snapshot(spark, base))


def released_orders(spark, base):
    """What failed payments gave back, by product (M12), from the event log."""
    log = chain(spark, base).log().filter(F.col("event_type") == "INVENTORY_RELEASED")
    return (log.select(F.explode("items").alias("item")).groupBy(F.col("item.product_id").alias("product_id"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("item.quantity").alias("released")))


def payments_by_amount(spark, base):
    """Every order through the amount rule."""
    return O.payment_by_amount(chain(spark, base).totals().select("order_id", F.col("total_amount").alias("amount")))


def known_order_events(spark, base):
    """Events of even orders only, the others being unknown to the order table."""
    c = chain(spark, base)
    known = c.orders().filter(F.col("order_id") % 2 == 0)
    return O.known_orders_only(c.log().select("order_id", "step", "event_type"), known)


def event_fanout(spark, base):
    return O.fan_out(chain(spark, base).log(), O.subscriptions(spark))


def order_envelopes(spark, base):
    return O.envelopes(chain(spark, base).dated_log(), F.col("order_date"))


def event_monitor(spark, base):
    """What the live monitor prints for every published event."""
    from tidewater.operators.enrich import monitor_view
    log = chain(spark, base).dated_log()
    return monitor_view(O.with_topic(O.envelopes(log, F.col("order_date"))), amount_key="amount")


QUERIES = {
    "order_totals": order_totals,
    "order_validation": order_validation,
    "stock_check": stock_check,
    "reservation": reservation,
    "stock_after_orders": stock_after_orders,
    "payment_outcomes": payment_outcomes,
    "shipments": shipments,
    "notifications": notifications,
    "order_status": order_status,
    "orders_by_status": orders_by_status,
    "order_chains": order_chains,
    "order_kpis": order_kpis,
    "inventory_snapshot": inventory_snapshot,
    "inventory_totals": inventory_totals,
    "released_orders": released_orders,
    "payments_by_amount": payments_by_amount,
    "known_order_events": known_order_events,
    "event_fanout": event_fanout,
    "order_envelopes": order_envelopes,
    "event_monitor": event_monitor,
}
