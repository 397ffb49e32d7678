"""All-or-nothing stock reservation in arrival order (M9).

Sequential rule: orders are taken in sequence order; an order is accepted
iff every one of its products still has enough stock left by the orders
accepted before it, and an accepted order reserves all its lines.

Orders compete for several products, so no single key partitions the work and a
running sum alone is wrong (a rejected order frees its demand).  The sequence is
cut into blocks of whole orders, and what links the blocks is, per product, how
much the earlier ones take.  That is known at first only between two bounds: what
their accepted orders take (``lo``), and that plus all they have not decided yet
(``hi``).  A pass walks every open block in order, all blocks in parallel:

* an order is **accepted** if all its lines fit above ``hi``,
* **rejected** if some line does not fit even above ``lo``,
* else it stays open, and only its ``hi`` is taken.

Both bounds move along within the block, so one walk draws every conclusion that
the block's own orders allow.  The evaluation is semi-naive: a block whose orders
are all decided is not walked again, rejected lines leave, and of a product that no
open order asks for in a block only the sum stays.  The first open block begins
with exact bounds, so every pass decides at least that one, and an order whose
earlier competitors are decided is decided, too: passes are at most the blocks,
and at most the longest chain of competing orders.  As lines leave, neighbouring
blocks are walked together, as many as hold a block's share of the lines that are
left, and bounds move along through all of them.  What is settled moves into a
``base`` that stays with each product still open in a block, so a pass reads and
writes what is open, however much was settled before.

Between passes a block is one row with its lines packed as plain arrays, and its sums
are one row per bucket of products: so a pass deals and sorts blocks and buckets, and
only numpy sees lines.  An order that asks for more of a product than there ever was
takes nothing and enters no pass.

When all is decided the bounds agree, and a last walk from them gives each order's
decision and first failing item.  A hot product is no hot key: a block holds at most
its share of the sequence, and the sums have a row per block and product.
Products whose whole demand fits their stock constrain nothing and never enter.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.session import discard, ensure_checkpoint_dir, materialise

#: Lines in a block: it is walked by one task, in order.
BLOCK_LINES = 250_000


def order_demand(lines: DataFrame, order_col: str, seq_cols, product_col: str,
                 qty_col: str, pos_col: str | None) -> DataFrame:
    """One row per (order, product): two lines of one product must fit together."""
    pos = F.min(pos_col) if pos_col else F.lit(0)
    return lines.groupBy(order_col, *seq_cols, product_col).agg(
        F.sum(qty_col).alias("qty"), pos.alias("pos"))


# Between passes a block is one row: its lines, and per bucket of products its sums, are packed as
# plain arrays one after the other.  So the engine deals and sorts blocks, not lines.
LINE = ("<i4", "<i8", "<f8", "<f8", "?")  # nth, item, qty, stock, accepted
SUM = ("<i8", "<f8", "<f8", "<f8", "<f8", "?")  # item, base, q, lo, hi, live
START = ("<i8", "<f8", "<f8", "<f8")  # item, base, lo, hi
ROWS = "kind string, block int, bucket int, n int, open int, cells binary"
#: Sums of so many lines at most share a bucket, about; up to SPREAD buckets follow the blocks.
BUCKET_LINES, SPREAD = 1_000_000, 256


def _pack(types: tuple[str, ...], *arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a, dtype=t).tobytes() for t, a in zip(types, arrays))


def _unpack(types: tuple[str, ...], cells: list[bytes]) -> list[np.ndarray]:
    """The arrays of all cells, those of one after those of the other."""
    sizes = [np.dtype(t).itemsize for t in types]
    out: list[list[np.ndarray]] = [[np.empty(0, t)] for t in types]
    for cell in cells:
        n, at = len(cell) // sum(sizes), 0
        for into, t, size in zip(out, types, sizes):
            into.append(np.frombuffer(cell, t, n, at))
            at += n * size
    return [np.concatenate(x) for x in out]


def _by_bucket(kind: str, block: int, buckets: int, item: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """Rows of ``SUM``, one for each bucket that has any."""
    bucket = item % buckets
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(kind, block, int(bucket[at[0]]), len(at), 0, _pack(SUM, item[at], *(v[at] for v in values)))
            for at in np.split(order, cuts) if len(at)]


def _table(rows: list[tuple]) -> pa.Table:
    types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "block", "bucket", "n", "open", "cells"])


def _same_as_before(column: pa.ChunkedArray) -> np.ndarray:
    """Of every value but the first, whether it equals the one before (nulls and NaN equal themselves)."""
    now, before = column.slice(1), column.slice(0, max(len(column) - 1, 0))
    same = pc.or_(pc.fill_null(pc.equal(now, before), False), pc.and_(pc.is_null(now), pc.is_null(before)))
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(now), pc.is_nan(before)), False))
    return np.asarray(same)


def _opened(lines: pa.Table, ordering: list[str], order_col: str, buckets: int) -> pa.Table:
    """A block's rows before the first pass, from its lines: the lines that may still be decided
    (``line``) and what they ask for (``sum``), the products of all constraining lines (``asked``)
    and these lines as they are (``all``); and a row for every order (``order``) with whether it
    has such a line (``held``, null if that is known of none of its lines).

    An order with a line that asks for more than there ever was is lost: it takes nothing, so
    only the last walk needs it."""
    if not any(pa.types.is_floating(lines.schema.field(c).type) for c in ordering):
        lines = lines.take(pc.sort_indices(lines, [(c, "ascending") for c in ordering], null_placement="at_start"))
    same = functools.reduce(np.logical_and, [_same_as_before(lines.column(c)) for c in ordering])
    first = np.r_[True, ~same]
    nth = np.cumsum(first).astype(np.int32)

    def any_of(flags: pa.ChunkedArray) -> np.ndarray:
        return np.logical_or.reduceat(np.asarray(flags, dtype=bool), np.flatnonzero(first))

    block = lines.column("block")[0].as_py()
    tight = np.asarray(pc.fill_null(lines.column("constraining"), False), dtype=bool)
    held = pa.array(any_of(tight), mask=~any_of(pc.is_valid(lines.column("constraining"))))
    live = tight & ~any_of(lines.column("hopeless"))[nth - 1]
    item, qty, stock = (lines.column(c).to_numpy() for c in ("item", "qty", "stock"))
    item, qty = item.astype(np.int64), qty.astype(np.float64)
    rows = []
    if live.any():
        rows.append(("line", block, -1, int(live.sum()), int(live.sum()),
                     _pack(LINE, nth[live], item[live], qty[live], stock[live], np.zeros(live.sum(), bool))))
        asked, place = np.unique(item[live], return_inverse=True)
        none, on = np.zeros(len(asked)), np.ones(len(asked), bool)
        wanted = np.bincount(place, weights=np.where(np.isnan(qty[live]), 0.0, qty[live]), minlength=len(asked))
        rows += _by_bucket("sum", block, buckets, asked, none, none, none, wanted, on)
    if tight.any():
        asked = np.unique(item[tight])
        none, on = np.zeros(len(asked)), np.ones(len(asked), bool)
        rows += _by_bucket("asked", block, buckets, asked, none, none, none, none, on)
        whole = lines.select(list(dict.fromkeys([order_col, "product", "item", "qty", "pos", "stock", "found"]))).append_column("nth", pa.array(nth))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema) as writer:
            writer.write_table(whole.filter(pa.array(tight)))
        rows.append(("all", block, -1, int(tight.sum()), 0, sink.getvalue().to_pybytes()))
    out, orders = _table(rows), lines.column(order_col).filter(pa.array(first))
    n = len(orders)
    packed = out.append_column(order_col, pa.nulls(len(out), orders.type)).append_column("held", pa.nulls(len(out), pa.bool_()))
    blank = [pa.array(["order"] * n, pa.string()), pa.array(np.full(n, block, np.int32)), *(pa.nulls(n, pa.int32()) for _ in range(3)),
             pa.nulls(n, pa.binary())]
    return pa.concat_tables([packed, pa.table([*blank, orders, held], schema=packed.schema)])


def _orders(nth: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last line (exclusive) of each order of sorted lines."""
    starts = np.flatnonzero(np.r_[True, nth[1:] != nth[:-1]])
    return zip(starts.tolist(), np.r_[starts[1:], len(nth)].tolist())


def _known(starts: pa.Table) -> dict[int, list[bytes]]:
    cells: dict[int, list[bytes]] = {}
    for at, cell in zip(starts.column("at").to_pylist(), starts.column("cells").to_pylist()):
        cells.setdefault(at, []).append(cell)
    return cells


def _at_start(item: np.ndarray, cells: list[bytes]) -> list[np.ndarray]:
    """base, lo and hi of the items (sorted); 0 where nothing is known."""
    known, *values = _unpack(START, cells)
    order = np.argsort(known)
    known = known[order]
    at = np.minimum(np.searchsorted(known, item), max(len(known) - 1, 0))
    found = known[at] == item if len(known) else np.zeros(len(item), bool)
    return [np.where(found, v[order][at], 0.0) if len(known) else np.zeros(len(item)) for v in values]


def _walk(lines: pa.Table, starts: pa.Table, buckets: int) -> pa.Table:
    """Walk the blocks of a group in order; what a block learns goes on to the next one."""
    known = _known(starts)
    cells: dict[int, list[bytes]] = {}
    for block, cell in zip(lines.column("block").to_pylist(), lines.column("cells").to_pylist()):
        cells.setdefault(block, []).append(cell)
    carried: dict | None = {} if len(cells) > 1 else None
    return _table([row for block in sorted(cells) for row in _walk_block(block, _unpack(LINE, cells[block]), known.get(block, []), carried, buckets)])


def _walk_block(block: int, lines: list[np.ndarray], starts: list[bytes], carried: dict | None, buckets: int) -> list[tuple]:
    """Decide what the bounds allow; the lines that still matter, and sums of all.
    ``carried`` holds, per product, base and bounds as the group's blocks before left them:
    what was settled since is the difference of the bases."""
    nth, item, amount, had, accepted = lines
    products, place = np.unique(item, return_inverse=True)
    base, *bounds = _at_start(products, starts)
    lo, hi = (b.tolist() for b in bounds)
    for j, product in enumerate(products.tolist() if carried else ()):
        if product in carried:
            was, low, high = carried[product]
            lo[j], hi[j] = low + (base[j] - was), high + (base[j] - was)
    at, qty, stock = place.tolist(), amount.tolist(), had.tolist()
    open_ = np.zeros(len(nth), dtype=bool)
    taken = accepted.tolist()
    for a, b in _orders(nth):
        fits = taken[a]
        if not fits:
            fits, lost = True, False
            for i in range(a, b):
                if qty[i] > stock[i] - lo[at[i]]:
                    lost = True
                    break
                if not qty[i] <= stock[i] - hi[at[i]]:
                    fits = False
            if lost:
                continue
            (accepted if fits else open_)[a:b] = True
        for i in range(a, b):
            hi[at[i]] += qty[i]
            if fits:
                lo[at[i]] += qty[i]
    if carried is not None:
        carried.update(zip(products.tolist(), zip(base.tolist(), lo, hi)))
    last = np.full(len(products), -1)
    np.maximum.at(last, place[open_], np.flatnonzero(open_))
    stays = (open_ | accepted) & (np.arange(len(nth)) < last[place] + 1)
    amount = np.where(np.isnan(amount), 0.0, amount)

    def total(of: np.ndarray) -> np.ndarray:
        return np.bincount(place[of], weights=amount[of], minlength=len(products))

    # of a product without live lines the sum is final; else lines that left (q) are in it, too
    live, left = last >= 0, total(accepted & ~stays)
    took, most = total(accepted), total(accepted | open_)
    q = np.where(live, left, took)
    low, high = np.where(live, took - left, 0.0), np.where(live, most - left, 0.0)
    rows = []
    if stays.any():
        rows.append(("line", block, -1, int(stays.sum()), int(open_.sum()),
                     _pack(LINE, nth[stays], item[stays], lines[2][stays], had[stays], accepted[stays])))
    on = live | (q > 0)
    rows += _by_bucket("sum", block, buckets, products[on], np.where(live, base, 0.0)[on], q[on], low[on], high[on], live[on])
    on = q > 0
    none = np.zeros(on.sum())
    return rows + _by_bucket("settled", block, buckets, products[on], none, q[on], none, none, none)


def _judge(lines: pa.Table, starts: pa.Table, order_col: str) -> pa.Table:
    """Every order's decision and first failing item, from what is taken before the block."""
    block = pa.concat_tables([pa.ipc.open_stream(c).read_all() for c in lines.column("cells").to_pylist()])
    block = block.take(pc.sort_indices(block, [("nth", "ascending"), ("product", "ascending")]))
    products, place = np.unique(block.column("item").to_numpy(), return_inverse=True)
    taken = _at_start(products, [c for cells in _known(starts).values() for c in cells])[1].tolist()
    at, (qty, stock, pos) = place.tolist(), (block.column(c).to_numpy().tolist() for c in ("qty", "stock", "pos"))
    product = block.column("product").to_pylist()
    rows = []
    for a, b in _orders(block.column("nth").to_numpy()):
        failing = [i for i in range(a, b) if qty[i] > stock[i] - taken[at[i]]]
        if not failing:
            for i in range(a, b):
                taken[at[i]] += qty[i]
            rows.append((a, None, None))
        else:
            first = min(failing, key=lambda i: (pos[i], product[i]))
            rows.append((a, first, stock[first] - taken[at[first]]))
    orders, lost, available = (pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64())))
    return pa.table([block.column(order_col).take(orders), pc.is_null(lost), block.column("product").take(lost), available,
                     block.column("qty").take(lost).cast(pa.float64()), block.column("found").take(lost)],
                    names=[order_col, "accepted", "failed_product", "available", "requested", "found"])


def _earlier(sums: pa.Table) -> pa.Table:
    """Of a bucket's sums: per block and live item what the blocks before it take (see ``_before``)."""
    item, base, q, lo, hi, live = _unpack(SUM, sums.column("cells").to_pylist())
    block = np.repeat(sums.column("block").to_numpy(), sums.column("n").to_numpy())
    order = np.lexsort((block, item))
    item, block = item[order], block[order]
    fresh = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (block[1:] != block[:-1])])
    item, block = item[fresh], block[fresh]
    base, q, lo, hi = (np.add.reduceat(v[order], fresh) for v in (base, q, lo, hi))
    live = np.logical_or.reduceat(live[order], fresh)
    begins = np.r_[True, item[1:] != item[:-1]]
    running = pd.DataFrame({"q": q, "lo": lo, "hi": hi}).groupby(np.cumsum(begins)).cumsum()
    q, lo, hi = (np.where(begins, 0.0, np.r_[0.0, running[c].to_numpy()[:-1]]) for c in ("q", "lo", "hi"))
    base = base + q
    out, kept = [], np.flatnonzero(live)
    kept = kept[np.argsort(block[kept], kind="stable")]
    for at in np.split(kept, np.flatnonzero(np.diff(block[kept])) + 1):
        if len(at):
            out.append((int(block[at[0]]), _pack(START, item[at], base[at], (base + lo)[at], (base + hi)[at])))
    return pa.table([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=["at", "cells"])


def _before(sums: DataFrame) -> DataFrame:
    """(at, cells): what the blocks before block ``at`` take of the items that are live in it, a row
    per bucket.  Sums have what the block still takes (lo, hi), what it was newly settled to take
    (q), and what was settled before it up to now (base)."""
    return sums.select("bucket", "block", "n", "cells").groupBy("bucket").applyInArrow(_earlier, "at int, cells binary")


def _groups(lines: DataFrame, share: int) -> dict[int, int]:
    """Group of each block with lines (the group's first block): neighbours that hold
    ``share`` lines together, or one that holds more."""
    group, first, held = {}, None, 0
    for block, n in sorted(tuple(r) for r in lines.groupBy("block").agg(F.sum("n")).collect()):  # a row per block
        if first is None or held + n > share:
            first, held = block, 0
        group[block] = first
        held += n
    return group


def _grouped(df: DataFrame, block: str, group: dict[int, int] | None) -> DataFrame:
    if not group:
        return df.withColumn("group", F.col(block))
    table = ", ".join(str(group.get(b, -1)) for b in range(max(group) + 1))
    return df.withColumn("group", F.expr(f"element_at(array({table}), `{block}` + 1)"))


def reserve_stock(lines: DataFrame, stock: DataFrame, *, order_col: str = "order_id",
                  seq_cols=("order_date", "order_id"), product_col: str = "product_id",
                  qty_col: str = "quantity", pos_col: str | None = "pos",
                  stock_col: str = "stock", ranges: int | None = None,
                  stats: dict | None = None) -> DataFrame:
    """Decide every order that has lines.

    Returns ``order_col, decision ('INVENTORY_RESERVED'|'OUT_OF_STOCK'),
    failed_product, available, requested, reason`` where the last four
    describe the first failing item (by ``pos``, then product) of a rejected
    order.  ``seq_cols`` must order orders totally (end with the order id).
    ``ranges`` overrides the number of blocks the sequence is cut into (one per
    ``BLOCK_LINES``).  ``stats``, when given, receives the number of passes, the open
    lines after each and the rows each wrote.

    The loop needs its decisions as it goes, so this runs jobs when called; what
    it returns is a table in the shared folder.  The demand is computed once; a
    pass's table is removed when the next one is written.
    """
    spark = lines.sparkSession
    seq_cols = list(seq_cols)
    ensure_checkpoint_dir(spark)
    t0 = time.perf_counter()
    seq_keys = [c for c in seq_cols if c != order_col]
    ordering = seq_keys + [order_col]
    demand = materialise(order_demand(lines, order_col, seq_keys, product_col, qty_col, pos_col)
                         .withColumnRenamed(product_col, "product"), "demand")
    total = demand.count()
    blocks = ranges or max(1, -(-total // BLOCK_LINES))
    buckets = max(min(blocks, SPREAD), -(-total // BUCKET_LINES))
    # Where quantities are plain amounts, what asks for more than the stock is lost whatever comes before.
    amount = F.coalesce((F.col("qty") >= 0) & (F.col("qty") < float("inf")), F.lit(False))
    # A product is one item, however many rows the stock has of it; numbers are written before they are used.
    items = materialise(demand.groupBy("product").agg(F.sum("qty").alias("total"), F.bool_and(amount).alias("amounts"))
                        .withColumn("item", F.monotonically_increasing_id()), "items")
    products = (
        items.join(stock.select(F.col(product_col).alias("product"), F.col(stock_col).cast("double").alias("stock")), "product", "left")
        .select("product", "item", F.col("stock").isNotNull().alias("found"),
                F.coalesce("stock", F.lit(0.0)).alias("stock"), (F.col("total") > F.coalesce("stock", F.lit(0.0))).alias("constraining"),
                "amounts"))
    # Whole orders stand in one block: it is cut by the order's place alone.
    cut = (demand.join(products, "product").repartitionByRange(blocks, *ordering).withColumn("block", F.spark_partition_id())
           .select("block", *ordering, "product", "item", "qty", "pos", "stock", "found", "constraining",
                   F.coalesce(F.col("constraining") & F.col("amounts") & (F.col("qty") > F.col("stock")), F.lit(False)).alias("hopeless")))
    types = dict(cut.dtypes)
    if {types[c] for c in ordering} & {"double", "float"}:
        cut = cut.sortWithinPartitions(*ordering)

    def open_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = [b for b in batches if b.num_rows]
        if lines:
            yield from _opened(pa.Table.from_batches(lines), ordering, order_col, buckets).to_batches(max_chunksize=10_000)

    placed = materialise(cut.mapInArrow(open_block, f"{ROWS}, `{order_col}` {types[order_col]}, held boolean"), "placed")
    discard(demand, items)

    def rows(table: DataFrame, kind: str) -> DataFrame:
        return table.filter(F.col("kind") == kind).select("kind", "block", "bucket", "n", "open", "cells")

    def lines_in(table: DataFrame) -> int:
        return table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def walk(lines: pa.Table, starts: pa.Table) -> pa.Table:
        return _walk(lines, starts, buckets)

    live, sums = rows(placed, "line"), rows(placed, "sum")
    settled: list[DataFrame] = []
    last_pass, sizes = None, []
    share = max(1, -(-lines_in(rows(placed, "all")) // blocks))
    open_lines, group = lines_in(live), _groups(live, share)
    while open_lines:
        t_pass = time.perf_counter()
        seen = Observation(f"reservation_pass_{len(sizes)}")
        walked = materialise(
            _grouped(live, "block", group).groupBy("group").cogroup(_grouped(_before(sums), "at", group).groupBy("group"))
            .applyInArrow(walk, ROWS).observe(seen, F.coalesce(F.sum("open"), F.lit(0)).alias("open"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")),
            "reservation-pass")
        if seen.get["open"] >= open_lines:
            raise RuntimeError("a pass decided nothing: the quantities or the sequence are not comparable")
        open_lines = seen.get["open"]
        live, sums = rows(walked, "line"), rows(walked, "sum")
        settled.append(materialise(rows(walked, "settled"), "reservation-settled"))
        if last_pass is not None:
            discard(last_pass)
        last_pass = walked
        group = _groups(live, share)
        sizes.append({"open": open_lines, "rows": seen.get["rows"], "seconds": round(time.perf_counter() - t_pass, 2)})
    if stats is not None:
        stats.update(rounds=len(sizes), open_after=[s["open"] for s in sizes], rows_written=[s["rows"] for s in sizes],
                     blocks=blocks, seconds=round(time.perf_counter() - t0, 2))

    verdict = (f"`{order_col}` {types[order_col]}, accepted boolean, failed_product {types['product']}, available double, "
               "requested double, found boolean")

    def judge(lines: pa.Table, starts: pa.Table) -> pa.Table:
        return _judge(lines, starts, order_col)

    starts = _before(functools.reduce(DataFrame.unionByName, settled, rows(placed, "asked")))
    judged = rows(placed, "all").groupBy("block").cogroup(starts.groupBy("at")).applyInArrow(judge, verdict)
    # Orders that never meet a constraint.
    free = (placed.filter("kind = 'order'").groupBy(order_col).agg(F.max("held").alias("held")).filter("NOT held")
            .select(order_col, F.lit(True).alias("accepted")))
    # Written once: later stages read the decisions several times.
    out = materialise(judged.unionByName(free, allowMissingColumns=True).select(
        order_col,
        F.when(F.col("accepted"), "INVENTORY_RESERVED").otherwise("OUT_OF_STOCK").alias("decision"),
        F.col("failed_product"), "available", "requested",
        F.when(F.col("accepted"), F.lit(None).cast("string"))
         .when(~F.col("found"), "Product not found")
         .otherwise("Insufficient stock").alias("reason")), "reservation")
    discard(placed, *settled, *([last_pass] if last_pass is not None else []))
    return out


def sequential_reservation(orders, stock: dict):
    """Plain loop of the sequential rule, for tests: ``orders`` is a list of
    ``(order_id, [(product, qty), ...])`` in sequence order."""
    left = dict(stock)
    out = {}
    for oid, items in orders:
        need: dict = {}
        for p, q in items:
            need[p] = need.get(p, 0) + q
        if all(left.get(p, 0) >= q for p, q in need.items()):
            for p, q in need.items():
                left[p] -= q
            out[oid] = True
        else:
            out[oid] = False
    return out, left
