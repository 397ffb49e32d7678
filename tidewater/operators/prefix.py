"""Running sums per key that stay balanced when one key holds much of the data.

A plain ``sum().over(partitionBy(key).orderBy(seq))`` sends every row of a key
to one task.  Here the sequence is cut into even ranges, and rows are windowed
per ``(key, chunk)``: a key that holds more rows than one range is cut along the
ranges (its chunk is the range), any other key is one chunk.  So no window
partition exceeds the rows of one range, whatever the skew, and the table of
totals per (key, chunk), which gives each chunk the sum of the key's earlier
chunks, has at most one row per key plus one per split key and range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import discard, materialise

#: Ranges of a sequence: at least so many for each task slot, and so few rows in one.
RANGES_PER_SLOT = 4
RANGE_ROWS = 1_000_000


def with_chunks(df: DataFrame, key: str, order_cols, name: str = "chunk", ranges: int | None = None) -> DataFrame:
    """Add the chunk of every row, for ``running_sums`` (one shuffle by the sequence,
    and an aggregate by key).  ``ranges`` overrides the number of ranges.

    ``df`` is evaluated once, and the result is written to the shared folder: the range
    of a row is where the range shuffle put it, which must not change between two uses.
    """
    spark = df.sparkSession
    df = materialise(df, "unranged")
    total = df.count()
    slots = spark.sparkContext.defaultParallelism
    ranges = ranges or max(RANGES_PER_SLOT * slots, -(-total // RANGE_ROWS))
    ranged = materialise(df.repartitionByRange(ranges, *order_cols).withColumn("_rs_range", F.spark_partition_id()), "ranged")
    share = -(-total // ranges)
    sizes = materialise(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rs_n")), "key-sizes")
    discard(df)
    return (ranged.join(sizes, key).withColumn(name, F.when(F.col("_rs_n") > share, F.col("_rs_range")).otherwise(F.lit(-1)))
            .drop("_rs_range", "_rs_n"))


def running_sums(df: DataFrame, key: str, order_cols, values: dict, *, chunk: str = "chunk",
                 inclusive: bool = True, key_max: dict | None = None) -> DataFrame:
    """Add one column per ``values`` entry: the sum of that expression over the
    rows of the same key up to this row (``inclusive``) or before it.

    ``order_cols`` must order rows of a key totally, and the ``chunk`` column
    must never decrease along them within a key (see ``with_chunks``).  ``key_max``
    adds, per entry, the maximum of an expression over the whole key (e.g. the
    last position still undecided).  Input columns starting with ``_rs_`` are
    reserved.
    """
    order_cols = list(order_cols)
    key_max = key_max or {}
    frame_end = Window.currentRow if inclusive else -1
    local_w = (Window.partitionBy(key, chunk).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, frame_end))
    local = df.select("*", *[F.coalesce(F.sum(v).over(local_w), F.lit(0)).alias(f"_rs_l_{n}")
                             for n, v in values.items()])
    totals = df.groupBy(key, chunk).agg(
        *[F.sum(v).alias(f"_rs_t_{n}") for n, v in values.items()],
        *[F.max(v).alias(f"_rs_m_{n}") for n, v in key_max.items()])
    earlier = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    offsets = totals.select(
        F.col(key).alias("_rs_key"), F.col(chunk).alias("_rs_chunk"),
        *[F.coalesce(F.sum(f"_rs_t_{n}").over(earlier), F.lit(0)).alias(f"_rs_o_{n}") for n in values],
        *[F.max(f"_rs_m_{n}").over(whole).alias(n) for n in key_max])
    out = local.join(offsets, (F.col(key) == F.col("_rs_key")) & (F.col(chunk) == F.col("_rs_chunk")), "inner")
    return out.select(*df.columns, *[(F.col(f"_rs_l_{n}") + F.col(f"_rs_o_{n}")).alias(n) for n in values],
                      *list(key_max))
