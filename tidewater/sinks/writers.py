"""Sinks (K1-K15).  Every writer is idempotent where the reference was not:
a replayed micro-batch or a retried job leaves the same table behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tidewater.schemas import CONTRACTS, Contract
from tidewater.sinks.keyed import KeyedTable, read_keyed

__all__ = [
    "write_batch", "insert_if_absent_table", "upsert_counts_table", "read_keyed",
    "snapshot", "append_history", "write_csv", "write_zones", "replace_table", "publish_events",
    "console_sink", "create_table_as", "write_if_not_empty", "fan_out_writes", "conform",
    "write_jdbc", "upsert_latest",
]


def _exists(df_or_spark, path: str) -> bool:
    """True when ``path`` holds a readable Parquet dataset."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Append a micro-batch stamped with ``batch_id`` (K1), idempotently: only the
    ``batch_id=`` partition is replaced, so a replayed batch does not double rows."""
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").format(fmt).save(path))


def insert_if_absent_table(batch: DataFrame, path: str, keys, order_cols=None, batch_id: int | None = None) -> bool:
    """``INSERT .. ON CONFLICT DO NOTHING`` into a keyed table (K3).

    The first row per key inside the batch wins; keys already stored are skipped.
    Only the buckets the batch touches are read, and only new rows are written.
    Re-running the same batch appends nothing.  Read it with ``read_keyed``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    combine = {c: "any" for c in batch.columns if c not in keys}
    return KeyedTable(batch.sparkSession, path, keys, combine).insert_absent(batch, order_cols, batch_id)


def upsert_counts_table(delta: DataFrame, path: str, batch_id: int, key: str,
                        count_col: str, stamp_col: str) -> bool:
    """Accumulating upsert ``count = count + EXCLUDED.count`` into a keyed table (K4):
    a batch writes its own rows, the sums are made when the table is read or a bucket
    compacted.  A batch that was applied is skipped (a replay)."""
    return KeyedTable(delta.sparkSession, path, key, {count_col: "sum", stamp_col: "max"}).append(delta, batch_id)


def upsert_latest(delta: DataFrame, path: str, keys, partition_col: str, partition_expr) -> None:
    """Replace rows by key (latest value wins), rewriting only the partitions the
    delta touches (K4, replace form).  Used for windows re-emitted in update
    mode: each window keeps one row.  Replaying a batch gives the same table.

    ``partition_expr`` derives ``partition_col`` from the row (e.g. the day of
    the window start), so a micro-batch rewrites a few recent partitions, not
    the table.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark = delta.sparkSession
    delta = delta.withColumn(partition_col, partition_expr)
    merged = delta
    if _exists(spark, path):
        touched = delta.select(partition_col).distinct()
        old = (spark.read.parquet(path).join(touched, partition_col, "left_semi")
               .join(delta.select(*keys), keys, "left_anti"))
        # Cut the lineage to the files about to be replaced.
        merged = old.unionByName(delta.select(*old.columns)).checkpoint()
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def snapshot(df: DataFrame, path: str, fmt: str = "parquet", stamp_col: str | None = None) -> None:
    """Overwrite one dataset with the current contents (K5).  ``stamp_col`` adds
    the export time as its own column, leaving event/processing times intact."""
    if stamp_col:
        df = df.withColumn(stamp_col, F.current_timestamp())
    df.write.mode("overwrite").format(fmt).save(path)


def append_history(df: DataFrame, path: str, date_col: str, batch_id: int | None = None) -> None:
    """History append partitioned by date (K6); readers prune by date.  With a
    batch id the (date, batch) partitions are replaced, so retries do not double."""
    out = df.withColumn("date", F.to_date(F.col(date_col)))
    if batch_id is None:
        out.write.mode("append").partitionBy("date").parquet(path)
    else:
        (out.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "batch_id").parquet(path))


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV with a header row and no index column (K7)."""
    df.write.mode("overwrite").option("header", header).csv(path)


def write_zones(raw: DataFrame, curate, base: str, version: str = "v1") -> DataFrame:
    """Raw zone, then the curated zone derived from what was written (K8)."""
    raw_path = f"{base.rstrip('/')}/raw/{version}"
    cur_path = f"{base.rstrip('/')}/curated/{version}"
    raw.write.mode("overwrite").parquet(raw_path)
    stored = raw.sparkSession.read.parquet(raw_path)
    curate(stored).write.mode("overwrite").parquet(cur_path)
    return raw.sparkSession.read.parquet(cur_path)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table (K9)."""
    df.write.mode("overwrite").saveAsTable(name)


def publish_events(df: DataFrame, key_col: str, *, fmt: str = "kafka", topic: str | None = None,
                   path: str | None = None, bootstrap: str | None = None) -> None:
    """Key + JSON value records (K10): ``kafka`` on a cluster, files offline."""
    payload = [c for c in df.columns]
    rec = df.select(F.col(key_col).cast("string").alias("key"),
                    F.to_json(F.struct(*payload)).alias("value"))
    if fmt == "kafka":
        (rec.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("topic", topic).save())
    else:
        rec.write.mode("append").format(fmt).save(f"{path.rstrip('/')}/{topic}")


def console_sink(stream_df: DataFrame, rows: int = 10, mode: str = "update"):
    """Console sink writer, untruncated (K11); call ``.start()`` on the result."""
    return (stream_df.writeStream.format("console").outputMode(mode)
            .option("truncate", False).option("numRows", rows))


def create_table_as(df: DataFrame, name: str, temp: bool = False) -> None:
    """CREATE TABLE AS SELECT (K12); ``temp`` registers a view instead."""
    if temp:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


def write_if_not_empty(df: DataFrame, write) -> bool:
    """Run ``write(df)`` only when there is a row (K13): one-row probe, not a count."""
    if df.isEmpty():
        return False
    write(df)
    return True


def fan_out_writes(df: DataFrame, writers: dict) -> dict:
    """One batch → many sinks over one cached copy (K14).  ``writers`` maps a
    name to ``DataFrame -> None``; the cache is released even on failure."""
    df.persist()
    done = {}
    try:
        for name, w in writers.items():
            w(df)
            done[name] = True
    finally:
        df.unpersist()
    return done


#: Rates that may exceed their column's type although the row is right (there can be
#: many more purchases than cart adds).
UNBOUNDED_RATES = {"cart_to_purchase_rate"}


def conform(df: DataFrame, contract: Contract | str):
    """Project onto a sink contract (K15): cast with ``try_cast``, fill defaults,
    check length and not-null.  Returns ``(good, bad)``; bad rows carry the
    first broken rule in ``reason``.  An unbounded rate that is too large for its
    type becomes null and does not cost the row."""
    if isinstance(contract, str):
        contract = CONTRACTS[contract]
    cols, checks = [], []
    for name, dtype, max_len, not_null, default in contract.columns:
        src = F.col(name) if name in df.columns else F.lit(None)
        c = src.try_cast(dtype)
        derived = name in UNBOUNDED_RATES
        if default is not None:
            filled = F.coalesce(c, F.lit(default).cast(dtype))
            c = F.when(src.isNotNull() & c.isNull(), c).otherwise(filled) if derived else filled
        cols.append(c.alias(name))
        if name in df.columns and dtype != "string" and not derived:
            checks.append((f"bad_{name}", src.isNotNull() & src.try_cast(dtype).isNull()))
        if not_null:
            checks.append((f"null_{name}", c.isNull()))
        if max_len:
            checks.append((f"long_{name}", F.length(c) > max_len))
    reason = None
    for r, cond in checks:
        cond = F.coalesce(cond, F.lit(False))
        reason = F.when(cond, r) if reason is None else reason.when(cond, r)
    tagged = df.select(*cols, (reason if reason is not None else F.lit(None).cast("string")).alias("reason"))
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """JDBC write with batched inserts (K2 on a database)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "batchsize", batch_size)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
