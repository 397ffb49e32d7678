"""Cleaning, zones and idempotent-load logic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a null in any (or the given) column."""
    return df.dropna(how="any", subset=subset)


def upper_column(df: DataFrame, column: str) -> DataFrame:
    """Normalise a text column to upper case."""
    return df.withColumn(column, F.upper(F.col(column)))


def union_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; missing columns become null, duplicates are kept."""
    return a.unionByName(b, allowMissingColumns=True)


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep the first row of each key by ``order_cols`` (W2, M7 in batch).

    ``min_by`` is an ordinary aggregate, so each task keeps only its best row
    per key before the shuffle (partial aggregation): a hot key costs one row
    per task, not a sort of all its rows in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order_cols]))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c)
                                                                     for c in rest])


def rows_not_in(df: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Rows whose key is not yet in the target."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, batch: DataFrame, keys, order_cols) -> DataFrame:
    """``INSERT .. ON CONFLICT (key) DO NOTHING`` as a set operation (K3).

    The first row per key inside the batch wins; keys already in the target
    keep the target's row.  Returns the new table contents.
    """
    fresh = rows_not_in(first_per_key(batch, keys, order_cols), target, keys)
    return target.unionByName(fresh.select(*target.columns))


def accumulate_counts(target: DataFrame, delta: DataFrame, key: str, count_col: str,
                      stamp_col: str) -> DataFrame:
    """``count = count + EXCLUDED.count`` upsert (K4): union, then one aggregate."""
    return (target.select(key, count_col, stamp_col)
            .unionByName(delta.select(key, count_col, stamp_col))
            .groupBy(key)
            .agg(F.sum(count_col).alias(count_col), F.max(stamp_col).alias(stamp_col)))
