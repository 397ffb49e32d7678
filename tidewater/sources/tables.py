"""Parquet tables and dimension seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, base: str, name: str, columns=None) -> DataFrame:
    """``<base>/<name>.parquet``; naming the columns lets the scan prune the rest."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


STOCK_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("stock", T.LongType(), False),
    T.StructField("reserved", T.LongType(), False),
])


def stock_seed(spark: SparkSession, rows) -> DataFrame:
    """A stock dimension from ``(product_id, name, stock)`` rows; reserved starts at 0."""
    data = [(str(r[0]), (r[1] if len(r) > 2 else None), int(r[-1]), 0) for r in rows]
    return spark.createDataFrame(data, STOCK_SCHEMA)


def stock_from_parts(part: DataFrame, per_size: int = 10) -> DataFrame:
    """Stock derived from the part table: ``p_size * per_size`` units per product."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        (F.col("p_size").cast("bigint") * F.lit(per_size)).alias("stock"),
    )
