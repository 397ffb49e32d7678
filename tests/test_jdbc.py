"""JDBC source and sink (S5, K2, K9) on an in-memory Derby database.

Derby runs embedded inside the test's own JVM (no server, no port), so the
database is visible to this process only.
"""

from tidewater.sinks.writers import write_jdbc
from tidewater.sources.jdbc import read_jdbc_table

URL = "jdbc:derby:memory:tidewater_test;create=true"
PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_partitioned_jdbc_round_trip(spark):
    rows = [(i, f"u{i % 7}", ["view", "purchase", "cart"][i % 3]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, user_id string, action string")
    write_jdbc(df, URL, "events_t", mode="overwrite", properties=PROPS, batch_size=50)
    write_jdbc(df.limit(0), URL, "events_t", mode="append", properties=PROPS)
    back = read_jdbc_table(spark, URL, "events_t", partition_column="id", lower=0, upper=200,
                           num_partitions=4, properties=PROPS)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 200
    assert {r.action: r.n for r in back.groupBy("action").count().withColumnRenamed("count", "n").collect()} == \
        {"view": 67, "purchase": 67, "cart": 66}


def test_scan_splits_a_skewed_key_evenly(spark):
    """Keys crowd at both ends of a wide range; one key holds a sixth of the rows, some none."""
    from pyspark.sql import functions as F

    from tidewater.sources.jdbc import key_ranges, read_jdbc_table
    from tidewater.sinks.writers import write_jdbc
    url = "jdbc:derby:memory:tidewater_skewed;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    crowded = spark.range(4000).select(F.col("id").alias("k"))
    far = spark.range(3000).select((F.col("id") * 3 + 9_000_000_000).alias("k"))
    hot = spark.range(1400).select(F.lit(5_000_000_000).alias("k"))
    none = spark.range(100).select(F.lit(None).cast("bigint").alias("k"))
    rows = crowded.union(far).union(hot).union(none).withColumn("v", F.monotonically_increasing_id())
    write_jdbc(rows.coalesce(1), url, "t", properties=props)
    back = read_jdbc_table(spark, url, "t", partition_column="k", num_partitions=6, properties=props)
    sizes = [r["n"] for r in back.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 8500 and 5 <= len(sizes) <= 8 and max(sizes) <= 1.5 * 8500 / 6
    assert back.select("v").distinct().count() == 8500  # every row once
    names = {f.name.lower(): f.name for f in back.schema.fields}
    assert set(names) == {"k", "v"}
    write_jdbc(spark.createDataFrame([(None, 1)], "k bigint, v bigint").coalesce(1), url, "empty_keys", properties=props)
    assert key_ranges(spark, url, "empty_keys", "k", 4, props) == ["1 = 1"]
    assert read_jdbc_table(spark, url, "empty_keys", partition_column="k", properties=props).count() == 1
