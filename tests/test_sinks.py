"""Sinks (K1-K15): idempotent replays, contracts, zones."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.sinks import writers as K
from tidewater.sources.files import read_json_documents


def test_write_batch_replay_does_not_double(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    K.write_batch(df, f"{tmp}/t", 7)
    K.write_batch(df, f"{tmp}/t", 7)  # replay of batch 7
    K.write_batch(df.limit(1), f"{tmp}/t", 8)
    out = spark.read.parquet(f"{tmp}/t")
    assert out.count() == 3 and {r.batch_id for r in out.collect()} == {7, 8}


def test_insert_if_absent_table(spark, tmp):
    b1 = spark.createDataFrame([("e1", 1), ("e2", 2), ("e1", 3)], "id string, t int")
    K.insert_if_absent_table(b1, f"{tmp}/ev", "id", ["t"])
    K.insert_if_absent_table(b1, f"{tmp}/ev", "id", ["t"])  # replay appends nothing
    b2 = spark.createDataFrame([("e2", 9), ("e3", 4)], "id string, t int")
    K.insert_if_absent_table(b2, f"{tmp}/ev", "id", ["t"])
    got = {r.id: r.t for r in K.read_keyed(spark, f"{tmp}/ev").collect()}
    assert got == {"e1": 1, "e2": 2, "e3": 4}


def test_upsert_counts_table_versions(spark, tmp):
    t = dt.datetime(2024, 1, 1)
    d1 = spark.createDataFrame([(1, 2, t), (2, 1, t)], "article_id int, daily_views bigint, last_updated timestamp")
    d2 = spark.createDataFrame([(1, 3, t + dt.timedelta(1))], "article_id int, daily_views bigint, last_updated timestamp")
    p = f"{tmp}/agg"
    K.upsert_counts_table(d1, p, 0, "article_id", "daily_views", "last_updated")
    K.upsert_counts_table(d2, p, 1, "article_id", "daily_views", "last_updated")
    K.upsert_counts_table(d2, p, 1, "article_id", "daily_views", "last_updated")  # replay skipped
    got = {r.article_id: r.daily_views for r in K.read_keyed(spark, p).collect()}
    assert got == {1: 5, 2: 1}


def test_conform_contract(spark):
    df = spark.createDataFrame(
        [("books", "a", 10, 3, 1, 0.5, "x"), (None, "b", 11, 1, 0, 0.0, "y"),
         ("books", "c" * 201, 12, 1, 0, 0.0, "z"), ("toys", "d", 13, 1, 0, 12.5, "w")],
        "product_category string, product_name string, hour int, view_count bigint, purchases bigint, "
        "conversion_rate double, extra string")
    good, bad = K.conform(df, "product_performance")
    assert [r.product_name for r in good.collect()] == ["a"]
    assert good.first().cart_adds == 0  # default filled
    reasons = {r.product_name[:1]: r.reason for r in bad.collect()}
    assert reasons == {"b": "null_product_category", "c": "long_product_name", "d": "bad_conversion_rate"}
    assert "extra" not in good.columns


def test_write_if_not_empty_and_fan_out(spark, tmp):
    empty = spark.createDataFrame([], "id int")
    assert K.write_if_not_empty(empty, lambda d: d.write.parquet(f"{tmp}/never")) is False
    df = spark.createDataFrame([(1,), (2,)], "id int")
    done = K.fan_out_writes(df, {"a": lambda d: K.snapshot(d, f"{tmp}/a"),
                                 "b": lambda d: K.write_csv(d, f"{tmp}/b")})
    assert done == {"a": True, "b": True}
    assert spark.read.parquet(f"{tmp}/a").count() == 2
    assert spark.read.option("header", True).csv(f"{tmp}/b").count() == 2
    assert not df.is_cached


def test_history_is_partition_pruned(spark, tmp):
    rows = [(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 6))]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    K.append_history(df, f"{tmp}/h", "ts", batch_id=1)
    K.append_history(df, f"{tmp}/h", "ts", batch_id=1)  # retry replaces its partitions
    h = spark.read.parquet(f"{tmp}/h")
    assert h.count() == 2
    q = h.filter(F.col("date") == "2024-01-02")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and q.count() == 1


def test_zones_tables_and_publish(spark, tmp):
    raw = spark.createDataFrame([(1, "alice", "us"), (2, "bob", "uk")], "id int, name string, country string")
    cur = K.write_zones(raw, lambda d: d.withColumn("country", F.upper("country")), f"{tmp}/lake")
    assert sorted(r.country for r in cur.collect()) == ["UK", "US"]
    K.create_table_as(cur, "curated_people", temp=True)
    assert spark.sql("SELECT count(*) AS n FROM curated_people").first().n == 2
    K.publish_events(raw, "id", fmt="json", topic="people", path=f"{tmp}/topics")
    rec = spark.read.json(f"{tmp}/topics/people").collect()
    assert {r.key for r in rec} == {"1", "2"} and '"name":"alice"' in [r.value for r in rec if r.key == "1"][0]


def test_json_document_source(spark, tmp):
    p = f"{tmp}/users.json"
    with open(p, "w") as f:
        f.write('[{"user_id": 1, "email": "a@x"}, {"user_id": 2, "email": "b@x"}]')
    assert read_json_documents(spark, p, "user_id int, email string").count() == 2


def test_replace_table_and_console_sink(spark, tmp):
    spark.conf.set("spark.sql.legacy.allowNonEmptyLocationInCTAS", "true")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    K.replace_table(df, "tw_replace_t")
    K.replace_table(df.limit(1), "tw_replace_t")
    assert spark.table("tw_replace_t").count() == 1
    spark.sql("DROP TABLE tw_replace_t")
    df.write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp}/in")
    q = K.console_sink(stream, rows=5, mode="append").option("checkpointLocation", f"{tmp}/ck") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 2
