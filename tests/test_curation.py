"""Golden pairs and load semantics."""

from pyspark.sql import functions as F

from tidewater.operators import curate as C
from tidewater.operators import metrics as M
from tidewater.operators import quality as Q
from tidewater.sources.files import read_csv

# Golden input: five raw rows, one missing its value and one its timestamp.
RAW_CSV = """id,name,value,timestamp
1,Alice,10.0,2025-09-01 10:00:00
2,Bob,20.0,2025-09-02 11:30:00
3,Charlie,,2025-09-03 14:15:00
4,David,40.0,
5,Eve,50.0,2025-09-05 09:45:00
"""
SAMPLE_CSV = """id,name,country
1,alice,us
2,bob,uk
3,carol,de
"""


def _write(tmp, name, text):
    p = f"{tmp}/{name}"
    with open(p, "w") as f:
        f.write(text)
    return p


def test_dropna_golden(spark, tmp):
    df = read_csv(spark, _write(tmp, "raw.csv", RAW_CSV),
                  "id int, name string, value double, timestamp timestamp")
    out = C.drop_incomplete(df).orderBy("id").collect()
    assert [r.id for r in out] == [1, 2, 5]
    assert [r.value for r in out] == [10.0, 20.0, 50.0]


def test_upper_golden(spark, tmp):
    df = read_csv(spark, _write(tmp, "s.csv", SAMPLE_CSV), "id int, name string, country string")
    assert [r.country for r in C.upper_column(df, "country").orderBy("id").collect()] == ["US", "UK", "DE"]


def test_union_and_daily_sales(spark):
    sales = spark.createDataFrame([("2024-01-01", 10.0), ("2024-01-01", 5.5), (None, 7.0),
                                   ("2024-01-02", 1.25)], "date string, sales_amount double")
    users = spark.createDataFrame([(1, "a@x")], "user_id int, email string")
    u = C.union_sources(sales, users)
    assert u.count() == 5 and set(u.columns) == {"date", "sales_amount", "user_id", "email"}
    d = {str(r.date): r.daily_sales for r in M.daily_sum(u, "date", "sales_amount").collect()}
    assert d == {"2024-01-01": 15.5, "2024-01-02": 1.25}  # null date excluded


def test_count_per_key_drops_null_keys(spark):
    pv = spark.createDataFrame([(1,), (1,), (None,), (2,)], "article_id int")
    assert {r.article_id: r.views for r in M.count_per_key(pv, "article_id").collect()} == {1: 2, 2: 1}


def test_first_per_key_keeps_oldest(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"),
                                ("a", 1, "early-tie")], "id string, t int, v string")
    got = {r.id: r.v for r in C.first_per_key(df, "id", ["t", "v"]).collect()}
    assert got == {"a": "early", "b": "only"}


def test_insert_if_absent_keeps_target_row(spark):
    target = spark.createDataFrame([("e1", 1, "old")], "id string, t int, v string")
    batch = spark.createDataFrame([("e1", 0, "new"), ("e2", 3, "x"), ("e2", 2, "y")],
                                  "id string, t int, v string")
    out = {r.id: r.v for r in C.insert_if_absent(target, batch, "id", ["t"]).collect()}
    assert out == {"e1": "old", "e2": "y"}


def test_accumulate_counts(spark):
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    tgt = spark.createDataFrame([(1, 5, t0), (2, 1, t0)], "article_id int, daily_views bigint, last_updated timestamp")
    delta = spark.createDataFrame([(1, 2, t1), (3, 4, t1)], "article_id int, daily_views bigint, last_updated timestamp")
    out = {r.article_id: (r.daily_views, r.last_updated) for r in
           C.accumulate_counts(tgt, delta, "article_id", "daily_views", "last_updated").collect()}
    assert out == {1: (7, t1), 2: (1, t0), 3: (4, t1)}


def test_validation_report(spark):
    df = spark.createDataFrame([(1, "view"), (None, "cart"), (3, "bogus"), (4, None)],
                               "user_id int, action string")
    rep = {r.rule: r for r in Q.validation_report(
        df, [Q.expect_not_null("user_id"), Q.expect_in_set("action", ["view", "purchase", "cart"])]).collect()}
    nn = rep["expect_column_values_to_not_be_null(user_id)"]
    ins = rep["expect_column_values_to_be_in_set(action)"]
    assert (nn.element_count, nn.unexpected_count, nn.success) == (4, 1, False)
    assert (ins.unexpected_count, ins.success) == (1, False)  # null action is ignored


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    out = {r.check: r.passed for r in Q.schema_checks(df, ["id", "missing"]).collect()}
    assert out == {"column_exists(id)": True, "column_exists(missing)": False, "row_count>=1": True}


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (3, -2.0)], "user_id int, amount double")
    good, bad = Q.quarantine_split(df, [("missing_user", F.col("user_id").isNull()),
                                        ("negative_amount", F.col("amount") < 0)])
    assert [r.user_id for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == ["missing_user", "negative_amount"]
