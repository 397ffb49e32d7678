"""Keyed tables: splitting buckets, deltas, replays, commits that die."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.sinks.keyed import KeyedTable


def rows_of(table, **kw):
    return {r[0]: tuple(r)[1:] for r in table.read(**kw).collect()}


def files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_buckets_split_and_stay_bounded(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "id", {"n": "sum", "at": "max"}, bucket_rows=300, deltas=4)
    want = {}
    for batch, (lo, hi) in enumerate([(0, 200), (100, 2200), (0, 2500), (2400, 2450)]):  # tenfold in the second
        assert t.append(spark.range(lo, hi).select("id", F.lit(1).alias("n"), F.lit(batch).alias("at")), batch)
        for i in range(lo, hi):
            want[i] = (want.get(i, (0, 0))[0] + 1, batch)
        assert rows_of(t) == want
        assert max(b["rows"] for b in t.manifest()["buckets"]) <= 300
        assert max(len(b["folders"]) for b in t.manifest()["buckets"]) <= 4
    m = t.manifest()
    assert len(m["buckets"]) >= 9 and m["written"] < 400  # the last batch of 50 rewrote no more than what it filled
    seen = {(b["depth"], b["bits"]) for b in m["buckets"]}
    assert sum(2.0 ** -d for d, _ in seen) == 1.0  # the buckets cover every hash once


def test_many_small_batches_write_what_they_bring(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "id", {"n": "sum"}, bucket_rows=10_000, deltas=4)
    t.append(spark.range(1000).select("id", F.lit(100).alias("n")), -1)
    written = []
    for batch in range(6):
        t.append(spark.createDataFrame([(batch, -1), (7, -2)], "id bigint, n int"), batch)
        written.append(t.manifest()["written"])
    assert sorted(written)[:5] == [2] * 5 and sum(written) <= 1000 + 6 * 2  # one compaction
    got = rows_of(t)
    assert got[7] == (100 - 12,) and got[5] == (99,) and got[6] == (100,)


def test_replay_and_reading_before_a_batch(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", ["a", "b"], {"n": "sum"})
    one = spark.createDataFrame([(1, None, 5), (1, "x", 1), (None, None, 2)], "a int, b string, n bigint")
    assert t.append(one, 0) and not t.append(one, 0)
    assert t.append(one, 1) and not t.append(one, 1) and not t.append(one, 0)
    assert {tuple(r) for r in t.read().collect()} == {(1, None, 10), (1, "x", 2), (None, None, 4)}
    assert {tuple(r) for r in t.read(before=1).collect()} == {(1, None, 5), (1, "x", 1), (None, None, 2)}
    assert t.append(one.limit(0), 2) and t.manifest()["batch"] == 2 and t.read().count() == 3
    again = KeyedTable(spark, f"{tmp}/t")  # a reader needs to know nothing
    assert again.keys == ["a", "b"] and again.read(touching=one.filter("b = 'x'")).filter("b = 'x'").first().n == 2
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, f"{tmp}/none").read()


def test_a_commit_that_dies_leaves_the_old_table(spark, tmp, monkeypatch):
    t = KeyedTable(spark, f"{tmp}/t", "id", {"n": "sum"}, bucket_rows=50)
    t.append(spark.range(40).select("id", F.lit(1).alias("n")), 0)
    before = rows_of(t)

    def die(_manifest):
        raise RuntimeError("killed between data and manifest")

    monkeypatch.setattr(t, "_publish", die)
    with pytest.raises(RuntimeError):
        t.append(spark.range(400).select("id", F.lit(1).alias("n")), 1)
    assert rows_of(KeyedTable(spark, f"{tmp}/t")) == before
    monkeypatch.undo()
    assert t.append(spark.range(400).select("id", F.lit(1).alias("n")), 1)  # the batch again
    assert rows_of(t) == {i: (2,) if i < 40 else (1,) for i in range(400)}
    t.append(spark.range(1).select("id", F.lit(1).alias("n")), 2)
    named = {f.split("/")[0] for v in t.versions() for b in t._load(v)["buckets"] for f in b["folders"]}
    assert set(os.listdir(f"{tmp}/t/data")) == named and len(t.versions()) == 2  # what died is gone


def test_two_writers_do_not_overwrite_each_other(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "id", {"n": "sum"})
    t.append(spark.range(3).select("id", F.lit(1).alias("n")))
    manifest = t.manifest()
    with pytest.raises(RuntimeError):
        t._publish(manifest)


def test_insert_absent(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "id", {"t": "any"}, bucket_rows=4)
    first = spark.createDataFrame([(f"e{i}", i) for i in range(10)] + [("e1", -1), (None, 3)], "id string, t int")
    t.insert_absent(first, ["t"])
    t.insert_absent(first, ["t"])  # replay
    t.insert_absent(spark.createDataFrame([("e3", 100), ("e42", 7), (None, 9)], "id string, t int"), ["t"])
    got = rows_of(t)
    assert len(got) == 12 and got["e1"] == (-1,) and got["e3"] == (3,) and got["e42"] == (7,) and got[None] == (3,)


def test_buckets_stay_bounded_when_the_hash_fills_them_unevenly(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "id", {"n": "sum"}, bucket_rows=8)
    t.append(spark.range(350).select("id", F.lit(1).alias("n")), 0)  # 64 buckets of 5.5 rows on average
    assert max(b["rows"] for b in t.manifest()["buckets"]) <= 8
    assert rows_of(t) == {i: (1,) for i in range(350)}
