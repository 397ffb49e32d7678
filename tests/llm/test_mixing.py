"""Mixing: targets against a plain loop, pivotal rounding's guarantees, edge rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewater.llm import mixing, queries

SCHEMA = "doc_id bigint, text string, source string, size string, target string"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target} from {source: size}; sources in order, None last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return {**{s: cap * sizes[s] for s in capped}, **share}
        capped |= over


def check(rows, want_rows, source_of):
    assert len(rows) == want_rows
    sizes, taken, target, most = Counter(), Counter(), {}, defaultdict(int)
    for r in rows:
        s = source_of(r)
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        most[s] = max(most[s], r.size)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = brute_targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s], abs=1e-6), s
        assert abs(taken[s] - want[s]) <= most[s], s
    return taken, want


def words(n):
    return " ".join("w" for _ in range(n))


def test_caps_are_reshared():
    assert brute_targets({"a": 1, "b": 100, "c": 100}) == pytest.approx({"a": 3, "b": 132, "c": 66})


def test_targets_equal_the_loop(spark):
    for sizes in ({"a": 1, "b": 100, "c": 100}, {"a": 0, "b": 5, None: 7}, {"b": 10, "a": 10, "Z": 1, "é": 2, "": 40},
                  {f"s{i}": 1 + (i * 37) % 11 for i in range(40)}, {"only": 9}, {"a": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, size bigint").repartition(5)
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == {s: pytest.approx(t, abs=1e-9) for s, t in brute_targets(sizes).items()}


def test_settle_keeps_words_and_leaves_a_small_document():
    draw = np.random.Generator(np.random.Philox(1))
    for n in (1, 2, 3, 10, 1000):
        size = np.floor(draw.pareto(1.0, n) * 20 + 1)
        p0 = np.full(n, 0.37)
        p, left = mixing.settle(size, p0, draw)
        assert abs(size @ p - size @ p0) < 1e-6 * size.sum() + 1e-9
        loose = [i for i in range(n) if 0 < p[i] < 1]
        assert loose == ([left] if left >= 0 else [])
        if n == 1000 and left >= 0:
            assert size[left] <= np.median(size)


def test_settle_is_unbiased():
    size = np.array([1.0, 7.0, 2.0, 30.0, 30.0, 5.0, 900.0, 3.0])
    total = np.zeros(len(size))
    runs = 6000
    for seed in range(runs):
        draw = np.random.Generator(np.random.Philox(seed))
        p, left = mixing.settle(size, np.full(len(size), 0.3), draw)
        total += p
    assert np.allclose(total / runs, 0.3, atol=0.025)


def test_mix_in_blocks_and_levels(spark):
    rows = [(i, words(1 + (i * i) % 50), f"s{i % 7 if i % 3 else 0}", "x", "y") for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, block=10, fan_in=3).collect()
    check(got, 700, lambda r: r.source)
    again = mixing.mix(df.repartition(13), block=10, fan_in=3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_nulls_repeats_empty_texts_and_clashing_columns(spark):
    long = words(100_000)
    rows = [(1, "a b", "s"), (1, "a b", "s"), (1, "a b", "s"), (None, "c\x0bd\xa0e", None), (None, None, "t"),
            (2, "", "t"), (3, "x", "t"), (4, long, None), (5, " \t\n", "u")]
    df = spark.createDataFrame([(*r, "1", "2") for r in rows], SCHEMA)
    got = mixing.mix(df).collect()
    check(got, len(rows), lambda r: r.source)
    by = {r.doc_id: r for r in got}
    assert by[2].size == by[5].size == 0 and by[4].size == 100_000
    assert sorted(r.size for r in got if r.doc_id is None) == [0, 2]
    assert mixing.mix(df.limit(0)).collect() == []


def test_equal_and_unnamed_rows_spread_over_blocks(spark, monkeypatch):
    """A third of the rows without id and of one size, a third equal in everything."""
    rows = [(None, f"{i} b c", "s") for i in range(600)] + [(7, "one two three", "s")] * 600 + [(100 + i, words(i % 9), "s") for i in range(600)]
    df = spark.createDataFrame([(*r, "1", "2") for r in rows], SCHEMA)
    blocks = []
    keep = mixing.materialise

    def watch(out, name):
        if name == "mix-level0":
            blocks.append(out)
        return keep(out, name)

    monkeypatch.setattr(mixing, "materialise", watch)
    got = mixing.mix(df, block=60).collect()
    check(got, len(rows), lambda r: r.source)
    sizes = [r["count"] for r in blocks[0].groupBy("block").count().collect()]
    assert len(sizes) == 30 and max(sizes) <= 2 * 60


def test_mixed_documents_repeat_rows(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", None), (2, words(9), "s"), (3, words(4), "t"), (4, words(50), "u")]
    df = spark.createDataFrame([(*r, "1", "2") for r in rows], SCHEMA)
    want = Counter()
    for r in mixing.mix(df).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in out.collect())
    assert got == +want


def test_query_on_tables(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    df = queries.op10_mixing(spark, SF001)
    rows = df.collect()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.source == docs[r.doc_id].source
    check(rows, len(docs), lambda r: r.source)
    assert sorted(map(str, rows)) == sorted(map(str, queries.op10_mixing(spark, SF001).collect()))
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    assert all(r.source_size == sizes[r.source] for r in rows)
    assert df.where(F.col("taken") > 0).count() > 0
