"""Nearest neighbours: the adaptive scan and the whole search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidewater.llm import ann, queries


def brute(ids, x, query_ids, k=10):
    """{query id: [(vec_id, distance)]} over every row but the query's own."""
    out = {}
    for q in query_ids:
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def rows_by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_scan_of_a_block():
    draw = np.random.default_rng(1)
    for n, dims in ((1, 3), (5, 8), (300, 24), (2000, 64)):
        x, q = draw.normal(size=(n, dims)), draw.normal(size=(40, dims))
        x[: n // 3] = x[0]  # ties
        ids = draw.permutation(n)
        rotation = np.linalg.qr(draw.normal(size=(dims, dims)))[0]
        qi, xi, score = ann.scan_block(ids, x, q, rotation, 11)
        hits = total = 0
        for j in range(40):
            d = np.sqrt(((x - q[j]) ** 2).sum(1))
            want = np.lexsort((ids, d))[:11]
            got = xi[qi == j]
            assert len(got) == len(want) and np.allclose(score[qi == j], d[got]) and list(got) == sorted(got, key=lambda i: (d[i], ids[i]))
            hits, total = hits + len(set(got) & set(want)), total + len(want)
        assert hits >= 0.97 * total


def test_a_lenient_test_loses_nothing():
    draw = np.random.default_rng(2)
    x, q = draw.normal(size=(500, 64)), draw.normal(size=(20, 64))
    qi, xi, _ = ann.scan_block(np.arange(500), x, q, np.linalg.qr(draw.normal(size=(64, 64)))[0], 10, epsilon=100.0)
    for j in range(20):
        assert xi[qi == j].tolist() == np.argsort(((x - q[j]) ** 2).sum(1))[:10].tolist()


def test_fit_is_orthogonal_and_bounded():
    x = np.random.default_rng(3).normal(size=(400, 16))
    index = ann.fit(x, 10_000, 10)
    assert np.allclose(index.rotation @ index.rotation.T, np.eye(16)) and len(index.centres) <= 50
    assert 1 <= index.probes <= len(index.centres)
    assert len(ann.fit(np.ones((50, 4)), 50, 10).centres) == 1


def test_lists_grow_with_the_rows_from_one_bounded_sample():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4000, 8)) + 6 * draw.normal(size=(20, 8))[draw.integers(0, 20, 4000)]
    for rows, lists in ((100, 10), (4_096, 64), (40_000, 64 * 4), (160_000, 64 * 7)):
        index = ann.fit(x, rows, 10, level=64)
        assert index.lists == lists and 1 <= index.probes <= lists
        own = index.place(x)
        pairs = (index.centres[:, None] + index.finer[None]).reshape(-1, 8)
        assert own.min() >= 0 and own.max() < lists and sorted(index.order(x[0])) == list(range(lists))
        assert (np.diff(((x[0] - pairs[index.order(x[0])]) ** 2).sum(1)) > -1e-9).all()
    assert index.probes < lists / 4


def test_search_over_two_levels_and_a_list_that_all_ask_for(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(6000, 8)) + 6 * draw.normal(size=(12, 8))[draw.integers(0, 12, 6000)]
    x[::100] = x[0] + draw.normal(size=(60, 8)) / 100  # all queries and their neighbours in one place
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(4)
    x = x.astype(np.float32).astype(np.float64)
    want = brute(np.arange(6000), x, range(0, 6000, 100))
    got = rows_by_query(ann.search(df, F.col("vec_id") % 100 == 0, level=8, block=50, query_block=4))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.95 * 600


def frame(spark, rows, extra=True):
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id bigint, embedding array<float>, rep string, list int")


def test_search_small_with_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    draw = np.random.default_rng(4)
    x = draw.normal(size=(60, 5)).astype(np.float32)
    x[20:50] = x[0]  # a large group of copies
    good = [(i * 10, x[i].tolist()) for i in range(60)]
    bad = [(1000, None), (1100, [0.0] * 5), (1200, [1.0, None, 1.0, 1.0, 1.0]), (1300, [nan, 1.0, 1.0, 1.0, 1.0]),
           (1400, [inf] * 5), (1500, [1.0, 2.0]), (1600, []), (None, [1.0] * 5)]
    df = frame(spark, good + bad + [good[5], good[10]]).repartition(6)
    got = rows_by_query(ann.search(df, F.col("vec_id") % 100 == 0, block=7, query_block=2))
    want = brute(np.array([g[0] for g in good]), x.astype(np.float64), [i for i, _ in good if i % 100 == 0])
    assert got.keys() == want.keys()
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_fewer_candidates_than_asked(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])
    got = rows_by_query(ann.search(df, F.col("vec_id") % 100 == 0))
    assert got == {0: [(1, 0.0), (2, pytest.approx(2 ** 0.5))]}
    assert ann.search(df.where("vec_id = 0"), F.col("vec_id") % 100 == 0).collect() == []
    assert ann.search(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_query_recall(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet").toPandas()
    ids, x = e.vec_id.to_numpy(), np.array(e.embedding.tolist(), dtype=np.float64)
    want = brute(ids, x, [i for i in ids.tolist() if i % 100 == 0])
    got = rows_by_query(queries.op5_ann(spark, SF01))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    at = {v: i for i, v in enumerate(ids.tolist())}
    assert all(s == pytest.approx(np.sqrt(((x[at[q]] - x[at[v]]) ** 2).sum()), rel=1e-12) for q in got for v, s in got[q])
