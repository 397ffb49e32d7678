"""Ranked search against plain loops, the sharing graph against plain sums, edge rows."""

import math
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF001
from tidewater.llm import queries, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, words(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, length = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, w in held:
            m = 100 - 90 + (90 * len(w) * n_docs) // length
            s = 0
            for t in ts & set(w):
                tf = w.count(t)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@given(st.text(alphabet="aZ09 .é-İ_\u0085 ", max_size=60))
def test_terms_are_maximal_matches(text):
    assert [t.decode() for t in search.terms(text.encode())] == words(text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), max_size=20), max_size=12))
def test_graph_sums_every_items_terms(items):
    given_ = np.random.default_rng(1).integers(0, 1000, (31, 5))
    graph = search.share([list(i) for i in items], 31)
    assert graph.evaluate(given_).tolist() == [given_[sorted(i)].sum(axis=0).tolist() for i in items]


def test_shared_sets_are_computed_once():
    shared = list(range(16))
    graph = search.share([shared + [20 + i] for i in range(50)], 100)
    assert len(graph.left) == 15 and len(graph.parts) == 100  # one sum of 16 terms, then two parts an item


def test_against_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(search, "DOC_BLOCK", 16)
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Äther", "naïve", "UPPER"]
    def text(n):
        return rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary[: rnd.randint(5, 63)]) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 60))) for i in range(300)] + [(1000 + i, "w1 w2 w3 same words") for i in range(30)]
    items = [(i, text(rnd.randint(0, 25))) for i in range(25)] + [(99, "w1 same"), (98, "nowhere found")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(search.search(d, q)) == brute(docs, items)
    monkeypatch.setattr(search, "ITEM_BLOCK", 7)
    assert got(search.search(d, q)) == brute(docs, items)


def test_nulls_ties_repeats_long_and_empty(spark):
    docs = [(None, "alpha beta"), (None, None), (4, "alpha beta"), (4, "alpha beta"), (3, "alpha beta"), (5, ""), (6, "..."),
            (7, "alpha " * 30000), (8, "gamma delta epsilon"), (9, None)]
    items = [(1, "Alpha alpha ALPHA"), (None, "beta"), (None, "gamma"), (2, None), (3, ""), (1, "delta")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id bigint, text string, item int, score string")
    q = spark.createDataFrame([(*r, "y") for r in items], "item_id bigint, text string, rank string")
    assert got(search.search(d, q)) == brute(docs, items)
    assert got(search.search(d, q, k=2)) == brute(docs, items, 2)
    for a, b in ((d.limit(0), q), (d, q.limit(0)), (d.where("doc_id = 5"), q)):
        out = search.search(a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_query_on_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert got(queries.op13_search(spark, SF001)) == brute(docs, items)
