"""Closed syncmers against plain loops, neighbours against a plain list, edge rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF001
from tidewater.llm import queries
from tidewater.llm import syncmers as syn
from tidewater.llm.common import materialise


def word(b: bytes) -> int:
    return int(syn.mix(np.frombuffer(b, dtype="<u8").copy())[0])


def brute(text: str) -> list[tuple[int, bytes]]:
    """(position, k-mer) of every closed syncmer, one k-mer at a time; a non-empty
    text without any is an anchor as a whole."""
    data = text.encode()
    out = []
    for i in range(len(data) - syn.K + 1):
        inner = [word(data[j:j + syn.S]) for j in range(i, i + syn.WINDOW)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, data[i:i + syn.K]))
    return out or ([(0, data)] if data else [])


def brute_likeness(a: str, b: str) -> float:
    x, y = (Counter(k for _, k in brute(t)) for t in (a, b))
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total if total else 1.0


rnd = random.Random(1)
SHORT = ["", "a", "x" * 22, "x" * 23, "x" * 24, "é" * 30, "abc " * 30, "The same line.\n" * 12]
LONG = [" ".join(rnd.choice(["the", "cat", "sat", "é", "mat", "on"]) for _ in range(n)) for n in (5, 30, 120, 300)]


def test_anchors_equal_brute_force():
    texts = SHORT + LONG + SHORT[::-1]
    doc, at, ident = syn.anchors(texts, every=True)
    names = {}
    for i, t in enumerate(texts):
        want = brute(t)
        assert at[doc == i].tolist() == [p for p, _ in want], t
        for x, (_, kmer) in zip(ident[doc == i].tolist(), want):
            assert names.setdefault(kmer, x) == x  # the id follows the k-mer, wherever it stands
    assert len(set(names.values())) == len(names)
    assert syn.anchors([])[0].tolist() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é", min_size=25, max_size=90), st.text(alphabet="ab é", max_size=60), st.text(alphabet="ab é", max_size=60))
def test_context_free(passage, before, after):
    doc, _, ident = syn.anchors([passage, before + passage + after])
    inner, outer = (Counter(ident[doc == i].tolist()) for i in (0, 1))
    assert not inner - outer


def test_matches_are_equal_passages():
    a = " ".join(f"word{i * i % 97}" for i in range(200))
    b = "some new start " + a[:500] + " an insertion here " + a[520:]
    found = syn.matches(a, b)
    assert found and all(a.encode()[x:x + n] == b.encode()[y:y + n] for x, y, n in found)
    assert sum(n for _, _, n in found) > 0.8 * len(a)
    assert syn.matches("", a) == [] and syn.matches(a, a)[0][0] == syn.matches(a, a)[0][1]


def test_edited():
    assert syn.edited("abcdefg", "XYZ") == "abcdeXY" and syn.edited("abcdef", "X") == "abcdX" and syn.edited("ab", "X") == "ab"


def spark_hash(text):
    """Spark's xxhash64 of a string; a null leaves the seed."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def neighbours(docs):
    """{(doc_id, text): result} with everything in one list, as the contract says."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), spark_hash(d[1]), d[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        e = text[:len(text) - n] + nxt[:n]
        out.append((doc_id, len(text), hashlib.sha256(e.encode()).hexdigest(), round(brute_likeness(text, e), 12),
                    round(brute_likeness(text, nxt), 12)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12))
                   for r in df.collect()), key=str)


def test_neighbours_over_partitions(spark, monkeypatch):
    texts = LONG + SHORT
    docs = [(i * 7 % 50, texts[i % len(texts)]) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    assert got(syn.compare_neighbours(df)) == neighbours(docs)
    monkeypatch.setattr(syn, "PIECE_CHARS", 100)
    assert got(syn.compare_neighbours(df)) == neighbours(docs)


def test_nulls_ties_repeats_single_row_and_empty(spark):
    docs = [(3, "a b c d e f"), (3, "a b c d e f"), (3, "other text of the same id here"), (None, None), (None, "z" * 40),
            (1, None), (2, ""), (9, "long " * 5000)]
    schema = "doc_id bigint, text string, fingerprint string, kind string"
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], schema)
    assert got(syn.compare_neighbours(df)) == neighbours(docs)
    one = df.where("doc_id = 9")
    assert got(syn.compare_neighbours(one)) == neighbours(docs[-1:])
    assert syn.compare_neighbours(df.limit(0)).collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    texts = SHORT + LONG
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[::-1])], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in syn.fingerprint_documents(df).collect()}
    n = len(texts)
    assert all(rows[i].fingerprint == rows[2 * n - 1 - i].fingerprint for i in range(n))
    assert len({rows[i].fingerprint for i in range(n)}) == n
    assert [(a["at"]) for a in rows[4].anchors] == [p for p, _ in brute(texts[4])]


def test_query_on_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").where("n_chars < 1500").collect()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(syn.compare_neighbours(df)) == neighbours(docs)
    rows = queries.op9_syncmers(spark, SF001).collect()
    assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    by_text = {}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_texts_without_a_closed_syncmer_differ(spark):
    bare = ["Laèoueau la ément est éailele.", "Von.*** Keitkeitkeit.&&&", "Ththth of to thenre onin.", "Geungü teüpf der geachber."]
    assert all(syn.K <= len(t.encode()) <= 36 and brute(t) == [(0, t.encode())] for t in bare)
    docs = [(9, bare[0]), (8, bare[1]), (7, bare[2]), (6, bare[2]), (5, bare[3]), (4, ""), (3, None), (2, LONG[1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = {r.doc_id: r for r in syn.compare_neighbours(df).collect()}
    assert [rows[i].near_next for i in range(9, 1, -1)] == [0, 0, 1, 0, 0, 1, 0, 0]
    assert [rows[i].near_edited for i in (9, 8, 5, 4)] == [0, 0, 0, 1]
    assert rows[9].edited_fingerprint != rows[9].fingerprint and rows[5].edited_fingerprint != rows[9].edited_fingerprint
    got = {r.doc_id: r for r in syn.fingerprint_documents(df).collect()}
    assert all(got[i].fingerprint == rows[i].fingerprint for i in got)
    assert len({got[i].fingerprint for i in got}) == len(docs) - 2  # equal: 7 and 6, 4 and 3
    assert [[a["at"] for a in got[i].anchors] for i in (9, 5, 4)] == [[0], [0], []]
    assert syn.anchors(bare)[0].tolist() == [] and syn.anchors(bare, every=True)[0].tolist() == [0, 1, 2, 3]


def test_equal_bare_texts_match_as_a_whole():
    for t in ("Laèoueau la ément est éailele.", "short", "x" * 23):
        assert syn.matches(t, t) == [(0, 0, len(t.encode()))]
    assert syn.matches("short", "other") == [] and syn.matches("", "") == []


def test_shared_and_missing_ids_spread_over_ranges(spark, monkeypatch):
    """A third of the rows without id, a third with one id (half of them one text)."""
    sizes = []
    monkeypatch.setattr(syn, "materialise", lambda df, name: sizes.append(df) or materialise(df, name))
    docs = ([(None, f"no id {i} " * 4) for i in range(800)] + [(7, "the one text" if i % 2 else f"text {i}") for i in range(800)]
            + [(i + 100, f"own {i} " * 3) for i in range(800)])
    random.Random(3).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as they are
    try:
        assert got(syn.compare_neighbours(df)) == neighbours(docs)
        per_task = sizes[0].where("kind = 'row'").groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in per_task) <= 2 * len(docs) / 8
