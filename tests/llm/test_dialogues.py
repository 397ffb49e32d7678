"""Repair against a shortest-path search over single rows, edge rows."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from itertools import groupby

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF001
from tidewater.llm import dialogues as dia
from tidewater.llm import queries

DUE = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def cheapest(rows):
    """(audit, cost, repaired rows) of (role, text, fault) rows: Dijkstra over cost and letters."""
    best, heap = set(), [(0, "", 0, 0, ())]
    while True:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return audit, cost, list(out)
        if (i, q) in best:
            continue
        best.add((i, q))
        due = "assistant" if q == 2 else "user"
        heapq.heappush(heap, (cost + 5, audit + "I", i, DUE[q], (*out, (due, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, out))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, DUE[q], (*out, (due, text))))
                kept = KEEP.get(role[:1], {}).get(q)
                if kept is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, kept, (*out, (role, text))))


def key(role, text):
    """The order of rows of one turn: Spark's xxhash64 of role and text."""
    role, text = " " if role is None else role, " " if text is None else text
    h = xxhash.xxh64_intdigest(text.encode(), seed=xxhash.xxh64_intdigest(role.encode(), seed=42))
    return h - (1 << 64) if h >= 1 << 63 else h


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows, everyone):
    """The summary of rows with everything in lists."""
    out = []
    for conv in {c for c in everyone} | {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, key(r[2], r[3])))
        seen, faults, turns = set(), [], [t for _, t, _, _ in own if t is not None]
        for _, _, role, text in own:
            role, text = " " if role is None else role, " " if text is None else text
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
            faults.append((role, text, fault))
        audit, cost, kept = cheapest(faults)
        initials = [r[:1] for r, _, _ in faults]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(sum(f == name for _, _, f in faults) for name in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def rows_of(symbols):
    names = {0: ("user", "", "blank")}
    for i, role in enumerate(("system", "user", "assistant", "tool")):
        names[1 + 2 * i], names[2 + 2 * i] = (role, "x.", None), (role, "x", "truncated")
    return [names[s] for s in symbols]


def runs_of(symbols):
    return [(s, len(list(g))) for s, g in groupby(symbols)]


def test_every_short_sequence():
    for n in range(4):
        for symbols in itertools.product(range(9), repeat=n):
            assert dia.unroll(runs_of(symbols))[:2] == cheapest(rows_of(symbols))[:2], symbols


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 3, 3, 4, 5, 5, 6, 7, 8]), st.integers(1, 5)), max_size=6))
def test_runs_against_single_rows(runs):
    symbols = [s for s, n in runs for _ in range(n)]
    assert dia.unroll(runs_of(symbols))[:2] == cheapest(rows_of(symbols))[:2]
    assert (dia.matrix(runs_of(symbols))[0] + dia.END).min() == cheapest(rows_of(symbols))[1]


def test_powers_are_repeated_steps():
    for sym in range(9):
        out = dia.END
        for n in range(1, 40):
            out = dia.advance(sym, 1, out)
            assert (dia.advance(sym, n, dia.END) == out).all() and (dia.within(sym, n, dia.END)[:, n] == out).all()
    assert (dia.power(3, 20) <= dia.FAR).all() and np.array_equal(dia.power(0, 3).diagonal(), [16] * 4)
    audit, cost, _ = dia.unroll([(3, 100_000), (0, 100_000)])
    assert len(audit) == 200_000 and cost == 50_000 + 200_000


SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TEXTS = ["yes.", "no!", "cut", "", " \n", "really? ", "ok.\t\n", "é", "a.b", "tail .x"]


def test_hot_conversation_over_many_ranges(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, None, rnd.randint(2, 80)]), rnd.choice([i, i, i, i // 2, None]),
             rnd.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
             rnd.choice([*TEXTS, f"own text {i}.", f"own text {i}.", f"own text {i}.", f"cut {i}"])) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as they are
    try:
        found = dia.edits(df)
        for conv in (1, None):  # a hot conversation spreads over tasks
            assert found.where(found.conv_id.eqNullSafe(conv) & (found["at"] == -1)).count() > 1
        assert got(dia.summary(df)) == brute(rows, [])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x."), (3, None, "user", "hi."), (3, None, "user", "hi."), (3, 2, "assistant", "a."),
            (4, 5, "", "no role."), (4, 9, "User", "upper."), (5, 1, "assistant", "word " * 50000 + "."), (6, None, None, "."),
            (7, 3, "user", "q?"), (7, 3, "assistant", "a."), (7, 3, "system", "s."), (8, 1, "user", "q?"), (8, 1 << 40, "assistant", "a.")]
    rows += [(9, 4, "user", "one and the same.")] * 300
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", part int, audit string")
    everyone = spark.createDataFrame([(3,), (11,), (None,), (11,)], "conv_id bigint")
    assert got(dia.summary(df, everyone)) == brute(rows, [3, 11, None])
    empty = hashlib.sha256(b"").hexdigest()
    assert got(dia.summary(df.limit(0), everyone)) == sorted([(c, 0, 0, 0, 0, 0, 0, "", empty) for c in (3, 11, None)], key=str)
    assert dia.summary(df.limit(0)).collect() == []


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(60), None) for r, x in (("assistant", "a. b! c?"), (None, None))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, dia.damage(df).collect()), key=str) == sorted(damaged(rows), key=str)


def test_query_on_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_repair(spark, SF001)) == brute(damaged(rows), [r[0] for r in rows])
