"""Rendered turns and conversations read back, against plain digests, edge rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF001
from tidewater.llm import chat, queries

PARTS = ["### ", "</turn>", "\\", "\n", "###", " ", "</turn", ">", "a", "é", ":", "#", "\n</turn>\n", "### user:\n", "\x00"]
hard = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(hard, hard)
def test_a_turn_comes_back(role, text):
    s, start, stop, parses = chat.render_turn(role, text)
    got, back, a, b, end = chat.parse_turn(s)
    assert (got, back, a, b, end) == (role, text, start, stop, len(s)) and parses <= 4
    assert chat.unescape(s[start:stop]) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(hard, hard), max_size=6))
def test_turns_in_a_row_come_back(turns):
    s = "".join(chat.render_turn(*t)[0] for t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(s)] == turns


def test_only_texts_in_conflict_are_escaped():
    assert chat.render_turn("user", r"a \ b \\ # <") == ("### user:\na \\ b \\\\ # <\n</turn>\n", 10, 22, 1)
    assert chat.render_turn("user", "x </turn> # y")[0] == "### user:\nx \\</turn> # y\n</turn>\n"
    s, _, _, parses = chat.render_turn("a:b", r"\### Assistant: </turn> ok")
    assert s == "### a\\:b:\n\\\\### Assistant: \\</turn> ok\n</turn>\n" and parses == 4


def test_broken_texts_are_refused():
    for s in ("user:\nx\n</turn>\n", "### user:\nx", "### user\nx\n</turn>\n", "### user:\nx</turn>\n", "### user:\n### x\n</turn>\n",
              "### user:\nx\n</turn> \n", "### user:\n</turn>\n"):
        with pytest.raises(chat.Unreadable):
            list(chat.parse(s))
    assert list(chat.parse("")) == [] and list(chat.parse("### u:\n\n</turn>\n")) == [("u", "", 7, 7)]


def plain(rows):
    """Digests of (conv_id, turn, role, text) rows, all in one list."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    result = []
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len(chat.render_turn(r, t)[0]) for r, t in turns)
        result.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                       len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(result, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_hot_conversation_and_small_pieces(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(rnd.choice([1, None, rnd.randint(2, 60)]), i, rnd.choice(["user", "assistant", "system"]),
             "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as they are
    try:
        for size in (1 << 20, 200):
            monkeypatch.setattr(chat, "PIECE_CHARS", size)
            assert got(chat.read_back(df)) == plain(rows)
            pieces = chat.format_conversations(df).collect()
            assert max(len(p.formatted) for p in pieces) < max(size, 40000)
            for conv in (1, None, rows[5][0]):
                own = sorted((p for p in pieces if p.conv_id == conv), key=lambda p: (p.part, p.piece))
                assert conv not in (1, None) or len({p.part for p in own}) > 1  # a hot one spreads over tasks
                want = [(r[2], r[3]) for r in rows if r[0] == conv]
                assert [(r, t) for p in own for r, t, _, _ in chat.parse(p.formatted)] == want
                loss = [chat.unescape(p.formatted[s.start:s.end]) for p in own for s in p.loss]
                assert loss == [t for r, t in want if r == "assistant"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_repeats_long_texts_and_empty(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (3, None, "user", None), (3, None, "user", None), (3, 2, "assistant", ""),
            (4, 1, "assistant", "</turn> ### \\" * 20000), (5, 9, "assistant", "same"), (5, 9, "assistant", "same"), (6, 0, "a:\nb\\", "t")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", part int, formatted string")
    assert got(chat.read_back(df)) == plain(rows)
    assert chat.read_back(df.limit(0)).collect() == []
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_query_on_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard_text = r"\### Assistant: </turn> ok"
    assert got(queries.op12_chat(spark, SF001)) == plain(rows + [(-7, 0, "user", hard_text), (-7, 1, "assistant", hard_text)])
