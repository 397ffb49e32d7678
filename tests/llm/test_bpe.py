"""BPE against the tokenizers library: ids, round trips, edge rows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF001
from tidewater.llm import bpe, queries

PATH = bpe.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


CASES = ["", " ", "a", "The the  the\n\n the\t", "it's WE'LL 12 ١٢ ½²Ⅷ", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>",
         "a" * 5000, " " * 3000, "\n" * 700 + "x", "aaaa" * 9 + "b", "中文字　x", "é ​﻿",
         "՘ a֋1 \U00012550x \U00018e00", "hellohello" * 100, "=" * 65, "-" * 600]


def test_equals_the_library_on_cases(library):
    b = bpe.load(PATH)
    got = b.encode_batch(CASES)
    assert [x.tolist() for x in got] == library_ids(library, CASES)
    for x in got:
        assert b.decode(x.tolist()) == library.decode(x.tolist(), skip_special_tokens=False)


def test_equals_the_library_on_random_texts(library):
    rnd = random.Random(3)
    pool = "aaabbbcc the'LL's're 12²½ \n\t　<|endoftext|>éÉ😀ſ_-=+"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0xd7ff), rnd.randrange(0xe000, 0x2ffff)]))
                      for _ in range(30)) for _ in range(500)]
    got = bpe.load(PATH).encode_batch(texts)
    assert [x.tolist() for x in got] == library_ids(library, texts)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x24F), max_size=60))
def test_round_trip(text):
    b = bpe.load(PATH)
    assert b.decode(b.encode_batch([text])[0].tolist()) == text


def test_speculation_is_checked(library):
    """Greedy proposals are wrong for some words; those and only those are merged exactly."""
    b = bpe.load(PATH)
    words = sorted({w.encode() for t in CASES for w in b.word.findall(t)} | {b" thndor", b"erheer", b"reading"})
    t, count, merged = b.encode_words(words)
    assert 0 < merged < len(words)
    at = np.cumsum(count) - count
    for w, a, n in zip(words, at, count):
        assert t[a:a + n].tolist() == b.merge_word(w).tolist()


def test_short_and_heap_merging_agree():
    b = bpe.load(PATH)
    rnd = random.Random(5)
    words = [bytes(rnd.choice(b"abetthion ") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    short = [b.merge_word(w).tolist() for w in words]
    old, bpe.SHORT_WORD = bpe.SHORT_WORD, 0
    try:
        assert short == [b.merge_word(w).tolist() for w in words]
    finally:
        bpe.SHORT_WORD = old


def test_rows_nulls_repeats_and_clashing_columns(spark, library):
    long = "word " * 200_000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", "y"), (2, None, None), (3, "", "z"), (4, long, "w")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = bpe.encode_digests(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[2].n_tokens == by[3].n_tokens == 0 and by[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[4].n_tokens == len(library_ids(library, [long])[0])
    assert by[4].decoded_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert bpe.encode(df).where("doc_id = 1").select("decoded").distinct().collect()[0][0] == "a b"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode_digests(df).count() == 0


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    want = {}
    for d, ids in zip(docs, library_ids(library, [d.text or "" for d in docs])):
        text = library.decode(ids, skip_special_tokens=False)
        want[d.doc_id] = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                          hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op7_bpe(spark, SF001).collect()}
    assert got == want
