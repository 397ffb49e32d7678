"""Cross-parsing: phrase counts against a plain search, accuracy, edge rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import SF01, SF001
from tidewater.llm import langid, queries


def brute_phrases(text: bytes, ref: bytes, segment: int) -> int:
    """Greedy longest phrases found in the reference, segment by segment."""
    n = 0
    for a in range(0, len(text), segment):
        s, i = text[a:a + segment], 0
        while i < len(s):
            j = i + 1
            while j <= len(s) and s[i:j] in ref:
                j += 1
            i = max(j - 1, i + 1)
            n += 1
    return n


def test_lockstep_parse_equals_plain_search():
    rnd = random.Random(1)
    for width in (3, 6):
        refs = [bytes(rnd.randrange(width - 1) for _ in range(n)) for n in (1, 5, 60, 400)]
        texts = [bytes(rnd.randrange(width) for _ in range(n)) for n in (0, 1, 7, 30, 31, 200, 64, 65)]
        ends = np.cumsum([len(t) for t in texts])
        codes = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int32)
        classes = np.tile(np.arange(width, dtype=np.int32), (len(refs), 1))
        tables = [langid.parse_table(r, width) for r in refs]
        for segment in (16, 64, 1000):
            got = langid.count_phrases(codes, ends, classes, tables, segment)
            assert got.tolist() == [[brute_phrases(t, r, segment) for r in refs] for t in texts]


def test_suffix_automaton_accepts_exactly_the_substrings():
    ref = b"abcbcabbbcab"
    nxt, _ = langid.suffix_automaton(ref)
    subs = {ref[i:j] for i in range(len(ref)) for j in range(i, len(ref) + 1)}
    rnd = random.Random(2)
    for _ in range(500):
        w = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 6)))
        state = 0
        for c in w:
            state = nxt[state].get(c) if state is not None else None
        assert (state is not None) == (w in subs)


def test_normalise():
    numbers, classes = langid.letter_numbers(("abé", "zb"))
    codes, ends = langid.normalise(["", "A, b!!É", "12 \n", "xa中", "a"], numbers)
    first, second = ([classes[j][codes][a:b].tolist() for a, b in zip([0, *ends], ends)] for j in (0, 1))
    no = langid.WIDTH - 1
    assert first == [[], [1, 0, 2, 0, 3, 0], [], [no, 1, no, 0], [1, 0]]
    assert second == [[], [no, 0, 2, 0, no, 0], [], [no, no, no, 0], [no, 0]]
    many = "".join(chr(0x4E00 + i) for i in range(200))
    _, classes = langid.letter_numbers((many,))
    assert classes.max() == langid.WIDTH - 1 and len(set(classes[0][1:-1].tolist())) == langid.OWN + langid.SHARED


def test_nine_scripts(spark):
    """Languages that share no letters, some with thousands of them, all told apart."""
    rnd = random.Random(3)
    scripts = {"en": (0x61, 26), "ru": (0x430, 32), "el": (0x3B1, 17), "he": (0x5D0, 27), "ar": (0x628, 20), "hi": (0x915, 36),
               "ko": (0xAC00, 2000), "zh": (0x4E00, 3000), "ja": (0x3041, 80)}
    rows = []
    for lang, (start, n) in scripts.items():
        words = ["".join(chr(start + min(int(rnd.expovariate(6 / n)), n - 1)) for _ in range(rnd.randint(1, 5))) for _ in range(400)]
        rows += [(len(rows) + i, " ".join(rnd.choice(words) for _ in range(60)), lang) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    lang = {r[0]: r[2] for r in rows}
    got = langid.predict(docs, langid.fit(docs)).where(langid.fold() == 1).collect()
    for name in scripts:
        own = [r.lang_pred == name for r in got if lang[r.doc_id] == name]
        assert sum(own) >= 0.97 * len(own) > 0, name


SCHEMA = "doc_id bigint, text string, lang string, score string, rate string"


def test_edge_rows(spark):
    rows = [(i, "the cat and the dog sat on the mat", "en") for i in range(20)]
    rows += [(i, "der hund und die katze auf der matte", "de") for i in range(20, 40)]
    rows += [(None, "the dog", "en"), (100, None, "en"), (101, "", None), (102, " 12 ***", "de"), (103, "und die katze", None),
             (103, "und die katze", None), (104, "the mat " * 50_000, None), (105, "中文", "zz")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "en" for i in range(20)) and all(by[i].lang_pred == "de" for i in range(20, 40))
    for i in (100, 101, 102):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[103].lang_pred == "de" and by[104].lang_pred == by[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()] == ["und"]
    assert langid.predict(docs.limit(0), langid.fit(docs.limit(0))).collect() == []
    one = spark.createDataFrame([(7, "abc", "en")], docs.schema)
    assert zlib.crc32(b"7") % 3 != 1
    assert [(r.lang_pred, r.score) for r in langid.predict(one, langid.fit(one)).collect()] == [("en", 1.0)]


def test_learns_nothing_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    lied = docs.withColumn("lang", F.when(langid.fold() == 1, F.lit("zz")).otherwise(F.col("lang")))
    assert langid.fit(docs) == langid.fit(lied)
    sampled = langid.sample(docs, 7, 100)
    assert max(r["count"] for r in sampled.groupBy("lang").agg(F.count("*").alias("count")).collect()) <= 7


def test_query_accuracy_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op1_langid(spark, SF01).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_a_segment_adds_at_most_one_phrase():
    draw = np.random.default_rng(8)
    refs = [draw.integers(0, 5, 400).astype(np.uint8).tobytes() for _ in range(3)]
    texts = [draw.integers(0, 6, n).astype(np.uint8) for n in (1, 50, 700, 3000)]
    codes, ends = np.concatenate(texts).astype(np.int32), np.cumsum([len(t) for t in texts])
    classes, tables = np.tile(np.arange(6, dtype=np.int32), (3, 1)), [langid.parse_table(r, 6) for r in refs]
    whole = langid.count_phrases(codes, ends, classes, tables, 1 << 20)
    for segment in (16, 128, 1024):
        more = langid.count_phrases(codes, ends, classes, tables, segment) - whole
        cuts = np.array([-(-len(t) // segment) - 1 for t in texts])[:, None]
        assert (more >= 0).all() and (more <= cuts).all()


def test_the_language_stage_parses_every_document(spark, monkeypatch):
    """What the pipeline keeps is judged by the parse of each whole text under every language."""
    rows = [(i, f"the cat and the dog sat on mat {i}", "en") for i in range(9)] + [(i, f"der hund und die katze {i}", "de") for i in range(20, 29)]
    rows += [(40, None, "en"), (41, "12 ***", "de"), (42, "the hund " * 900, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    parsed, count = [], langid.count_phrases

    def counted(codes, ends, classes, tables, *segment):
        parsed.append((ends.tolist(), len(tables)))
        return count(codes, ends, classes, tables, *segment)

    class Here:  # runs the stage's function in this process
        columns, schema = docs.columns, docs.schema

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=self.columns)
            return [r["doc_id"] for b in run(iter([batch])) for r in b.to_pylist()]

    monkeypatch.setattr(langid, "count_phrases", counted)
    kept = langid.accepted(Here(), model)
    numbers, _, _ = langid.prepared(model)
    assert parsed == [(langid.normalise([r[1] or "" for r in rows], numbers)[1].tolist(), 2)]
    assert kept == [r.doc_id for r in langid.predict(docs, model).collect() if r.lang_pred != langid.UNKNOWN]
    assert set(r[0] for r in rows) - set(kept) == {40, 41}


def test_a_language_called_und_is_one(spark):
    docs = spark.createDataFrame([(i, "the cat and the dog sat", "und") for i in range(9)] + [(40, "12", "und")], "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in langid.accepted(docs, langid.fit(docs)).collect()) == list(range(9))
