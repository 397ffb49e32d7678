"""The corpus pipeline against a stage-by-stage brute force, and its edge rows."""

import re
from collections import Counter

import corpus_pipeline as pipeline
from tests.conftest import SF001
from tests.llm.test_secrets import brute_base
from tests.llm.test_simhash import brute_groups, brute_print
from tidewater.llm import bpe, langid, mixing, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, sf_dir=None):
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(pipeline.materialise(stage(spark, out[-1], sf_dir), "test"))
    return out


def check_stages(out):
    docs, known, single, clean, mixed, tokens = [d.collect() for d in out]
    for d in out[:-1]:
        assert d.columns == out[0].columns
    # language id: what goes has no letters
    kept = Counter(map(str, known))
    gone = list((Counter(map(str, docs)) - kept).elements())
    assert not kept - Counter(map(str, docs))
    assert len(gone) == sum(1 for d in docs if not any(c.isalpha() for c in d.text or ""))
    # near-dedup: the least id of each component, once
    prints = [(d.doc_id, brute_print(d.text)) for d in known if d.doc_id is not None]
    groups = brute_groups(prints)
    assert sorted(d.doc_id for d in single if d.doc_id is not None) == sorted(set(groups.values()))
    assert not Counter(map(str, single)) - kept
    # secrets: no base span is left, clean documents are untouched
    before = {d.doc_id: d for d in single}
    assert len(clean) == len(single)
    for d in clean:
        old = before[d.doc_id]
        assert not brute_base(d.text or "")
        if d.text != old.text:
            assert "[SECRET]" in d.text and d.n_chars == len(d.text)
        elif not brute_base(old.text or ""):
            assert d == old
    # mixing: as often as the operator says, near each source's target
    want = Counter()
    target, taken, most = {}, Counter(), Counter()
    for r in mixing.mix(out[3]).collect():
        want[r.doc_id] += r.copies
        target[r.source], most[r.source] = r.target, max(most[r.source], r.size)
    assert Counter(d.doc_id for d in mixed) == +want
    texts = {d.doc_id: d for d in clean}
    for d in mixed:
        assert d == texts[d.doc_id]
        taken[d.source] += len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)
    # tokens: every copy, ids that decode to the text
    assert Counter(t.doc_id for t in tokens) == Counter(d.doc_id for d in mixed)
    b = bpe.load(bpe.vocabulary_path())
    for t in tokens:
        assert t.round_trip and t.n_tokens == len(t.ids) and b.decode(t.ids) == (texts[t.doc_id].text or "")


def test_on_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert docs.columns == COLUMNS
    out = stages(spark, docs, SF001)
    check_stages(out)
    run = pipeline.run(spark, SF001)
    assert run.columns == out[-1].columns and sorted(map(str, run.collect())) == sorted(map(str, out[-1].collect()))


def test_edge_rows(spark):
    base = "the cat sat on the mat and the dog slept in the sun all day long"
    rows = [(i, f"{base} {i} " + "word " * i, "en", "s" if i % 2 else None, 1) for i in range(12)]
    rows += [(i, f"der hund {i} und die katze und das haus am see " + "ende " * i, "de", "t", 1) for i in range(20, 30)]
    rows += [(40, None, None, None, None), (41, "", "en", "s", 0), (42, "12 ***", None, "s", 6),
             (43, "the mat and token = abcdefghijklmnop in the sun", "en", "s", 47), (44, "the dog and the cat " * 9000, "en", None, 1),
             (45, f"{base} 3 " + "word " * 3, None, "zz", 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string")
    out = stages(spark, docs)
    check_stages(out)
    assert 40 not in {d.doc_id for d in out[1].collect()}


def test_null_ids_and_repeats(spark):
    base = "the cat sat on the mat and the dog slept in the sun"
    rows = [(None, base, "en", "s", 1), (None, base + " too", "en", "s", 1), (7, base + " again", "en", "s", 1),
            (7, base + " again", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    single = simhash.one_per_group(docs)
    assert Counter(d.doc_id for d in single.collect()) == {None: 2, 7: 1}
    assert len(stages(spark, docs)[-1].columns) == 6


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert [d.count() for d in stages(spark, docs)] == [0] * 6


def test_stage_names():
    assert [n for n, _ in pipeline.STAGES] == ["language id", "simhash near-dedup", "secret scans", "mixing sources", "bpe encoding"]
    assert pipeline.ORACLE_SQL is None


def test_short_clean_documents_stay(spark):
    rows = [(i, "the cat sat on the mat all rights reserved a " * 40, "en", "s", 1) for i in range(70)]
    rows += [(i, "der hund und die katze all rights reserved a " * 40, "de", "s", 1) for i in range(100, 170)]
    short = ["A.\nAll rights reserved.", "A", "Reserved", "all rights", "all rights reserved a " * 20]
    rows += [(200 + i, t, None, "s", 1) for i, t in enumerate(short)]
    foreign = "".join(chr(0x4E00 + i) for i in range(300))
    rows += [(300, foreign[:9], None, "s", 1), (301, foreign, None, "s", 1), (302, "12 ***", "en", "s", 1), (303, None, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    by = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert all(by[200 + i].score < 0.01 and by[200 + i].lang_pred != langid.UNKNOWN for i in range(len(short)))
    kept = {r.doc_id for r in pipeline.language_id(spark, docs, None).collect()}
    assert {r[0] for r in rows} - kept == {302, 303}


def test_columns_that_are_called_like_helpers(spark):
    """Extra columns come through every stage but the last as they were, whatever their names."""
    names = ["row", "digest", "group", "best_id", "best_digest", "size", "total", "rows", "n", "copy", "at", "mix_doc_id", "mix_size",
             "nth", "component_id", "fp", "root", "_text", "_nth", "_n", "_copy", "_size", "_key_doc_id", "_keep"]
    base = "the cat sat on the mat and the dog slept in the sun all day long number"
    rows = [(i, f"{base} {'w%d ' % i * 9}", "en", "st"[i % 2], 5, *(f"{n}-{i}" for n in names)) for i in range(12)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names)
    out = stages(spark, spark.createDataFrame(rows, schema))
    for stage in out[:-1]:
        assert stage.columns[5:] == names
        for r in stage.collect():
            assert list(r)[5:] == [f"{n}-{r.doc_id}" for n in names]
    assert {r.doc_id for r in out[3].collect()} == set(range(12)) and out[4].count() > 0


def test_rows_without_id_are_deduplicated(spark):
    base = "the cat sat on the mat and the dog slept in the sun " * 8
    rows = [(None, base, "en", "s", 1)] * 3 + [(4, base, "en", "s", 2), (9, base, "de", "t", 3), (None, "quite another text here " * 9, "en", "s", 4)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(((r.doc_id, r.n_chars) for r in simhash.one_per_group(docs).collect()), key=str) == [(4, 2), (None, 4)]
