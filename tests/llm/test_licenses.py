"""License scans: base phrases against brute force, the method's labels, native plan."""

import random
import re

from tests.conftest import SF001
from tidewater.llm import licenses, queries


def brute(text):
    """(n_words, sorted places, labels) of the base phrases by trying every word."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for label, phrase in licenses.BASE:
        k = phrase.split()
        places += [(i, label) for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k]
    return len(w), sorted(places)


def rows_of(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                               "doc_id bigint, text string, words string, found string")
    return {r.doc_id: r for r in licenses.summary(licenses.scan(df)).collect()}


def agrees(r, text):
    n, places = brute(text)
    at = [i for i, _ in places]
    assert r.n_words == n and r.n_base == len(places), text
    assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
    assert r.base_labels == ",".join(sorted({x for _, x in places}))
    assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert 0 <= r.score <= 1 and (not places or r.score > 0)


def test_base_phrases_on_random_texts(spark):
    rnd = random.Random(4)
    pool = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", "CC-BY-NC", "é", "x", ".", "\n",
            "under the mit license", "Apache License, Version 2.0", "licenſe", "2.0", "nc by cc", " ", "K"]
    texts = [rnd.choice(["", " ", "-"]) + " ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) for _ in range(250)]
    texts += [None, "", "...", "under the mit license" * 2, "cc by nc by nc cc by nc", "UNDER_THE.MIT(LICENSE)",
              "cc by nc ", "x" * 100_000, "under the mit license " * 3000]
    got = rows_of(spark, texts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        agrees(got[i], t)


def test_method_labels(spark):
    full = [t for _, t, _ in licenses.TEMPLATES]
    labels = [a for a, _, _ in licenses.TEMPLATES]
    edited = full[0].replace("associated", "related")  # a passage with a changed word
    texts = full + [edited, "Prefix words. " + full[2] + " and more.", "the license of this is under the sun",
                    "permission is hereby not granted free of charge", "free software you can have",
                    "This work is licensed under the GNU General Public License, version 3."]
    got = rows_of(spark, texts)
    for i, a in enumerate(labels):
        assert a in got[i].labels.split(","), (a, got[i])
    n = len(full)
    assert got[n].labels == "mit" and got[n + 1].labels == "bsd"
    assert got[n + 2].labels == got[n + 3].labels == got[n + 4].labels == "" and got[n + 2].score == 0
    assert got[n + 5].labels == "gpl"


def test_index_takes_the_rarest_words():
    e = licenses.index(100, {"license": 50, "the": 99, "under": 60, "mit": 2})[0]
    assert e["anchors"] == {"mit", "license"}


def test_rows_with_null_and_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "under the mit license"), (1, "under the mit license"), (None, "x")], "doc_id bigint, text string")
    rows = licenses.summary(licenses.scan(df)).collect()
    assert sorted(r.n_base for r in rows) == [0, 1, 1]
    assert licenses.summary(licenses.scan(df.limit(0))).collect() == []


def test_query_equals_brute_force_and_is_native(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    df = queries.op8_licenses(spark, SF001)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(docs)
    for d in docs:
        agrees(got[d.doc_id], d.text)


def test_a_place_without_the_rarest_words_is_proposed(spark):
    rare = ["obtaining", "documentation", "associated", "files", "person", "copy"]
    full = licenses.TEMPLATES[0][1]
    filler = " ".join(sorted(set(licenses.words_of(full)) - set(rare)))
    edited = full.replace("obtaining", "getting").replace("documentation", "docs")
    more = edited.replace("associated", "related")  # half of the rare words: too few
    got = rows_of(spark, [filler] * 60 + [f"Some words. {edited} and more", more])
    assert got[60].labels == "mit" and licenses.LEAST <= got[60].score < 0.7
    assert got[61].labels == "" and got[0].labels == ""


def test_looked_up_words_outweigh_what_may_lack():
    for df in ({}, {"license": 50, "the": 99, "permission": 1, "software": 7}):
        for least in (0.3, licenses.LEAST, 0.9):
            for e in licenses.index(100, df, least=least):
                total = sum(x for _, _, x in e["rare"])
                assert e["base"] or sum(x for _, w, x in e["rare"] if w not in e["anchors"]) < least * total
