"""Toxicity: forward pass and gradients against plain loops, accuracy, edge rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewater.llm import queries, toxicity as tox


def plain_logit(net, text):
    """The network word by word and filter by filter."""
    words = tox.LETTERS.findall(text.lower())
    x = [sum(net.embed[b].astype(float) for b in tox.features(w)) for w in words] or [np.zeros(tox.DIM)]
    x += [np.zeros(tox.DIM)] * (max(tox.WIDTHS) - 1)
    best = []
    for k, width in enumerate(tox.WIDTHS):
        z = [net.bias[k] + sum(x[i + j] @ net.conv[k][j].astype(float) for j in range(width) if i + j < len(x))
             for i in range(len(x))]
        best.append(np.max(z, axis=0))
    return float(np.maximum(np.concatenate(best), 0) @ net.out + net.out_bias)


TEXTS = ["", "a", "One two two, three!", "é 12 é", "x y " * 40, "word*** word###", "\n", "A b c d e f g h i j k"]


def test_forward_equals_plain_loops(monkeypatch):
    net = tox.fresh(3)
    want = [plain_logit(net, t) for t in TEXTS]
    assert np.allclose(tox.logits(net, TEXTS)[0], want, atol=1e-4)
    monkeypatch.setattr(tox, "BLOCK_WORDS", 5)  # blocks that cut through texts
    assert np.allclose(tox.logits(net, TEXTS)[0], want, atol=1e-4)


ODD = ["", "É É 12é_x", "ΑΣ Σ ΟΔΟΣ.", "漢字" * 40 + " 漢字 ½ Ⅷ ² ٣ x", "\ud800abc \U0001F600 \U0001D4B3y a\0b", "İstanbul ǅ x\u0301y", "\0",
       *("é" * (n // 2) + "a" * n for n in (3, 4, 5, 6, 7, 31, 32, 33, 47, 48, 49, 500)), "a" * 48 + "b " + "a" * 48 + "c"]


def test_words_of_many_texts_are_hashed_together(monkeypatch):
    """Each word's buckets are those of ``features``, found without a call a word."""
    texts = ODD + [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)), *TEXTS]
    want = [[tox.features(w) for w in tox.LETTERS.findall(t.lower())] for t in texts]

    def one_by_one(word):
        raise AssertionError("hashed word by word")

    monkeypatch.setattr(tox, "features", one_by_one)
    rows, words, starts = tox.tokenise(texts)
    alone = [tox.tokenise([t]) for t in texts]
    for i, found in enumerate(want):
        assert [tuple(rows[c]) for c in words[starts[i]:starts[i] + len(found)]] == found
        end = starts[i + 1] if i + 1 < len(texts) else len(words)
        assert (words[starts[i] + len(found):end] == len(rows)).all() and end - starts[i] == max(len(found), 1) + 2
    assert len(rows) == len({w for t in texts for w in tox.LETTERS.findall(t.lower())})
    each = tox.tokenise_each(texts)
    assert len(each) == len(texts) and all(np.array_equal(a, b) for x, y in zip(each, alone) for a, b in zip(x, y))
    assert tox.tokenise([])[0].shape == (0, 3) and tox.tokenise_each([]) == []


def test_many_distinct_words_need_no_table_of_all(monkeypatch):
    net = tox.fresh(3)
    want = tox.logits(net, TEXTS)[0]
    monkeypatch.setattr(tox, "TABLE_WORDS", 0)
    assert np.allclose(tox.logits(net, TEXTS)[0], want, atol=1e-5)


def test_gradients_equal_small_differences():
    texts, y, weight = ["una slur of una", "of the cat sat on una una"], np.array([1, 0]), np.array([2.0, 0.7])
    net, sums = tox.fresh(5), tox.fresh_sums(tox.fresh(5))
    net.bias = [b + np.float32(0.3) for b in net.bias]

    def loss():
        z = np.array([plain_logit(net, t) for t in texts])
        return float((weight * (np.log1p(np.exp(z)) - y * z)).mean())

    slopes, places = [], [(net.conv[0][0], (3, 5)), (net.conv[1][1], (2, 7)), (net.conv[2][2], (9, 1)), (net.bias[1], 4), (net.out, 20),
                          (net.conv[2][0], (0, 0)), (net.bias[2], 15)]
    for part, at in places:
        kept, ends = part[at], []
        for by in (1e-3, -1e-3):
            part[at] = kept + np.float32(by)
            ends.append((loss(), float(part[at])))
        part[at] = kept
        slopes.append((ends[0][0] - ends[1][0]) / (ends[0][1] - ends[1][1]))
    tox.step(net, sums, tox.tokenise_each(texts), y, weight, tox.RATE)
    found = [sums["conv"][0][0, 3, 5], sums["conv"][1][1, 2, 7], sums["conv"][2][2, 9, 1], sums["bias"][1][4], sums["out"][20],
             sums["conv"][2][0, 0, 0], sums["bias"][2][15]]
    assert np.allclose(np.sqrt(np.maximum(np.array(found) - 1e-8, 0)), np.abs(slopes), rtol=0.02, atol=2e-4)
    assert max(np.abs(slopes)) > 0.01


def test_training_separates_words_and_unseen_forms():
    rnd = random.Random(1)
    clean = ["the", "cat", "sat", "mat", "dog", "over", "house"]
    rows, y = [], []
    for i in range(400):
        words = [rnd.choice(clean) for _ in range(rnd.randint(3, 60))]
        if i % 4 == 0:
            words.insert(rnd.randrange(len(words)), rnd.choice(["scumbag", "rotten"]) + rnd.choice(["", "s", "ly", "ness"]))
        rows.append(" ".join(words))
        y.append(int(i % 4 == 0))
    net = tox.train(rows[:300], np.array(y[:300]), epochs=10)
    z, _ = tox.logits(net, rows[300:])
    assert ((z > 0).astype(int) == y[300:]).mean() > 0.97
    z, _ = tox.logits(net, ["the cat scumbagging over", "the cat over the house"])
    assert z[0] > 0 > z[1]


def test_one_label_only_and_no_rows():
    assert (tox.scores(tox.train([], np.zeros(0, dtype=int)), ["a", ""]) < 0.5).all()
    assert (tox.scores(tox.train(["a"], np.array([0])), ["a"]) < 0.5).all()
    assert (tox.scores(tox.train(["a"], np.array([1])), ["a"]) > 0.5).all()


def test_best_cut():
    assert tox.best_cut(np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])) == 1.5
    z, y = np.array([0.5, 0.1, 0.9, 0.2]), np.array([1, 0, 0, 1])
    c = tox.best_cut(z, y)
    p = z >= c
    assert 2 * (p & (y == 1)).sum() / (p.sum() + y.sum()) == pytest.approx(0.8)


def test_thresholds_by_language():
    rnd = random.Random(2)
    words = {"aa": ["un", "deux", "trois", "quatre"], "bb": ["one", "two", "three", "four"]}
    texts, y, langs = [], [], []
    for i in range(400):
        lang = "aa" if i % 2 else "bb"
        t = [rnd.choice(words[lang]) for _ in range(12)]
        if i % 3 == 0:
            t[3] = "vile"
        texts.append(" ".join(t))
        y.append(int(i % 3 == 0))
        langs.append(lang)
    y = np.array(y)
    fit_on = np.arange(400) % 5 > 1
    net = tox.train([t for t, f in zip(texts, fit_on) if f], y[fit_on], epochs=6)
    tox.calibrate(net, texts, y, langs, fit_on)
    assert set(net.cuts) == {"aa", "bb"}
    assert (tox.logits(net, ["un deux", "one two", ""])[1] == [0, 1, -1]).all()
    assert ((tox.scores(net, texts) >= 0.5) == (y == 1)).mean() > 0.98
    net.cuts = {"aa": 100.0, "bb": -100.0}
    assert (tox.scores(net, ["un vile", "one two"]) >= 0.5).tolist() == [False, True]


def test_learns_nothing_from_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    lied = labels.withColumn("toxic", F.when(tox.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (tox.sample(docs, x, 20, 30, 5000).collect() for x in (labels, lied))
    assert a == b and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in a)
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == whole[r.doc_id] for r in a) and sum(len(r.text) for r in a[:-1]) < 5000  # rows are left out, never parts


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the vile cat", "en", "s"), (1, "the vile cat", "en", "s"), (2, None, None, "s"), (3, "", "en", "s"),
         (None, "a cat", "en", "s"), (4, "word " * 100_000, "de", "s"), (5, "12 **", "en", "s")],
        "doc_id bigint, text string, lang string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 0, 0), (4, None, 0), (None, 1, 1), (3, 0, 0)],
                                   "doc_id bigint, toxic int, lang int")
    got = tox.score(docs, tox.fit(docs, labels)).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = tox.fit(docs.limit(0), labels.limit(0))
    assert {r.predicted for r in tox.score(docs, none).collect()} == {0}
    assert tox.score(docs.limit(0), none).collect() == []


def test_query_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op3_toxicity(spark, sf).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(r.predicted and labels[r.doc_id] for r in held)
    assert hits >= 0.88 * sum(labels[r.doc_id] for r in held)  # some toxic rows have no toxic word
    assert hits >= 0.88 * sum(r.predicted for r in held)


def test_toxic_tail_of_long_texts(spark):
    """The passage stands after 24,000 characters: learned and found on whole texts."""
    rnd = random.Random(8)
    plain = [f"word{i}" for i in range(300)]
    bad = ["vileness", "slurring", "hatemost"]
    rows, labels = [], []
    for i in range(240):
        words = [rnd.choice(plain) for _ in range(3600)]
        if i % 2:
            words += [rnd.choice(bad) for _ in range(6)] + [rnd.choice(plain) for _ in range(20)]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 0, i % 2))
    assert min(len(r[1]) for r in rows) > 24_000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = tox.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    held = tox.score(docs, net).where(tox.fold() == 0).collect()
    found = sum(r.predicted for r in held if r.doc_id % 2)
    assert found >= 0.9 * sum(r.doc_id % 2 for r in held) and sum(r.predicted for r in held if r.doc_id % 2 == 0) <= 2


def labelled(spark, n=600):
    """Clean words in two languages; toxic rows hold a common or a rare toxic word."""
    rnd = random.Random(9)
    words = {"aa": [f"un{c}" for c in "abcdefgh"], "bb": [f"of{c}" for c in "abcdefgh"]}
    rows = []
    for i in range(n):
        lang = "ab"[i % 2] * 2
        t = [rnd.choice(words[lang]) for _ in range(12)]
        if i % 3 == 0:
            t[rnd.randrange(12)] = "slur"
        rows.append((i, " ".join(t), lang, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")
    return docs.select("doc_id", "text", "lang"), docs.select("doc_id", "toxic"), rows


def test_learns_from_rows_outside_the_sample(spark):
    docs, labels, rows = labelled(spark)
    first = {r.doc_id for r in tox.sample(docs, labels, 20, 20).collect()}
    later = [r[0] for r in rows if r[3] and r[0] not in first]
    assert len(first) < 60 and len(later) > 100
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(later), F.replace("text", F.lit("slur"), F.lit("zzscum")))
                           .otherwise(F.col("text")))
    for more in ({}, {"share_rows": 100}):
        net = tox.fit(docs, labels, 20, 20, **more)
        held = tox.score(docs, net).where(tox.fold() == 0).collect()
        assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) >= 0.97 * len(held)


def test_counts_and_thresholds_of_all_rows(spark):
    docs, labels, rows = labelled(spark)
    net = tox.fit(docs, labels, 20, 20, share_rows=150)
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    fit_on = np.array([zlib.crc32(b"cut:%d" % r[0]) % 5 != 0 for r in learn])
    want = tox.Net(net.embed, net.conv, net.bias, net.out, net.out_bias)
    tox.calibrate(want, [r[1] for r in learn], np.array([r[3] for r in learn]), [r[2] for r in learn], fit_on)
    assert net.langs == want.langs == ("aa", "bb") and np.array_equal(net.evidence, want.evidence)
    assert net.cut == pytest.approx(want.cut, abs=2 / tox.GRID) and set(net.cuts) == set(want.cuts) == {"aa", "bb"}
    assert all(net.cuts[x] == pytest.approx(want.cuts[x], abs=2 / tox.GRID) for x in net.cuts)


def test_shares_are_trained_on_whole_and_averaged(spark, monkeypatch):
    docs, labels, rows = labelled(spark, 120)
    rows = docs.join(labels, "doc_id")
    h = F.xxhash64(F.col("doc_id").cast("string"))

    def go(shares):
        sums = tox.fresh_sums(tox.fresh(7))
        net = tox.train(["slur una", "una unb"], np.array([1, 0]), epochs=2, sums=sums)
        return net, sums, tox.train_on(rows.repartition(shares, "doc_id"), net, sums, tox.weights(1 / 3)) if shares else None

    got, _, counts = go(1)
    want, sums, _ = go(0)
    order = rows.orderBy(h).collect()
    y = np.array([r.toxic for r in order])
    for a in range(0, 120, 24):
        tox.step(want, sums, [tox.tokenise([r.text]) for r in order[a:a + 24]], y[a:a + 24],
                 tox.weights(1 / 3)[y[a:a + 24]], tox.RATE)
    assert np.allclose(got.embed, want.embed, atol=1e-5) and np.allclose(tox.dense(got), tox.dense(want), atol=1e-5)
    assert sum(c.sum() for c in counts.values()) == 120 * 12
    a, b = go(3)[0], go(3)[0]
    assert np.array_equal(a.embed, b.embed) and np.array_equal(tox.dense(a), tox.dense(b))
    assert not np.array_equal(a.embed, got.embed)
    monkeypatch.setattr(tox, "BLOCK_WORDS", 5)  # blocks that cut through texts
    assert np.array_equal(go(3)[0].embed, a.embed)
