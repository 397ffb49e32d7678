"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed entries for the word and two of its
beginnings (so that unseen forms of a known stem are recognised).  Filters of
several widths slide over the whole text, the strongest response of each filter
is kept, and a linear layer turns them into a logit.  The logit is shifted by a
threshold calibrated for the text's language, which is itself read off the
words, so that a score of 0.5 is the decision boundary in every language.

Training starts from weights fitted on a bounded sample; tasks then train on from
them, each on its share of all labelled rows, and their changes are averaged.
Language evidence and thresholds come from counts over all labelled rows.
"""

from __future__ import annotations

import copy
import math
import re
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import chunks, columns, id_column, type_of

LETTERS = re.compile(r"[^\W\d_]+")
#: Hashed entries (a power of two, at most 1 << 16), embedding size, filter widths (rising),
#: filters of each width and letters of the two stems.
BUCKETS = 1 << 16
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
STEMS = (4, 6)
#: The bound of the sample that gives the weights to start from: rows of each label (texts
#: are taken whole), and characters of all rows, beyond which it takes no further rows.
TOXIC_ROWS = 1_500
CLEAN_ROWS = 3_000
SAMPLE_CHARS = 60_000_000
#: Labelled rows a task trains on (about, at most), and the step in which it counts changes.
SHARE_ROWS = 4_000
STEP = 2.0 ** -24
#: Logits are counted in steps of 1 / GRID, from -REACH to REACH, to set thresholds.
GRID = 256
REACH = 64.0
#: Documents shown in training: small samples are shown more often.
SHOWN = 30_000
MOST_EPOCHS = 40
RATE = 0.05
#: Words scored at once, and distinct words whose filter products are kept at once.
BLOCK_WORDS = 4_000
TABLE_WORDS = 1 << 17
#: Bytes of a word that are hashed together with those of the other words.
LONG = 48
CRC_STEP = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], dtype=np.uint32)


def features(word: str) -> tuple[int, ...]:
    """Buckets of a word (lower case) and of its beginnings; ``keys`` finds those of many."""
    b = word.encode("utf-8", "surrogatepass")
    return (zlib.crc32(b) % BUCKETS, *(zlib.crc32(b"%d:" % n + b[:n]) % BUCKETS for n in STEMS))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is one of ``LETTERS``."""
    out = np.zeros(0x110000, dtype=bool)
    for found in LETTERS.finditer("".join(map(chr, range(len(out))))):
        out[slice(*found.span())] = True
    return out


def crcs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, prefix: bytes = b"") -> np.ndarray:
    """CRC-32 of the prefix and so many bytes of ``data`` for each word, all words byte by
    byte together; sizes never fall."""
    state = np.full(len(begin), zlib.crc32(prefix) ^ 0xFFFFFFFF, dtype=np.uint32)
    for i in range(size[-1] if len(size) else 0):
        first = np.searchsorted(size, i, side="right")
        part = state[first:]
        state[first:] = CRC_STEP[(part ^ data[begin[first:] + i]) & 0xFF] ^ (part >> 8)
    return ~state


def keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A key of every word, that is its CRC-32 and its stems' buckets, which are also all
    that its features need; and how many words each text has."""
    lower = [t.lower() for t in texts]
    joined = "\0".join(lower)  # no letter
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    plain = len(data) == len(joined)
    chars = data if plain else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.zeros(len(chars) + 2, dtype=bool)
    inside[1:-1] = letters()[chars]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    ends = np.cumsum(np.fromiter(map(len, lower), dtype=np.int64, count=len(lower)) + 1)
    sizes = np.diff(np.searchsorted(edges[::2], ends), prepend=0)
    if not plain:  # from characters to bytes
        wide = sum((chars > last).view(np.uint8) for last in (0x7F, 0x7FF, 0xFFFF)) + np.uint8(1)
        edges = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])[edges]
    size = edges[1::2] - edges[::2]
    order = np.argsort(np.minimum(size, LONG + 1).astype(np.uint8), kind="stable")
    begin, size = edges[::2][order], size[order]
    short = np.minimum(size, LONG)
    whole = crcs(data, begin, short)
    for i in range(np.searchsorted(short, LONG), len(size)):
        whole[i] = zlib.crc32(data[begin[i] + LONG:begin[i] + size[i]], int(whole[i]))
    key = whole.astype(np.uint64)
    for n in STEMS:
        key = key << 16 | crcs(data, begin, np.minimum(short, n), b"%d:" % n) % BUCKETS
    out = np.empty_like(key)
    out[order] = key
    return out, sizes


def numbered(key: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tokenise`` from the words' keys."""
    pad = max(WIDTHS) - 1
    coded = pa.array(key).dictionary_encode()
    codes, found = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    rows = np.stack([(found >> 16 * n) % BUCKETS for n in range(len(STEMS), -1, -1)], axis=1).astype(np.int32)
    room = np.maximum(sizes, 1) + pad
    starts = np.cumsum(room) - room
    out = np.full(int(room.sum()), len(found), dtype=np.int32)
    out[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(codes))] = codes
    return rows, out, starts


def tokenise(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the distinct words (rows), the texts as numbers of distinct words
    with padding after each, and where each text starts.  Padding is the last
    distinct word, which has no buckets of its own."""
    return numbered(*keys(texts))


def tokenise_each(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``tokenise`` of each text alone."""
    key, sizes = keys(texts)
    return [numbered(k, n) for k, n in zip(np.split(key, np.cumsum(sizes)[:-1]), sizes[:, None])]


@dataclass
class Net:
    """Weights of the classifier, language evidence and thresholds."""

    embed: np.ndarray
    conv: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    langs: tuple[str, ...] = ()
    evidence: np.ndarray | None = None  # (BUCKETS, languages): log odds of a word
    cuts: dict[str, float] = field(default_factory=dict)
    cut: float = 0.0
    scale: float = 1.0


def fresh(seed: int) -> Net:
    r = np.random.default_rng(seed)
    return Net(r.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
               [r.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
               [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
               r.normal(0, 0.2, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)


def word_vectors(net: Net, rows: np.ndarray) -> np.ndarray:
    """Embeddings of the distinct words and, last, of the padding (zero)."""
    out = np.zeros((len(rows) + 1, DIM), dtype=np.float32)
    for j in range(rows.shape[1]):
        out[:-1] += net.embed[rows[:, j]]
    return out


def products(net: Net, x: np.ndarray) -> np.ndarray:
    """What words add to the filters at their place, to the wider ones one word before, and so on."""
    return np.concatenate([x @ net.conv[k][j] for j in range(max(WIDTHS)) for k, w in enumerate(WIDTHS) if w > j], axis=1)


def products_of_all(net: Net, x: np.ndarray) -> np.ndarray | None:
    """The products of all distinct words, if they are not too many to keep."""
    return products(net, x) if len(x) <= TABLE_WORDS else None


def responses(net: Net, x: np.ndarray, words: np.ndarray, table: np.ndarray | None) -> np.ndarray:
    """Filter responses, width by width, at every word (zeros beyond a text)."""
    seen = products(net, x[words]) if table is None else table.take(words, axis=0)
    bias = np.concatenate(net.bias)
    z = seen[:, :len(bias)] + bias
    at = len(bias)
    for j in range(1, max(WIDTHS)):
        n = FILTERS * sum(w > j for w in WIDTHS)  # the widest filters stand last
        z[:len(words) - j, -n:] += seen[j:, at:at + n]
        at += n
    z[words == len(x) - 1] = bias  # windows that start in the padding see nothing
    return z


def pooled(net: Net, x: np.ndarray, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The strongest response of each filter in each text; long inputs in blocks."""
    out = np.full((len(starts), FILTERS * len(WIDTHS)), -np.inf, dtype=np.float32)
    table, lap = products_of_all(net, x), max(WIDTHS) - 1
    for a in range(0, len(words), BLOCK_WORDS):
        part = words[a:a + BLOCK_WORDS + lap]
        own = min(BLOCK_WORDS, len(words) - a)
        first = np.searchsorted(starts, a, side="right") - 1
        last = np.searchsorted(starts, a + own, side="left")
        cuts = np.maximum(starts[first:last] - a, 0)
        best = np.maximum.reduceat(responses(net, x, part, table)[:own], cuts, axis=0)
        np.maximum(out[first:last], best, out=out[first:last])
    return np.maximum(out, 0)


def logits(net: Net, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Logit of each text, and its language as a number (-1: no evidence)."""
    rows, words, starts = tokenise(texts)
    z = pooled(net, word_vectors(net, rows), words, starts) @ net.out + net.out_bias
    if not net.langs:
        return z, np.full(len(texts), -1)
    evidence = np.vstack([net.evidence[rows[:, 0]], np.zeros((1, len(net.langs)), dtype=np.float32)])
    votes = np.stack([np.add.reduceat(evidence[:, j][words].astype(np.float64), starts) for j in range(len(net.langs))], axis=1)
    return z, np.where((votes != 0).any(axis=1), votes.argmax(axis=1), -1)


def strongest(net: Net, x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's strongest response in one text and the word where it starts; long
    texts in blocks."""
    table, every = products_of_all(net, x), np.arange(FILTERS * len(WIDTHS))
    best, where = np.full(len(every), -np.inf, dtype=np.float32), np.zeros(len(every), dtype=np.int64)
    for a in range(0, len(words), BLOCK_WORDS):
        z = responses(net, x, words[a:a + BLOCK_WORDS + max(WIDTHS) - 1], table)[:BLOCK_WORDS]
        w = z.argmax(axis=0)
        v = z[w, every]
        where, best = np.where(v > best, w + a, where), np.maximum(v, best)
    return best, where


def fresh_sums(net: Net) -> dict:
    """Adagrad's sums of squares before the first step."""
    return {"embed": np.full(net.embed.shape[0], 1e-8), "out": np.full(net.out.shape, 1e-8), "b": 1e-8,
            "conv": [np.full(c.shape, 1e-8) for c in net.conv], "bias": [np.full(b.shape, 1e-8) for b in net.bias]}


def step(net: Net, sums: dict, tokens: list, labels: np.ndarray, weight: np.ndarray, rate: float) -> np.ndarray:
    """One Adagrad step on a batch of tokenised texts; the buckets it touched."""
    g_out, g_b = np.zeros_like(net.out), 0.0
    taps = [(k, j) for k, width in enumerate(WIDTHS) for j in range(width)]
    width_of, place = (np.array(v) for v in zip(*taps))
    conv = np.stack([net.conv[k][j].T for k, j in taps])  # (taps, FILTERS, DIM)
    g_taps, g_bias = np.zeros((len(taps), DIM, FILTERS), dtype=np.float32), np.zeros_like(net.out)
    at_rows, at_grads = [], []
    for i, (rows, words, _) in enumerate(tokens):
        x = word_vectors(net, rows)
        best, where = strongest(net, x, words)
        h = np.maximum(best, 0)
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(h @ net.out + net.out_bias)))))
        g = (p - labels[i]) * weight[i] / len(tokens)
        g_out += g * h
        g_b += g
        back = g * net.out * (h > 0)
        g_bias += back
        at = where.reshape(-1, FILTERS)[width_of] + place[:, None]
        code = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], len(rows))
        gk = back.reshape(-1, FILTERS)[width_of][..., None]  # (taps, FILTERS, 1)
        g_taps += (x[code] * gk).transpose(0, 2, 1)
        live = code < len(rows)
        found = np.full((*code.shape, rows.shape[1]), -1, dtype=rows.dtype)
        found[live] = rows[code[live]]
        found = found.transpose(0, 2, 1)  # the features of a tap's words one after the other
        at_rows.append(found[found >= 0])
        at_grads.append(np.broadcast_to((conv * gk)[:, None], (*found.shape, DIM))[found >= 0])
    g_conv = [np.stack([g_taps[t] for t, (of, _) in enumerate(taps) if of == k]) for k in range(len(WIDTHS))]
    g_bias = np.split(g_bias, len(WIDTHS))
    sums["out"] += g_out ** 2
    net.out -= (rate * g_out / np.sqrt(sums["out"])).astype(np.float32)
    sums["b"] += g_b ** 2
    net.out_bias -= rate * g_b / math.sqrt(sums["b"])
    for k in range(len(WIDTHS)):
        sums["conv"][k] += g_conv[k] ** 2
        net.conv[k] -= (rate * g_conv[k] / np.sqrt(sums["conv"][k])).astype(np.float32)
        sums["bias"][k] += g_bias[k] ** 2
        net.bias[k] -= (rate * g_bias[k] / np.sqrt(sums["bias"][k])).astype(np.float32)
    touched, back_at = np.unique(np.concatenate(at_rows), return_inverse=True)
    total = np.zeros((len(touched), DIM), dtype=np.float64)
    np.add.at(total, back_at, np.concatenate(at_grads))
    sums["embed"][touched] += (total ** 2).mean(axis=1)
    net.embed[touched] -= (rate * total / np.sqrt(sums["embed"][touched])[:, None]).astype(np.float32)
    return touched


def weights(bad: float) -> np.ndarray:
    """What a clean and a toxic row weigh where the share ``bad`` is toxic."""
    return np.array([0.5 / max(1 - bad, 1e-9), 0.5 / max(bad, 1e-9)])


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int | None = None, batch: int = 24,
          rate: float = RATE, sums: dict | None = None) -> Net:
    """Adagrad on the logistic loss, both labels weighing the same.  Gradients
    reach only the places where a filter responded most.  ``sums`` are Adagrad's,
    for the caller to go on from."""
    net = fresh(seed)
    if not len(texts) or labels.min() == labels.max():
        net.out[:] = 0
        net.out_bias = -4.0 if not len(texts) or labels.max() == 0 else 4.0
        return net
    r = np.random.default_rng(seed)
    epochs = epochs or max(4, min(MOST_EPOCHS, SHOWN // len(texts)))
    weight = weights(labels.mean())[labels]
    sums = fresh_sums(net) if sums is None else sums
    tokens = [x for a in range(0, len(texts), batch) for x in tokenise_each(texts[a:a + batch])]
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for a in range(0, len(order), batch):
            docs = order[a:a + batch]
            step(net, sums, [tokens[i] for i in docs], labels[docs], weight[docs], rate)
    return net


def dense(net: Net) -> np.ndarray:
    """All weights but the embeddings, in rows as long as an embedding (the last one padded)."""
    flat = np.concatenate([*(c.ravel() for c in net.conv), *net.bias, net.out, [net.out_bias]]).astype(np.float64)
    return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)


def add_dense(net: Net, change: np.ndarray) -> None:
    """Add to the weights what is laid out as by ``dense``."""
    flat, at = change.ravel(), 0
    for part in (*net.conv, *net.bias, net.out):
        part += flat[at:at + part.size].reshape(part.shape).astype(np.float32)
        at += part.size
    net.out_bias += float(flat[at])


def train_on(rows: DataFrame, net: Net, sums: dict, weight: np.ndarray, batch: int = 24,
             rate: float = RATE) -> dict[str, np.ndarray]:
    """Go on training ``net`` on all of ``rows``, each shown once: every task starts from
    ``net`` and trains on its partition.  Of every weight the mean change is taken, an
    embedding's by the steps that touched it, any other's by the task's rows.  Returns
    how often each bucket's words stand in the rows of each language.

    A partition's rows are shown in the order of a hash of their ids, changes are summed
    as whole numbers, so reruns agree; what comes back has the size of the model.
    """
    shared = rows.sparkSession.sparkContext.broadcast((net, sums))

    def run(batches):
        start = shared.value[0]
        own, own_sums = copy.deepcopy(shared.value)
        steps, shown, words_of = np.zeros(BUCKETS, dtype=np.int64), 0, {}
        for piece, texts in chunks(batches):
            y = piece.column("toxic").to_numpy()
            langs = piece.column("lang").to_pylist()
            for a in range(0, len(texts), batch):
                tokens = tokenise_each(texts[a:a + batch])
                steps[step(own, own_sums, tokens, y[a:a + batch], weight[y[a:a + batch]], rate)] += 1
                for lang, (found, words, _) in zip(langs[a:a + batch], tokens):
                    count_words(words_of, lang, found, words)
            shown += len(texts)
        if not shown:
            return
        at = np.flatnonzero(steps)
        change = np.concatenate([(own.embed[at].astype(np.float64) - start.embed[at]) * steps[at, None],
                                 (dense(own) - dense(start)) * shown])
        change = np.rint(change / STEP).astype(np.int64)
        at = np.concatenate([at, BUCKETS + np.arange(len(change) - len(at))])
        n = np.concatenate([steps[steps > 0], np.full(len(change) - (steps > 0).sum(), shown)])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n),
             *(pa.array(np.ascontiguousarray(c)) for c in change.T)], names=names)
        for lang, counts in words_of.items():  # DIM buckets a row
            counts = counts.reshape(-1, DIM)
            at = np.flatnonzero(counts.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(np.ones(len(at), dtype=np.int64)),
                 *(pa.array(np.ascontiguousarray(c)) for c in counts[at].T)], names=names)

    names = ["lang", "at", "n", *(f"v{j}" for j in range(DIM))]
    h = F.xxhash64(F.col("doc_id").cast("string"))
    ordered = rows.withColumn("h", h).sortWithinPartitions("h", "doc_id", "text", "toxic", "lang").select("toxic", "lang", "text")
    sent = (ordered.mapInArrow(run, "lang string, at int, " + ", ".join(f"{c} bigint" for c in names[2:]))
            .groupBy("lang", "at").agg(*(F.sum(c).alias(c) for c in names[2:])).toArrow())
    shared.unpersist()
    langs = np.array(sent.column("lang").to_pylist(), dtype=object)
    at, n = sent.column("at").to_numpy(), sent.column("n").to_numpy()
    values = np.stack([sent.column(f"v{j}").to_numpy() for j in range(DIM)], axis=1)
    mine = np.equal(langs, None)
    embeds = mine & (at < BUCKETS)
    others = mine & ~embeds
    net.embed[at[embeds]] += (values[embeds] * STEP / n[embeds, None]).astype(np.float32)
    change = np.zeros_like(dense(net))
    change[at[others] - BUCKETS] = values[others] * STEP / n[others, None]
    add_dense(net, change)
    counts = {}
    for lang in sorted(set(langs[~mine])):
        counts[lang] = np.zeros((BUCKETS // DIM, DIM), dtype=np.int64)
        counts[lang][at[langs == lang]] = values[langs == lang]
    return {lang: table.ravel() for lang, table in counts.items()}


def best_cut(z: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> float:
    """The threshold of the best F1, halfway between the neighbouring logits.  With
    ``rows``, a logit stands for so many rows, ``y`` of them toxic."""
    rows = np.ones(len(z), dtype=np.int64) if rows is None else rows
    order = np.argsort(-z, kind="stable")
    z, y, rows = z[order], y[order], rows[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.cumsum(rows) + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(np.argmax(f1))
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k]) - 1.0


def count_words(counts: dict[str, np.ndarray], lang: str | None, rows: np.ndarray, words: np.ndarray) -> None:
    """Add the words of one tokenised text to its language's counts by bucket."""
    if lang is not None:
        table = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
        np.add.at(table, rows[:, 0], np.bincount(words, minlength=len(rows))[:len(rows)])


def set_evidence(net: Net, counts: dict[str, np.ndarray]) -> None:
    """Log odds of the words under each language, if there are several."""
    names = tuple(sorted(counts))
    if len(names) > 1:
        table = np.stack([counts[x] for x in names], axis=1) + 1.0
        share = np.log(table / table.sum(axis=0))
        net.langs, net.evidence = names, (share - share.mean(axis=1, keepdims=True)).astype(np.float32)


def set_cuts(net: Net, lang: np.ndarray, z: np.ndarray, toxic: np.ndarray, rows: np.ndarray, least: int = 15) -> None:
    """Thresholds from logits and how many rows, how many of them toxic, have each: one
    for each language with at least ``least`` rows of either label, the common one for
    the rest."""
    if not 0 < toxic.sum() < rows.sum():
        return
    net.cut = best_cut(z, toxic, rows)
    for j, name in enumerate(net.langs):
        at = lang == j
        if min(toxic[at].sum(), (rows - toxic)[at].sum()) >= least:
            net.cuts[name] = best_cut(z[at], toxic[at], rows[at])


def calibrate(net: Net, texts: list[str], labels: np.ndarray, langs: list[str | None], fit_on: np.ndarray,
              least: int = 15) -> None:
    """Word evidence of the languages from the rows fitted on, and thresholds from
    the others, for rows at hand (``train_on`` and ``calibrate_on`` do it in Spark)."""
    counts = {x: np.zeros(BUCKETS, dtype=np.int64) for x in langs if x is not None}
    for i in np.flatnonzero(fit_on):
        rows, words, _ = tokenise([texts[i]])
        count_words(counts, langs[i], rows, words)
    set_evidence(net, counts)
    rest = np.flatnonzero(~fit_on)
    z, lang = logits(net, [texts[i] for i in rest])
    set_cuts(net, lang, z, labels[rest], np.ones(len(rest), dtype=np.int64), least)


def calibrate_on(rows: DataFrame, net: Net) -> None:
    """Thresholds from all of ``rows``: their logits are counted on a grid."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for piece, texts in chunks(batches):
            z, lang = logits(shared.value, texts)
            z = np.rint(np.clip(z, -REACH, REACH) * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(z), piece.column("toxic")],
                                             names=["lang", "z", "toxic"])

    found = (rows.select("toxic", "text").mapInArrow(run, "lang int, z int, toxic int").groupBy("lang", "z")
             .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).toArrow())
    shared.unpersist()
    lang, z, toxic, n = (found.column(c).to_numpy() for c in ("lang", "z", "toxic", "n"))
    set_cuts(net, lang, z / GRID, toxic, n)


def scores(net: Net, texts: list[str]) -> np.ndarray:
    z, lang = logits(net, texts)
    cut = np.array([net.cuts.get(name, net.cut) for name in net.langs] + [net.cut])[lang]
    return 1 / (1 + np.exp(-np.clip(net.scale * (z - cut), -30, 30)))


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def known(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of learnable labels; a document with several labels counts as
    toxic if one says so."""
    return (labels.where(F.col("toxic").isNotNull() & (fold() != 0)).groupBy("doc_id")
            .agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))


def set_aside():
    """Whether a labelled row sets thresholds (a fifth does) instead of fitting weights."""
    return F.crc32(F.concat(F.lit("cut:"), F.col("doc_id").cast("string")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, toxic, lang, text) of at most so many labelled rows by the order of a
    hash of their ids, learnable rows only, whole texts; no more rows once ``chars``
    are reached."""
    most = 1 << 30
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(most))
    marked = known(labels)
    rows = marked.groupBy().agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")).first()
    bad, good = rows["bad"] or 0, (rows["all"] or 0) - (rows["bad"] or 0)
    below = F.when(F.col("toxic") == 1, min(1.0, toxic_rows / max(bad, 1)) * most).otherwise(
        min(1.0, clean_rows / max(good, 1)) * most)
    picked = marked.where(h < below)  # about the rows wanted: small enough to send everywhere
    rows = (docs.join(F.broadcast(picked), "doc_id")
            .select("doc_id", "toxic", "lang", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
            .orderBy("h", "doc_id", "text").limit(2 * (toxic_rows + clean_rows)))
    before = F.sum(F.length("text")).over(Window.orderBy("h", "doc_id", "text").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < chars).drop("before", "h")


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
        chars: int = SAMPLE_CHARS, seed: int = 7, share_rows: int = SHARE_ROWS) -> Net:
    """Train and calibrate on all labelled rows; labels only of rows whose
    crc32(doc_id) mod 5 is not 0.  Four fifths of them fit the weights and the
    languages' words, the rest the thresholds (the languages of rows are used here
    and nowhere else).  Without labels of both kinds every text gets the same score.

    A bounded sample of the rows to fit gives the weights to start from; tasks of at most
    about ``share_rows`` rows go on from there, so that every row is learnt from.  (There
    may be more tasks: the join takes the session's shuffle partitions if those are more.)
    """
    docs, labels = columns(docs, doc_id="doc_id", text="text", lang="lang"), columns(labels, doc_id="doc_id", toxic="toxic")
    marked = known(labels)
    sizes = docs.where(fold() != 0).join(marked, "doc_id").groupBy(set_aside().alias("aside"), "toxic").count().collect()
    have = {label: sum(r["count"] for r in sizes if r["toxic"] == label and not r["aside"]) for label in (0, 1)}
    some_aside = have[0] > 0 and have[1] > 0
    if not some_aside:  # too few rows: all fit the weights
        have = {label: sum(r["count"] for r in sizes if r["toxic"] == label) for label in (0, 1)}
    bad, good = have[1], have[0]
    if not bad or not good:
        return train([""], np.array([int(bad > 0)]), seed)
    shares = -(-(bad + good) // share_rows)

    def rows(which):
        """The labelled rows in shares: texts move once, joined where they are dealt to."""
        return (docs.where((fold() != 0) & which).repartition(shares, "doc_id")
                .join(marked.where(which).repartition(shares, "doc_id"), "doc_id")
                .select("doc_id", "toxic", "lang", F.coalesce("text", F.lit("")).alias("text")))

    fitting = ~set_aside() if some_aside else F.lit(True)
    first = sample(docs.where(fitting), labels, toxic_rows, clean_rows, chars).collect()
    y = np.array([r["toxic"] for r in first], dtype=np.int64)
    net = fresh(seed)
    sums = fresh_sums(net)
    if len(y) and y.min() != y.max():
        net = train([r["text"] for r in first], y, seed, sums=sums)
    set_evidence(net, train_on(rows(fitting), net, sums, weights(bad / (bad + good))))
    if some_aside:
        calibrate_on(rows(set_aside()), net)
    return net


def score(docs: DataFrame, net: Net, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row's whole text; null counts as empty.

    Rows with null or repeated ids are scored each on their own; further columns
    are ignored; no rows in, no rows out.
    """
    src = columns(docs, doc_id=doc_id, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # its size is fixed by the parameters above

    def run(batches):
        for piece, texts in chunks(batches):
            s = scores(shared.value, [t or "" for t in texts]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [id_column(piece), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, score double, predicted int")
