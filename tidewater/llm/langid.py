"""Language identification by cross-parsing entropy.

A suffix automaton of a language's reference text parses a document greedily
into the longest phrases that occur in the reference.  The language that needs
the fewest phrases, normalised by the reference's size, wins.  Documents are
parsed in lockstep: one table look-up per character and language for thousands
of segments at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import chunks, columns, held, id_column, type_of

UNKNOWN = "und"
#: The bound of the labelled sample: documents of a language, and normalised characters
#: of a language's reference and of all references.  Documents are taken whole, in the
#: order of a hash, until they fill the reference.
DOCS_PER_LANG = 200
REF_CHARS = 60_000
ALL_REF_CHARS = 320_000
#: A language's classes: its most frequent letters have one each, its other letters share
#: some, and letters it does not use are all unknown to it.
OWN, SHARED = 64, 32
WIDTH = 1 + OWN + SHARED + 1
#: Texts are parsed in segments of so many normalised characters; a phrase ends there, so
#: a text has at most one phrase more per segment, under every language alike.
SEGMENT = 1_024
CODE_POINTS = 0x33480  # no letters beyond


@dataclass(frozen=True)
class Model:
    """Languages (those with the most labelled rows first), the letters of each (the
    most frequent first) and their reference texts (as the language's own classes)."""

    langs: tuple[str, ...]
    letters: tuple[str, ...]
    refs: tuple[bytes, ...]


def letter_numbers(model_letters: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Number of every code point: 0 no letter, 1.. the letters (in either case) that any
    language uses, then one number for all others; and per language the class of every
    number."""
    every = sorted(set("".join(model_letters)))
    number = {c: i + 1 for i, c in enumerate(every)}
    other = len(every) + 1
    numbers = np.fromiter((number.get(chr(i).lower()[:1], other) if chr(i).isalpha() else 0 for i in range(CODE_POINTS)),
                          dtype=np.int32, count=CODE_POINTS)
    classes = np.full((len(model_letters), other + 1), WIDTH - 1, dtype=np.int32)
    classes[:, 0] = 0
    for j, letters in enumerate(model_letters):
        for rank, c in enumerate(letters):
            classes[j, number[c]] = 1 + (rank if rank < OWN else OWN + rank % SHARED)
    return numbers, classes


def normalise(texts: list[str], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all texts, one after the other, runs of non-letters as one 0;
    and where each text ends.  A text that has letters ends with a 0."""
    points = np.frombuffer("".join(f"{t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    cls = np.where(points < CODE_POINTS, numbers[np.minimum(points, CODE_POINTS - 1)], 0).astype(np.int32)
    keep = cls > 0
    keep[1:] |= cls[:-1] > 0
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    return cls[keep], np.cumsum(keep)[ends - 1]


def suffix_automaton(ref: bytes) -> tuple[list[dict[int, int]], list[int]]:
    """Transitions and longest lengths of the states; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in ref:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
        last = cur
    return nxt, length


def parse_table(ref: bytes, width: int) -> np.ndarray:
    """Flat table: at state * width + class, the next state * width, shifted left
    by two bits, plus the phrases that end before it (an unknown letter is a
    phrase of its own).  States are ordered by length, the busiest first."""
    nxt, length = suffix_automaton(ref)
    order = np.argsort(length, kind="stable")
    place = np.empty(len(nxt), dtype=np.int64)
    place[order] = np.arange(len(nxt))
    root = np.zeros(width, dtype=np.int64)
    for c, q in nxt[0].items():
        root[c] = place[q]
    ends = np.where(root > 0, 1, 2)
    table = np.broadcast_to((root * width) << 2 | ends, (len(nxt), width)).astype(np.int32)
    table[0] = (root * width) << 2 | np.where(root > 0, 0, 1)
    sizes = np.fromiter(map(len, nxt), dtype=np.int64, count=len(nxt))
    at = np.repeat(place, sizes) * width + np.fromiter((c for d in nxt for c in d), dtype=np.int64, count=sizes.sum())
    to = place[np.fromiter((q for d in nxt for q in d.values()), dtype=np.int64, count=sizes.sum())]
    table = table.ravel()
    table[at] = (to * width) << 2
    return table


def prepared(model: Model) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Letter numbers, classes and parse tables, made once per worker process."""
    return held(("langid", model), lambda: (*letter_numbers(model.letters), [parse_table(r, WIDTH) for r in model.refs]))


def count_phrases(codes: np.ndarray, ends: np.ndarray, classes: np.ndarray, tables: list[np.ndarray],
                  segment: int = SEGMENT) -> np.ndarray:
    """Phrases of each text (row) under each language (column)."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    sizes = ends - starts
    pieces = -(-sizes // segment)
    owner = np.repeat(np.arange(len(ends)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = starts[owner] + nth * segment
    length = np.minimum(segment, ends[owner] - first)
    by = np.argsort(-length, kind="stable")
    owner, first, length = owner[by], first[by], length[by]
    out = np.zeros((len(ends), len(tables)), dtype=np.int64)
    if not len(owner):
        return out
    active = np.searchsorted(-length, -np.arange(int(length[0])), side="left")  # segments longer than t
    steps = [codes[first[:k] + t] for t, k in enumerate(active)]
    for j, table in enumerate(tables):
        state = np.zeros(len(owner), dtype=np.int32)
        count = np.zeros(len(owner), dtype=np.int32)
        for step in steps:
            k = len(step)
            v = table.take(state[:k] + classes[j].take(step))
            count[:k] += v & 3
            np.right_shift(v, 2, out=state[:k])
        count += state > 0  # the phrase that the segment's end cuts off
        out[:, j] = np.bincount(owner, weights=count, minlength=len(ends)).astype(np.int64)
    return out


def rates(codes: np.ndarray, ends: np.ndarray, model: Model, classes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Normalised phrases: phrases * log2(reference length) / characters."""
    sizes = np.diff(ends, prepend=0)
    weight = np.array([np.log2(max(len(r), 2)) for r in model.refs])
    return count_phrases(codes, ends, classes, tables) * weight / np.maximum(sizes, 1)[:, None]


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def sample(docs: DataFrame, per_lang: int, ref_chars: int) -> DataFrame:
    """(lang, text, count of the language): at most ``per_lang`` documents of each
    language by the order of a hash, those of at most ``ref_chars`` characters first;
    learnable rows only, whole texts, no more than fill the reference.

    A first pass counts the rows of each language (languages are few: the model
    holds a reference of each); the second keeps about four times the documents
    wanted by the hash alone, so that what is ranked stays bounded and the texts
    of all other rows never leave their scan.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 1))
    most = 1 << 30
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(most))
    counts = [(r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect()]
    if not counts:
        return rows.select("lang", "text", F.lit(0).cast("bigint").alias("count")).limit(0)
    count = F.create_map(*(F.lit(x) for lang, n in counts for x in (lang, n)))[F.col("lang")].cast("bigint")
    below = F.create_map(*(F.lit(x) for lang, n in counts for x in (lang, int(min(1.0, 4 * per_lang / n) * most))))[F.col("lang")]
    picked = (rows.where(h < below)
              .select("lang", "text", (F.length("text") > ref_chars).alias("long"), h.alias("h"), "doc_id", count.alias("count")))
    order = Window.partitionBy("lang").orderBy("long", "h", "doc_id", "text")
    before = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (picked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
            .withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < 2 * ref_chars)
            .orderBy("lang", "rank").select("lang", "text", "count"))


def fit(docs: DataFrame, per_lang: int = DOCS_PER_LANG, ref_chars: int = REF_CHARS, all_chars: int = ALL_REF_CHARS) -> Model:
    """Reference texts from a bounded sample of the learnable rows (lang known,
    crc32(doc_id) mod 3 not 1); columns doc_id, text and lang."""
    texts: dict[str, list[str]] = {}
    known: dict[str, int] = {}
    for r in sample(docs, per_lang, ref_chars).collect():  # a language's share is bounded
        if any(c.isalpha() for c in r["text"]):
            texts.setdefault(r["lang"], []).append(r["text"])
            known[r["lang"]] = r["count"]
    langs = tuple(sorted(texts, key=lambda x: (-known[x], x)))
    letters = []
    for lang in langs:
        seen = Counter(c for t in texts[lang] for c in t.lower() if c.isalpha())
        letters.append("".join(sorted(seen, key=lambda c: (-seen[c], c))))
    numbers, classes = letter_numbers(tuple(letters))
    limit = min(ref_chars, all_chars // max(len(langs), 1))
    refs = tuple(classes[j][normalise(texts[x], numbers)[0][:limit]].astype(np.uint8).tobytes() for j, x in enumerate(langs))
    return Model(langs, tuple(letters), refs)


def judged(texts: list[str | None], model: Model) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Language (None if it has none), score and rate of every text, parsed whole under every
    language (see ``predict``)."""
    numbers, classes, tables = prepared(model)
    codes, ends = normalise([t or "" for t in texts], numbers)
    letters = np.diff(ends, prepend=0) > 0
    if model.langs:
        r = rates(codes, ends, model, classes, tables)
        best = np.argmin(r, axis=1)
        low = r[np.arange(len(r)), best]
        if len(model.langs) > 1:
            second = np.partition(r, 1, axis=1)[:, 1]
            score = np.where(second > 0, (second - low) / np.maximum(second, 1e-12), 0.0)
        else:
            score = np.ones(len(r))
    else:
        letters[:] = False
        best, low, score = (np.zeros(len(texts), dtype=int), *np.zeros((2, len(texts))))
    return ([model.langs[b] if ok else None for b, ok in zip(best.tolist(), letters.tolist())],
            np.where(letters, np.clip(score, 0, 1), 0.0), np.where(letters, low, 0.0))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rate) of every row's whole text.

    lang_pred: the language of the least rate (ties: the one with more labelled rows); ``und`` with
    score 0 for a null text, one without letters, or a model without languages.
    score: how much lower the best rate is than the next one, relative to that (1
    with a single language).  rate: the best rate, about bits per character.  Rows
    with null or repeated ids are judged each on their own; further columns are
    ignored.
    """
    src = columns(docs, doc_id=doc_id, text=text)

    def run(batches):
        for piece, texts in chunks(batches):
            langs, score, rate = judged(texts, model)
            yield pa.RecordBatch.from_arrays(
                [id_column(piece), pa.array([UNKNOWN if x is None else x for x in langs], pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
                names=["doc_id", "lang_pred", "score", "rate"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, lang_pred string, score double, rate double")


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``predict`` gives a language: every text is parsed whole
    under every language, as there, and what has none goes (texts without letters; the others
    stay, however short or undecided).  Columns and repeated rows stay as they are; nothing is
    shuffled."""
    names = docs.columns

    def run(batches):
        for piece, texts in chunks(batches, text):
            langs, _, _ = judged(texts, model)
            yield pa.RecordBatch.from_arrays(piece.columns, names=names).filter(pa.array([x is not None for x in langs], pa.bool_()))

    return docs.mapInArrow(run, docs.schema) if model.langs else docs.limit(0)
