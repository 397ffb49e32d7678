"""Ranked lexical search of many items at once, with shared partial sums.

The items' term sets overlap.  Their shared parts are mined once: pairs of symbols
that several items hold become new symbols, again and again, until no pair serves
two items.  The result is a graph in which a node is the sum of two others and an
item the sum of a few nodes.  Per block of documents every node's accumulator is computed once and used
by all items that share it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import columns, materialise, type_of

#: Items searched in one pass over the documents, and documents scored at once.
ITEM_BLOCK = 1_000
DOC_BLOCK = 256
TOP = 10
#: Symbols of an item that may form pairs in a round of mining.
PAIRED = 64

#: Everything in ASCII that is no letter or digit separates terms; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order, repeats included."""
    return text.translate(_TABLE).split()


# ---------------------------------------------------------------- sharing graph

@dataclass(frozen=True)
class Graph:
    """Symbols 0 .. terms-1 are terms; symbol ``terms + i`` is the sum of
    ``left[i]`` and ``right[i]``; ``levels`` are runs of nodes that only need earlier
    ones; item j is the sum of the symbols ``parts[starts[j]:starts[j + 1]]``."""

    terms: int
    left: np.ndarray
    right: np.ndarray
    levels: list[tuple[int, int]]
    parts: np.ndarray
    starts: np.ndarray

    def evaluate(self, given: np.ndarray) -> np.ndarray:
        """(items, documents) sums from (terms, documents) contributions."""
        n, docs = self.terms, given.shape[1]
        acc = np.empty((n + len(self.left), docs), dtype=np.int64)
        acc[:n] = given
        for a, b in self.levels:
            np.add(acc[self.left[a:b]], acc[self.right[a:b]], out=acc[n + a:n + b])
        out = np.zeros((len(self.starts) - 1, docs), dtype=np.int64)
        full = np.flatnonzero(np.diff(self.starts))
        if len(full):
            out[full] = np.add.reduceat(acc[self.parts], self.starts[full], axis=0)
        return out


def share(items: list[list[int]], n_terms: int) -> Graph:
    """Mine the term sets that items share.  A round counts pairs of symbols over the
    items, lets every item pick disjoint pairs, most frequent first, and gives each
    pair that two or more items picked a symbol of its own.  A round shortens the
    sequences it changes, so rounds are few.  Pairs are taken from an item's ``PAIRED``
    most shared symbols: that bounds the mining, and only how much is shared."""
    rows = [sorted(set(item)) for item in items]
    left: list[int] = []
    right: list[int] = []
    levels: list[tuple[int, int]] = []
    while True:
        uses = Counter(t for row in rows for t in row)
        shared = [sorted((t for t in row if uses[t] > 1), key=lambda t: (-uses[t], t))[:PAIRED] for row in rows]
        frequent = Counter(p for row in shared for p in combinations(sorted(row), 2))
        picked = []
        for row in shared:
            free, mine = set(row), []
            for p in sorted((p for p in combinations(sorted(row), 2) if frequent[p] > 1), key=lambda p: (-frequent[p], p)):
                if free.issuperset(p):
                    free.difference_update(p)
                    mine.append(p)
            picked.append(mine)
        picks = Counter(p for mine in picked for p in mine)
        symbol = {p: n_terms + len(left) + i for i, p in enumerate(sorted(p for p, c in picks.items() if c > 1))}
        if not symbol:
            break
        levels.append((len(left), len(left) + len(symbol)))
        left.extend(p[0] for p in symbol)
        right.extend(p[1] for p in symbol)
        for i, mine in enumerate(picked):
            used = [p for p in mine if p in symbol]
            gone = {t for p in used for t in p}
            rows[i] = [t for t in rows[i] if t not in gone] + [symbol[p] for p in used]
    return Graph(n_terms, np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), levels,
                 np.array([s for row in rows for s in row], dtype=np.int64), np.cumsum([0, *map(len, rows)]))


# ---------------------------------------------------------------- postings

def postings(docs: DataFrame, vocabulary: list[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) per document with at least one term: the number of
    its terms, and which of the vocabulary it holds how often."""
    src = columns(docs, doc_id=doc_id, text=text)

    def run(batches: Iterable[pa.RecordBatch]):
        number = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            at, n, sizes, ids, counts = [], [], [], [], []
            for i in range(batch.num_rows):
                words = terms(texts[i].as_py() or b"")
                if not words:
                    continue
                found = Counter(map(number.get, words))
                found.pop(None, None)
                at.append(i)
                n.append(len(words))
                sizes.append(len(found))
                ids.extend(found.keys())
                counts.extend(found.values())
            ends = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, type=pa.int64())), pa.array(n, type=pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(ids, type=pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, type=pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, n bigint, terms array<int>, counts array<bigint>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contributions(weights: np.ndarray, counts: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term that stands ``counts`` times in a document of n terms adds."""
    m = 100 - 90 + (90 * n * documents) // length
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


# ---------------------------------------------------------------- ranking

def _best(score: np.ndarray, doc: np.ndarray, missing: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k first columns per row: highest score, then documents with an id, then least id."""
    order = np.lexsort((doc, missing, -score), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (score, doc, missing))


def _ranker(graph: Graph, items: int, weights: np.ndarray, documents: int, length: int, k: int):
    """A task's k best documents of every item."""

    def run(batches: Iterable[pa.RecordBatch]):
        score = np.zeros((items, k), dtype=np.int64)
        doc = np.zeros((items, k), dtype=np.int64)
        missing = np.ones((items, k), dtype=bool)
        for batch in batches:
            for start in range(0, batch.num_rows, DOC_BLOCK):
                part = batch.slice(start, DOC_BLOCK)
                held = part.column(2).flatten().to_numpy(zero_copy_only=False)
                counts = part.column(3).flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(part.column(2).offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), sizes)
                n = part.column(1).to_numpy(zero_copy_only=False)
                given = np.zeros((graph.terms, part.num_rows), dtype=np.int64)
                given[held, row] = contributions(weights[held], counts, n[row], documents, length)
                total = graph.evaluate(given)
                rows = np.flatnonzero((total.max(axis=1) >= score[:, -1]) & (total.max(axis=1) > 0))
                if not len(rows):
                    continue
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                none = part.column(0).is_null().to_numpy(zero_copy_only=False)
                wide = (len(rows), part.num_rows)
                score[rows], doc[rows], missing[rows] = _best(
                    np.hstack([score[rows], total[rows]]), np.hstack([doc[rows], np.broadcast_to(ids, wide)]),
                    np.hstack([missing[rows], np.broadcast_to(none, wide)]), k)
        item, col = np.nonzero(score > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(doc[item, col], mask=missing[item, col]), pa.array(score[item, col])],
            names=["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of every item's k highest-scoring documents.

    ``doc_id`` is of an integer type.  Equal scores by ascending doc_id, rows without
    id last; rows that share an id or a text are ranked each on their own.  Rows of
    one item_id (null is one, too) count as one item with the terms of all.  Null and
    empty texts have no terms: such a document is found by nothing and not counted,
    such an item finds nothing.  Further columns are left out.

    Items go through in blocks of about ``ITEM_BLOCK``, whose terms and graph are
    sent to the tasks; a block reads the documents once, writes its postings to the
    shared folder, counts the documents of each term from them and scores them.
    A task returns its k best per item, so the last step ranks k rows per task.
    """
    spark = docs.sparkSession
    id_type, doc_type = type_of(items, item_id), type_of(docs, doc_id)
    asked = materialise(columns(items, item_id=item_id, text=item_text), "items")
    blocks = -(-asked.select("item_id").distinct().count() // ITEM_BLOCK)
    found = []
    for block in range(blocks):
        sets: dict = {}
        for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            sets.setdefault(r["item_id"], set()).update(terms((r["text"] or "").encode()))
        names = list(sets)
        vocabulary = sorted(set().union(*sets.values()))
        if not vocabulary:
            continue
        number = {t: i for i, t in enumerate(vocabulary)}
        graph = share([[number[t] for t in sets[name]] for name in names], len(vocabulary))
        posted = materialise(postings(docs, vocabulary, doc_id, text), "postings")
        documents, length = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
        holding = posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term asked
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for r in holding:
            weights[r["term"]] = weight(documents, r["count"])
        ranked = (posted.where(F.size("terms") > 0)
                  .mapInArrow(_ranker(graph, len(names), weights, documents, length or 1, k), "item int, doc_id bigint, score bigint"))
        named = spark.createDataFrame([(i, name) for i, name in enumerate(names)], f"item int, item_id {id_type}")
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found.append(ranked.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
                     .join(named, "item").select("item_id", "rank", F.col("doc_id").cast(doc_type).alias("doc_id"), "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id {doc_type}, score bigint")
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out
