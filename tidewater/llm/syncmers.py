"""Document fingerprints from closed syncmers.

A k-mer is kept when the smallest of its inner s-mers (by a hash) is the first or
the last one.  Whether it is kept depends on its own bytes only, so the same
passage yields the same anchors in every document and at every place, and an edit
changes only the anchors that overlap it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import columns, materialise, type_of

#: Bytes of a k-mer and of its inner s-mers; an s-mer is one 64-bit word.
K = 23
S = 8
WINDOW = K - S + 1
#: Bins of the sketch in a fingerprint; text (in characters) worked on at once.
BINS = 32
PIECE_CHARS = 2 << 20

_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (invertible, so different words stay different)."""
    x = x * _A
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def anchors(texts: list[str], every: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, byte position in the text, 64-bit k-mer id) of every closed
    syncmer, in order of text and position.  A text shorter than a k-mer is one
    anchor as a whole; an empty text has none.  With ``every``, so is a longer text
    without a closed syncmer (possible below 37 bytes), though no text that holds it
    has that anchor."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(data) + bytes(K), dtype=np.uint8)
    h = mix(np.lib.stride_tricks.sliding_window_view(flat, S).copy().view("<u8").ravel())
    low, span = h, 1
    while span < WINDOW:  # minima over windows that double in length
        step = min(span, WINDOW - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    low = low[:max(int(ends[-1]) if len(ends) else 0, 0)]
    keep = (low == h[:len(low)]) | (low == h[WINDOW - 1:WINDOW - 1 + len(low)])
    over = (ends[:, None] - np.arange(1, K)).ravel()  # starts whose k-mer leaves its text
    keep[over[(over >= 0) & (over < len(keep))]] = False
    at = np.flatnonzero(keep)
    ident = mix(mix(h[at] ^ _C) + h[at + S] * _D) ^ h[at + K - S]
    text = np.searchsorted(ends, at, side="right")
    bare = np.bincount(text, minlength=len(data)) == 0
    short = np.flatnonzero((sizes > 0) & (bare if every else sizes < K))
    if len(short):
        whole = np.array([int.from_bytes(hashlib.blake2b(data[i], digest_size=8).digest(), "little") for i in short],
                         dtype=np.uint64)
        text, at, ident = (np.concatenate(x) for x in ((text, short), (at, ends[short] - sizes[short]), (ident, whole)))
        by = np.argsort(text, kind="stable")
        text, at, ident = text[by], at[by], ident[by]
    return text, at - (ends - sizes)[text], ident


def occurrence_keys(text: np.ndarray, ident: np.ndarray) -> np.ndarray:
    """A key for every anchor that tells its id and the how-manieth it is of that
    id in its text; the text's number is added in (times a constant)."""
    key = ident + text.astype(np.uint64) * _C
    order = np.argsort(key, kind="stable")
    run = key[order]
    new = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.zeros(0, dtype=bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0)) if len(run) else np.zeros(0, dtype=np.int64)
    nth = np.empty(len(run), dtype=np.uint64)
    nth[order] = (np.arange(len(run)) - first).astype(np.uint64)
    return key + nth * _D


def likeness(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the anchors of both texts that match (1 for two texts without any:
    both are empty if every other text has one)."""
    return np.where(a + b > 0, 2 * shared / np.maximum(a + b, 1), 1.0)


def matches(a: str, b: str) -> list[tuple[int, int, int]]:
    """Positional matching of two texts: (byte in a, byte in b, bytes) of passages
    whose anchors agree in id and order, merged while their offset stays.  Equal
    texts with one anchor (short ones, mostly) match as a whole."""
    text, at, ident = anchors([a, b], every=True)
    in_a, in_b = text == 0, text == 1
    key_a, key_b = (occurrence_keys(np.zeros(int(m.sum()), dtype=np.int64), ident[m]) for m in (in_a, in_b))
    _, i, j = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
    pairs = sorted(zip(at[in_a][i].tolist(), at[in_b][j].tolist()))
    if pairs == [(0, 0)] and a == b:
        return [(0, 0, len(a.encode("utf-8", "surrogatepass")))]
    out: list[list[int]] = []
    for x, y in pairs:
        if out and y - x == out[-1][1] - out[-1][0] and x <= out[-1][0] + out[-1][2]:
            out[-1][2] = x + K - out[-1][0]
        else:
            out.append([x, y, K])
    return [tuple(o) for o in out]


def fingerprints(count: int, text: np.ndarray, ident: np.ndarray) -> list[str]:
    """Per text, 16 hex digits that stand for the whole sequence of its anchors, and
    a sketch: for each bin, eight bits of the least id that falls into it."""
    cuts = np.searchsorted(text, np.arange(count + 1))
    least = np.full(count * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, text * BINS + (ident % np.uint64(BINS)).astype(np.int64), ident // np.uint64(BINS))
    sketch = (least & np.uint64(0xFF)).astype(np.uint8).reshape(count, BINS)
    return [hashlib.blake2b(ident[a:b].tobytes(), digest_size=8).hexdigest() + sketch[i].tobytes().hex()
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def edited(text: str, following: str) -> str:
    """The text with its last third (rounded down) replaced by as many first
    characters of the following one (or all)."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def compare(texts: list[str]) -> dict[str, list]:
    """Results for every text but the last, each with the one after it."""
    n = len(texts) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    doc, _, ident = anchors(texts, every=True)
    other, _, other_ident = anchors(changed, every=True)
    count, other_count = np.bincount(doc, minlength=n + 1), np.bincount(other, minlength=n)
    keys, other_keys = occurrence_keys(doc, ident), occurrence_keys(other, other_ident)
    in_edited = np.bincount(other[np.isin(other_keys, keys, assume_unique=True)], minlength=n)[:n]
    later = doc > 0  # as the following text of the one before
    in_next = np.bincount(doc[later][np.isin(keys[later] - _C, keys, assume_unique=True)] - 1, minlength=n)[:n]
    return {
        "n_chars": [len(t) for t in texts[:n]],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        "fingerprint": fingerprints(n + 1, doc, ident)[:n],
        "edited_fingerprint": fingerprints(n, other, other_ident),
        "near_edited": likeness(in_edited, count[:n], other_count).tolist(),
        "near_next": likeness(in_next, count[:n], count[1:]).tolist(),
    }


RESULT = [("n_chars", pa.int64(), "bigint"), ("edited_sha256", pa.string(), "string"), ("fingerprint", pa.string(), "string"),
          ("edited_fingerprint", pa.string(), "string"), ("near_edited", pa.float64(), "double"),
          ("near_next", pa.float64(), "double")]


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, anchors) of every row's whole text; anchors are structs
    of byte position and id.  Null texts count as empty; rows stay on their own."""
    src = columns(docs, doc_id=doc_id, text=text)

    def run(batches):
        from tidewater.llm.common import chunks, id_column
        for piece, texts in chunks(batches, size=PIECE_CHARS):
            doc, at, ident = anchors([t or "" for t in texts], every=True)
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            pairs = pa.StructArray.from_arrays([pa.array(at), pa.array(ident.view(np.int64))], names=["at", "id"])
            yield pa.RecordBatch.from_arrays(
                [id_column(piece), pa.array(fingerprints(len(texts), doc, ident)),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pairs)], names=["doc_id", "fingerprint", "anchors"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, fingerprint string, "
                               "anchors array<struct<at: bigint, id: bigint>>")


def _pieces(batches) -> Iterator[tuple[list, list[str]]]:
    """Rows in runs of about PIECE_CHARS characters; each run but the first begins
    with the last row of the one before."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            ids.append(batch.column(0)[i].as_py())
            texts.append(batch.column(1)[i].as_py() or "")
            held += len(texts[-1])
            if held >= PIECE_CHARS and len(texts) > 1:
                yield ids, texts
                ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])
    yield ids, texts


def compare_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row compared with its edited text and with the next row.

    Rows stand by descending doc_id (null last, equal ids by the hashes of their
    texts, then by the texts); the first follows the last, and a single row follows
    itself.  Null texts count as empty; two empty texts are alike (1), one is unlike
    any other (0).
    Rows are sorted over range partitions, and each task compares neighbours; only
    the first and last row of every partition meet again in a second, small step.
    The ranges are cut by id, text hash and input position, so an id (or none) that
    many rows share, with equal or different texts, spreads over tasks.
    Writes the results (no texts but those) to the shared folder.
    """
    src = columns(docs, doc_id=doc_id, text=text)
    id_type = type_of(src, "doc_id")
    arrow_id = pa.schema([("doc_id", pa.string() if id_type == "string" else pa.int32() if id_type == "int" else pa.int64())]).field(0)
    names = [n for n, _, _ in RESULT]
    schema = pa.schema([("kind", pa.string()), ("part", pa.int32()), arrow_id, ("text", pa.string()),
                        *((n, t) for n, t, _ in RESULT)])

    def rows(kind: str, part: int, ids: list, texts: list | None = None, result: dict | None = None) -> pa.RecordBatch:
        n = len(ids)
        cols = [[kind] * n, [part] * n, ids, texts or [None] * n, *((result or {}).get(c, [None] * n) for c in names)]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    def walk(batches):
        from pyspark import TaskContext
        part, begun, last = TaskContext.get().partitionId(), False, None
        for ids, texts in _pieces(batches):
            if not ids:
                return
            if not begun:
                yield rows("head", part, ids[:1], texts[:1])
                begun = True
            if len(ids) > 1:
                yield rows("row", part, ids[:-1], result=compare(texts))
            last = ids[-1:], texts[-1:]
        yield rows("tail", part, *last)

    def close(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield rows("row", r["part"], [r["doc_id"]], result=compare([r["text"], r["following"]]))

    ddl = f"kind string, part int, doc_id {id_type}, text string, " + ", ".join(f"{n} {t}" for n, _, t in RESULT)
    ids = F.col("doc_id").desc_nulls_last()
    cuts = [ids, F.col("hash"), F.col("at")]  # rows equal in id and text may stand in any order
    walked = materialise(src.withColumns({"hash": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
                         .repartitionByRange(*cuts).sortWithinPartitions(ids, "hash", "text", "at").drop("hash", "at")
                         .mapInArrow(walk, ddl), "syncmers")
    heads = walked.where("kind = 'head'")
    parts = sorted(r["part"] for r in heads.select("part").collect())  # one row per partition
    following = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    ends = (walked.where("kind = 'tail'").select("part", "doc_id", "text").join(following, "part")
            .join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part")
            .select("part", "doc_id", "text", "following").mapInArrow(close, ddl))
    return walked.where("kind = 'row'").unionByName(ends).select("doc_id", *names)
