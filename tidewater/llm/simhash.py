"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints (64 bits) are cut into partitions of correlated bits.  If the
thresholds of the partitions, each plus one, add up to the maximum distance plus
one, then two fingerprints within that distance differ by at most its threshold in
some partition.  Thresholds are chosen by dynamic programming on estimated
candidate counts; partition values within the threshold are probed, and every
candidate is verified on all bits.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import chunks, columns, id_column, materialise, type_of
from tidewater.llm.components import components

BITS = 64
SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Numbers of partitions to choose from, and the largest threshold of one.
PARTITIONS = (2, 3, 4)
MOST_FLIPS = 2
#: Fingerprints under one key that a task compares directly; keys with more are
#: split by further bits.
GROUP = 8_192
#: Cost of a key row, in candidate comparisons.
ROW_COST = 20.0

_MIX = np.uint64(0x9E3779B97F4A7C15)


def text_hashes(text: str, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of words (one shingle if there are fewer words)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(line, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]


def fingerprints(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """A bit is set if more than half of the text's shingle hashes have it set."""
    hashes = [text_hashes(t, shingle) for t in texts]
    out = np.zeros(len(texts), dtype=np.uint64)
    sizes = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))
    some = np.flatnonzero(sizes)
    if len(some):
        flat = np.array([h for hs in hashes for h in hs], dtype=np.uint64)
        starts = (np.cumsum(sizes) - sizes)[some]
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_ = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * set_ > sizes[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint_documents(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row's whole text; fp holds the 64 bits as a signed
    long.  A null text has no words, and a text without words has fingerprint 0."""
    src = columns(docs, doc_id=doc_id, text=text)

    def run(batches):
        for piece, texts in chunks(batches, size=1 << 20):
            fp = fingerprints([t or "" for t in texts], shingle)
            yield pa.RecordBatch.from_arrays([id_column(piece), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, fp bigint")


@dataclass(frozen=True)
class Part:
    """A partition: its bits, and how many of them a probe may flip (-1: unused)."""

    bits: tuple[int, ...]
    flips: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for every two bits how many have both set."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits = np.unpackbits(fp.copy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(fp)
        cell = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS + 1)
    for r in rows:  # as many as there are pairs of bits
        out[r["cell"]] = r["n"]
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Equal groups of bits, each grown from the two most correlated bits left by
    the bit that correlates most with the group."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, -1)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        if k == parts - 1:
            out.append(tuple(left))
            break
        sub = corr[np.ix_(left, left)]
        i, j = np.unravel_index(np.argmax(sub), sub.shape)
        group = [left[i], left[j]]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(rest[int(np.argmax(corr[np.ix_(group, rest)].sum(axis=0)))])
        out.append(tuple(sorted(group)))
        left = [b for b in left if b not in group]
    return out


def collisions(fps: DataFrame, groups: list[tuple[int, ...]]) -> list[float]:
    """For each group of bits, the pairs of fingerprints that agree on all of them."""
    masks = [sum(1 << b for b in g) for g in groups]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    values = F.explode(F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
                                 for i, m in enumerate(signed)))).alias("x")
    n = F.col("count").cast("double")
    rows = (fps.select(values).groupBy("x.part", "x.value").count().groupBy("part")
            .agg(F.sum(n * (n - 1) / 2).alias("pairs")).collect())  # a row per group of bits
    found = {r["part"]: r["pairs"] for r in rows}
    return [found.get(i, 0.0) for i in range(len(groups))]


def probes(width: int, flips: int) -> float:
    """Key rows of a fingerprint: its own value, and half of the flipped ones."""
    return 0.0 if flips < 0 else 1 + sum(math.comb(width, r) for r in range(1, flips + 1)) / 2


def allocate(n: int, agree: np.ndarray, groups: list[tuple[int, ...]], pairs: list[float],
             distance: int) -> tuple[float, list[Part]]:
    """Thresholds that add up (each plus one) to ``distance`` + 1 at the least cost.

    A partition with threshold t costs its key rows and its candidates, estimated
    from the pairs that agree on all its bits: each further bit that may differ
    multiplies them by the ways to choose it and the odds that it differs.  Dynamic
    programming over the partitions and the sum still to be spent.
    """
    def cost(i: int, flips: int) -> float:
        if flips < 0:
            return 0.0
        width = len(groups[i])
        q = min(max(float(np.mean(agree[list(groups[i])])), 0.5), 1 - 1e-9)
        candidates = pairs[i] * sum(math.comb(width, r) * ((1 - q) / q) ** r for r in range(flips + 1))
        return candidates + ROW_COST * n * probes(width, flips)

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(groups)):
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for flips in range(-1, MOST_FLIPS + 1):
                key, value = spent + flips + 1, total + cost(i, flips)
                if key <= distance + 1 and (key not in new or value < new[key][0]):
                    new[key] = (value, [*chosen, flips])
        best = new
    if distance + 1 not in best:
        return math.inf, []
    total, chosen = best[distance + 1]
    return total, [Part(g, f) for g, f in zip(groups, chosen)]


def plan(fps: DataFrame, distance: int = MAX_BITS) -> list[Part]:
    """Partitions and thresholds for these fingerprints, from statistics of all."""
    n, both = bit_statistics(fps)
    p = np.diag(both) / max(n, 1)
    schemes = [correlated_groups(n, both, m) for m in PARTITIONS]
    pairs = collisions(fps, [g for s in schemes for g in s])
    options, at = [], 0
    for s in schemes:
        options.append(allocate(n, p ** 2 + (1 - p) ** 2, s, pairs[at:at + len(s)], distance))
        at += len(s)
    if min(o[0] for o in options) == math.inf:  # larger distances need more partitions
        groups = correlated_groups(n, both, distance + 1)
        return [Part(g, 0) for g in groups]
    return [p for p in min(options, key=lambda o: o[0])[1] if p.flips >= 0]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(31)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def key_rows(fp: np.ndarray, path: int, mask: int, bits: tuple[int, ...], flips: int):
    """(key, fp, probe) of one partition: each fingerprint under its own value, and
    as a probe under the values with up to ``flips`` bits flipped.  Of two values
    that differ in a set of bits only the one with the lowest of them set probes."""
    salt = np.uint64((path * 0x94D049BB133111EB) & (2 ** 64 - 1))
    value = fp & np.uint64(mask)
    yield _scramble(value ^ salt), fp, np.zeros(len(fp), dtype=bool)
    for r in range(1, flips + 1):
        for chosen in itertools.combinations(bits, r):
            on = (fp >> np.uint64(chosen[0])) & np.uint64(1) == 1
            flip = np.uint64(sum(1 << b for b in chosen))
            yield _scramble((value[on] ^ flip) ^ salt), fp[on], np.ones(int(on.sum()), dtype=bool)


KEYS = "key bigint, fp bigint, probe boolean, unused bigint"


def _key_batch(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, unused: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(probe),
         pa.array(np.full(len(fp), unused, dtype=np.uint64).view(np.int64))], names=["key", "fp", "probe", "unused"])


def probe_keys(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """The key rows of all partitions; ``unused`` are the bits outside the partition."""
    full = (1 << BITS) - 1

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, part in enumerate(parts):
                for key, own, probe in key_rows(fp, i + 1, part.mask, part.bits, part.flips):
                    if len(own):
                        yield _key_batch(key, own, probe, full & ~part.mask)

    return fps.select("fp").mapInArrow(run, KEYS)


def split_keys(rows: DataFrame, distance: int) -> DataFrame:
    """Rows of overfull keys under finer ones.  Two of them differ by at most
    ``distance`` of the bits not used so far, so if those are cut into one group
    more, some group agrees; each row goes under its key and the value of each group."""

    def run(batches):
        for batch in batches:
            key, fp, unused = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1, 3))
            probe = np.asarray(batch.column(2).to_pylist(), dtype=bool)
            for mask in np.unique(unused):
                at = np.flatnonzero(unused == mask)
                bits = [b for b in range(BITS) if int(mask) >> b & 1]
                for j, group in enumerate(np.array_split(np.array(bits), distance + 1)):
                    use = sum(1 << int(b) for b in group)
                    salt = np.uint64(((j + 1) * 0x94D049BB133111EB) & (2 ** 64 - 1))
                    new = _scramble(_scramble(key[at] ^ salt) ^ (fp[at] & np.uint64(use)))
                    yield _key_batch(new, fp[at], probe[at], int(mask) & ~use)

    return rows.mapInArrow(run, KEYS)


def linked(fp: np.ndarray, probe: np.ndarray, start: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places within ``distance`` bits under one key, enough to connect all
    that are linked: ``start`` numbers the rows' groups, in order.  All groups
    advance together: first neighbours, then rows two apart, and so on; a pair whose
    ends are already connected adds nothing."""
    out = []
    root = np.arange(len(fp))
    size = np.bincount(start)[start] if len(start) else start
    first = np.concatenate([[True], start[1:] != start[:-1]]) if len(start) else np.zeros(0, dtype=bool)
    nth = np.arange(len(fp)) - np.maximum.accumulate(np.where(first, np.arange(len(fp)), 0))
    lag = 1
    live = np.flatnonzero(size > 1)
    while True:
        live = live[nth[live] + lag < size[live]]
        if not len(live):
            return out
        a, b = live, live + lag
        near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        near &= ~(probe[a] & probe[b]) & (root[a] != root[b])
        if near.any():
            a, b = a[near], b[near]
            out.append((a, b))
            _connect(root, a, b)
        lag += 1


def _connect(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all rows that pairs (a, b) connect the same, least root."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            jump = root[root]
            if (jump == root).all():
                break
            root[:] = jump


def compare_groups(rows: DataFrame, distance: int) -> DataFrame:
    """(u, v): links between fingerprints that share a key, enough to connect them."""
    ready = rows.select("key", "fp", "probe").repartition("key").sortWithinPartitions("key", "fp")

    def run(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                key, fp = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
                probe = np.asarray(batch.column(2).to_pylist(), dtype=bool)
                if held is not None:
                    key, fp, probe = (np.concatenate(x) for x in zip(held, (key, fp, probe)))
                stop = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1:], side="left")[0]) if len(key) else 0
                held = key[stop:], fp[stop:], probe[stop:]  # the last key may go on in the next batch
                key, fp, probe = key[:stop], fp[:stop], probe[:stop]
            elif held is not None:
                key, fp, probe = held
            else:
                return
            if not len(key):
                continue
            number = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
            for a, b in linked(fp, probe, number, distance):
                yield pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], names=["u", "v"])

    return ready.mapInArrow(run, "u bigint, v bigint")


def links(fps: DataFrame, distance: int = MAX_BITS, group: int = GROUP, parts: list[Part] | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` at most ``distance`` bits
    apart: all verified, and enough to connect whatever such links connect.

    Keys that hold more than ``group`` rows are split by the values of further bits,
    again and again, until hardly any bit is left (as fingerprints are distinct, few
    can then share a key).  No candidate is dropped.
    """
    splittable = F.bit_count(F.max("unused")) > 2 * (distance + 1)
    parts = plan(fps, distance) if parts is None else parts
    rows, ready = materialise(probe_keys(fps, parts), "keys"), []
    while True:
        crowded = materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), splittable.alias("more"))
                              .where((F.col("n") > group) & F.col("more")).select("key"), "crowded")
        if crowded.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(crowded, "key", "left_anti"))
        rows = materialise(split_keys(rows.join(crowded, "key", "left_semi")
                                      .select("key", "fp", "probe", "unused"), distance), "keys")
    out = compare_groups(ready[0], distance)
    for more in ready[1:]:
        out = out.union(compare_groups(more, distance))
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_BITS, group: int = GROUP,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the least doc_id of
    all rows reachable over links of at most ``distance`` differing bits.

    Equal fingerprints are one node, so copies cost one row each.  Null and empty
    texts have fingerprint 0 and are linked like others; a null doc_id never is the
    least, and a component without any id has a null component_id; repeated rows
    stay; no rows in, no rows out.  Writes small tables to the shared folder.
    """
    prints = materialise(fingerprint_documents(docs, shingle, doc_id, text), "prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), distance, group))
    named = materialise(nodes.join(roots, F.col("fp") == F.col("node"), "left")
                        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    least = materialise(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    by_print = materialise(named.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the least
    doc_id (rows without an id come last, by a digest of the text); rows equal in
    doc_id and text count once.  Columns stay as they are, whatever they are called.

    Groups are found on digests of the texts, so rows without an id are grouped like
    others; texts move once, and a row that many others equal is combined before it does.
    """
    digest = F.md5(F.coalesce("text", F.lit(""))).alias("digest")
    groups = near_duplicates(docs.select(digest.alias("doc_id"), F.col("text").alias("text")), shingle, distance)
    of_text = groups.groupBy(F.col("doc_id").alias("digest")).agg(F.min("component_id").alias("group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    best = (docs.select("doc_id", digest).join(of_text, "digest").groupBy("group").agg(F.min(order).alias("best"))
            .select(F.col("best.doc_id").alias("best_id"), F.col("best.digest").alias("best_digest")))
    rows = docs.select("doc_id", digest, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = rows.join(best, F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("digest") == F.col("best_digest")), "left_semi")
    return kept.groupBy("doc_id", "digest").agg(F.first("row").alias("row")).select("row.*")
