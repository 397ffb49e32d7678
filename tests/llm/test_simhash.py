"""SimHash: fingerprints, links and components against brute force; the method's parts."""

import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash

from tests.conftest import SF01, SF001
from tidewater.llm import queries
from tidewater.llm import simhash as sh
from tidewater.llm.components import components


def brute_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, edges):
    """{node: least node reachable}."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_groups(prints, distance=3):
    """{doc_id: component} of [(doc_id, fp)] by comparing all pairs of distinct prints."""
    fps = np.array(sorted({f for _, f in prints}), dtype=np.uint64)
    edges = []
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= distance)
        edges += [(int(fps[i]), int(fps[i + 1 + j])) for j in near]
    root = brute_components([int(f) for f in fps], edges)
    least = {}
    for d, f in prints:
        least[root[f]] = min(least.get(root[f], d), d)
    return {d: least[root[f]] for d, f in prints}


TEXTS = ["", " \t\n", "a", "One two", "one TWO three", "one two three four", "é\xa0b c d e f", "x " * 500, None, "\x1c a b c"]


def test_fingerprints_equal_brute_force():
    texts = [t or "" for t in TEXTS] + [" ".join(random.Random(i).choices(["a", "b", "Cd", "é"], k=i)) for i in range(60)]
    assert sh.fingerprints(texts).tolist() == [brute_print(t) for t in texts]


def near_set(rnd, n, spread):
    """Distinct fingerprints: random ones, and families that differ in few bits."""
    out = set()
    while len(out) < n:
        base = rnd.getrandbits(64)
        out.add(base)
        for _ in range(rnd.choice([0, 0, 3, 12])):
            f = base
            for b in rnd.sample(range(64), rnd.randint(1, spread)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


def as_frame(spark, fps):
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    return spark.createDataFrame([(f,) for f in signed], "fp bigint")


def check_links(spark, fps, found, distance):
    edges = [tuple(int(x) & (2 ** 64 - 1) for x in r) for r in found.collect()]
    assert all(0 < (a ^ b).bit_count() <= distance for a, b in edges)
    arr = np.array(fps, dtype=np.uint64)
    want = [(fps[i], fps[j]) for i in range(len(fps)) for j in (i + 1 + np.flatnonzero(
        np.bitwise_count(arr[i + 1:] ^ arr[i]) <= distance)).tolist()]
    assert brute_components(fps, edges) == brute_components(fps, want)
    return edges


def parts_of(thresholds):
    bounds = np.array_split(np.arange(64), len(thresholds))
    return [sh.Part(tuple(map(int, b)), t) for b, t in zip(bounds, thresholds) if t >= 0]


@pytest.mark.parametrize("thresholds", [(0, 0, 0, 0), (1, 0, 0), (1, 1), (2, 0), (1, 1, -1, -1), (2, -1, -1, 0)])
def test_links_for_every_allocation(spark, thresholds):
    fps = near_set(random.Random(str(thresholds)), 500, 5)
    check_links(spark, fps, sh.links(as_frame(spark, fps), parts=parts_of(thresholds)), 3)


def test_overfull_keys_are_split_exactly(spark):
    rnd = random.Random(9)
    fps = {rnd.getrandbits(20) << 44 | 0xABCDE for _ in range(150)} | {1 << b for b in range(40)} | {0}
    fps = sorted(fps | set(near_set(rnd, 100, 4)))
    for group in (2, 10):
        check_links(spark, fps, sh.links(as_frame(spark, fps), group=group, parts=parts_of((0, 0, 0, 0))), 3)
        check_links(spark, fps, sh.links(as_frame(spark, fps), group=group, parts=parts_of((1, 1))), 3)


def test_dense_groups_give_few_links(spark):
    rnd = random.Random(3)
    fps = set()
    while len(fps) < 1500:
        f = 0
        for b in rnd.sample(range(64), rnd.randint(0, 2)):
            f ^= 1 << b
        fps.add(f)
    edges = check_links(spark, sorted(fps), sh.links(as_frame(spark, sorted(fps))), 3)
    assert len(edges) < 40 * len(fps)


def test_other_distances(spark):
    fps = near_set(random.Random(5), 300, 7)
    for distance in (0, 1, 5, 12):
        check_links(spark, fps, sh.links(as_frame(spark, fps), distance=distance), distance)


def test_plan_spends_the_distance_and_prefers_cheap_partitions(spark):
    rnd = random.Random(4)
    # the low 16 bits hardly vary: probing there would pair nearly everything
    fps = sorted({rnd.getrandbits(48) << 16 | rnd.choice([0, 1]) for _ in range(2000)})
    parts = sh.plan(as_frame(spark, fps))
    assert sum(p.flips + 1 for p in parts) == 4
    bits = [b for p in parts for b in p.bits]
    assert len(bits) == len(set(bits))
    n, both = sh.bit_statistics(as_frame(spark, fps))
    assert n == len(fps) and both[0, 0] == sum(f & 1 for f in fps) and both[20, 33] == sum(f >> 20 & f >> 33 & 1 for f in fps)
    groups = [tuple(range(16)), tuple(range(16, 40)), tuple(range(40, 64))]
    cost, chosen = sh.allocate(n, np.full(64, 0.5), groups, sh.collisions(as_frame(spark, fps), groups), 3)
    brute = min((t for t in itertools.product(range(-1, 3), repeat=3) if sum(x + 1 for x in t) == 4),
                key=lambda t: brute_cost(n, groups, t, fps))
    assert tuple(p.flips for p in chosen) == brute and chosen[0].flips <= 0


def brute_cost(n, groups, thresholds, fps):
    total = 0.0
    for g, t in zip(groups, thresholds):
        if t >= 0:
            counts = np.unique([f & sum(1 << b for b in g) for f in fps], return_counts=True)[1]
            total += (counts * (counts - 1) / 2).sum() * sum(math.comb(len(g), r) for r in range(t + 1))
            total += sh.ROW_COST * n * sh.probes(len(g), t)
    return total


def test_correlated_bits_share_a_partition():
    rnd = np.random.default_rng(1)
    bits = rnd.integers(0, 2, (4000, 64))
    for b in range(1, 16):
        bits[:, b * 4] = np.where(rnd.random(4000) < 0.9, bits[:, 0], bits[:, b * 4])
    groups = sh.correlated_groups(4000, (bits.T @ bits).astype(float), 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and set(range(0, 64, 4)) in [set(g) for g in groups]


def test_components(spark):
    rnd = random.Random(6)
    path = [(i, i + 1) for i in range(300)]
    rnd.shuffle(path)
    edges = path + [(1000 + rnd.randrange(60), 1000 + rnd.randrange(60)) for _ in range(50)] + [(5000, i) for i in range(5001, 5200)]
    edges += [(7, 7), (9000, 9000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges + [(None, 3)], "a bigint, b bigint")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == brute_components(nodes, edges[:-2])


def test_rows_nulls_repeats_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(5, "a b c d e", "x"), (3, "A b c D e", "x"), (3, "A b c D e", "x"), (None, "a b c d e", "x"), (8, None, "x"),
            (7, "", "x"), (9, long, "x"), (2, long + " end", "x"), (None, "alone here it stands", "x")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, fp string, root int, key int")
    got = sorted(((r.doc_id, r.component_id) for r in sh.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (None, 3), (8, 7), (7, 7), (9, 2), (2, 2), (None, None)], key=str)
    kept = sh.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text and r.text[:5]) for r in kept.collect()), key=str) == sorted(
        [(3, "A b c"), (7, ""), (2, "w0 w1"), (None, "alone")], key=str)
    assert sh.near_duplicates(df.limit(0)).collect() == [] and sh.one_per_group(df.limit(0)).collect() == []


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = [(d.doc_id, brute_print(d.text)) for d in docs] if sf == SF001 else list(
        zip([d.doc_id for d in docs], sh.fingerprints([d.text or "" for d in docs]).tolist()))
    want = brute_groups(prints)
    rows = queries.op6_simhash(spark, sf).collect()
    assert {r.doc_id: r.component_id for r in rows} == want and len(rows) == len(docs)
    assert {r.doc_id: r.fingerprint for r in rows} == {d: format(f, "016x") for d, f in prints}
