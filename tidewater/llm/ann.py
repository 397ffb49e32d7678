"""Approximate nearest neighbours by adaptive dimension scans.

Vectors are rotated at random, so that the distance over the first few dimensions
estimates the whole one.  Rows lie in inverted lists, in blocks; a task scans a
block column by column, and after each column block a hypothesis test abandons the
candidates whose partial distance is already too large to be among the nearest.
What survives is measured exactly on the original vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import columns, materialise

#: The bound of the sample the index is fitted on, and of the centres of one level.
#: There are as many lists as the square root of the rows; beyond one level's centres
#: a second level of centres, of what the first leaves over, cuts every list further.
SAMPLE_ROWS = 20_000
LEVEL = 1_024
#: Share of the sample's own neighbours that the probed lists must hold.
COVER = 0.97
SAMPLE_QUERIES = 300
#: Rows of a block, and queries that one task answers on it.
BLOCK = 8_192
QUERY_BLOCK = 4_096
#: Dimensions of a column block, and the test's strictness.
COLUMNS = 16
EPSILON = 2.1
#: Distances held at once.
CELLS = 1 << 21


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b (in blocks of a, by callers)."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, CELLS // len(centres))
    return np.concatenate([squared(x[i:i + step], centres).argmin(1) for i in range(0, len(x), step)]
                          or [np.zeros(0, dtype=np.int64)])


@dataclass(frozen=True)
class Index:
    """Rotation, centres of both levels (in original coordinates; a list is a pair of
    them) and the lists to probe."""

    rotation: np.ndarray
    centres: np.ndarray
    finer: np.ndarray
    probes: int

    @property
    def lists(self) -> int:
        return len(self.centres) * len(self.finer)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The list of every row."""
        own = nearest_centre(x, self.centres)
        return own * len(self.finer) + nearest_centre(x - self.centres[own], self.finer)

    def order(self, query: np.ndarray) -> np.ndarray:
        """All lists, nearest first."""
        return np.argsort(squared(query - self.centres, self.finer).ravel(), kind="stable")


def k_means(points: np.ndarray, n: int, draw: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Centres, to begin with distinct points."""
    centres = points[draw.choice(len(points), n, replace=False)]
    for _ in range(rounds):
        own = nearest_centre(points, centres)
        count = np.bincount(own, minlength=n)
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def fit(sample: np.ndarray, rows: int, k: int, seed: int = 11, level: int = LEVEL) -> Index:
    """Random rotation, k-means centres and the probes that cover the neighbours of
    sample rows within the sample."""
    draw = np.random.default_rng(seed)
    dims = sample.shape[1]
    q, r = np.linalg.qr(draw.normal(size=(dims, dims)))
    rotation = q * np.sign(np.diag(r))
    points = np.unique(sample, axis=0)
    wanted, most = max(1, int(math.sqrt(rows))), max(1, len(points) // 8)
    centres = k_means(points, min(level, wanted, most), draw)
    finer = np.zeros((1, dims))
    if wanted > level:
        rest = np.unique(points - centres[nearest_centre(points, centres)], axis=0)
        finer = k_means(rest, min(-(-wanted // level), level, max(1, len(rest) // 8)), draw)
    index = Index(rotation, centres, finer, 1)
    own = index.place(points)
    at = draw.choice(len(points), min(SAMPLE_QUERIES, len(points)), replace=False)
    needed = []
    for i in at.tolist():
        far = squared(points[i:i + 1], points)[0]
        far[i] = np.inf
        nth = np.empty(index.lists, dtype=np.int64)
        nth[index.order(points[i])] = np.arange(1, index.lists + 1)
        needed += nth[own[np.argsort(far)[:k]]].tolist()
    needed.sort()
    probes = needed[min(len(needed) - 1, math.ceil(COVER * len(needed)))] if needed else 1
    return Index(rotation, centres, finer, probes)


def scan_block(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, rotation: np.ndarray, k: int,
               epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, place in the block, distance) of each query's ``k`` nearest
    rows of a block, ties to the smaller id."""
    dims = x.shape[1]
    xr, qr = (x @ rotation), (queries @ rotation)
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, CELLS // max(len(x), 1))
    for a in range(0, len(queries), step):
        q, r = queries[a:a + step], qr[a:a + step]
        first = min(COLUMNS, dims)
        part = squared(r[:, :first], xr[:, :first])
        if len(x) > k:
            # a distance that k rows of the block are known to keep within
            pick = np.argpartition(part, k - 1, axis=1)[:, :k]
            bound = ((x[pick] - q[:, None, :]) ** 2).sum(2).max(1)
        else:
            bound = np.full(len(q), np.inf)
        scale = float((x * x).sum(1).max() + (q * q).sum(1).max()) * 1e-12 + 1e-300

        def limit(d: int, who):
            return bound[who] * (d / dims) * (1 + epsilon / math.sqrt(d)) ** 2 + scale

        qi, xi = np.nonzero(part <= limit(first, slice(None))[:, None])
        held = part[qi, xi]
        for b in range(first, dims, COLUMNS):
            e = min(b + COLUMNS, dims)
            held = held + ((xr[xi, b:e] - r[qi, b:e]) ** 2).sum(1)
            keep = held <= limit(e, qi) if e < dims else held <= bound[qi] * (1 + 1e-9) + scale
            qi, xi, held = qi[keep], xi[keep], held[keep]
        exact = np.sqrt(((x[xi] - q[qi]) ** 2).sum(1))
        order = np.lexsort((ids[xi], exact, qi))
        qi, xi, exact = qi[order], xi[order], exact[order]
        nth = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
        top = nth < k
        out.append((qi[top] + a, xi[top], exact[top]))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows that take part, as (vec_id, vec array<double>), and their dimension."""
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = (vectors.withColumn("vec", F.col("vec").cast("array<double>")).where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
            .where(finite & F.exists("vec", lambda v: v != 0)))
    most = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = most["dims"] if most else 0
    return rows.where(F.size("vec") == dims), dims


def search(vectors: DataFrame, is_query, k: int = 10, sample_rows: int = SAMPLE_ROWS, block: int = BLOCK,
           query_block: int = QUERY_BLOCK, level: int = LEVEL, vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row
    that the condition ``is_query`` (on vec_id) picks, all rows but those with the
    query's own vec_id being candidates; score is the Euclidean distance in double
    precision, ties go to the smaller vec_id.

    Left out are rows without vec_id, and vectors that are null, zero, hold null or
    non-finite components, or differ in dimension from most.  Of rows with one
    vector only the ``k`` + 1 with the smallest ids are candidates: the others tie
    with them and come after them for every query, so this loses nothing.  Equal
    queries are answered once.  Rows that repeat id and vector count once; if a
    query's id stands for several vectors, the least vector is searched.

    The index is fitted on at most about ``sample_rows`` rows; every row is indexed.
    A list goes out in blocks of about ``block`` rows, and once for every
    ``query_block`` queries that ask for it.
    """
    spark = vectors.sparkSession
    rows, dims = usable(columns(vectors, vec_id=vec_id, vec=embedding))
    rows = rows.dropDuplicates(["vec_id", "vec"])
    out = "query_id bigint, rank int, vec_id bigint, score double"
    same = Window.partitionBy("vec").orderBy("vec_id")
    points = materialise(rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth"), "ann-points")
    asked = materialise(rows.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec")), "ann-asked")
    count = points.count()
    if not count:
        return spark.createDataFrame([], out)
    most = 1 << 30
    share = min(1.0, sample_rows / count) * most
    picked = points.where(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(most)) < F.lit(share)).orderBy("vec_id", "vec")
    sample = np.array([r["vec"] for r in picked.select("vec").collect()], dtype=np.float64).reshape(-1, dims)
    if not len(sample):
        sample = np.array([points.orderBy("vec_id", "vec").first()["vec"]])
    index = spark.sparkContext.broadcast(fit(sample, count, k, level=level))

    def assign(batches):
        for batch in batches:
            own = index.value.place(matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=["vec_id", "vec", "list"])

    def per_list(lists: DataFrame) -> np.ndarray:
        out = np.zeros(index.value.lists, dtype=np.int64)
        for r in lists.groupBy("list").count().collect():  # a row per list
            out[r["list"]] = r["count"]
        return out

    listed = materialise(points.mapInArrow(assign, "vec_id bigint, vec array<double>, list int"), "ann-lists")
    sizes = spark.sparkContext.broadcast(per_list(listed))

    def probe(batches):
        for batch in batches:
            q = matrix(batch.column(0), dims)
            chosen = []
            for i in range(len(q)):
                order = index.value.order(q[i])
                enough = int(np.searchsorted(np.cumsum(sizes.value[order]), k + 1)) + 1
                near = order[:max(index.value.probes, enough)]
                chosen.append(near[sizes.value[near] > 0].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, type=pa.list_(pa.int32()))],
                                             names=["vec", "rep", "lists"])

    reps = asked.groupBy("vec").agg(F.min("vec_id").alias("rep"))
    probed = materialise(reps.repartition(F.col("rep")).mapInArrow(probe, "vec array<double>, rep bigint, lists array<int>"), "ann-probes")
    asking = per_list(probed.select(F.explode("lists").alias("list")))
    # a list's blocks of rows, and its parts of queries
    split = spark.sparkContext.broadcast((np.maximum(-(-sizes.value // block), 1), -(-asking // query_block)))

    def send_rows(batches):
        blocks, parts = split.value
        for batch in batches:
            at, mix = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            slot = pa.array((mix.view(np.uint64) % blocks[at].astype(np.uint64)).astype(np.int32))
            for part in range(int(parts[at].max(initial=0))):
                go = np.flatnonzero(parts[at] > part)
                rows = pa.RecordBatch.from_arrays([*batch.columns[:3], slot], names=["vec_id", "vec", "list", "slot"]).take(pa.array(go))
                yield rows.append_column("part", pa.array(np.full(len(go), part, dtype=np.int32)))

    def send_queries(batches):
        blocks, parts = split.value
        for batch in batches:
            rep = batch.column(1).to_numpy(zero_copy_only=False)
            mix = rep.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            for i in range(batch.num_rows):
                chosen = np.asarray(batch.column(2)[i].as_py(), dtype=np.int64)
                at = np.repeat(chosen, blocks[chosen])
                slot = np.concatenate([np.arange(b) for b in blocks[chosen]])
                one = batch.slice(i, 1).take(pa.array(np.zeros(len(at), dtype=np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(slot.astype(np.int32)),
                     pa.array((mix[i] % parts[at].astype(np.uint64)).astype(np.int32)), one.column(1), one.column(0)],
                    names=["list", "slot", "part", "rep", "vec"])

    asks = probed.mapInArrow(send_queries, "list int, slot int, part int, rep bigint, vec array<double>")
    held = (listed.select("vec_id", "vec", "list", F.xxhash64("vec_id", "vec").alias("mix"))
            .mapInArrow(send_rows, "vec_id bigint, vec array<double>, list int, slot int, part int"))
    key = ["list", "slot", "part"]
    answer = pa.schema([("rep", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def answer_block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return answer.empty_table()
        ids, rep = left["vec_id"].to_numpy(), right["rep"].to_numpy()
        qi, xi, score = scan_block(ids, matrix(left["vec"], dims), matrix(right["vec"], dims), index.value.rotation, k + 1)
        return pa.table([pa.array(rep[qi]), pa.array(ids[xi]), pa.array(score)], schema=answer)

    found = held.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(answer_block, "rep bigint, vec_id bigint, score double")
    best = Window.partitionBy("rep").orderBy("score", "vec_id")
    found = materialise(found.distinct().withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth"), "ann-found")
    named = asked.join(probed.select("vec", "rep"), "vec").select(F.col("vec_id").alias("query_id"), "rep")
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (named.join(found, "rep").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
