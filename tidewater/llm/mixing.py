"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same fractional number of copies.
Its fraction is settled by pairing documents: a pair trades words so that one of
the two becomes whole and the words expected from both stay exactly the same.
Blocks of documents are reduced to one unsettled document each, and these meet
again in ever larger blocks, up to one per source.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import columns, materialise, type_of

#: The words of a text, and the default weights.
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Documents of a block on the lowest level, and blocks joined on each further one.
BLOCK = 2_000
FAN_IN = 1_000
CAP = 3


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint")


def ranked(sources: DataFrame) -> DataFrame:
    """Number the rows by source (code point order, null last) from 0, without
    bringing them together: range partitions, and the counts of those before."""
    spark = sources.sparkSession
    ordered = materialise(sources.repartitionByRange(F.col("source").asc_nulls_last())
                          .sortWithinPartitions(F.col("source").asc_nulls_last())
                          .withColumn("_at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("_at", 33)
    before, offsets = 0, []
    for r in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row per partition
        offsets.append((r["part"], before))
        before += r["count"]
    table = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    return (ordered.withColumn("_part", part).join(F.broadcast(table), "_part")
            .withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_before", "_at"))


def targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, n_docs, rank, target) from (source, size) rows.

    Sources share the sum of all sizes by weight; no target exceeds ``cap`` times
    its source's size, and what is cut off is shared again among the others by
    weight.  Every round is one sum over the sources; the set of capped sources
    only grows, and the loop ends when it no longer does.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    src = materialise(ranked(totals).withColumn("weight", weight), "mix-weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.lit(cap) * F.col("source_size")
        row = src.agg(F.count(F.when(over, 1)).alias("n"),
                      F.sum(F.when(over, F.lit(cap) * F.col("source_size"))).alias("fixed"),
                      F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (total - (row["fixed"] or 0)) / row["open"]
    return src.withColumn("target", F.least(F.col("weight") * F.lit(level),
                                            F.lit(float(cap)) * F.col("source_size"))).drop("weight")


def trade(size_i, p_i, size_j, p_j, draw: np.random.Generator):
    """Settle one of each pair (i, j): either i gains all it can from j or loses
    all it can to it, the chances being such that no expectation changes."""
    need, give = size_i * (1 - p_i), size_i * p_i
    have, room = size_j * p_j, size_j * (1 - p_j)
    gain, loss = np.minimum(need, have), np.minimum(give, room)
    up = draw.random(len(size_i)) * (gain + loss) < loss
    new_i = np.where(up, np.where(need <= have, 1.0, p_i + gain / size_i), np.where(give <= room, 0.0, p_i - loss / size_i))
    new_j = np.where(up, np.where(need <= have, p_j - gain / size_j, 0.0), np.where(give <= room, p_j + loss / size_j, 1.0))
    return snap(new_i), snap(new_j)


def snap(p: np.ndarray) -> np.ndarray:
    """Rounding errors must not keep a settled fraction alive."""
    return np.where(p < 1e-12, 0.0, np.where(p > 1 - 1e-12, 1.0, p))


def settle(size: np.ndarray, p: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, int]:
    """Settle fractional copies ``p`` of documents of ``size`` words, all but one
    at most; returns the new p and the place of the unsettled one (or -1).

    Documents of like size (powers of two) are settled together, the largest
    first: neighbours are paired, and who is still fractional meets the next such
    one, tree-wise.  The one left over then trades with the next smaller class as
    a whole, so that what remains in the end is a small document.
    """
    p = p.copy()
    live = np.flatnonzero((p > 0) & (p < 1))
    kind = np.floor(np.log2(np.maximum(size[live], 1)))
    left = -1
    for k in sorted(set(kind.tolist()), reverse=True):
        at = live[kind == k]
        if left >= 0:
            have, room = size[at] @ p[at], size[at] @ (1 - p[at])
            one, all_of = trade(size[[left]], p[[left]], np.array([have + room]), np.array([have / (have + room)]), draw)
            share = all_of[0] * (have + room)  # words expected of the class from now on
            p[at] = snap(p[at] * (share / have) if share <= have else 1 - (1 - p[at]) * ((have + room - share) / room))
            p[left] = one[0]
            left = left if 0 < p[left] < 1 else -1
        at = at[(p[at] > 0) & (p[at] < 1)]
        while len(at) > 1:
            odd = at[-1:] if len(at) % 2 else at[:0]
            i, j = at[0:len(at) - len(odd):2], at[1:len(at):2]
            p[i], p[j] = trade(size[i], p[i], size[j], p[j], draw)
            at = np.concatenate([np.stack([i, j], axis=1).ravel(), odd])
            at = at[(p[at] > 0) & (p[at] < 1)]
        if len(at):
            left = int(at[0])
    return p, left


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, seed: int = 42, block: int = BLOCK,
        fan_in: int = FAN_IN, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, digest), one row per
    input row; digest is a 64-bit hash of the text.

    size: words of the text (null: 0); copies: whole copies that the mix takes,
    the floor or ceiling of target / source_size; taken = copies * size, whose sum
    over a source misses its target by less than its last unsettled, small document.
    Documents without words carry nothing and get the floor.  A null source is a
    source of its own, the last; null and repeated doc_ids are rows like others;
    no rows in, no rows out.  The same rows and seed give the same result however
    they are partitioned.  Writes small tables (no texts) to the shared folder.
    """
    src = columns(docs, doc_id=doc_id, source=source, text=text).select(
        "doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("digest"))
    # Equal rows are counted and numbered, so blocks stay even however many there are.
    sizes = materialise(src.groupBy(*src.columns).agg(F.count(F.lit(1)).alias("rows"))
                        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows"), "mix-sizes")
    aims = targets(sizes, weights, cap)
    x = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    whole = F.floor(x + F.lit(1e-12))
    part = F.greatest(x - whole, F.lit(0.0))
    blocks = F.greatest(F.ceil(F.col("n_docs") / F.lit(block)), F.lit(1))
    rows = (sizes.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
            .select("doc_id", "source", "size", "source_size", "target", F.col("rank").alias("src"),
                    F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "size", "digest", "nth").alias("h"), "digest",
                    whole.cast("int").alias("copies"),
                    F.when((F.col("size") > 0) & (part > 1e-12), part).otherwise(F.lit(0.0)).alias("p"), blocks.alias("blocks")))
    rows = rows.withColumn("block", F.pmod("h", "blocks")).drop("blocks")
    schema = (f"doc_id {type_of(src, 'doc_id')}, source {type_of(src, 'source')}, size bigint, source_size bigint, "
              "target double, src bigint, h bigint, digest bigint, copies int, p double, block bigint")

    def level(df: DataFrame, number: int, last: bool) -> DataFrame:
        def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values(["h", "size"], kind="stable")
            draw = np.random.Generator(np.random.Philox(
                zlib.crc32(repr((seed, number, *map(int, key))).encode())))
            p, left = settle(g["size"].to_numpy(float), g["p"].to_numpy(float), draw)
            if last and left >= 0:
                p[left] = float(draw.random() < p[left])
            if left < 0 or last:
                done = np.ones(len(g), dtype=bool)
            else:
                done = np.arange(len(g)) != left
            return g.assign(copies=g["copies"].to_numpy() + np.where(done, p, 0).astype(np.int32),
                            p=np.where(done, -1.0, p))  # a negative p: settled
        return materialise(df.groupBy("src", "block").applyInPandas(run, schema), f"mix-level{number}")

    most = aims.agg(F.max(F.ceil(F.col("n_docs") / F.lit(block)))).first()[0] or 1
    out, number = [], 0
    while True:
        settled = level(rows, number, most <= 1)
        out.append(settled.where("p < 0"))
        if most <= 1:
            break
        rows = settled.where("p >= 0").withColumn("block", F.floor(F.col("block") / F.lit(fan_in)))
        most, number = -(-most // fan_in), number + 1
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.select("doc_id", "source", "size", "source_size", "target", "copies",
                         (F.col("copies") * F.col("size")).alias("taken"), "digest")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` takes it.  Columns stay
    as they are, whatever they are called.

    Rows are matched to their copies by doc_id, source, size and text; texts move
    once at most.  Of rows equal in all four each gets the whole part of its share, and
    some one more, in any order.
    """
    from pyspark.sql import Window
    key = ["doc_id", "source", "size", "digest"]
    found = (mix(docs, **options).groupBy(*key).agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("rows"))
             .where("total > 0").select(*(F.col(c).alias(f"mix_{c}") for c in key), "total", "rows"))
    rows = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("digest"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"mix_{c}"))
    taken = rows.join(found, same)
    one = taken.where("rows = 1").select("row", F.col("total").alias("n"))
    at = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    more = taken.where("rows > 1").withColumn("at", at).select(
        "row", (F.floor(F.col("total") / F.col("rows")) + F.when(F.col("at") <= F.col("total") % F.col("rows"), 1).otherwise(0)).alias("n"))
    return (one.unionByName(more).where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
            .select("row.*"))
