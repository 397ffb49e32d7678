"""Connected components of a graph given as edges, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are joined to the least node it sees."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star")
    return (both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are joined to the least of these."""
    least = materialise(edges.groupBy("v").agg(F.min("u").alias("m")), "star")
    moved = edges.join(least, "v").select("v", "u", "m")
    return (moved.where("u != m").select(F.col("m").alias("u"), F.col("u").alias("v"))
            .union(least.select(F.col("m").alias("u"), "v")).where("u < v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node of its
    component.

    ``edges`` has two columns of one ordered type; direction, repeats and loops do
    not matter, null ends are left out.  A round is two joins; the edges only ever
    move to smaller ends, and the loop stops when a round changes nothing, after
    about as many rounds as the logarithm of the longest path.  Rounds are written
    to the shared folder; a node that many edges share is a skewed join key, which
    the join splits, and never a collected group.
    """
    a, b = (F.col(c) for c in edges.columns)
    edges = materialise(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
                        .where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "edges")

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        new = state(edges)
        if new == now:
            break
        now = new
    return (edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
            .union(edges.select(F.col("u"), F.col("u")).distinct()))
