"""Connected components by alternating stars, on Spark tables alone.

Each round links every node to the smallest node it knows of ("large star": a
node's larger neighbours to its smallest one; "small star": its smaller
neighbours to the smallest), until nothing changes; then each edge leads from a
node to the smallest of its component.  Rounds are cut by checkpoints in the
shared folder; only one count and one sum of each round reach the driver.  The
smallest neighbour is a grouped minimum (combined before the shuffle), and it
meets the edges in a join whose skewed keys Spark can split, so a node with a
great many neighbours is no single task.  A round is half a dozen shuffles, so a
small graph's go in as many tasks as its edges need, not as a shuffle has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Edges that a task of a round takes, about.
EDGES = 50_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _few(df: DataFrame, edges: int) -> DataFrame:
    """``df`` in no more tasks than so many edges need, or the cluster has cores."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-edges // EDGES)))


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """Edges (u, v) with u > v after one star step on ``n`` edges."""
    edges = _few(edges, n)
    if large:
        arcs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = edges
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = arcs.join(least, "u")
    if large:  # larger neighbours go to the least of all, the node itself included
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours go to the least of them
        out = joined.select("v", "m").union(least.select(F.col("u").alias("v"), "m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _few(_few(out.where("u <> v"), n).distinct(), n)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns u, v) but the roots themselves.

    Rounds end when nothing changes: their number grows with the logarithm of the longest path.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = cut(pairs)
    before = _state(pairs)
    while before[0]:
        pairs = cut(_star(_star(pairs, True, before[0]), False, before[0]))
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
