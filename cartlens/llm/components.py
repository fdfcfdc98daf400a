"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (larger ones, or the others with itself) point to its smallest one.

    Minima are combined in each task before the shuffle, and the join back is an ordinary
    one, so a node with very many neighbours is never gathered in one place.
    """
    if large:
        out = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        out = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = out.groupBy("u").agg(F.min("v").alias("m"))
    joined = out.join(smallest, "u").withColumn("m", F.least("u", "m"))
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(smallest.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node with an edge; the root is the smallest node that can be reached.

    edges: u, v (comparable, not null). Each round is written to the shared folder; the number of
    rounds grows with the logarithm of the number of nodes. No edges give no rows.
    """
    state = materialize(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "edges")

    def mark(df: DataFrame):
        h = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(h)).first())

    before = mark(state)
    while before[0]:
        state = materialize(_star(_star(state, large=True), large=False), "edges")
        after = mark(state)
        if after == before:
            break
        before = after
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
