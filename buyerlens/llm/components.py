"""Connected components by alternating star contractions.

Each round makes every node point to its smallest neighbour (large star: neighbours above the node; small
star: neighbours below it), which ends in stars around the smallest node of each component after about
log(n) rounds (Kiveris et al., "Connected components in MapReduce and beyond", 2014). Rounds are written
to the shared folder, so lineage stays short; only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from buyerlens.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (a, b) rows with a > b; gives such rows again."""
    if large:
        near = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        near = edges.toDF("u", "v")
    # Written, so that the join below reads two plain tables and adaptive execution can split a hub.
    near = written(near, "star-edges")
    least = written(
        near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")),
        "star-least",
    )
    met = near.join(least, near["u"] == least["w"])
    # Large: neighbours above u go to the least. Small: all neighbours below u, and u itself.
    moved = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("w", "m"))
    return moved.filter("a > b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; the root is the smallest node it can reach.

    Edges may repeat, have either direction, and lead from a node to itself (then ignored); a null
    end is ignored too.
    """
    now = written(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") > F.col("b")))
        .distinct(),
        "edges",
    )
    seen = _mark(now)
    while seen[0]:
        now = written(_star(_star(now, large=True), large=False), "edges")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Row count and checksum of an edge set."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).head()
    return row[0], row[1], row[2]
