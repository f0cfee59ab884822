"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node it reaches.

    Each round is two joins on the node and is stored in the shared folder; the
    rounds end when the edges no longer change, that is when every node hangs
    from its root.  A hub is reduced map-side (min) and its edges are split by
    AQE's skew join.  An empty edge table gives an empty result.
    """
    current = stored(_small_star(edges.where("u <> v").select("u", "v")), name)
    mark = _signature(current)
    while mark[0]:
        current = stored(_small_star(_large_star(current)), name)
        was, mark = mark, _signature(current)
        if mark == was:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
