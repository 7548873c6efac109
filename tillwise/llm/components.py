"""Connected components of an edge table by alternating stars, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import cut_lineage


def _with_least(arcs: DataFrame) -> DataFrame:
    """Arcs (u, v) with the least of u and its neighbours; the minimum folds before the shuffle,
    and the join can be split where one u has very many arcs."""
    least = arcs.groupBy(F.col("u").alias("least_of")).agg(F.min("v").alias("least"))
    return arcs.join(least, F.col("u") == F.col("least_of")).select(
        "u", "v", F.least("u", "least").alias("least")
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``), the root being the smallest
    node that can be reached; roots are nodes too.

    Each round hangs larger neighbours on the smallest one (large star) and then a node's smaller
    neighbours on their smallest (small star). Rounds grow with the logarithm of the longest chain;
    every round is checkpointed, so a lost executor repeats one round at most.
    """
    links = cut_lineage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    seen = None
    while True:
        both = links.union(links.select("v", "u"))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        down = large.where("u <> v").distinct()
        small = _with_least(down)
        links = cut_lineage(
            small.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .union(small.select("u", F.col("least").alias("v")))
            .where("u <> v")
            .distinct()
        )
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
