"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.session import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Map each linked node to the smallest node it reaches.

    ``links`` has two long columns ``a`` and ``b``; the result has ``node`` and
    ``component`` for every node that occurs in a link between two different
    nodes. Each round hooks every larger neighbour to a node's smallest
    neighbour (large star), then every smaller one (small star); both steps are
    a partially aggregated minimum and a join, so a hub with very many links is
    never gathered in one task. Rounds end when only stars are left. Null ends
    are ignored; an empty table gives an empty result.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    for _ in range(max_rounds):
        if _is_star_forest(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(low, "u")
        small = hooked.select("u", F.col("m").alias("v")).unionByName(
            hooked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = materialize(small.distinct(), "links")
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def _is_star_forest(edges: DataFrame) -> bool:
    """True when each node hangs on one centre and no centre hangs on another."""
    twice = edges.groupBy("u").count().where("count > 1").limit(1)
    chained = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1)
    return not (twice.count() or chained.count())
