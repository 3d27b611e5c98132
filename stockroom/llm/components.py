"""Connected components by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import stored


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Of each node of ``edges`` (columns ``u`` and ``v``): ``node`` and ``component``, the smallest node it reaches.

    A large star links every larger neighbour of a node with the smallest of its neighbourhood; a small star links the
    smaller ones and the node itself. Neither changes what is connected; repeated, every node ends next to its smallest.
    Only minima are gathered by node, so a node with very many links is no burden. Each round's links are written.
    """
    links = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
        few=True,
    )
    state = _state(links)
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Written, so that the join deals both sides out anew and Spark can split a node of very many links.
        smallest = stored(smallest, "smallest", few=True)
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-stars", few=True)
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "small-stars", few=True)
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
    raise RuntimeError("the components did not settle")


def _state(links: DataFrame) -> tuple:
    """Tells whether two rounds have the same links."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)
