"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (``a``, ``b``: bigint).

    Large-star and small-star steps (Kiveris et al., 2014) are repeated until nothing changes;
    a logarithmic number of rounds in practice, each linear in the links. Neighbourhoods are
    reduced to their minimum by partial aggregation, never collected. The minimum is written before the
    join that brings it back, so that both sides of that join are plain exchanges and adaptive
    execution splits a hub (it leaves a join alone whose one side is an aggregate). Each round is written
    to the shared folder. Self links and repeated links do not matter; no links give no rows.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).distinct(), "links")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "links")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        state = (state["n"], state["sum"])
        if state == before or not state[0]:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.unionByName(roots)


def _with_minimum(pairs: DataFrame) -> DataFrame:
    """Each (node, neighbour) with the smallest of the node and its neighbours."""
    smallest = pairs.groupBy("node").agg(F.min("neighbour").alias("low"))
    smallest = staged(smallest.select("node", F.least("low", "node").alias("low")), "lows")
    return pairs.join(smallest, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links larger neighbours of a node to the smallest node around it."""
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("neighbour")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("neighbour"))
    )
    linked = _with_minimum(pairs).where("neighbour > node").select(F.col("low").alias("a"), F.col("neighbour").alias("b"))
    return linked.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    pairs = edges.select(F.col("b").alias("node"), F.col("a").alias("neighbour"))
    low = _with_minimum(pairs)
    linked = low.select(F.col("low").alias("a"), F.col("neighbour").alias("b")).unionByName(
        low.select(F.col("low").alias("a"), F.col("node").alias("b"))
    )
    return linked.where("a <> b").distinct()
