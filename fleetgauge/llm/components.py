"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HEAVY, SPREAD, TRACKED, HeavyKeys
from .scratch import Scratch

#: Edges that a node must have to be split.
HUB = 128


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node that it can reach.

    Rounds of two steps, each a grouping and a join: every node hooks its larger neighbours to the smallest node it
    knows, then its smaller ones. Both keep the components as they are. Hubs are aggregated before they are shuffled,
    and the edges of a node that has many of them are dealt to several tasks; which nodes these are, a sketch of
    bounded size tells each round. The number of rounds grows with the logarithm of a component's extent. Ends when a
    round changes no edge.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = scratch.keep(edges, f"{name}-0", free=False)
    state, hubs = _state(edges)
    turn = 0
    while state[0]:
        turn += 1
        upward = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = edges.unionByName(upward).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hooked = _joined(upward, least, hubs, "b").select(F.col("b").alias("a"), F.col("m").alias("b"), F.col("a").alias("by"))
        least = hooked.groupBy("a").agg(F.min("b").alias("m"))
        down = _joined(hooked, least, hubs, "by").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hooked = down.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = scratch.keep(hooked, f"{name}-{turn}", free=False)
        scratch.drop(f"{name}-{turn - 1}")
        before = state
        state, hubs = _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _joined(edges: DataFrame, least: DataFrame, hubs: HeavyKeys, by: str) -> DataFrame:
    """The edges with ``m`` of their ``a``; a hub's edges are dealt by ``by``."""
    if not hubs.parts:
        return edges.join(least, "a")
    return hubs.split(edges, [by]).join(hubs.repeated(least), ["a", "part"])


def _state(edges: DataFrame) -> tuple[tuple, HeavyKeys]:
    """Two numbers that differ if the edges do, and the nodes with many edges.

    A node meets at most as many rows in either step as it has edges here.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("end"), F.xxhash64("a", "b").alias("h"))
    row = ends.agg(
        F.count("*").alias("n"),
        F.sum(F.pmod("h", F.lit(1 << 40))).alias("h"),
        F.call_function("approx_top_k", F.xxhash64("end"), F.lit(HEAVY), F.lit(TRACKED)).alias("top"),
    ).first()
    # a node of a few edges is no hub, however small the graph
    parts = {r["item"]: -(-r["count"] * SPREAD // row.n) for r in row.top or [] if r["count"] >= HUB}
    return (row.n, row.h), HeavyKeys(("a",), {key: n for key, n in parts.items() if n > 1})
