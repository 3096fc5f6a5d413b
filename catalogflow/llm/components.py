"""Connected components of a link table by alternating large-star and small-star steps, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.session import materialize

MAX_STEPS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest one."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    stars = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return stars.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``links(u, v)``; the component is its smallest node.

    Links of a node with itself and repeated links are ignored. Hubs are safe: minima are combined before they
    are shuffled, and the joins behind them may be split.
    """
    edges = materialize(links.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = _mark(edges)
    for _ in range(MAX_STEPS):
        if not before[0]:
            break
        edges = materialize(_star(_star(edges, True), False), name)
        now = _mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
