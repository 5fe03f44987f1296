"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices_for, staged, with_group_totals


def _stars(directed: DataFrame, slices: int) -> DataFrame:
    """Each edge (u, v) with the smallest neighbour of u, or u itself if that is smaller."""
    return with_group_totals(directed, ["u"], {"low": ("min", F.col("v"))}, ["v"], slices).withColumn(
        "low", F.least("low", "u")
    )


def _large_star(edges: DataFrame, slices: int) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    return _stars(both, slices).where("v > u and v != low").selectExpr("v as u", "low as v").distinct()


def _small_star(edges: DataFrame, slices: int) -> DataFrame:
    down = edges.selectExpr("greatest(u, v) as u", "least(u, v) as v")
    met = _stars(down, slices)
    return (
        met.where("v != low").selectExpr("v as u", "low as v")
        .union(met.selectExpr("u", "low as v")).where("u != v").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """Map each node of ``edges`` (u, v) to the smallest node it is connected with.

    Returns (node, root) for all nodes that have an edge to another node, roots
    included. Rounds repeat until a round changes nothing; each is staged in the shared
    folder, and a node with very many edges is dealt over many tasks.
    """
    edges = staged(edges.where("u != v").distinct(), "edges")
    slices = slices_for(edges.count())
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == seen or not state["n"]:
            break
        seen = state
        edges = staged(_small_star(_large_star(edges, slices), slices), "edges")
    return edges.selectExpr("u as node", "v as root").union(
        edges.selectExpr("v as node", "v as root").distinct()
    )
