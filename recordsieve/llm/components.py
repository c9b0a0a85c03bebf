"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.session import remove, work_dir, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour, or to itself if it is smaller."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _unsettled(edges: DataFrame) -> int:
    """How many nodes keep the edges (u, v), u > v, from being stars: those with two smaller neighbours, or with smaller
    and larger ones."""
    ends = edges.selectExpr("u AS node", "1 AS down", "0 AS up").unionAll(edges.selectExpr("v AS node", "0 AS down", "1 AS up"))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.count_if(F.expr("down > 1 OR down > 0 AND up > 0"))).first()[0]


def components(links: DataFrame, max_steps: int = 100) -> DataFrame:
    """(node, component) of every node of the links (u, v); a component is named by its smallest node.

    NULL ends, loops and repeated links change nothing; no links give no rows. Each step is a few joins and
    aggregations over the links alone, and is written to the shared folder. Ends when the links are stars around the
    smallest nodes, which one aggregation tells; links that are so from the start take no step.
    """
    store = work_dir(links.sparkSession, "components")
    start = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, step = written(start, f"{store}/0"), 0
    while _unsettled(edges):
        step += 1
        if step > max_steps:
            raise RuntimeError(f"no fixed point in {max_steps} steps")
        edges = written(_small_star(_large_star(edges)), f"{store}/{step}")
        remove(links.sparkSession, f"{store}/{step - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
