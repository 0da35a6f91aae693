"""Connected components of a link table, as Spark joins (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voltline.session import drop_frame, materialize


def _written(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """(edges, their number, a sum that changes when they do), from one write."""
    obs = Observation("round")
    out = materialize(edges.observe(obs, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "edges")
    got = obs.get
    return out, got["n"], int(got["h"] or 0)


def _large_star(e: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the node's least neighbour (itself included)."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Links each smaller neighbour of a node, and the node, to the least of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(a, b)`` of long ids; a component is named by its least node.

    Each round is written to the shared folder, so rounds don't lengthen the lineage and nothing gathers on the
    driver but a count. Hot nodes only meet in aggregates and joins that Spark can combine early or split.
    """
    now, n, h = _written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while n:
        nxt, m, g = _written(_small_star(_large_star(now)))
        if (m, g) == (n, h):
            drop_frame(nxt)
            break
        drop_frame(now)
        now, n, h = nxt, m, g
    # at the end every node but the least links to the least
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
