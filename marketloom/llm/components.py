"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a < b.

    Large star: each node points its larger neighbours to the smallest node in
    reach. Small star: it points its smaller neighbours and itself there. The
    minima are stored, so the join that follows has a plain exchange on either
    side and a node with very many neighbours can be split.
    """
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        near = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = materialize(near.groupBy("u").agg(F.min("v").alias("m")), "star-minima").select(
        F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    pointed = near.where("v > u").join(least, F.col("u") == F.col("_u")) if large else near.join(
        least, F.col("u") == F.col("_u"))
    out = pointed.select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        out = out.union(least.select("m", "_u"))
    return out.where("a < b").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component_id) of every node with an edge; the id is the smallest node.

    ``edges`` has columns a and b (longs, any order). Rounds go on until both
    steps leave the edges as they are; each round is a stored table, so a lost
    executor costs at most one round. Nothing but counts comes to the driver.
    """
    now = materialize(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = materialize(_star(materialize(_star(now, large=True), "large-star"), large=False), "small-star")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component_id"))
