"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import settle


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour (large: above; small: below the node, and the node itself) to the smallest one around."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """For links (a, b) of long numbers: ``node`` and the smallest ``root`` it is connected with, roots included.

    Every round is written to the shared folder, which cuts the lineage; the rounds grow with the logarithm of the
    longest path. A node without links is not in the result.
    """
    now = settle(edges.select("a", "b").where(F.col("a") != F.col("b")), "edges")
    nodes = now.select(F.col("a").alias("node")).unionByName(now.select(F.col("b").alias("node"))).distinct()
    before = _state(now)
    for _ in range(rounds):
        now = settle(_stars(_stars(now, True), False), "stars")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no stable components after {rounds} rounds")
    return nodes.join(now, nodes["node"] == now["a"], "left").select("node", F.coalesce("b", "node").alias("root"))
