"""Connected components of an edge table by alternating large-star and
small-star rounds.  Every step is a combinable minimum or an equi-join whose
two inputs are plain tables, so AQE can split a hub's edges over many tasks;
no component ever meets in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _settled(edges: DataFrame) -> bool:
    """Whether every node is either a least node or has one edge to one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 or (up > 0 and down > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    far = both.where("v > u").join(low.hint("merge"), "u")
    return far.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = materialize(edges.groupBy("u").agg(F.min("v").alias("m")))
    near = edges.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node;
    ``component`` is the least node of the component.  Null ends and loops are
    ignored; repeated edges are harmless; no edges give no rows."""
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where(
        F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))).distinct()
    e = materialize(e)
    for _ in range(max_rounds):
        if _settled(e):
            break
        far = materialize(_large_star(e))
        near = materialize(_small_star(far))
        release(e, far)
        e = near
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    out._written_to = e._written_to
    return out
