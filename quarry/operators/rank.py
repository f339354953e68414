"""Ordering, top-k and set operators.

Top-k per group is done in two phases so that no task ever holds a whole
group: phase one ranks inside ``(group, hash(row) mod buckets)`` slices and
keeps k rows per slice, phase two ranks the at most ``buckets * k``
survivors per group.  The global top-k of a group is always contained in the
union of the per-slice top-ks, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SLICES = 64


def _cols(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def topk_per_group(df: DataFrame, group_cols, order: Sequence[Column], k: int,
                   rank_col: str = "rank", slices: int = DEFAULT_SLICES,
                   slice_cols=None) -> DataFrame:
    """Rows ranked 1..k inside every group by ``order`` (exact, skew-safe).

    ``order`` must be a total order (end it with a unique key) so that ties
    are resolved the same way in every run.  ``slice_cols`` are hashed to
    spread one group over ``slices`` tasks (default: all columns).
    """
    groups = _cols(group_cols)
    salt_src = [F.col(c) for c in (_cols(slice_cols) or df.columns)]
    salted = df.withColumn("_slice", F.pmod(F.xxhash64(*salt_src), F.lit(slices)))
    first = (salted
             .withColumn("_r1", F.row_number().over(
                 Window.partitionBy(*groups, "_slice").orderBy(*order)))
             .where(F.col("_r1") <= k)
             .drop("_r1", "_slice"))
    win = Window.partitionBy(*groups).orderBy(*order) if groups else Window.orderBy(*order)
    return (first.withColumn(rank_col, F.row_number().over(win))
            .where(F.col(rank_col) <= k))


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_col: str | None = "rank") -> DataFrame:
    """Global top-k: TakeOrderedAndProject (per-task heaps of k rows, one merge)."""
    out = df.orderBy(*order).limit(k)
    if rank_col:
        # k rows only: a single-partition window over a bounded set.
        out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    return out


def best_per_key(df: DataFrame, key_cols, order: Sequence[Column]) -> DataFrame:
    """Best-scoring row per key (first wins ties via the order)."""
    return topk_per_group(df, key_cols, order, 1, rank_col="_best").drop("_best")


def share_of_total(df: DataFrame, value_col: str, partition_cols=None,
                   out_col: str = "share", digits: int | None = 4) -> DataFrame:
    """Value / partition total.

    The total is an aggregate joined back on the partition key instead of a
    window, so one hot partition key is summed by many tasks.
    """
    parts = _cols(partition_cols)
    if parts:
        totals = df.groupBy(*parts).agg(F.sum(value_col).alias("_total"))
        joined = df.join(totals, parts, "inner")
    else:
        totals = df.agg(F.sum(value_col).alias("_total"))
        joined = df.crossJoin(F.broadcast(totals))  # one-row scalar
    share = F.try_divide(F.col(value_col).cast("double"), F.col("_total"))
    if digits is not None:
        share = F.round(share, digits)
    return joined.withColumn(out_col, share).drop("_total")


def cumulative(df: DataFrame, value_col: str, order_col: str, out_col: str = "cumulative") -> DataFrame:
    """Running total over a small ordered table (e.g. PCA components)."""
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out_col, F.sum(value_col).over(w))


def label_union(df: DataFrame, a: str, b: str, out_col: str = "label") -> DataFrame:
    """Distinct labels in truth ∪ prediction."""
    return df.select(F.col(a).alias(out_col)).union(df.select(F.col(b).alias(out_col))).distinct()


def feature_subsets(groups: DataFrame, name_col: str, max_size: int) -> DataFrame:
    """U4: every non-empty subset of the feature groups up to ``max_size``.

    Built by repeated equi-free extension on ``last < next``; the group table
    is a small fixed list of feature-group names.
    """
    g = groups.select(F.col(name_col).alias("_g")).distinct()
    level = g.select(F.array(F.col("_g")).alias("subset"), F.col("_g").alias("_last"))
    out = level
    for _ in range(max_size - 1):
        level = (level.join(F.broadcast(g), F.col("_g") > F.col("_last"))
                 .select(F.concat("subset", F.array("_g")).alias("subset"), F.col("_g").alias("_last")))
        out = out.unionByName(level)
    return out.select("subset", F.size("subset").alias("size"),
                      F.concat_ws("+", "subset").alias("subset_name"))


def attach(df: DataFrame, stats: DataFrame, keys) -> DataFrame:
    """Join per-group statistics back to rows on ``keys``; with no keys the
    statistics are a single aggregate row, attached by a broadcast."""
    keys = _cols(keys)
    if keys:
        return df.join(stats, keys)
    return df.crossJoin(F.broadcast(stats))  # one-row scalar
