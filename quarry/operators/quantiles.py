"""Exact quantiles with linear interpolation, without holding a group in one task.

``percentile``/``median`` keep one value→count map per group inside a single
aggregation buffer, so a group holding a third of a 100 TB table lands in
one task.  Here the distinct values are sorted once by the whole cluster:

1. distinct (group, value) pairs with multiplicities (map-side combined);
2. one range partitioning by (group, value), sorted inside and checkpointed.
   A hot group or a heavy tail takes as many partitions as its distinct
   values need, whatever their scale, and each row's partition number is
   fixed by the checkpoint, so that lost executors change nothing;
3. counts per (group, partition) — a table of at most partitions + groups
   rows — and their running totals give the first position of each piece;
4. only the pieces that hold a wanted position (two per probability) are
   read again and ranked, a piece never being larger than a partition, and
   the values around ``p·(n-1)`` are interpolated like numpy / DuckDB
   ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.rank import _cols
from quarry.session import checkpoint_dir


def sorted_counts(df: DataFrame, group_cols, value_col: str, partitions: int | None = None) -> DataFrame:
    """``*groups, _v, _c, _part``: every distinct non-null value of a group with
    its multiplicity, globally sorted; ``_part`` is its range partition.
    ``partitions`` is the session's number of shuffle partitions when not given."""
    groups = _cols(group_cols)
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.select(*groups, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c")))
    return (counts.repartitionByRange(n, *groups, "_v").sortWithinPartitions(*groups, "_v")
            .withColumn("_part", F.spark_partition_id()).checkpoint())


def quantiles_of_counts(counts: DataFrame, group_cols, probs: Mapping[str, float],
                        count_col: str | None = "n") -> DataFrame:
    """Quantiles of the ``sorted_counts`` table; several calls may share one."""
    groups = _cols(group_cols)
    positions = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs.values()]

    whole = Window.partitionBy(*groups)
    pieces = counts.groupBy(*groups, "_part").agg(F.sum("_c").alias("_size"))
    pieces = pieces.withColumn("_n", F.sum("_size").over(whole)).withColumn(
        "_base", F.sum("_size").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    holds = F.lit(False)
    for pos in positions:
        for k in (F.floor(pos), F.ceil(pos)):
            holds = holds | ((F.col("_base") <= k) & (k < F.col("_base") + F.col("_size")))
    names = [f"_g{i}" for i in range(len(groups))]
    wanted = pieces.where(holds).select(*[F.col(g).alias(x) for g, x in zip(groups, names)],
                                        F.col("_part").alias("_piece"), "_n", "_base")
    same = F.col("_part") == F.col("_piece")
    for g, x in zip(groups, names):
        same = same & F.col(g).eqNullSafe(F.col(x))
    ranked = counts.join(wanted, same).withColumn("_end", F.col("_base") + F.sum("_c").over(
        Window.partitionBy(*groups, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))

    def value_at(k):
        return F.max(F.when((F.col("_end") - F.col("_c") <= k) & (k < F.col("_end")), F.col("_v")))
    picked = ranked.groupBy(*groups).agg(
        F.first("_n").alias("_n"), *[value_at(F.floor(pos)).alias(f"_lo{i}") for i, pos in enumerate(positions)],
        *[value_at(F.ceil(pos)).alias(f"_hi{i}") for i, pos in enumerate(positions)])
    out = [F.col(g) for g in groups]
    if count_col:
        out.append(F.col("_n").cast("long").alias(count_col))
    for i, (name, pos) in enumerate(zip(probs, positions)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (pos - F.floor(pos)) * (hi - lo)).alias(name))
    return picked.select(*out)


def exact_quantiles(df: DataFrame, group_cols, value_col: str,
                    probs: Mapping[str, float], count_col: str | None = "n") -> DataFrame:
    """One row per group: ``count_col`` (non-null values) and one column per
    named probability.  Groups with no non-null value are absent; without
    group columns there is always one row, of nulls when no value is there."""
    return quantiles_of_counts(sorted_counts(df, group_cols, value_col), group_cols, probs, count_col)


def exact_quantiles_of(df: DataFrame, group_cols, value_cols: Sequence[str], probs: Mapping[str, float],
                       count_col: str | None = "n") -> DataFrame:
    """Quantiles of many columns in one pass: ``*groups, measure`` (the column's
    name), ``count_col`` and the named probabilities."""
    groups = _cols(group_cols)
    each = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("_value")) for c in value_cols]
    long = df.select(*groups, F.inline(F.array(*each)))
    return exact_quantiles(long, [*groups, "measure"], "_value", probs, count_col)


def median_of(df: DataFrame, group_cols, value_col: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, group_cols, value_col, {name: 0.5}, count_col=None)


def check_probs(probs: Mapping[str, float]) -> None:
    for k, p in probs.items():
        if not (0.0 <= p <= 1.0) or math.isnan(p):
            raise ValueError(f"probability {k}={p} outside [0, 1]")
