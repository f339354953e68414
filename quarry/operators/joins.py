"""Join operators.

Dimension lookups are plain equi-joins: Catalyst/AQE broadcast the side
whose measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
shuffle otherwise, so no lookup table is broadcast on trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.rank import topk_per_group


def lookup_default(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, dim_value: str,
                   out: str, default: str = "Unknown") -> DataFrame:
    """Left lookup of a dimension value with a default label."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(dim_value).alias("_lv"))
    j = df.join(d, F.col(left_key) == F.col("_lk"), "left")
    return j.withColumn(out, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


def lookup_unknown_id(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, dim_value: str,
                      out: str, matched: Column | None = None) -> DataFrame:
    """Lookup where an id missing from the dimension becomes
    ``Unknown(<id>)``; rows whose parent record is missing (``matched`` is
    false) become ``Unknown``."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(dim_value).alias("_lv"))
    j = df.join(d, F.col(left_key) == F.col("_lk"), "left")
    name = F.coalesce(F.col("_lv"), F.format_string("Unknown(%d)", F.col(left_key).cast("long")))
    if matched is not None:
        name = F.when(matched, name).otherwise(F.lit("Unknown"))
    return j.withColumn(out, name).drop("_lk", "_lv")


def first_match(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row per key in ``order`` (skew-safe top-1)."""
    return topk_per_group(df, key, order, 1, rank_col="_first").drop("_first")


def exists_in(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows with at least one match (left semi join)."""
    return df.join(other, on, "left_semi")


def unmatched_counts(df: DataFrame, matched: Column) -> DataFrame:
    """Matched vs unmatched counters."""
    return df.agg(F.count_if(matched).alias("matched"), F.count_if(~matched).alias("unmatched"))
