"""Feature engineering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minmax(df: DataFrame, cols: Sequence[str], suffix: str = "_mm") -> DataFrame:
    """(x - min) / (max - min) with global min/max; 0 for constant columns."""
    stats = df.agg(*[F.min(c).alias(f"_{c}_lo") for c in cols], *[F.max(c).alias(f"_{c}_hi") for c in cols])
    out = df.crossJoin(F.broadcast(stats))  # one-row scalar
    for c in cols:
        lo, hi = F.col(f"_{c}_lo"), F.col(f"_{c}_hi")
        out = out.withColumn(f"{c}{suffix}", F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.lit(0.0)))
    return out.drop(*[f"_{c}_lo" for c in cols], *[f"_{c}_hi" for c in cols])


def composite_score(df: DataFrame, cols: Sequence[str], out: str = "score") -> DataFrame:
    """Mean of min-max scaled metrics."""
    scaled = minmax(df, cols)
    expr = sum((F.col(f"{c}_mm") for c in cols), F.lit(0.0)) / len(cols)
    return scaled.withColumn(out, expr).drop(*[f"{c}_mm" for c in cols])


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Z-score with the population standard deviation (constant → 0)."""
    from quarry.operators.rank import attach
    stats = df.agg(*[F.avg(c).alias(f"_{c}_m") for c in cols], *[F.stddev_pop(c).alias(f"_{c}_s") for c in cols])
    out = attach(df, stats, [])
    for c in cols:
        m, s = F.col(f"_{c}_m"), F.col(f"_{c}_s")
        out = out.withColumn(f"{c}{suffix}", F.when(s > 0, (F.col(c) - m) / s).otherwise(F.lit(0.0)))
    return out.drop(*[f"_{c}_m" for c in cols], *[f"_{c}_s" for c in cols])
