"""Group similarity and clustering.

Groups are reduced to mean vectors first (one map-side-combined
aggregate); similarities are computed between those few vectors, whose
count is bounded by ``top_n`` per type, so the pair table is at most
``top_n²`` rows per type and is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.rank import _cols, topk_per_group


def group_means(df: DataFrame, keys, group: str, cols: Sequence[str], min_count: int = 1,
                top_n: int | None = None) -> DataFrame:
    """Mean of ``cols`` per (keys, group) for groups with ≥ ``min_count`` rows,
    the ``top_n`` largest per key (size desc, then group); adds ``vec``."""
    keys = _cols(keys)
    g = df.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])
    g = g.where(F.col("n") >= min_count)
    if top_n:
        g = topk_per_group(g, keys, [F.col("n").desc(), F.col(group)], top_n, rank_col="group_rank",
                           slice_cols=[group])
    return g.withColumn("vec", F.array(*[F.col(c).cast("double") for c in cols]))


def _unit(vec):
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    den = F.greatest(norm, F.lit(1e-9))
    return F.transform(vec, lambda x: x / den)


def cosine_pairs(left: DataFrame, right: DataFrame, name_l: str, name_r: str, on=None,
                 digits: int = 4) -> DataFrame:
    """Cosine between every left and right mean vector (norm floor 1e-9,
    clipped to [-1, 1]).  Both sides are bounded top-n group tables."""
    a = left.select(*_cols(on), F.col(name_l).alias("group_a"), _unit(F.col("vec")).alias("_ua"))
    b = right.select(*_cols(on), F.col(name_r).alias("group_b"), _unit(F.col("vec")).alias("_ub"))
    pairs = a.join(F.broadcast(b), _cols(on)) if on else a.crossJoin(F.broadcast(b))  # ≤ top_n² rows
    dot = F.aggregate(F.zip_with("_ua", "_ub", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return pairs.select(*_cols(on), "group_a", "group_b",
                        F.round(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0)), digits).alias("cosine"))


def cluster_profiles(means: DataFrame, keys, cluster: str, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean of the group mean vectors inside each cluster."""
    keys = _cols(keys)
    return means.groupBy(*keys, cluster).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols])


def mixed_clusters(assign: DataFrame, cluster: str, type_col: str) -> DataFrame:
    """Number of clusters holding groups of more than one type."""
    per = assign.groupBy(cluster).agg(F.count_distinct(type_col).alias("_types"))
    return per.agg(F.count_if(F.col("_types") >= 2).alias("mixed_clusters"),
                   F.count(F.lit(1)).alias("clusters"))


def order_by_cluster(pairs: DataFrame, groups: DataFrame, group: str, cluster: str, keys=()) -> DataFrame:
    """K7: a similarity matrix (``group_a, group_b, ...``) with the cluster of
    both groups and their positions when groups are sorted by (cluster, name).
    ``groups`` has one row per group of a key: the matrix's side, not its cells."""
    keys = _cols(keys)
    place = groups.select(*keys, F.col(group).alias("_g"), F.col(cluster).alias("_c"), F.row_number().over(
        Window.partitionBy(*keys).orderBy(cluster, group)).alias("_p"))
    side = lambda x: place.select(*keys, F.col("_g").alias(f"group_{x}"), F.col("_c").alias(f"cluster_{x}"),
                                  F.col("_p").alias(f"pos_{x}"))
    return pairs.join(side("a"), [*keys, "group_a"]).join(side("b"), [*keys, "group_b"])


def cluster_groups(means: DataFrame, keys, k: int, seed: int = 42, features: str = "vec") -> DataFrame:
    """Divisive (bisecting k-means) clustering of the group mean
    vectors per key; returns the input rows with a ``cluster`` column.

    Runs MLlib on the (≤ top_n rows per key) mean-vector table; one fit per
    key value, keys being the handful of types."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector
    keys = _cols(keys)
    # Each bisecting step is a job of its own: the few mean rows are checkpointed
    # so that no step aggregates the facts again.
    data = means.withColumn("_features", array_to_vector(F.col(features))).checkpoint()
    if not keys:
        model = BisectingKMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(data)
        return model.transform(data).drop("_features")
    out = None
    key_rows = data.select(*keys).distinct().collect()  # the few type values
    for row in key_rows:
        part = data.where(F.expr(" AND ".join(f"`{c}` <=> {repr(row[c])}" for c in keys)))
        model = BisectingKMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(part)
        res = model.transform(part).drop("_features")
        out = res if out is None else out.unionByName(res)
    return out
