"""Distributions: grouped statistics, box plots, histograms, densities
(SURVEY A8-A14, A25, A27-A39)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.quantiles import exact_quantiles, exact_quantiles_of, quantiles_of_counts, sorted_counts
from quarry.operators.rank import _cols, attach, top_k


def group_summary(df: DataFrame, group: str, means: Mapping[str, str], median_col: str,
                  median_name: str = "median", digits: int = 4) -> DataFrame:
    """Per group size, means of several columns and an exact median."""
    base = df.groupBy(group).agg(F.count(F.lit(1)).alias("size"),
                                 *[F.round(F.avg(c), digits).alias(n) for n, c in means.items()])
    med = exact_quantiles(df, group, median_col, {median_name: 0.5}, count_col=None)
    return (base.join(med, group, "left")
            .withColumn(median_name, F.round(median_name, digits))
            .orderBy(F.col("size").desc(), F.col(group)))


def group_median_rank(df: DataFrame, group: str, value: str, digits: int = 4) -> DataFrame:
    """Groups ordered by their median value, highest first."""
    med = exact_quantiles(df, group, value, {"median": 0.5}, count_col="n")
    return med.withColumn("median", F.round("median", digits)).orderBy(
        F.col("median").desc(), F.col(group))


def five_number(df: DataFrame, group, value: str, digits: int = 4) -> DataFrame:
    """Mean, q1, median, q3 by group (exact, linear interpolation)."""
    groups = _cols(group)
    q = exact_quantiles(df, groups, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    means = df.groupBy(*groups).agg(F.avg(value).alias("mean"))
    out = attach(q, means, groups)
    return out.select(*groups, "n", *[F.round(c, digits).alias(c) for c in ("mean", "q1", "median", "q3")])


def box_stats(df: DataFrame, group, value: str, whisker: float = 1.5, digits: int = 4) -> DataFrame:
    """Box-plot statistics per group.

    The rows are read once, into the sorted table of distinct values and their
    counts: it gives the exact quartiles, and joined with the one row of
    fences per group the whiskers (extreme values inside the fences) and the
    outlier count.
    """
    groups = _cols(group)
    counts = sorted_counts(df, groups, value)
    q = quantiles_of_counts(counts, groups, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumn("lower_fence", F.col("q1") - whisker * iqr).withColumn("upper_fence", F.col("q3") + whisker * iqr)
    of_group = ("n", "q1", "median", "q3", "lower_fence", "upper_fence")
    inside = (F.col("_v") >= F.col("lower_fence")) & (F.col("_v") <= F.col("upper_fence"))
    out = attach(counts, fences, groups).groupBy(*groups).agg(
        *[F.first(c).alias(c) for c in of_group],
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_c"))).alias("outliers"))
    r = [F.round(c, digits).alias(c) for c in
         ("q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high")]
    return out.select(*groups, "n", *r, F.col("outliers").cast("long").alias("outliers"))


def conditional_means(df: DataFrame, outcome: str, value: str, low_max: int, high_min: int,
                      digits: int = 4) -> DataFrame:
    """Mean of ``value`` over low-outcome rows and over high-outcome rows."""
    return df.agg(
        F.round(F.avg(F.when(F.col(outcome) <= low_max, F.col(value))), digits).alias("low_mean"),
        F.round(F.avg(F.when(F.col(outcome) >= high_min, F.col(value))), digits).alias("high_mean"))


def timeline_peak(df: DataFrame, key: str) -> DataFrame:
    """Counts per key, peak key (earliest on ties) and latest key with its count."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    peak = counts.agg(F.max("cnt").alias("peak_count"))
    summary = (counts.crossJoin(F.broadcast(peak))  # one-row scalar
               .agg(F.min(F.when(F.col("cnt") == F.col("peak_count"), F.col(key))).alias("peak_key"),
                    F.max("peak_count").alias("peak_count"),
                    F.max(key).alias("latest_key"),
                    F.max_by("cnt", key).alias("latest_count")))
    return counts.crossJoin(F.broadcast(summary)).orderBy(key)  # one-row scalar


def _edge_bin(x: Column, edges: Sequence[float], right: bool) -> Column:
    """Bin index of ``x`` for explicit edges; null outside.

    right=False: numpy.histogram — [e_i, e_i+1), last bin closed.
    right=True:  pandas.cut — (e_i, e_i+1], lowest edge excluded.
    """
    n = len(edges) - 1
    out = F.lit(None).cast("int")
    for i in reversed(range(n)):
        lo, hi = F.lit(edges[i]), F.lit(edges[i + 1])
        if right:
            cond = (x > lo) & (x <= hi)
        elif i == n - 1:
            cond = (x >= lo) & (x <= hi)
        else:
            cond = (x >= lo) & (x < hi)
        out = F.when(cond, F.lit(i)).otherwise(out)
    return out


def _fmt_edge(e) -> str:
    return str(int(e)) if float(e).is_integer() else str(e)


def histogram_edges(df: DataFrame, value: str, edges: Sequence[float], group=None) -> DataFrame:
    """Counts over explicit edges; empty bins appear with 0.

    Labels are ``lo-(hi-1)`` as in the reference reports.
    """
    groups = _cols(group)
    binned = df.select(*groups, _edge_bin(F.col(value), edges, right=False).alias("bin"))
    # No filter on the derived bin: a pushed-down predicate would inline
    # (and so re-evaluate) the value expression; out-of-range bins are null
    # and match no counter anyway.
    counts = binned.groupBy(*groups).agg(*[F.count_if(F.col("bin") == i).alias(f"_b{i}")
                                           for i in range(len(edges) - 1)])
    n = len(edges) - 1
    body = ", ".join(f"{i}, '{_fmt_edge(edges[i])}-{_fmt_edge(edges[i + 1] - 1)}', "
                     f"CAST({edges[i]} AS DOUBLE), CAST({edges[i + 1]} AS DOUBLE), _b{i}"
                     for i in range(n))
    if not groups:
        # Empty input still yields every bin with 0.
        counts = df.sparkSession.range(1).select(*[F.lit(0).alias(f"_b{i}") for i in range(n)]) \
            .unionByName(counts).groupBy().agg(*[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(n)])
    return counts.select(*groups, F.expr(f"stack({n}, {body}) AS (bin, label, lo, hi, cnt)")) \
        .withColumn("cnt", F.col("cnt").cast("long"))


def histogram_equal(df: DataFrame, value: str, bins: int, group=None, digits: int = 4) -> DataFrame:
    """Equal-width histogram per group between the group's min and max
    (numpy rule: last bin closed); every bin appears, empty ones with 0."""
    groups = _cols(group)
    v = F.col(value).cast("double")
    base = df.select(*groups, v.alias("_v")).where(F.col("_v").isNotNull())
    rng = base.groupBy(*groups).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counts = (attach(base, rng, groups).select(*groups, idx.alias("bin"))
              .groupBy(*groups, "bin").agg(F.count(F.lit(1)).alias("cnt")))
    grid = rng.select(*groups, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return (grid.join(counts, [*groups, "bin"], "left")
            .select(*groups, "bin",
                    F.round(F.col("_lo") + F.col("bin") * w, digits).alias("lo"),
                    F.round(F.col("_lo") + (F.col("bin") + 1) * w, digits).alias("hi"),
                    F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt")))


def cut_labels(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """pandas.cut(right=True) with labels: null outside (lo_0, hi_n]."""
    idx = _edge_bin(x, edges, right=True)
    out = F.lit(None).cast("string")
    for i, lab in reversed(list(enumerate(labels))):
        out = F.when(idx == i, F.lit(lab)).otherwise(out)
    return out


def heatmap_binned(df: DataFrame, x: str, x_edges, x_labels, y: str, y_edges, y_labels,
                   target: str, digits: int = 4) -> DataFrame:
    """Right-closed bins on two axes → mean target per cell (long form)."""
    b = df.select(cut_labels(F.col(x), x_edges, x_labels).alias("x_bin"),
                  cut_labels(F.col(y), y_edges, y_labels).alias("y_bin"), F.col(target))
    return (b.where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
            .groupBy("x_bin", "y_bin")
            .agg(F.round(F.avg(target), digits).alias("mean_target"),
                 F.count(F.lit(1)).alias("cnt")))


def length_summary(df: DataFrame, cols: Mapping[str, Column], digits: int = 2) -> DataFrame:
    """Per named length expression, mean (2 dp) and int-truncated median.

    The measures are unpivoted into one long column so a single quantile
    pass serves all of them."""
    names = list(cols)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), cols[n].cast("double").alias("_len"))
                                          for n in names])).alias("_m")).select("_m.*")
    q = exact_quantiles(long, "measure", "_len", {"median": 0.5}, count_col=None)
    m = long.groupBy("measure").agg(F.round(F.avg("_len"), digits).alias("mean"))
    return m.join(q, "measure").select("measure", "mean", F.col("median").cast("int").alias("median_int"))


def metric_medians(df: DataFrame, group: str, metrics: Sequence[str], domain: Sequence | None = None,
                   digits: int = 4) -> DataFrame:
    """Median of several metrics per group, long form (one quantile
    pass over the unpivoted metrics); with a domain, absent groups get 0."""
    out = exact_quantiles_of(df, group, metrics, {"median": 0.5}, count_col=None) \
        .select(group, F.col("measure").alias("metric"), F.round("median", digits).alias("median"))
    if domain is not None:
        spark = df.sparkSession
        dom = spark.createDataFrame([(d, m) for d in domain for m in metrics],
                                    f"{group} {df.schema[group].dataType.simpleString()}, metric string")
        out = (dom.join(out, [group, "metric"], "left")
               .select(group, "metric", F.coalesce("median", F.lit(0.0)).alias("median")))
    return out


def mean_std(df: DataFrame, value: str, digits: int = 4) -> DataFrame:
    """Overall mean and sample standard deviation."""
    return df.agg(F.round(F.avg(value), digits).alias("mean"),
                  F.round(F.stddev_samp(value), digits).alias("std"))


def class_weights(df: DataFrame, label: str, digits: int = 4) -> DataFrame:
    """Total / (k · count_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    tot = counts.agg(F.sum("cnt").alias("_total"), F.count(F.lit(1)).alias("_k"))
    return counts.crossJoin(F.broadcast(tot)).select(  # one-row scalar
        label, "cnt", F.round(F.col("_total") / (F.col("_k") * F.col("cnt")), digits).alias("weight"))


def kde(df: DataFrame, value: str, grid: int = 200, cut: float = 3.0, group=None,
        digits: int = 6) -> DataFrame:
    """Gaussian kernel density on a grid, Scott bandwidth ``std·n^(-1/5)``.

    Equal values are counted first; one combinable aggregate then holds a
    kernel sum for each of the ``grid`` points of a group, so no row is
    multiplied and a hot group is summed by many tasks.
    """
    groups = _cols(group)
    v = F.col(value).cast("double")
    base = df.select(*groups, v.alias("_v")).where(F.col("_v").isNotNull())
    st = base.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_sd"),
                                   F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))) \
           .where(F.col("_h") > 0)
    st = st.withColumn("_lo", F.col("_min") - cut * F.col("_h")) \
           .withColumn("_step", (F.col("_max") - F.col("_min") + 2 * cut * F.col("_h")) / (grid - 1)) \
           .select(*groups, "_n", "_h", "_lo", "_step")
    values = attach(base.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c")), st, groups)

    def kernel(i):
        return F.expr(f"sum(_c * exp(-0.5 * pow((_lo + {i} * _step - _v) / _h, 2))) AS _k{i}")

    sums = values.groupBy(*groups).agg(*[F.max(c).alias(c) for c in ("_n", "_h", "_lo", "_step")], *[kernel(i) for i in range(grid)])
    out = sums.where(F.col("_n").isNotNull()).select(
        *groups, "_n", "_h", "_lo", "_step", F.posexplode(F.array(*[F.col(f"_k{i}") for i in range(grid)])).alias("point", "_k"))
    return out.select(*groups, "point", F.round(F.col("_lo") + F.col("point") * F.col("_step"), digits).alias("x"),
                      F.round(F.col("_k") / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)), digits).alias("density"))


def scatter_grid(df: DataFrame, x: str, y: str, x_width: float, y_width: float, group=None) -> DataFrame:
    """Scatter reduced to counts on a floor-binned 2-D grid."""
    groups = _cols(group)
    bx = F.floor(F.col(x) / x_width).cast("long")
    by = F.floor(F.col(y) / y_width).cast("long")
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(*groups, bx.alias("x_bin"), by.alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("x_lo", F.col("x_bin") * x_width)
            .withColumn("y_lo", F.col("y_bin") * y_width))


def group_mean_vector(df: DataFrame, group: str, vector: str, min_count: int = 1,
                      top: int | None = None, digits: int = 6) -> DataFrame:
    """Mean feature vector per group (long form: group, pos, mean)
    for groups with at least ``min_count`` rows, optionally the ``top``
    largest groups only (by size, then group)."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    if top:
        sizes = top_k(sizes, [F.col("n").desc(), F.col(group).asc()], top, rank_col=None)
        sizes = F.broadcast(sizes)  # at most ``top`` rows
    long = df.select(group, F.posexplode(vector).alias("pos", "_x"))
    means = long.groupBy(group, "pos").agg(F.avg("_x").alias("mean"))
    return means.join(sizes, group).select(group, "n", "pos", F.round("mean", digits).alias("mean"))
