"""Correlation and association statistics.

All statistics are sums over distributed aggregates; pairwise work is done
on long-form aggregated tables, never by launching one job per pair.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.crosstab import _lit_sql
from quarry.operators.rank import _cols, attach, top_k


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson matrix over ``cols`` in long form (col_a, col_b, pos_a,
    pos_b, corr).  Undefined correlations (constant columns) are 0.

    Two passes: means, then centred cross-product sums — one aggregate row
    with k(k+1)/2 sums, no per-pair jobs, numerically stable.
    """
    cols = list(cols)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    means = x.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    cen = attach(x, means, []).select(*[(F.col(c) - F.col(f"_m{i}")).alias(f"_d{i}") for i, c in enumerate(cols)])
    sums = []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            sums.append(F.sum(F.col(f"_d{i}") * F.col(f"_d{j}")).alias(f"_s{i}_{j}"))
    agg = cen.agg(*sums)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            rows.append(f"{_lit_sql(a)}, {_lit_sql(b)}, {i}, {j}, "
                        f"try_divide(_s{lo}_{hi}, sqrt(_s{i}_{i} * _s{j}_{j}))")
    long = agg.select(F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS (col_a, col_b, pos_a, pos_b, r)"))
    return long.select("col_a", "col_b", "pos_a", "pos_b",
                       F.coalesce(F.round("r", digits), F.lit(0.0)).alias("corr"))


def corr_pair(df: DataFrame, a: str, b: str, digits: int = 4) -> DataFrame:
    """Pearson correlation of two columns (null when undefined)."""
    m = corr_matrix(df, [a, b], digits=12).where((F.col("pos_a") == 0) & (F.col("pos_b") == 1))
    return m.select(F.round("corr", digits).alias("corr"))


def corr_top_pairs(df: DataFrame, cols: Sequence[str], k: int = 15, digits: int = 4) -> DataFrame:
    """The k pairs i<j with the largest |corr| (ties: column order)."""
    pairs = corr_matrix(df, cols, digits).where(F.col("pos_a") < F.col("pos_b"))
    return top_k(pairs, [F.abs("corr").desc(), F.col("pos_a"), F.col("pos_b")], k)


def _cramers_from_cells(cells: DataFrame, keys: list[str], a: str, b: str, digits: int) -> DataFrame:
    """Bias-corrected Cramér's V per ``keys`` group from observed cells
    (keys..., a, b, O).  Zero cells are accounted for analytically:
    Σ_all E = n, and for 2×2 tables (Yates' correction) the four expected
    values come from the two row sums (min, max) and two column sums."""
    rows = cells.groupBy(*keys, a).agg(F.sum("O").alias("rs"))
    cols = cells.groupBy(*keys, b).agg(F.sum("O").alias("cs"))
    tot = cells.groupBy(*keys).agg(F.sum("O").alias("n"))
    rdim = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("r"), F.min("rs").alias("r0"), F.max("rs").alias("r1"))
    kdim = cols.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.min("cs").alias("c0"), F.max("cs").alias("c1"))
    e = (attach(attach(cells, rows, [*keys, a]), cols, [*keys, b]))
    e = attach(e, tot, keys).withColumn("E", F.col("rs") * F.col("cs") / F.col("n"))
    O, E = F.col("O"), F.col("E")
    yadj = O + F.least(F.lit(0.5), F.abs(E - O)) * F.signum(E - O)

    def fz(ev):  # Yates term of a zero cell with expectation ev
        return F.pow(F.least(F.lit(0.5), ev) - ev, 2) / ev
    s = e.groupBy(*keys).agg(
        F.sum(F.pow(O - E, 2) / E).alias("s_plain"), F.sum(E).alias("s_e"),
        F.sum(F.pow(yadj - E, 2) / E).alias("s_yates"), F.sum(fz(E)).alias("s_fz"))
    g = attach(attach(attach(s, tot, keys), rdim, keys), kdim, keys)
    n = F.col("n").cast("double")
    grid_fz = sum((fz(F.col(rr) * F.col(cc) / n) for rr in ("r0", "r1") for cc in ("c0", "c1")), F.lit(0.0))
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    chi2 = F.when(dof == 1, F.col("s_yates") + grid_fz - F.col("s_fz")) \
            .otherwise(F.col("s_plain") + n - F.col("s_e"))
    r, k = F.col("r"), F.col("k")
    phi2 = chi2 / n
    phi2c = F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (n - 1))
    rc = r - F.pow(r - 1, 2) / (n - 1)
    kc = k - F.pow(k - 1, 2) / (n - 1)
    v = F.sqrt(F.try_divide(phi2c, F.least(kc - 1, rc - 1)))
    return g.select(*keys, F.round(chi2, digits).alias("chi2"), F.round(v, digits).alias("cramers_v"))


def cramers_v(df: DataFrame, a: str, b: str, digits: int = 4) -> DataFrame:
    """Bias-corrected Cramér's V of two categorical columns (Yates'
    correction when the table is 2×2, as scipy's default)."""
    cells = (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
             .groupBy(a, b).agg(F.count(F.lit(1)).alias("O")))
    return _cramers_from_cells(cells, [], a, b, digits)


def cramers_matrix(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """V for every ordered pair of ``cols``; 1.0 on the diagonal.

    The table is first reduced to its distinct value combinations with
    counts (map-side combined), then each combination is expanded into the
    k(k-1)/2 pairs it contributes to: one job, one long-form aggregate.
    """
    cols = list(cols)
    combos = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .groupBy(*cols).agg(F.count(F.lit(1)).alias("_w")))
    pairs = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            pairs.append(F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"),
                                  F.col(cols[i]).alias("va"), F.col(cols[j]).alias("vb")))
    long = combos.select("_w", F.explode(F.array(*pairs)).alias("p")).select("p.*", "_w")
    cells = (long.where(F.col("va").isNotNull() & F.col("vb").isNotNull())
             .groupBy("col_a", "col_b", "va", "vb").agg(F.sum("_w").alias("O")))
    v = _cramers_from_cells(cells, ["col_a", "col_b"], "va", "vb", digits).select("col_a", "col_b", "cramers_v")
    mirrored = v.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "cramers_v")
    spark = df.sparkSession
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, cramers_v double")
    return v.unionByName(mirrored).unionByName(diag)


def anova(df: DataFrame, factors: Sequence[str], target: str, digits: int = 4,
          with_p: bool = False) -> DataFrame:
    """One-way ANOVA F of ``target`` across the levels of each factor.

    Group n / sum / sum of squares are map-side-combined aggregates; the F
    statistic is arithmetic on them.  ``with_p`` adds the upper-tail
    p-value of the F distribution (Arrow UDF over one row per factor).
    """
    y = F.col(target).cast("double")
    out = None
    grand = df.where(y.isNotNull()).agg(F.count(F.lit(1)).alias("_total"), F.avg(y).alias("gm"))
    for fac in factors:
        g = (df.where(y.isNotNull() & F.col(fac).isNotNull())
             .groupBy(fac).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("m"),
                               F.sum(y * y).alias("ss"), F.sum(y).alias("s")))
        g = attach(g, grand, [])
        row = g.agg(F.count(F.lit(1)).alias("k"), F.first("_total").alias("_total"),
                    F.sum(F.col("n") * F.pow(F.col("m") - F.col("gm"), 2)).alias("ssb"),
                    F.sum(F.col("ss") - F.col("s") * F.col("m")).alias("ssw"))
        row = row.select(F.lit(fac).alias("factor"),
                         (F.col("k") - 1).cast("long").alias("df_between"),
                         (F.col("_total") - F.col("k")).cast("long").alias("df_within"),
                         F.round(F.try_divide(F.col("ssb") / (F.col("k") - 1),
                                              F.col("ssw") / (F.col("_total") - F.col("k"))), digits)
                         .alias("f_stat"))
        out = row if out is None else out.unionByName(row)
    if with_p:
        out = out.withColumn("p_value", f_survival("f_stat", "df_between", "df_within"))
    return out


# -- F distribution tail (regularised incomplete beta, continued fraction) --
def _betacf(a, b, x, iters=300, eps=3e-16):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < 1e-300, 1e-300, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        d = 1.0 / d
        de = d * c
        h *= de
        if np.all(np.abs(de - 1.0) < eps):
            break
    return h


def regularized_beta(a, b, x):
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    from math import lgamma
    lg = np.vectorize(lgamma)
    ln_bt = lg(a + b) - lg(a) - lg(b) + a * np.log(np.clip(x, 1e-300, 1)) + b * np.log(np.clip(1 - x, 1e-300, 1))
    bt = np.exp(ln_bt)
    direct = x < (a + 1) / (a + b + 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        res = np.where(direct, bt * _betacf(a, b, x) / a, 1.0 - bt * _betacf(b, a, 1 - x) / b)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, res))


def f_sf_numpy(f, d1, d2):
    """P(F > f) for F(d1, d2)."""
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    x = d2 / (d2 + d1 * f)
    return regularized_beta(d2 / 2.0, d1 / 2.0, x)


@F.pandas_udf(T.DoubleType())
def _f_sf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    ok = f.notna() & (d1 > 0) & (d2 > 0)
    out = pd.Series(np.nan, index=f.index)
    if ok.any():
        out[ok] = f_sf_numpy(f[ok].to_numpy(), d1[ok].to_numpy(), d2[ok].to_numpy())
    return out


def f_survival(f, d1, d2):
    return _f_sf(F.col(f), F.col(d1).cast("double"), F.col(d2).cast("double"))


def chi2_terms(tf: DataFrame, doc_col: str, term_col: str, value_col: str, class_col: str,
               digits: int = 6, docs: DataFrame | None = None) -> DataFrame:
    """T4: χ² of each term against the class, on summed feature values.

    ``tf`` is long form (doc, class, term, value).  Expected value of a
    (class, term) cell = class share of documents × the term's total; cells
    with no observation contribute their expectation, which is summed
    analytically (Σ_classes E = term total), so no class × term grid is
    built.
    """
    if docs is None:
        docs = tf.select(doc_col, class_col).distinct()
    class_share = docs.groupBy(class_col).agg(F.count(F.lit(1)).alias("_nc"))
    ndocs = docs.agg(F.count(F.lit(1)).alias("_nd"))
    class_share = attach(class_share, ndocs, []).select(class_col, (F.col("_nc") / F.col("_nd")).alias("_p"))
    obs = tf.groupBy(class_col, term_col).agg(F.sum(value_col).alias("_o"))
    # Σ (o - e)²/e + t - Σ e = Σ o²/p / t - 2 Σ o + t with e = p t: one grouping by term.
    cell = obs.join(F.broadcast(class_share), class_col, "left")   # one row per class
    agg = cell.groupBy(term_col).agg(F.sum(F.col("_o") * F.col("_o") / F.col("_p")).alias("_s"), F.sum("_o").alias("_t"),
                                     F.sum(F.when(F.col("_p").isNotNull(), F.col("_o"))).alias("_known"))
    agg = agg.where(F.col("_known").isNotNull())   # terms of rows without a class have no cell
    return agg.select(term_col, F.round(F.col("_s") / F.col("_t") - 2 * F.col("_known") + F.col("_t"), digits).alias("chi2"))
