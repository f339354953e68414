"""Crosstab family.

Layout of every crosstab result is long form::

    <label cols...>, outcome, cnt, pct, label_count

One hash aggregate per crosstab: the outcome domain is known, so the counts
of every outcome are conditional counts in a single ``groupBy(label)``
(map-side combined, so a hot label is summed by many tasks), and
``stack`` turns them back into rows.  Zero cells come from the domain, not
from a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.rank import _cols, top_k, topk_per_group


def _lit_sql(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def crosstab_wide(df: DataFrame, label_cols, outcome: str, domain: Sequence,
                  weight: str | None = None) -> DataFrame:
    """One row per label: label_count, n_outcome and one count per domain value.

    ``weight`` names a pre-aggregated row count (rows were grouped before a
    join to shrink the shuffle); without it every row counts once.
    """
    labels = _cols(label_cols)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    aggs = [F.sum(w).alias("label_count"),
            F.sum(F.when(F.col(outcome).isNotNull(), w).otherwise(zero)).alias("_n_outcome")]
    aggs += [F.sum(F.when(F.col(outcome) == F.lit(v), w).otherwise(zero)).alias(f"_c{i}")
             for i, v in enumerate(domain)]
    return df.groupBy(*labels).agg(*aggs)


def wide_to_long(wide: DataFrame, label_cols, outcome: str, domain: Sequence,
                 digits: int = 4) -> DataFrame:
    labels = _cols(label_cols)
    pairs = ", ".join(f"{_lit_sql(v)}, _c{i}" for i, v in enumerate(domain))
    stacked = wide.select(*labels, "label_count", "_n_outcome",
                          F.expr(f"stack({len(domain)}, {pairs}) AS ({outcome}, cnt)"))
    pct = F.coalesce(F.round(F.try_divide(F.col("cnt").cast("double"), F.col("_n_outcome")), digits),
                     F.lit(0.0))
    return stacked.select(*labels, outcome, F.col("cnt").cast("long").alias("cnt"),
                          pct.alias("pct"), F.col("label_count").cast("long").alias("label_count"))


def crosstab_full(df: DataFrame, label_cols, outcome: str, domain: Sequence,
                  digits: int = 4, weight: str | None = None) -> DataFrame:
    """Labels × fixed outcome domain, row %, 0 fill, label counts.

    Rows with a null label are dropped (crosstab semantics); map nulls to a
    label first (P5) to keep them.
    """
    labels = _cols(label_cols)
    base = df.where(F.col(labels[0]).isNotNull()) if labels else df
    return wide_to_long(crosstab_wide(base, labels, outcome, domain, weight), labels, outcome,
                        domain, digits)


def crosstab_rowpct(df: DataFrame, label: str, outcome: str, digits: int = 4) -> DataFrame:
    """Row-normalised crosstab over the observed cells (sparse long form).

    Cells that never occur are implicit zeros; use ``crosstab_full`` with a
    domain to materialise them.
    """
    base = df.where(F.col(label).isNotNull() & F.col(outcome).isNotNull())
    cells = base.groupBy(label, outcome).agg(F.count(F.lit(1)).alias("cnt"))
    totals = cells.groupBy(label).agg(F.sum("cnt").alias("label_count"))
    return (cells.join(totals, label)
            .select(label, outcome, "cnt",
                    F.round(F.col("cnt") / F.col("label_count"), digits).alias("pct"),
                    "label_count"))


def crosstab_topk(df: DataFrame, label: str, outcome: str, domain: Sequence, k: int,
                  digits: int = 4, weight: str | None = None) -> DataFrame:
    """Top-k labels overall (by count, then label), row % over outcomes.

    The crosstab aggregate already carries each label's count, so the top-k
    is a TakeOrdered over aggregated rows: one shuffle in total.
    """
    wide = crosstab_wide(df.where(F.col(label).isNotNull()), label, outcome, domain, weight)
    best = top_k(wide, [F.col("label_count").desc(), F.col(label).asc()], k, rank_col="label_rank")
    return (wide_to_long(best, [label, "label_rank"], outcome, domain, digits))


def crosstab_topk_by_type(df: DataFrame, type_col: str, label: str, outcome: str,
                          domain: Sequence, k: int, digits: int = 4,
                          weight: str | None = None) -> DataFrame:
    """Top-k labels inside each type, row % over outcomes, counts."""
    wide = crosstab_wide(df.where(F.col(label).isNotNull()), [type_col, label], outcome, domain,
                         weight)
    best = topk_per_group(wide, type_col, [F.col("label_count").desc(), F.col(label).asc()], k,
                          rank_col="label_rank", slice_cols=[label])
    return wide_to_long(best, [type_col, label, "label_rank"], outcome, domain, digits)


def collapse_rare(df: DataFrame, col: str, k: int, out_col: str, other: str = "Other",
                  order_col: str | None = None) -> DataFrame:
    """Values outside the top-k most frequent → 'Other'.

    The top-k set is at most k rows, so it is broadcast.  ``order_col``
    receives the numeric-then-Other display order (value order for kept
    values, k for Other).
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    keep = (top_k(counts, [F.col("_n").desc(), F.col(col).asc()], k, rank_col=None)
            .select(F.col(col).alias("_keep")))
    if order_col:
        keep = keep.withColumn(order_col, F.rank().over(Window.orderBy("_keep")) - 1)
    joined = df.join(F.broadcast(keep), F.col(col) == F.col("_keep"), "left")
    out = joined.withColumn(out_col, F.when(F.col("_keep").isNotNull(), F.col(col).cast("string"))
                            .otherwise(F.lit(other)))
    if order_col:
        out = out.withColumn(order_col, F.coalesce(F.col(order_col), F.lit(k)))
    return out.drop("_keep")


def ordered_domain(df: DataFrame, label: str, order: Sequence, pos_col: str = "pos",
                   drop_absent: bool = True) -> DataFrame:
    """Attach the fixed display position of each label; absent labels
    are dropped (``drop_absent``) or kept with a null position."""
    case = F.lit(None).cast("int")
    for i, v in reversed(list(enumerate(order))):
        case = F.when(F.col(label) == F.lit(v), F.lit(i)).otherwise(case)
    out = df.withColumn(pos_col, case)
    return out.where(F.col(pos_col).isNotNull()) if drop_absent else out
