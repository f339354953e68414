"""Evaluation reports over prediction tables (SURVEY Q1-Q8, Q12, Q16, K5,
K6, M12, U1, U2, W2).

A prediction table is long form: ``keys..., actual, predicted`` (keys
identify the model/attribute).  Everything is derived from one
``groupBy(keys, actual, predicted).count`` — the confusion cells — which
is tiny compared with the predictions, so the reports are cheap at any
scale and never collect predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.rank import _cols, attach, top_k, topk_per_group


def confusion_cells(pred: DataFrame, actual: str, predicted: str, keys=()) -> DataFrame:
    keys = _cols(keys)
    return (pred.groupBy(*keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def _per_label(cells: DataFrame, keys: list[str]) -> DataFrame:
    """tp, support and predicted count per label of the truth ∪ prediction set."""
    known = lambda c: F.when(F.col(c).isNotNull(), F.col("cnt")).otherwise(0)
    none = F.lit(0).cast("long")
    # Each cell counts once for its true and once for its predicted label, so
    # one aggregate over the cells gives all three counts.
    roles = F.array(
        F.struct(F.col("actual").alias("label"), known("actual").alias("support"), none.alias("n_pred"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("cnt")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"), known("predicted").alias("n_pred"),
                 none.alias("tp")))
    out = (cells.select(*keys, F.explode(roles).alias("_role")).select(*keys, "_role.*")
           .groupBy(*keys, "label").agg(*[F.sum(c).alias(c) for c in ("support", "n_pred", "tp")]))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    out = out.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return out.withColumn("f1", f1)


def classification_metrics(pred: DataFrame, actual: str, predicted: str, keys=(), digits: int = 4) -> DataFrame:
    """Q1: accuracy, macro/weighted F1, macro precision/recall (zero division → 0)."""
    keys = _cols(keys)
    per = _per_label(confusion_cells(pred, actual, predicted, keys), keys)
    agg = per.groupBy(*keys).agg(
        F.sum("tp").alias("_tp"), F.sum("support").alias("_n"),
        F.avg("f1").alias("macro_f1"), F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.sum(F.col("f1") * F.col("support")).alias("_wf1"))
    return agg.select(*keys,
                      F.round(F.col("_tp") / F.col("_n"), digits).alias("accuracy"),
                      F.round("macro_f1", digits).alias("macro_f1"),
                      F.round(F.col("_wf1") / F.col("_n"), digits).alias("weighted_f1"),
                      F.round("macro_precision", digits).alias("macro_precision"),
                      F.round("macro_recall", digits).alias("macro_recall"),
                      F.col("_n").cast("long").alias("n"))


def class_report(pred: DataFrame, actual: str, predicted: str, keys=(), digits: int = 4) -> DataFrame:
    """Q2: per-class precision, recall, F1, support plus 'macro avg' and
    'weighted avg' rows (labels as strings)."""
    keys = _cols(keys)
    per = _per_label(confusion_cells(pred, actual, predicted, keys), keys)
    rows = per.select(*keys, F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    macro = per.groupBy(*keys).agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                   F.sum("support").cast("long").alias("support"))
    w = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    weighted = per.groupBy(*keys).agg(F.lit("weighted avg").alias("label"), w("precision").alias("precision"),
                                      w("recall").alias("recall"), w("f1").alias("f1"),
                                      F.sum("support").cast("long").alias("support"))
    out = rows.unionByName(macro).unionByName(weighted)
    return out.select(*keys, "label", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")],
                      "support")


def confusion_full(pred: DataFrame, actual: str, predicted: str, keys=()) -> DataFrame:
    """Q3: dense confusion matrix over the truth ∪ prediction labels.

    The label set per key is the (small) set of classes; the dense grid is
    an ``explode`` of that bounded array, then the observed cells are joined."""
    keys = _cols(keys)
    cells = confusion_cells(pred, actual, predicted, keys)
    labels = (cells.select(*keys, F.col("actual").alias("l")).union(cells.select(*keys, F.col("predicted").alias("l")))
              .distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("l")).alias("_ls")))
    grid = labels.select(*keys, F.explode("_ls").alias("actual"), "_ls") \
        .select(*keys, "actual", F.explode("_ls").alias("predicted"))
    return (grid.join(cells, [*keys, "actual", "predicted"], "left")
            .select(*keys, "actual", "predicted", F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt")))


def confusion_top_normalized(pred: DataFrame, actual: str, predicted: str, top_labels: DataFrame,
                             keys=(), digits: int = 4) -> DataFrame:
    """Q4: confusion over the chosen labels (rows whose truth or prediction
    is outside are dropped first), row-normalised, empty rows → 0."""
    keys = _cols(keys)
    lab = top_labels.select(F.col(top_labels.columns[0]).alias("_l"))
    full = confusion_full(pred, actual, predicted, keys)
    lab_b = F.broadcast(lab)  # the chosen label list (top-k) is bounded
    inside = (full.join(lab_b, F.col("actual") == F.col("_l"), "left_semi")
              .join(lab_b.withColumnRenamed("_l", "_p"), F.col("predicted") == F.col("_p"), "left_semi"))
    tot = inside.groupBy(*keys, "actual").agg(F.sum("cnt").alias("_row"))
    out = inside.join(tot, [*keys, "actual"])
    return out.select(*keys, "actual", "predicted", "cnt",
                      F.coalesce(F.round(F.try_divide(F.col("cnt").cast("double"), F.col("_row")), digits),
                                 F.lit(0.0)).alias("share"))


def top_confusions(pred: DataFrame, actual: str, predicted: str, k: int = 12, keys=()) -> DataFrame:
    """K6: the k largest off-diagonal cells (ties: actual, predicted)."""
    keys = _cols(keys)
    off = confusion_cells(pred, actual, predicted, keys).where(F.col("actual") != F.col("predicted"))
    order = [F.col("cnt").desc(), F.col("actual"), F.col("predicted")]
    return topk_per_group(off, keys, order, k) if keys else top_k(off, order, k)


def quadratic_kappa(pred: DataFrame, actual: str, predicted: str, keys=(), digits: int = 4) -> DataFrame:
    """Q6: quadratic weighted kappa ``1 - Σ w·O / Σ w·E`` with w = (i-j)² on
    the positions of the sorted truth ∪ prediction labels.

    Σ w·E is expanded into row/column moments, so no label × label grid is
    built: Σ w·E = (Σi²r_i·C - 2·Σi·r_i·Σj·c_j + R·Σj²c_j) / n."""
    return kappa_of_cells(confusion_cells(pred, actual, predicted, _cols(keys)), keys, digits)


def kappa_of_cells(cells: DataFrame, keys=(), digits: int = 4) -> DataFrame:
    """``quadratic_kappa`` from the cells of ``confusion_cells``."""
    keys = _cols(keys)
    labels = (cells.select(*keys, F.col("actual").alias("l")).union(cells.select(*keys, F.col("predicted").alias("l")))
              .distinct())
    # Label positions: ranking the (small) label set of each key.
    w = Window.partitionBy(*keys).orderBy("l") if keys else Window.orderBy("l")
    pos = labels.withColumn("_pos", (F.row_number().over(w) - 1).cast("double"))
    c = (cells.join(pos.withColumnRenamed("l", "actual").withColumnRenamed("_pos", "_i"), [*keys, "actual"])
         .join(pos.withColumnRenamed("l", "predicted").withColumnRenamed("_pos", "_j"), [*keys, "predicted"]))
    n = F.col("cnt").cast("double")
    agg = c.groupBy(*keys).agg(
        F.sum(n).alias("_n"), F.sum(n * F.pow(F.col("_i") - F.col("_j"), 2)).alias("_wo"),
        F.sum(n * F.col("_i")).alias("_ri1"), F.sum(n * F.col("_i") * F.col("_i")).alias("_ri2"),
        F.sum(n * F.col("_j")).alias("_cj1"), F.sum(n * F.col("_j") * F.col("_j")).alias("_cj2"))
    we = (F.col("_ri2") * F.col("_n") - 2 * F.col("_ri1") * F.col("_cj1") + F.col("_n") * F.col("_cj2")) / F.col("_n")
    kappa = 1 - F.try_divide(F.col("_wo"), we)
    return agg.select(*keys, F.round(kappa, digits).alias("qwk"))


def regression_metrics(pred: DataFrame, y: str, yhat: str, keys=(), digits: int = 4) -> DataFrame:
    """Q8: MAE, RMSE and R² per key (two passes: mean of y, then sums)."""
    keys = _cols(keys)
    base = pred.select(*keys, F.col(y).cast("double").alias("_y"), F.col(yhat).cast("double").alias("_p")) \
        .where(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    means = base.groupBy(*keys).agg(F.avg("_y").alias("_my"))
    j = attach(base, means, keys)
    agg = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("_y") - F.col("_p"))).alias("_mae"),
                               F.avg(F.pow(F.col("_y") - F.col("_p"), 2)).alias("_mse"),
                               F.sum(F.pow(F.col("_y") - F.col("_p"), 2)).alias("_sse"),
                               F.sum(F.pow(F.col("_y") - F.col("_my"), 2)).alias("_sst"))
    return agg.select(*keys, "n", F.round("_mae", digits).alias("mae"), F.round(F.sqrt("_mse"), digits).alias("rmse"),
                      F.round(F.when(F.col("_sst") == 0, F.lit(0.0)).otherwise(1 - F.col("_sse") / F.col("_sst")),
                              digits).alias("r2"))


def hard_vote(df: DataFrame, pred_cols: Sequence[str], out: str = "vote") -> Column:
    """Row-local hard majority vote; ties go to the smallest label."""
    arr = F.array(*[F.col(c) for c in pred_cols])
    scored = F.transform(arr, lambda p: F.struct((-F.size(F.filter(arr, lambda q: q == p))).alias("neg"),
                                                  p.alias("label")))
    return F.array_min(scored)["label"].alias(out)


def leaderboard(metrics: DataFrame, name: str, primary: str = "macro_f1", secondary: str = "weighted_f1",
                family: str | None = None, digits: int = 4) -> DataFrame:
    """Rank runs by (primary desc, secondary desc) with failures
    (nulls) last, flag the best run, and the gap of each family's best to
    the overall best.  The run table has one row per fitted model, so the
    global window over it is bounded by the number of runs."""
    order = [F.col(primary).desc_nulls_last(), F.col(secondary).desc_nulls_last(), F.col(name)]
    ranked = metrics.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    best = ranked.where(F.col("rank") == 1).select(F.col(primary).alias("_best"))
    out = attach(ranked, best, []).withColumn("gap_to_best", F.round(F.col("_best") - F.col(primary), digits))
    if family:
        fw = Window.partitionBy(family).orderBy(*order)
        out = out.withColumn("family_rank", F.row_number().over(fw))
    return out.drop("_best").withColumn("is_best", F.col("rank") == 1)
