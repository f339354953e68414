"""Deterministic sampling and splits.

Randomness is a hash: rows are ordered by ``md5(id ':' seed)``, which is
independent of partitioning, task retries and executor loss (a recomputed
partition draws exactly the same rows), unlike ``rand()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.rank import attach, topk_per_group


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """V2: n rows without replacement (TakeOrdered on the hash key)."""
    return df.withColumn("_h", hash_key(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")


def sample_cap_per_group(df: DataFrame, group: str, id_col: str, cap: int, seed: int = 42) -> DataFrame:
    """V3: at most ``cap`` rows per group (two-phase top-k, skew-safe)."""
    h = df.withColumn("_h", hash_key(id_col, seed))
    return topk_per_group(h, group, [F.col("_h"), F.col(id_col)], cap, rank_col="_r",
                          slice_cols=[id_col]).drop("_h", "_r")


def _class_positions(df: DataFrame, label: str, id_col: str, seed: int, buckets_hex: int = 4) -> DataFrame:
    """Rank of each row inside its class in hash order, plus the class size.

    The md5 key is uniform, so its first hex digits split every class into
    16^``buckets_hex`` equally sized, ordered slices: rows are ranked inside
    (class, slice) windows and the slice offsets come from a small running
    total — a huge class is spread over many tasks, and every step is a
    pure function of the data (stable under task retries).
    """
    h = df.withColumn("_h", hash_key(id_col, seed)) \
          .withColumn("_s", F.conv(F.substring("_h", 1, buckets_hex), 16, 10).cast("int"))
    local = h.withColumn("_lr", F.row_number().over(Window.partitionBy(label, "_s").orderBy("_h", id_col)))
    sizes = h.groupBy(label, "_s").agg(F.count(F.lit(1)).alias("_ss"))
    w = Window.partitionBy(label)
    sizes = (sizes.withColumn("_off", F.coalesce(F.sum("_ss").over(
        w.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("class_n", F.sum("_ss").over(w)).drop("_ss"))
    return (local.join(sizes, [label, "_s"])
            .withColumn("class_pos", (F.col("_off") + F.col("_lr")).cast("long"))
            .drop("_s", "_lr", "_off", "_h"))


def split_train_test(df: DataFrame, id_col: str, train_frac: float = 0.8, seed: int = 42) -> DataFrame:
    """V1: seeded row split: the first floor(frac·n) rows in hash order are train."""
    # Only ids are ranked; the last train row's (hash, id) then labels whole rows.
    pos = _class_positions(df.select(id_col, F.lit(0).alias("_all")), "_all", id_col, seed)
    cut = pos.where(F.col("class_pos") == F.floor(F.col("class_n") * train_frac)).agg(
        F.max(F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))).alias("_cut"))
    here = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    return attach(df, cut, []).withColumn("split", F.when(here <= F.col("_cut"), F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_cut")


def _order_key(id_col: str, seed: int) -> Column:
    return F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))


def _class_cuts(ranked: DataFrame, label: str, id_col: str, seed: int, ends: dict[str, Column]) -> DataFrame:
    """One row per class: the order key of the class's row at each end position.
    Only those rows are kept of the ranked ids, at most one per end and class."""
    at_an_end = F.lit(False)
    for end in ends.values():
        at_an_end = at_an_end | (F.col("class_pos") == end)
    return ranked.where(at_an_end).groupBy(label).agg(*[
        F.max(F.when(F.col("class_pos") == end, _order_key(id_col, seed))).alias(name) for name, end in ends.items()])


#: Classes whose cuts are sent to every task; with more of them the rows are shuffled by class.
CUTS_SENT = 100_000


def _beside_cuts(df: DataFrame, cuts: DataFrame, label: str) -> DataFrame:
    """Rows with their class's cuts.  The cuts are finished and counted first,
    because a join planned before their size is known shuffles whole rows by
    class, which brings each class into one task."""
    cuts = cuts.checkpoint()
    return df.join(F.broadcast(cuts) if cuts.count() <= CUTS_SENT else cuts, label)


def split_stratified(df: DataFrame, label: str, id_col: str, test: float = 0.2, val: float = 0.0,
                     seed: int = 42) -> DataFrame:
    """V4: per class, the first ceil(test·n_c) rows in hash order are test,
    then (of the rest) ceil(val/(1-test)·rest) are validation, the others train.

    Only labels and ids are ranked.  Whole rows then meet one row of cuts per
    class (broadcast up to ``CUTS_SENT`` classes), so no class's rows are brought together.  Rows of one id and class
    come into the same part; rows without a class into none."""
    n = F.col("class_n")
    n_test = F.ceil(n * test)
    rest = n - n_test
    n_val = F.ceil(rest * (val / (1 - test))) if val > 0 else F.lit(0)
    ranked = _class_positions(df.select(label, id_col), label, id_col, seed)
    cuts = _class_cuts(ranked, label, id_col, seed, {"_test": n_test, "_val": n_test + n_val})
    here = _order_key(id_col, seed)
    split = F.when(here <= F.col("_test"), F.lit("test")).when(here <= F.col("_val"), F.lit("val")).otherwise(F.lit("train"))
    return _beside_cuts(df, cuts, label).select(*df.columns, split.alias("split"))


def sample_stratified_proportional(df: DataFrame, label: str, id_col: str, size: int,
                                   seed: int = 42, min_per_class: int = 2) -> DataFrame:
    """V5: per class ``max(2, round_half_even(n_c / N · size))`` rows, capped by
    the class size; classes left with fewer than 2 rows are dropped.  Rows are
    picked by their class's cut, as in ``split_stratified``."""
    ranked = _class_positions(df.select(label, id_col), label, id_col, seed)
    total = df.agg(F.count(F.lit(1)).alias("_N"))
    want = F.least(F.greatest(F.lit(min_per_class),
                              F.bround(F.col("class_n") * size / F.col("_N"), 0).cast("long")),
                   F.col("class_n"))
    ranked = ranked.crossJoin(F.broadcast(total)).where(want >= min_per_class)  # one-row scalar
    cuts = _class_cuts(ranked, label, id_col, seed, {"_last": want})
    return _beside_cuts(df, cuts, label).where(_order_key(id_col, seed) <= F.col("_last")).select(*df.columns)
