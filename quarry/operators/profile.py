"""Column profiles, overviews and frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.crosstab import _lit_sql
from quarry.operators.rank import _cols, top_k

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def columns_by_dtype(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical column names (schema metadata only)."""
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, NUMERIC) and f.name not in exclude]
    cat = [f.name for f in df.schema.fields
           if not isinstance(f.dataType, NUMERIC) and f.name not in exclude]
    return num, cat


def _stack(df: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Unpivot one wide aggregate row into one row per column name."""
    body = ", ".join(
        f"{_lit_sql(n)}, {i}, " + ", ".join(f"`{n}__{f}`" for f in fields)
        for i, n in enumerate(names))
    cols = ", ".join(["column", "position", *fields])
    return df.select(F.expr(f"stack({len(names)}, {body}) AS ({cols})"))


def column_profile(df: DataFrame, target: str | None = None, blank_is_missing: bool = False,
                   digits: int = 2) -> DataFrame:
    """A1/A2 (+P20): per column dtype, non-null, missing, missing %, feature kind.

    One aggregation pass over the table computes every column's missing
    count; ``blank_is_missing`` also counts strings that are empty after
    trimming (A2).
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in fields:
        miss = F.col(f.name).isNull()
        if blank_is_missing and isinstance(f.dataType, T.StringType):
            miss = miss | (F.trim(F.col(f.name)) == F.lit(""))
        aggs.append(F.count_if(miss).alias(f"{f.name}__missing"))
    wide = df.agg(*aggs)
    names = [f.name for f in fields]
    long = _stack(wide.select("__rows", *[f"{n}__missing" for n in names]), names, ["missing"])
    long = long.crossJoin(wide.select("__rows"))  # one-row scalar
    dtypes = {f.name: f.dataType.simpleString() for f in fields}
    num, _ = columns_by_dtype(df)
    dtype_col = F.lit(None).cast("string")
    kind = F.lit("Categorical")
    for n in names:
        dtype_col = F.when(F.col("column") == n, F.lit(dtypes[n])).otherwise(dtype_col)
    if num:
        kind = F.when(F.col("column").isin(num), F.lit("Numerical")).otherwise(kind)
    if target:
        kind = F.when(F.col("column") == target, F.lit("Target")).otherwise(kind)
    missing = F.col("missing").cast("long")
    return long.select(
        "column", F.col("position").cast("int").alias("position"),
        dtype_col.alias("dtype"), kind.alias("feature_kind"),
        (F.col("__rows") - missing).cast("long").alias("non_null"),
        missing.alias("missing"),
        F.coalesce(F.round(F.try_divide(missing * 100.0, F.col("__rows")), digits),
                   F.lit(0.0)).alias("missing_pct"))


def value_counts(df: DataFrame, col: str, out: str = "cnt", by_key: bool = False) -> DataFrame:
    """A4/A5: frequency by value, ordered by count (desc, then value) or by value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    order = [F.col(col).asc_nulls_last()] if by_key else [F.col(out).desc(), F.col(col).asc_nulls_last()]
    return counts.orderBy(*order)


def category_shares(df: DataFrame, col: str, top: int = 10, bottom: int = 5,
                    digits: int = 2) -> DataFrame:
    """Top-k counts with % share of all rows, plus the k smallest."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    heads = top_k(counts, [F.col("cnt").desc(), F.col(col).asc()], top).withColumn("part", F.lit("top"))
    tails = top_k(counts, [F.col("cnt").asc(), F.col(col).desc()], bottom).withColumn("part", F.lit("bottom"))
    both = heads.unionByName(tails).crossJoin(F.broadcast(total))  # one-row scalar
    return both.select("part", "rank", col, "cnt",
                       F.round(F.col("cnt") * 100.0 / F.col("_total"), digits).alias("share_pct"))


def imbalance(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Max, min and max/min of the class counts (null when min is 0)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.agg(F.max("cnt").alias("max_count"), F.min("cnt").alias("min_count"),
                      F.round(F.try_divide(F.max("cnt").cast("double"), F.min("cnt")), digits)
                      .alias("imbalance_ratio"))


def duplicates(df: DataFrame, subsets: dict[str, Sequence[str]]) -> DataFrame:
    """Extra copies (rows - distinct groups) for each named column subset.

    Nulls compare equal (grouping semantics)."""
    rows = None
    for name, cols in subsets.items():
        part = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
                .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))
                .select(F.lit(name).alias("subset"), "duplicates"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def dataset_overview(df: DataFrame, class_col: str, date_col: str | None = None,
                     flags: dict | None = None) -> DataFrame:
    """A3: rows, columns, distinct classes, date range and conditional counts."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
            F.count_distinct(F.col(class_col)).alias("classes")]
    if date_col:
        aggs += [F.min(date_col).alias("date_min"), F.max(date_col).alias("date_max")]
    for name, cond in (flags or {}).items():
        aggs.append(F.count_if(cond).alias(name))
    return df.agg(*aggs)
