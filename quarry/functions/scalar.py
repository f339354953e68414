"""Scalar Column builders: labels, flags, parsing, rounding, JSON access.

All of them are native Catalyst expressions (whole-stage codegen), never
Python UDFs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_labels(col, mapping: Mapping, default: str = "Unknown") -> Column:
    """P5: code → label with a default for unknown codes and nulls."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.coalesce(m[F.col(col) if isinstance(col, str) else col], F.lit(default))


def fill_defaults(df, defaults: Mapping[str, object]):
    """Per-column null fill."""
    return df.na.fill(dict(defaults))


def parse_date(col, fmt: str | None = None) -> Column:
    """Lenient date parse; unparsable text becomes null (ANSI-safe)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def combined_text(a, b) -> Column:
    """Trim both parts, join with one space, trim again."""
    return F.trim(F.concat_ws(" ", F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))))


def flag(cond: Column, yes: str, no: str) -> Column:
    """Two-way label from a predicate."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def key_from_filename(col) -> Column:
    """Text before the last '-' of a file name (whole name when no '-')."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.contains("-"), F.regexp_extract(c, r"^(.*)-[^-]*$", 1)).otherwise(c)


def safe_ratio(num, den, digits: int = 4, default: float = 1.0) -> Column:
    """Rounded ratio, ``default`` when the denominator is not positive."""
    return F.when(den > 0, F.round(num / den, digits)).otherwise(F.lit(default))


def nearest_reference(ratio: Column, refs: Mapping[float, str]) -> Column:
    """Label of the closest reference ratio (first listed wins ties)."""
    items = list(refs.items())
    best_d = F.abs(ratio - F.lit(items[0][0]))
    best_l = F.lit(items[0][1])
    for r, lab in items[1:]:
        d = F.abs(ratio - F.lit(r))
        best_l = F.when(d < best_d, F.lit(lab)).otherwise(best_l)
        best_d = F.least(best_d, d)
    return best_l


def clip(col, lo: float, hi: float) -> Column:
    """clip into [lo, hi]."""
    c = F.col(col) if isinstance(col, str) else col
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def floor_at(col, lo: float) -> Column:
    """lower bound only (e.g. a 1e-9 norm floor)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.greatest(c, F.lit(lo))


def date_text(col, fmt: str = "yyyy-MM-dd") -> Column:
    """date → text."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, fmt)


def trim_lower_strip(col, quote: str = '"') -> Column:
    """strip spaces, lower-case, drop quote characters."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(F.regexp_replace(c, quote, "")))


def concat_label(*parts: Column, sep: str = "__") -> Column:
    """composite run id such as ``feature__reducer__model``."""
    return F.concat_ws(sep, *parts)


def safe_id(col) -> Column:
    """file-system-safe id ('/', '-', '.' and spaces → '_')."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(c, "/-. ", "____")


def round_half_even(col, digits: int) -> Column:
    """F5 variant: Python-style rounding of exact halves."""
    return F.bround(F.col(col) if isinstance(col, str) else col, digits)


def json_path(col, path: str, default=None, cast: str | None = None) -> Column:
    """optional nested JSON access with a default."""
    v = F.get_json_object(F.col(col) if isinstance(col, str) else col, path)
    if cast:
        v = v.try_cast(cast) if hasattr(v, "try_cast") else v.cast(cast)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def top_labels(arr: Column, k: int) -> Column:
    """label descriptions sorted by score (desc), first k.

    ``arr`` is ``array<struct<description, score>>``; missing scores sort
    as 0.  Ties keep the description order to stay deterministic.
    """
    srt = F.array_sort(arr, lambda a, b: F.when(
        F.coalesce(a.score, F.lit(0.0)) > F.coalesce(b.score, F.lit(0.0)), F.lit(-1))
        .when(F.coalesce(a.score, F.lit(0.0)) < F.coalesce(b.score, F.lit(0.0)), F.lit(1))
        .otherwise(F.lit(0)))
    return F.transform(F.slice(F.coalesce(srt, F.array()), 1, k), lambda x: x.description)


def colors(arr: Column, k: int | None = None) -> Column:
    """F8: dominant colours with missing channels defaulting to 0."""
    mapped = F.transform(F.coalesce(arr, F.array()), lambda x: F.struct(
        F.coalesce(x.color.red, F.lit(0.0)).alias("red"),
        F.coalesce(x.color.green, F.lit(0.0)).alias("green"),
        F.coalesce(x.color.blue, F.lit(0.0)).alias("blue"),
        F.coalesce(x.score, F.lit(0.0)).alias("score")))
    return F.slice(mapped, 1, k) if k else mapped


def bbox_from_vertices(vertices: Column) -> Column:
    """Polygon vertices (x, y may be absent → 0) → struct(x, y, w, h)."""
    xs = F.transform(vertices, lambda v: F.coalesce(v.x, F.lit(0)))
    ys = F.transform(vertices, lambda v: F.coalesce(v.y, F.lit(0)))
    x0, y0 = F.array_min(xs), F.array_min(ys)
    return F.struct(x0.alias("x"), y0.alias("y"), (F.array_max(xs) - x0).alias("w"),
                    (F.array_max(ys) - y0).alias("h"))


def bbox_pct(bbox: Column, width: Column, height: Column, digits: int = 2) -> Column:
    """Bbox as percentages of the image size."""
    return F.struct(
        F.round(bbox.x * 100.0 / width, digits).alias("x_pct"),
        F.round(bbox.y * 100.0 / height, digits).alias("y_pct"),
        F.round(bbox.w * 100.0 / width, digits).alias("w_pct"),
        F.round(bbox.h * 100.0 / height, digits).alias("h_pct"))


def label_ids(labels: Sequence[str]) -> dict[str, int]:
    """F12 helper for small fixed label sets (sorted label → id)."""
    return {lab: i for i, lab in enumerate(sorted(labels))}
