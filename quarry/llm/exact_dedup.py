"""Exact dedup by distributed most-significant-digit radix partitioning.

The digits of a text are its length and then its bytes in order, in digits of
48, 192, 768, ... bytes.  Each round splits every open group by its next
digit; a group of one row leaves (singleton), a group whose bytes are used up
leaves as a class of equal texts.  Rows are compared by their bytes alone: a
group is named by its least row, not by a digest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

FIRST_DIGIT = 48
GROWTH = 4


def _same_row(a: DataFrame, b: DataFrame):
    return (a["rk"] == b["rk"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def _split(level: DataFrame, keys: list[str]) -> DataFrame:
    """Members of the groups of two rows or more under ``keys``, each named by
    its least row; the groups are counted by a combinable aggregate and joined
    back, so AQE can split a group that holds much of the table."""
    groups = materialize(level.groupBy(*keys).agg(
        F.count("*").alias("n"), F.max("doc_id").alias("keep_id"),
        F.min(F.struct("doc_id", "rk")).alias("next")).where("n > 1"))
    own = [c for c in ("doc_id", "rk", "len") if c not in keys]
    out = level.select(*own, *keys).join(groups.hint("merge"), keys)
    return materialize(out.select("doc_id", "rk", "len", F.col("next").alias("gid"), "n", "keep_id"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  The largest doc_id of a group stays (a null id sorts below all
    others).  Repeated rows (same doc_id, same text) count each in
    ``group_size`` and share one decision.  Other columns are not read.  An
    empty table gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), ascii_lower(text_col).cast("binary").alias("t"))
    rows = rows.select("doc_id", F.xxhash64("t").alias("rk"), F.octet_length("t").alias("len"), "t")
    head = materialize(rows.select("doc_id", "rk", "len", F.substring("t", 1, FIRST_DIGIT).alias("digit"),
                                   F.sha2("t", 256).alias("text_sha256")))
    split = _split(head, ["len", "digit"])
    closed = [split.where(F.col("len") <= FIRST_DIGIT)]
    level = split.where(F.col("len") > FIRST_DIGIT).select("doc_id", "rk", "len", "gid").distinct()
    level = materialize(level)
    longest = level.agg(F.max("len")).first()[0] or 0
    if longest:
        long_rows = rows.where(F.col("len") > FIRST_DIGIT)
        text = materialize(long_rows.join(level.hint("merge"), _same_row(long_rows, level), "left_semi")
                           .select("doc_id", "rk", "t"))
    pos, width = FIRST_DIGIT, FIRST_DIGIT * GROWTH
    while pos < longest:
        digits = text.where(F.octet_length("t") > pos).select("doc_id", "rk", F.substring("t", pos + 1, width).alias("digit"))
        cur = materialize(digits.join(level.hint("merge"), _same_row(digits, level)).select(
            digits["doc_id"], digits["rk"], "len", "gid", "digit"))
        split = _split(cur, ["gid", "digit"])
        pos, width = pos + width, width * GROWTH
        closed.append(split.where(F.col("len") <= pos))
        level = split.where(F.col("len") > pos).select("doc_id", "rk", "len", "gid").distinct()
    classes = reduce(DataFrame.unionByName, [c.select("doc_id", "rk", "n", "keep_id") for c in closed]).distinct()
    out = head.join(classes.hint("merge"), _same_row(head, classes), "left").select(
        head["doc_id"], "n", "keep_id", "text_sha256")
    keep = F.when(F.col("n").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep = exact_groups(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha")).distinct()
    sha = F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256)
    return docs.join(keep, docs[id_col].cast("long").eqNullSafe(keep["_keep_id"]) & (sha == keep["_keep_sha"]), "left_semi")
