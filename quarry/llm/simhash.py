"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into segments, each with a table of its values.  Two
fingerprints within ``max_distance`` bits differ by at most ``max_distance //
segments`` bits in some segment, so the small Hamming ball of that many bits
is enumerated around each segment value, the matches are fetched from the
segment's table, and every match is verified by its complete distance.

A value that more than ``most`` fingerprints share is kept out of its table.
Its fingerprints, and those whose value is in its ball, meet under whole codes
half-way between them instead: such an entry holds no more fingerprints than
one ball has codes, so there is no hot bucket, no cap and no pair explosion.
Components follow by distributed star rounds.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_batches, materialize, release, texts_of
from .components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
#: Two halves, each with a ball of one bit: a value of 32 bits stays selective up to billions of fingerprints.
SEGMENTS = 2
#: Fingerprints that may share a segment's value before the value is split.
MOST_IN_ENTRY = 64
SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z lower-cased, words cut at ASCII
    white space, all shingles with repeats, a bit set when over half the
    shingle hashes have it.  No words: 0."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends - size + 1
    n = max(1, len(words) - words_per_shingle + 1)
    first, last = starts[:n].tolist(), ends[min(words_per_shingle, len(words)) - 1:].tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        hashes = np.array([h(flat[a:b], SEED) for a, b in zip(first[at:at + _BLOCK], last[at:at + _BLOCK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, rk, fp`` (text hash, signed 64-bit fingerprint) for every input row."""
    def f(cols):
        fp = np.array([fingerprint(t, words_per_shingle) for t in texts_of(cols["text"])], np.uint64).view(np.int64)
        return {"doc_id": cols["doc_id"], "rk": cols["rk"], "fp": fp}
    text = F.col(text_col).cast("string")
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("rk")),
                       f, "doc_id long, rk long, fp long")


def ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _cuts(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment; together they have all 64 bits."""
    edges = [64 * s // segments for s in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _long_array(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(v)).cast("long") for v in values])


def _values(codes: DataFrame, segments: int) -> DataFrame:
    """``fp, seg, value``: one row per fingerprint and segment."""
    return codes.select("fp", F.inline(F.array(*[
        F.struct(F.lit(i).alias("seg"), F.shiftrightunsigned("fp", at).bitwiseAND(F.lit(_signed((1 << width) - 1))).alias("value"))
        for i, (at, width) in enumerate(_cuts(segments))])))


def _around(values: DataFrame, segments: int, radius: int) -> DataFrame:
    """``values`` with ``near``, one row per member of the ball around ``value``."""
    masks = F.lit(None).cast("array<long>")
    for i, (_, width) in enumerate(_cuts(segments)):
        masks = F.when(F.col("seg") == i, _long_array(ball(width, radius))).otherwise(masks)
    return values.withColumn("mask", F.explode(masks)).withColumn("near", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _half_way_links(codes: DataFrame, max_distance: int) -> DataFrame:
    """``src, dst`` edges that connect every two of ``codes`` within the distance:
    both have some code half-way between them in their ball of half the
    distance.  For an even distance each fingerprint of an entry is linked to
    the least one, which it is near to."""
    masks = _long_array(ball(64, (max_distance + 1) // 2))
    probes = codes.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("code"), "fp")
    entries = probes.groupBy("code").agg(F.sort_array(F.collect_list("fp")).alias("near")).where(F.size("near") > 1)
    if max_distance % 2 == 0:
        pairs = entries.select(F.col("near")[0].alias("src"), F.explode(F.slice("near", 2, 2147483647)).alias("dst"))
    else:  # an odd distance: two in an entry may be one bit too far from each other
        pairs = entries.select(F.explode("near").alias("src"), "near").select("src", F.explode("near").alias("dst")).where("src < dst")
    return pairs.where(_distance(F.col("src"), F.col("dst")) <= max_distance)


def near_links(codes: DataFrame, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS,
               most: int = MOST_IN_ENTRY) -> DataFrame:
    """``src, dst`` edges of distinct fingerprints (column ``fp``) within the
    distance.  Every two that are so near are joined by a path of edges: by an
    edge of their own when the segment values they meet under are in the
    tables, else through an entry of a half-way code."""
    spark = codes.sparkSession
    codes = codes.select("fp").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    radius = max_distance // segments
    values = _values(codes, segments)
    key = ["seg", "value"]
    big = materialize(values.groupBy(*key).count().where(F.col("count") > most).select(*key))
    # Values within the ball of a big one, itself included.
    beside = materialize(_around(big, segments, radius).select("seg", F.col("near").alias("value")).distinct())
    # All joins are merged: Spark sizes a side behind an explode by what goes into it, so it would broadcast far more.
    table = values.join(big.hint("merge"), key, "left_anti")
    # Of two different values the greater one probes; equal ones meet once, by the order of the fingerprints.
    probes = _around(table, segments, radius).where("near <= value").select(
        "seg", F.col("near").alias("value"), F.col("fp").alias("src"), (F.col("near") == F.col("value")).alias("same"))
    met = probes.join(table.hint("merge"), key).where((~F.col("same") | (F.col("src") < F.col("fp"))) &
                                        (_distance(F.col("src"), F.col("fp")) <= max_distance))
    met = met.select(F.least("src", "fp").alias("src"), F.greatest("src", "fp").alias("dst"))
    crowded = values.join(beside.hint("merge"), key, "left_semi").select("fp").distinct()
    links = materialize(met.unionByName(_half_way_links(crowded, max_distance)).distinct())
    release(big, beside)
    return links


def _named(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int = SHINGLE_WORDS,
           max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """``doc_id, rk, fp`` of every row, and ``code, component_id, label`` of
    every fingerprint; ``label`` tells components apart that have no id."""
    fps = materialize(fingerprints(docs, id_col, text_col, words_per_shingle))
    codes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = near_links(codes, max_distance, segments)
    labels = connected_components(links)
    release(links)
    least = materialize(codes.join(labels.hint("merge"), codes["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label")))
    release(codes, labels)
    ids = materialize(least.groupBy("label").agg(F.min("least").alias("component_id")))
    named = materialize(least.join(ids.hint("merge"), "label").select(F.col("fp").alias("code"), "component_id", "label"))
    release(least, ids)
    return fps, named


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS,
                max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id`` (the least doc_id reachable over fingerprints that differ
    in ``max_distance`` bits or fewer).

    Null and empty texts, and texts of white space, have fingerprint zero and
    link like any other.  Rows with equal fingerprints, repeated rows and
    repeated ids among them, share a component; a null doc_id is never a
    component_id unless the component has no other (then it is null).  Very
    long texts are hashed in blocks.  An empty table gives no rows."""
    fps, named = _named(docs, id_col, text_col, words_per_shingle, max_distance, segments)
    return fps.join(named.hint("merge"), F.col("fp") == F.col("code")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each component, all columns kept: the one of the least
    doc_id, a null doc_id last, and among rows of one doc_id that of the least
    text hash.  Of repeated rows (same id and text) the one whose other columns
    come first as JSON stays.  Null, empty and white-space texts are one
    component; an empty table gives no rows; columns of any name pass."""
    fps, named = _named(docs, id_col, text_col, **kw)
    rows = fps.groupBy("fp", "doc_id", "rk").agg(F.count(F.lit(1)).alias("n")).join(
        named.hint("merge"), F.col("fp") == F.col("code"))
    first = rows.groupBy("label").agg(F.min(F.struct(F.isnull("doc_id").alias("nil"), "doc_id", "rk", "n")).alias("first"))
    i, k = fresh(docs, "stay_id"), fresh(docs, "stay_hash")
    stay = materialize(first.select(F.col("first.doc_id").alias(i), F.col("first.rk").alias(k), F.col("first.n").alias("n")))
    release(fps, named)
    here = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(k))
    single, repeated = (stay.where(c).drop("n") for c in ("n = 1", "n > 1"))
    kept = docs.join(single, here, "left_semi")
    if repeated.isEmpty():
        return kept
    row = F.struct(*docs.columns)
    one = docs.join(repeated, here).groupBy(i, k).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return kept.unionByName(one.select("row.*"))
