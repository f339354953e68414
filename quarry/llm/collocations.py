"""Phrase collocation mining by SON partitioning.

Support counts are per language.  Three passes read the text:

1. Words.  Every task sums its own words; one aggregate gives the frequent
   words and the total ``n`` of every language.
2. Shards.  Documents are dealt into shards of one language and bounded size.
   A shard with the share w of its language's bytes is mined completely, level
   by level, at local support t = ceil(w * support).  A phrase that stays at
   t - 1 or below in every shard is below the support everywhere, so the union
   of the shards' finds loses nothing.  A shard reports count - (t - 1); what
   it does not report can be t - 1 at most, so a phrase whose reports and the
   sum of all t - 1 of its language stay below the support is left out of the
   union.  Where shards are many, t is 1 and this bound is the exact count.
3. Counts.  All candidates are counted over all text, word for word.

Tasks know frequent words and candidates from bitmaps of fixed size over
64-bit hashes.  A bitmap can only let too much through, and the exact counts
decide.  Pieces never meet: a phrase lies within one piece.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.rank import topk_per_group

from .common import materialize, release, slices, texts_of

SUPPORT = 30
MAX_WORDS = 4
TOP = 2000
#: A phrase goes when a longer candidate around it has this percentage of its count.
ABSORBED = 80
SCORE_SCALE = 2_000_000
#: Bytes of text in a shard, and of text whose counts a task holds before it hands them on.
SHARD_BYTES = 24 << 20
#: Bytes of text for each hash range in which finds are united and counts summed.
BUCKET_BYTES = 8 << 20
#: Bits of a bitmap (16 MB), of which one row holds 2^15.
BITMAP_BITS = 1 << 27
#: White space that ends a word, and what ends a piece.
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\xff" * 10 + b" ")
_SPACES = re.compile(rb"[^ ]+")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Shard:
    """Word numbers of the texts of one language, pieces kept apart by 0."""

    def __init__(self):
        self.number, self.parts, self.bytes = {b"\xff": 0}, [], 0

    def add(self, text: bytes) -> None:
        """A-Z lower-cased; 0xFF, which no UTF-8 text has, marks the piece ends."""
        number = self.number
        words = _SPACES.findall(text.lower().translate(_BREAKS).replace(b"\xff", b" \xff ") + b" \xff")
        self.parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
        self.bytes += len(text)

    def hashes(self, lang: str) -> np.ndarray:
        """A 64-bit hash of every word number, with its language."""
        import xxhash
        seed = xxhash.xxh64_intdigest(lang.encode())
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.number), np.uint64, len(self.number))

    def words(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)


def chain(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase, extended by one word."""
    x = h * np.uint64(_MIX[0])
    x ^= word + np.uint64(_MIX[1])
    x ^= x >> np.uint64(29)
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(32)
    return x


def levels(words: np.ndarray, hashes: np.ndarray, usable: np.ndarray, max_words: int, may, keep):
    """For each length from 2: ``(first position, count, hash)`` of the
    distinct phrases that ``keep(count)`` lets stand.  A phrase is extended
    only where it stood and its last words stood as well, for no phrase is
    more frequent than its parts.  ``may(hash)`` passes over occurrences
    before they are sorted; it may let too many through, never too few.  The
    last word is a piece end, so every position has a next one."""
    at = np.flatnonzero(usable[words]).astype(np.int32)
    ids = words[at]
    h = hashes[ids]
    for size in range(2, max_words + 1):
        stood = np.zeros(len(words), bool)
        stood[at] = True
        ok = stood[at + 1]
        at, ids, h = at[ok], ids[ok], h[ok]
        h = chain(h, hashes[words[at + (size - 1)]])
        ok = may(h)
        at, ids, h = at[ok], ids[ok], h[ok]
        del stood, ok
        base, standing = 0, np.zeros(len(at), bool)
        # Equal phrases have equal hashes: an eighth of the hashes at a time bounds what is sorted at once.
        for eighth in range(8):
            some = np.flatnonzero(h >> np.uint64(61) == eighth)
            key = ids[some].astype(np.int64) * len(hashes) + words[at[some] + (size - 1)]
            _, first, new, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            ok, first = keep(counts), some[first]
            yield size, at[first[ok]], counts[ok], h[first[ok]]
            ids[some], standing[some] = new + base, ok[new]
            base += len(first)
        at, ids, h = at[standing], ids[standing], h[standing]


def _bucket_counts(h: np.ndarray, t: int) -> np.ndarray:
    """Whether a hash's bucket holds ``t`` occurrences or more."""
    if t <= 1:
        return np.ones(len(h), bool)
    bucket = (h >> np.uint64(42)).astype(np.int64)
    return (np.bincount(bucket, minlength=1 << 22) >= t)[bucket]


class Bitmap:
    """Fixed-size set of hashes without false negatives."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(BITMAP_BITS - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bitmap(hashes: DataFrame) -> Bitmap:
    """From column ``h``: one row of 4 KB for each 2^15 bits, so that the
    driver gets 16 MB at most, whatever the table's size."""
    at = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1  # Spark's bitmaps number their positions from 1
    rows = hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for b, bits in rows.toLocalIterator():
        out[(b - 1) * 4096:b * 4096] = np.frombuffer(bits, np.uint8)
    return Bitmap(out)


def _shards(batches, most: int):
    """``(lang, Shard)`` of a task's texts, handed on at ``most`` bytes in all."""
    held, size = {}, 0
    for b in batches:
        for part in slices(b):
            for lang, text in zip(part.column("lang").to_pylist(), texts_of(part.column("text"))):
                if lang not in held:
                    held[lang] = Shard()
                held[lang].add(text)
                size += len(text)
                if size >= most:
                    yield from held.items()
                    held, size = {}, 0
    yield from held.items()


def _count_words(batches):
    """``lang, phrase, h, n`` of the words of each run of texts."""
    for lang, shard in _shards(batches, SHARD_BYTES):
        counts = np.bincount(shard.words(), minlength=len(shard.number))
        counts[0] = 0
        at = np.flatnonzero(counts)
        names = list(shard.number)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.repeat(lang, len(at)), "phrase": pa.array([names[i].decode() for i in at], pa.string()),
            "h": shard.hashes(lang)[at].view(np.int64), "n": counts[at]})


def _ranges(h: np.ndarray, buckets: int):
    """``(bucket, order, cuts)``: the hash range of every hash in the order of
    the hashes, and where the ranges begin and end."""
    order = np.argsort(h)
    bucket = ((h[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    return bucket, order, np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(h)] if len(h) else np.zeros(1, np.int64)


def _mine_shard(table: pa.Table, frequent, support: int, max_words: int, buckets: int) -> pa.Table:
    """``lang, bucket, slack, h, over``: a shard's phrases at local support,
    count less (t - 1), those of one hash range packed into one row; ``slack``
    is t - 1, also in a row of bucket -1 that every shard has."""
    lang, whole, shard = table["lang"][0].as_py(), table["whole"][0].as_py(), Shard()
    for b in table.select(["text"]).to_batches():
        for part in slices(b):
            for text in texts_of(part.column(0)):
                shard.add(text)
    del table
    t = max(1, -(-support * shard.bytes // max(whole, 1)))
    words, hashes = shard.words(), shard.hashes(lang)
    counts = np.bincount(words, minlength=len(hashes))
    usable = (counts >= t) & frequent.value.has(hashes)
    usable[0] = False
    found, over = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, n, h in levels(words, hashes, usable, max_words, lambda h: _bucket_counts(h, t), lambda n: n >= t):
        found.append(h)
        over.append(n - (t - 1))
    h, over = np.concatenate(found), np.concatenate(over)
    bucket, order, cuts = _ranges(h, buckets)
    h, over = h[order], over[order]
    packs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    return pa.table({"lang": pa.repeat(lang, len(packs) + 1), "bucket": pa.array([-1, *bucket[cuts[:-1]].tolist()], pa.int64()),
                     "slack": pa.repeat(t - 1, len(packs) + 1), "h": pa.array([b"", *(h[a:b].tobytes() for a, b in packs)]),
                     "over": pa.array([b"", *(over[a:b].tobytes() for a, b in packs)])})


def _unite(table: pa.Table, support: int) -> pa.Table:
    """``h`` of one hash range that may reach the support in all shards."""
    h, over = (np.concatenate([np.frombuffer(x, kind) for x in table[c].to_pylist()]) for c, kind in (("h", np.uint64), ("over", np.int64)))
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    total = np.add.reduceat(over[order], first)
    return pa.table({"h": h[first[total + table["slack"][0].as_py() >= support]].view(np.int64)})


def _count_phrases(batches, frequent, candidates, max_words: int, buckets: int):
    """``lang, bucket, phrases, counts`` of the candidates in each run of
    texts, those of one hash range packed into one row."""
    for lang, shard in _shards(batches, SHARD_BYTES):
        words, hashes, names = shard.words(), shard.hashes(lang), list(shard.number)
        usable = frequent.value.has(hashes)
        usable[0] = False
        for size, at, n, h in levels(words, hashes, usable, max_words, candidates.value.has, lambda n: n > 0):
            bucket, order, cuts = _ranges(h, buckets)
            rows = words[at[order, None] + np.arange(size)].tolist()
            phrases = pa.array([b" ".join([names[w] for w in r]) for r in rows], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict({
                "lang": pa.repeat(lang, len(cuts) - 1), "bucket": bucket[cuts[:-1]],
                "phrases": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), phrases),
                "counts": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(n[order]))})


def _sum_counts(table: pa.Table, support: int) -> pa.Table:
    """``lang, phrase, f`` of one hash range's phrases that reach the support."""
    import pyarrow.compute as pc
    flat = {c: pa.chunked_array([x.flatten() for x in table[c].chunks]) for c in ("phrases", "counts")}
    sums = pa.table(flat).group_by("phrases").aggregate([("counts", "sum")])
    sums = sums.filter(pc.greater_equal(sums["counts_sum"], support))
    return pa.table({"lang": pa.repeat(table["lang"][0].as_py(), len(sums)), "phrase": sums["phrases"].cast(pa.string()),
                     "f": sums["counts_sum"]})


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                     max_words: int = MAX_WORDS, shard_bytes: int = SHARD_BYTES,
                     bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases of 1 to ``max_words`` words
    with f at ``support`` or more, and ``(lang, n)`` of all languages that
    have words; both exact."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("text <> ''")
    words = materialize(texts.mapInArrow(_count_words, "lang string, phrase string, h long, n long")
                        .groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.min("h").alias("h")))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = words.where(F.col("f") >= support)
    frequent = spark.sparkContext.broadcast(_bitmap(common))

    sizes = materialize(texts.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("whole")))
    whole = sizes.agg(F.coalesce(F.sum("whole"), F.lit(0))).first()[0]
    buckets = min(-(-whole // bucket_bytes) or 1, 1 << 31)
    # Rows are dealt in turn: equal texts and repeated ids spread over all shards of their language.
    deal = F.pmod("turn", F.floor((F.col("whole") - 1) / shard_bytes) + 1)
    dealt = texts.withColumn("turn", F.monotonically_increasing_id()).join(sizes, "lang").withColumn("shard", deal).drop("turn")
    found = materialize(dealt.groupBy("lang", "shard").applyInArrow(
        lambda table: _mine_shard(table, frequent, support, max_words, buckets),
        "lang string, bucket long, slack long, h binary, over binary"))
    # The t - 1 of a language's shards sum to less than the support.
    slack = found.where("bucket = -1").select("lang", "slack").groupBy("lang").agg(F.sum("slack").alias("slack"))
    union = found.where("bucket >= 0").drop("slack").join(slack, "lang").groupBy("lang", "bucket").applyInArrow(
        lambda table: _unite(table, support), "h long")
    candidates = spark.sparkContext.broadcast(_bitmap(union))
    release(found, sizes)

    packs = texts.mapInArrow(lambda b: _count_phrases(b, frequent, candidates, max_words, buckets),
                             "lang string, bucket long, phrases array<string>, counts array<long>")
    phrases = packs.groupBy("lang", "bucket").applyInArrow(lambda table: _sum_counts(table, support), "lang string, phrase string, f long")
    out = materialize(phrases.unionByName(common.select("lang", "phrase", "f"))
                      .withColumn("size", F.size(F.split("phrase", " "))))
    return out, totals


def _wide(c: Column | str, by: int) -> Column:
    """A product that may pass 64 bits."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)") * F.lit(by).cast("decimal(9,0)")


def mine_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                      max_words: int = MAX_WORDS, top: int = TOP, absorbed: int = ABSORBED,
                      shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The first ``top`` collocations of each language: ``lang, rank, phrase,
    a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces
    and at spaces and tabs into words.  A candidate has 2 to ``max_words``
    words and a count ``a`` of ``support`` or more, overlaps included.  Its
    score is ``floor(2000000 a / (l + r))`` at the cut into a first part
    (count l) and a rest (count r) where it is least, of equal ones the
    first.  A candidate that a longer candidate contains with ``absorbed``
    percent of its count goes.  Order: score, a (both descending), phrase.

    A null language counts as ``und``; null and empty texts have no words;
    repeated rows count as often as they stand there; a very long text is
    numbered whole, in the shard it was dealt to.  Extra columns are ignored,
    whatever their names; an empty table gives no rows."""
    phrases, totals = frequent_phrases(docs, text_col, lang_col, support, max_words, shard_bytes, bucket_bytes)
    parts = F.split("phrase", " ")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    candidates = phrases.where("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size")
    cuts = candidates.withColumn("w", parts).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "size", "k", F.concat_ws(" ", F.slice("w", 1, F.col("k"))).alias("head"),
        F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size"))).alias("rest"))
    both = cuts.join(part.select("lang", F.col("part").alias("head"), F.col("part_f").alias("l")), ["lang", "head"]).join(
        part.select("lang", F.col("part").alias("rest"), F.col("part_f").alias("r")), ["lang", "rest"])
    both = both.withColumn("scaled", _wide("a", SCORE_SCALE)).withColumn("parts", F.col("l").cast("decimal(20,0)") + F.col("r"))
    scored = both.groupBy("lang", "phrase", "a", "size").agg(
        F.min(F.struct(F.expr("scaled div parts").alias("score"), "k", "l", "r")).alias("cut"))

    longer = candidates.where("size > 2").withColumn("w", parts).withColumn(
        "k", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)))
    around = longer.groupBy("lang", F.concat_ws(" ", F.slice("w", F.col("i"), F.col("k"))).alias("phrase")).agg(
        F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (_wide("around", 100) < _wide("a", absorbed)))
    ranked = topk_per_group(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "lang",
                            [F.desc("score"), F.desc("a"), F.col("phrase")], top, slice_cols=["phrase"])
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
