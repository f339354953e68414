"""Fuzzy line dedup by MinHash, in DataFrame functions only.

Lines that are equal after trimming and lower-casing are one line.  Distinct
lines get MinHash signatures of their character shingles, bands of the
signature put likely equals into buckets, candidates that a bitmap of their
shingles does not rule out are verified by the exact Jaccard similarity of their
shingle sets, and distributed union-find over the
verified links gives components, of which the first line stays.

Buckets are worked off in rounds.  Ids are ordered by how often a line occurs,
so the first lead of a bucket is its most frequent line, which is likely the
original of its variants.  It is compared with all lines of the bucket.  Lines
of buckets that this leaves open carry their size, bitmap and 16-bit shingle
hashes from then on: about eight, 128, ... lines that are not in the component of
the least line meet every line of the bucket outside their own component, and the
join itself refuses the pairs that these rule out, so that it gives little more
than the near pairs.  A bucket is done when each of its lines is
in that one component or has been compared with the others: two lines of
different components are not both in it.  So a bucket full of near copies costs
about as many comparisons as it has lines, none of its links is given up, and no
bucket is gathered anywhere.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, release
from .components import connected_components

SHINGLE_CHARS = 6
SIMILARITY = 0.8
#: 6 groups of 6 minima; every 5 of a group are a band.  Two lines of similarity
#: 0.8 share a band with probability 1 - (1 - (0.8^6 + 6 * 0.8^5 * 0.2))^6 = 0.9983.
GROUPS, GROUP, ROWS = 6, 6, 5
#: Leads of a bucket grow by this factor a round.
GROWTH = 16
#: Positions of one exploded row; bounds the arrays that a very long line needs.
STRETCH = 4096
#: 64-bit words of a line's shingle bitmap.
SKETCH_WORDS = 32
#: Spark's limit, in bytes, of a method of whole-stage code; HotSpot compiles none above 8000.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _written(df: DataFrame) -> DataFrame:
    """``materialize``, without whole-stage code where a stage's method would be
    too long for the JVM to compile: the bucket join then takes a fifth of the time."""
    conf = df.sparkSession.conf
    before = conf.get(METHOD_LIMIT)
    conf.set(METHOD_LIMIT, "8000")
    try:
        return materialize(df)
    finally:
        conf.set(METHOD_LIMIT, before)


def _norm(line: Column) -> Column:
    return F.lower(F.trim(line))


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, rk, line_no, norm`` for every line that is not blank."""
    text = F.col(text_col).cast("string")
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("rk"),
                        F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "rk", "line_no", _norm(F.col("line")).alias("norm")).where("norm <> ''")


def _order(h: Column, k: int) -> Column:
    """The ``k``-th order of 32-bit hashes: a rotation, then a fixed mask."""
    turn, mask = k * 11 % 32, (k + 1) * 0x9E3779B9 % (1 << 32) - (1 << 31)
    turned = F.shiftleft(h, turn).bitwiseOR(F.shiftrightunsigned(h, 32 - turn)) if turn else h
    return turned.bitwiseXOR(F.lit(mask))


def _shingles(lines: DataFrame, shingle: int) -> DataFrame:
    """``id, h``: a 32-bit hash of every shingle of ``id, units`` (the line in
    UTF-16, two bytes a unit).  A line shorter than a shingle is its own only
    shingle."""
    last = F.greatest(F.floor(F.octet_length("units") / 2).cast("int") - shingle, F.lit(0))
    parts = lines.select("id", "units", last.alias("last"), F.explode(F.sequence(F.lit(0), last, F.lit(STRETCH))).alias("at"))
    each = parts.select("id", "units", F.explode(F.sequence("at", F.least(F.col("at") + STRETCH - 1, F.col("last")))).alias("i"))
    return each.select("id", F.hash(F.substring("units", F.col("i") * 2 + 1, F.lit(2 * shingle))).alias("h"))


def signatures(lines: DataFrame, shingle: int = SHINGLE_CHARS, n: int = GROUPS * GROUP) -> DataFrame:
    """``id, m0..`` from ``id, units``.  32-bit hashes do for candidates: a
    collision can only add one, which is then verified."""
    h = _shingles(lines, shingle)
    return h.groupBy("id").agg(*[F.min(_order(F.col("h"), k)).alias(f"m{k}") for k in range(n)])


def _parts(group: int, rows: int) -> list[list[tuple[int, list[int]]]]:
    """The bands of a group by a part that each contains whole.  A band leaves
    out ``group - rows`` minima, so that of one part more at least one is whole."""
    n = group - rows + 1
    edges = [group * i // n for i in range(n + 1)]
    out = [[] for _ in range(n)]
    for b, some in enumerate(combinations(range(group), rows)):
        whole = next(i for i in range(n) if set(range(edges[i], edges[i + 1])) <= set(some))
        out[whole].append((b, list(some)))
    return [[(edges[i], edges[i + 1]), bands] for i, bands in enumerate(out)]


def _banded(sig: DataFrame, g: int, group: int, rows: int) -> DataFrame:
    """``id, bucket``: the bands of group ``g`` of the lines that can share one.
    Lines with a band in common agree in the part of the group that it contains
    whole, so only those that share a part with another line make its bands."""
    m = [f"m{g * group + i}" for i in range(group)]
    parts = _parts(group, rows)
    keys = [F.xxhash64(F.lit(i), *m[a:b]) for i, ((a, b), _) in enumerate(parts)]
    rows_of = sig.select("id", *m, F.posexplode(F.array(*keys)).alias("part", "key")).repartition("key")
    twice = rows_of.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    alike = _written(rows_of.join(twice.select("key").hint("merge"), "key", "left_semi").drop("key"))
    none = F.lit(None).cast("array<long>")
    made = none
    for i, (_, bands) in enumerate(parts):
        made = F.when(F.col("part") == i, F.array(*[F.xxhash64(F.lit(g), F.lit(b), *[m[x] for x in some]) for b, some in bands])
                      if bands else none).otherwise(made)
    out = alike.select("id", F.explode(made).alias("bucket"))
    out._written_to = alike._written_to
    return out


def buckets(sig: DataFrame, g: int, group: int = GROUP, rows: int = ROWS) -> DataFrame:
    """``bucket, id, lead, n``: lines that share a band of group ``g``, the
    least of them and their number."""
    banded = _banded(sig, g, group, rows)
    sizes = _written(banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("lead")).where("n > 1"))
    out = _written(banded.join(sizes.hint("merge"), "bucket").select("bucket", "id", "lead", "n"))
    release(sizes, banded)
    return out


def _set(text: str, shingle: int) -> Column:
    """Distinct shingle hashes of a line.  The line goes through a one-element
    array so that the inner function refers to it instead of copying it."""
    def of(u: Column) -> Column:
        last = F.greatest(F.floor(F.octet_length(u) / 2).cast("int") - shingle, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.substring(u, i * 2 + 1, F.lit(2 * shingle))))
    return F.array_distinct(F.flatten(F.transform(F.array(F.encode(text, "UTF-16BE")), of)))


def sketches(lines: DataFrame, shingle: int = SHINGLE_CHARS, words: int = SKETCH_WORDS) -> DataFrame:
    """``id, size, w0..``: the number of shingles of a line, repeats included,
    and a bitmap of ``64 * words`` bits with the bit of every shingle set."""
    each = _shingles(lines, shingle)
    bit = F.expr("shiftleft(1L, cast(pmod(shiftright(h, 8), 64) as int))")
    word = F.pmod("h", F.lit(words))
    return each.groupBy("id").agg(F.count("*").alias("size"), *[
        F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{k}") for k in range(words)])


def short_sets(text: DataFrame, shingle: int = SHINGLE_CHARS) -> DataFrame:
    """``id, exact, short`` of ``id, norm``: the number of distinct shingles of
    a line and their hashes cut to 16 bits, each once."""
    sets = text.select("id", _set("norm", shingle).alias("of"))
    return sets.select("id", F.size("of").alias("exact"),
                       F.array_distinct(F.transform("of", lambda h: (F.pmod(h, F.lit(1 << 16)) - (1 << 15)).cast("short"))).alias("short"))


def _side(table: DataFrame, name: str, words: int, *more: Column) -> DataFrame:
    return table.select(*more, F.col("id").alias(name), F.col("size").alias(f"size_{name}"),
                        *[F.col(f"w{k}").alias(f"{name}{k}") for k in range(words)],
                        *[F.col(c).alias(f"{c}_{name}") for c in ("exact", "short") if c in table.columns])


def _possible(similarity: float, words: int) -> Column:
    """Whether the sketches of ``a`` and ``b`` leave the pair possible.  This
    drops no near pair: each bit that only one of two lines has stands for at
    least one shingle that only that line has, and sets of x and y shingles that
    differ in d have the Jaccard similarity (x + y - d) / (x + y + d).  ``size``
    counts repeats, so it is at least x."""
    apart = sum((F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in range(words)), F.lit(0))
    return apart <= (F.col("size_a") + F.col("size_b")) * ((1 - similarity) / (1 + similarity)) + 1e-6


def _near_enough(similarity: float) -> Column:
    """Whether the 16-bit hashes of ``a`` and ``b`` leave the pair possible.
    This drops no near pair: two lines have at most one shingle in common for
    each hash that both have, and besides at most as many as the line has whose
    shingles lose fewer to equal hashes."""
    part = round(similarity * 10**6)
    lost = F.least(F.col("exact_a") - F.size("short_a"), F.col("exact_b") - F.size("short_b"))
    common = F.size(F.array_intersect("short_a", "short_b")) + lost
    return common.cast("long") * (10**6 + part) >= (F.col("exact_a") + F.col("exact_b")).cast("long") * part


def possible(pairs: DataFrame, bits: DataFrame, similarity: float, words: int = SKETCH_WORDS) -> DataFrame:
    """The ``a, b`` pairs that their sketches leave possible."""
    both = pairs.join(_side(bits, "a", words).hint("merge"), "a").join(_side(bits, "b", words).hint("merge"), "b")
    return both.where(_possible(similarity, words)).select("a", "b")


def verified(pairs: DataFrame, text: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The ``a, b`` pairs whose shingle sets have at least that Jaccard similarity."""
    a = text.select(F.col("id").alias("a"), F.col("norm").alias("ta"))
    b = text.select(F.col("id").alias("b"), F.col("norm").alias("tb"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    # Both sets go into one value that a lambda refers to, so that each is made
    # once; the limit is in whole numbers: k / (n - k) >= part / 10^6.
    part = round(similarity * 10**6)
    sets = F.array(F.struct(_set("ta", shingle).alias("x"), _set("tb", shingle).alias("y")))
    near = F.exists(sets, lambda p: F.size(F.array_intersect(p["x"], p["y"])).cast("long") * (10**6 + part)
                    >= (F.size(p["x"]) + F.size(p["y"])).cast("long") * part)
    return both.where(near).select("a", "b")


def near_lines(lines: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE_CHARS,
               groups: int = GROUPS, group: int = GROUP, rows: int = ROWS, words: int = SKETCH_WORDS) -> DataFrame:
    """``node, component`` of the distinct lines ``id, norm`` that have a near line."""
    units = lines.select("id", F.encode("norm", "UTF-16BE").alias("units"))
    sig = _written(signatures(units, shingle, groups * group))
    # A group after another, so that the keys of one only are on disk at a time.
    parts = [buckets(sig, g, group, rows) for g in range(groups)]
    now = reduce(DataFrame.unionByName, parts)
    release(sig)
    # Only the text of lines that share a bucket goes through the rounds.
    shared = now.select("id").distinct()
    text = _written(lines.join(shared.hint("merge"), "id", "left_semi").select("id", "norm"))
    bits = _written(sketches(text.select("id", F.encode("norm", "UTF-16BE").alias("units")), shingle, words))
    pairs = now.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    pairs = _written(possible(pairs, bits, similarity, words))
    found = _written(verified(pairs, text, similarity, shingle))
    release(pairs)
    named = connected_components(found, "a", "b")
    release(found)
    # Buckets of two lines are done; the lead of a larger one has met the others.
    met = now.where("n > 2").select("bucket", "id", (F.col("id") == F.col("lead")).alias("done"))
    sketch, leads, number = ["size", *[f"w{k}" for k in range(words)], "exact", "short"], 8, 1
    while True:
        members = met.join(named.hint("merge"), met["id"] == named["node"], "left").select(
            *met.columns, F.coalesce("component", "id").alias("comp"))
        members = _written(members)
        release(now, *parts)
        parts = []
        low = members.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
        # Lines outside the bucket's least component that have still to be compared.
        ready = members.join(low.select("bucket", "low").hint("merge"), "bucket").withColumn(
            "open", ~F.col("done") & (F.col("comp") != F.col("low"))).drop("low")
        left = ready.groupBy("bucket").agg(F.sum(F.col("open").cast("long")).alias("left"),
                                           F.min(F.when(F.col("open"), F.col("id"))).alias("first")).where("left > 0")
        state = _written(left.select("bucket", "first", (F.lit(float(leads)) / F.col("left")).alias("share")))
        if state.isEmpty():
            release(members, state, text, bits)
            return named
        draw = F.pmod(F.xxhash64("id", "bucket", F.lit(number)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        now = ready.join(state.hint("merge"), "bucket").withColumn(
            "leads", F.col("open") & ((F.col("id") == F.col("first")) | (draw < F.col("share")))).drop("open", "first", "share")
        # The sketches join the open buckets once and stay with them.
        if "size" not in now.columns:
            some = text.join(now.select("id").distinct().hint("merge"), "id", "left_semi")
            now = now.join(bits.hint("merge"), "id").join(short_sets(some, shingle).hint("merge"), "id")
        now = _written(now)
        release(members, state)
        first = _side(now.where("leads"), "a", words, F.col("bucket"), F.col("comp").alias("of_a"))
        other = _side(now, "b", words, F.col("bucket").alias("at"), F.col("comp").alias("of_b"))
        cross = other.join(first.hint("merge"), (F.col("at") == F.col("bucket")) & (F.col("of_a") != F.col("of_b"))
                           & _possible(similarity, words) & _near_enough(similarity))
        pairs = _written(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        found = _written(verified(pairs, text, similarity, shingle))
        release(pairs)
        if not found.isEmpty():
            last = named
            links = found.unionByName(named.select(F.col("node").alias("a"), F.col("component").alias("b")))
            named = connected_components(links, "a", "b")
            release(last)
        release(found)
        met = now.select("bucket", "id", (F.col("done") | F.col("leads")).alias("done"), *sketch)
        leads, number = leads * GROWTH, number + 1


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    shingle: int = SHINGLE_CHARS) -> DataFrame:
    """``doc_id, rk, line_no`` of every line that goes: all of a component but
    its first, in the order of (doc_id, line_no)."""
    occ = line_table(docs, id_col, text_col)
    distinct = occ.groupBy("norm").agg(F.count("*").alias("n"))
    # Frequent lines get small ids: 9 bits of 8 log2(n) above the running number,
    # which stays below 2^54 up to 2^21 partitions.
    often = F.lit(511) - F.floor(F.log2("n") * 8)
    distinct = _written(distinct.withColumn("id", often * F.lit(1 << 54) + F.monotonically_increasing_id()))
    named = near_lines(distinct.select("id", "norm"), similarity, shingle)
    key = [F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit("line"), F.col("norm")).alias("h2")]
    # The keys are made before the join, so that no text goes through it.
    short = distinct.select("id", "n", *key)
    multi = short.join(named.hint("merge"), short["id"] == named["node"], "left").where("n > 1 or node is not null").select(
        "h1", "h2", F.coalesce("component", "id").alias("comp"))
    multi = _written(multi)
    seen = occ.select("doc_id", "rk", "line_no", *key)
    release(distinct, named)
    hit = _written(seen.join(multi.hint("merge"), ["h1", "h2"]).select("doc_id", "rk", "line_no", "comp"))
    first = _written(hit.groupBy("comp").agg(F.min(F.struct("doc_id", "line_no", "rk")).alias("first")))
    here = F.struct("doc_id", "line_no", "rk")
    out = hit.join(first.hint("merge"), "comp").where(~here.eqNullSafe(F.col("first"))).select("doc_id", "rk", "line_no").distinct()
    out = _written(out)
    release(multi, hit, first)
    return out


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with every duplicate line taken out of its text, plus ``n_lines``
    and ``n_dropped``; all rows stay, also those left with an empty text.

    Blank lines are not compared and stay.  Null texts stay null and have no
    lines; an empty text has one blank line.  Repeated rows (same id and text)
    are one document and lose the same lines.  Null ids come first in the
    order.  Ties cannot occur: two lines of a document differ in number.  Very
    long lines are cut into stretches of shingles, never shortened.  An empty
    table gives none.  Other columns stay; those named ``n_lines`` or
    ``n_dropped`` are replaced."""
    found = duplicate_lines(docs, id_col, text_col, **kw)
    i, k, gone, lines, kept, h = (fresh(docs, x) for x in ("gone_id", "gone_key", "gone", "gone_lines", "gone_kept", "gone_hash"))
    taken = _written(found.groupBy(F.col("doc_id").alias(i), F.col("rk").alias(k)).agg(F.collect_set("line_no").alias(gone)))
    release(found)
    text = F.col(text_col).cast("string")
    out = docs.withColumn(h, F.xxhash64(text))
    out = out.join(taken.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.col(h) == F.col(k)), "left")
    out = out.withColumn(lines, F.split(text, "\n"))
    n = F.size(lines)
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col(gone))
    parts = F.col(lines)
    rest = F.array_join(F.transform(stay, lambda at: F.get(parts, at)), "\n")
    out = out.withColumn(kept, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(rest))
    return out.select(*[F.col(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")],
                      F.when(n > 0, n).otherwise(0).alias("n_lines"),
                      F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias("n_dropped"))


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text``: each document without its duplicate lines."""
    return drop_duplicate_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "text")
