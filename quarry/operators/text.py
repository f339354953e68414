"""Text statistics and long-form term/document matrices (SURVEY X1-X8,
E10-E14, K2, K4, W5).

Documents are tokenised once into an array column; ``explode`` turns that
into a long (doc, term) table whose aggregates are map-side combined, so a
very frequent term is counted by every task before any shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarry.functions.text import STOPWORDS, adjacent_pairs, tokenize
from quarry.operators.rank import attach, top_k, topk_per_group  # noqa: F401


def term_counts(df: DataFrame, tokens: Column, k: int | None = None, group=None,
                term: str = "term") -> DataFrame:
    """Token frequencies, optionally the top-k (per group)."""
    groups = [group] if isinstance(group, str) else list(group or [])
    counts = (df.select(*groups, F.explode(tokens).alias(term))
              .groupBy(*groups, term).agg(F.count(F.lit(1)).alias("cnt")))
    if k is None:
        return counts
    order = [F.col("cnt").desc(), F.col(term).asc()]
    if groups:
        return topk_per_group(counts, groups, order, k, slice_cols=[term])
    return top_k(counts, order, k)


def stopword_counts(df: DataFrame, text: Column, k: int = 20, digits: int = 2) -> DataFrame:
    """Top-k stop words (tokens of any length), their total, and the share
    of all stop-word tokens covered by the top k."""
    toks = F.filter(tokenize(text, min_len=1), lambda t: t.isin(STOPWORDS))
    counts = term_counts(df, toks, term="word")
    top = top_k(counts, [F.col("cnt").desc(), F.col("word").asc()], k)
    total = counts.agg(F.sum("cnt").alias("total_stopword_tokens"))
    share = top.agg(F.sum("cnt").alias("_top"))
    summary = attach(total, share, []).select(
        F.col("total_stopword_tokens").cast("long").alias("total_stopword_tokens"),
        F.round(F.try_divide(F.col("_top") * 100.0, F.col("total_stopword_tokens")), digits).alias("share_top"))
    return attach(top, summary, [])


def bigram_counts(df: DataFrame, text: Column, k: int = 20) -> DataFrame:
    """Top-k adjacent pairs after stop-word removal, inside documents."""
    # Tokens are projected once; building the pairs from the column keeps
    # the tokeniser from being copied into each of its three references.
    toks = df.select(tokenize(text, remove_stopwords=True).alias("_tok"))
    return term_counts(toks, adjacent_pairs(F.col("_tok")), k, term="bigram")


def vocabulary_richness(df: DataFrame, text: Column, digits: int = 4) -> DataFrame:
    """Totals, unique, type-token ratio, hapax and dis-legomena counts,
    mean distinct tokens per document (documents without tokens count 0)."""
    toks = df.select(tokenize(text, remove_stopwords=True).alias("_t"))
    per_doc = toks.agg(F.count(F.lit(1)).alias("docs"),
                       F.avg(F.size(F.array_distinct("_t"))).alias("_avg_unique"))
    counts = toks.select(F.explode("_t").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("c"))
    voc = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("total_tokens"),
                     F.count(F.lit(1)).alias("unique_tokens"),
                     F.count_if(F.col("c") == 1).alias("hapax_count"),
                     F.count_if(F.col("c") == 2).alias("dislegomena_count"))
    out = attach(voc, per_doc, [])
    return out.select(
        "total_tokens", "unique_tokens",
        F.coalesce(F.round(F.try_divide(F.col("unique_tokens").cast("double"), F.col("total_tokens")), digits),
                   F.lit(0.0)).alias("type_token_ratio"),
        "hapax_count",
        F.coalesce(F.round(F.try_divide(F.col("hapax_count").cast("double"), F.col("unique_tokens")), digits),
                   F.lit(0.0)).alias("hapax_ratio"),
        "dislegomena_count",
        F.coalesce(F.round("_avg_unique", 2), F.lit(0.0)).alias("avg_unique_per_doc"))


# ---------------------------------------------------------------------------
# Long-form term/document matrices
# ---------------------------------------------------------------------------
def term_frequencies(df: DataFrame, doc_col: str, terms: Column, keys=(), bigrams: bool = False) -> DataFrame:
    """(keys..., doc, term, tf) from an array-of-terms expression; with
    ``bigrams`` the adjacent pairs are appended (built from the projected
    token column, so the tokeniser runs once per document)."""
    keys = list(keys)
    base = df.select(*keys, doc_col, terms.alias("_tok"))
    grams = F.concat(F.col("_tok"), adjacent_pairs(F.col("_tok"))) if bigrams else F.col("_tok")
    return (base.select(*keys, doc_col, F.explode(grams).alias("term"))
            .groupBy(*keys, doc_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def char_ngram_frequencies(df: DataFrame, doc_col: str, text: Column, keys=()) -> DataFrame:
    """(keys..., doc, term, tf) of char_wb 3-5-grams.

    Words are counted per document first (map-side combined), so the
    n-grams of a word repeated k times are generated once with weight k."""
    from quarry.functions.text import text_words
    return _char_ngrams_of_words(df, doc_col, text_words(text), keys)


def _char_ngrams_of_words(df: DataFrame, doc_col: str, words: Column, keys=()) -> DataFrame:
    from quarry.functions.text import word_char_ngrams
    keys = list(keys)
    words = (df.select(*keys, doc_col, F.explode(words).alias("_w"))
             .groupBy(*keys, doc_col, "_w").agg(F.count(F.lit(1)).alias("_wc")))
    grams = words.select(*keys, doc_col, "_wc", F.explode(word_char_ngrams(F.col("_w"))).alias("term"))
    return grams.groupBy(*keys, doc_col, "term").agg(F.sum("_wc").alias("tf"))


# Terms counted inside the task that holds a document's row
#: Distinct (row, term) pairs counted at a time for character n-grams.
_PAIRS = 1 << 21


#: Words of an Arrow batch that are counted at a time, so that a worker's memory does not grow with its batches.
_WORDS = 1 << 18


def pieces(batch: pa.RecordBatch, column: str, most: int | None = None):
    """Cut a batch into runs of rows with about ``most`` values in a list column
    (a longer row alone); a batch without rows is one run."""
    most, n, a = most or _WORDS, batch.num_rows, 0
    ends = np.cumsum(pc.list_value_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield batch.slice(a, b - a)
        a = b
    if not n:
        yield batch


def _word_grams(word: str) -> list[str]:
    """``functions.text.word_char_ngrams`` for one word."""
    p, out = f" {word} ", []
    for n in (3, 4, 5):
        if len(p) > n:
            out += [p[i:i + n] for i in range(len(p) - n + 1)]
        elif len(p) == n or n == 3:
            out.append(p)
    return out


def _row_counts(lists: pa.ListArray, kind: str):
    """``(terms, row, code, tf)`` of the rows of a string list column: distinct
    (row, term) pairs and their counts, no row in two pieces.  ``kind``: the
    strings themselves, ``bigrams`` added, or the ``chars`` n-grams of words."""
    flat, row = lists.flatten(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
    if flat.null_count:
        flat, row = flat.drop_null(), row[flat.is_valid().to_numpy(zero_copy_only=False)]
    if kind == "bigrams" and len(flat) > 1:
        words = flat.dictionary_encode()
        words, code, width = words.dictionary, words.indices.to_numpy().astype(np.int64), len(words.dictionary)
        if not pc.any(pc.match_substring(words, " ")).as_py():   # no word or other pair reads as a pair
            beside = np.flatnonzero(row[1:] == row[:-1])
            pair, made = pd.factorize(code[beside] * width + code[beside + 1])
            made = pc.binary_join_element_wise(words.take(pa.array(made // width)), words.take(pa.array(made % width)), pa.scalar(" ", flat.type))
            terms, code, row = pa.concat_arrays([words, made]), np.concatenate([code, pair + width]), np.concatenate([row, row[beside]])
            pair, tf = np.unique(row * len(terms) + code, return_counts=True)
            yield terms, pair // len(terms), pair % len(terms), tf
            return
        beside = row[1:] == row[:-1]
        pairs = pc.binary_join_element_wise(flat[:-1], flat[1:], pa.scalar(" ", flat.type)).filter(pa.array(beside))
        flat, row = pa.concat_arrays([flat, pairs]), np.concatenate([row, row[1:][beside]])
    if not len(flat):
        return
    coded = flat.dictionary_encode()
    terms, width = coded.dictionary, len(coded.dictionary)
    pair, tf = np.unique(row * width + coded.indices.to_numpy(), return_counts=True)
    row, code = pair // width, pair % width
    if kind != "chars":
        yield terms, row, code, tf
        return
    grams = [_word_grams(w) for w in terms.to_pylist()]
    size = np.array([len(g) for g in grams])
    coded = pa.array([x for g in grams for x in g], pa.string()).dictionary_encode()
    gram, start, terms = coded.indices.to_numpy(), np.cumsum(size) - size, coded.dictionary
    made, at = np.cumsum(size[code]), 0
    while at < len(code):
        most = (made[at - 1] if at else 0) + _PAIRS
        last = row[min(int(np.searchsorted(made, most, "right")), len(row) - 1)]
        to = int(np.searchsorted(row, last, "left"))
        to = to if to > at else int(np.searchsorted(row, last, "right"))
        to = len(row) if made[-1] <= most else to
        n, c = size[code[at:to]], code[at:to]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[c], n)
        pair = np.repeat(row[at:to], n) * len(terms) + gram[place]
        order = np.argsort(pair)
        pair = pair[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        total, pair = np.add.reduceat(np.repeat(tf[at:to], n)[order], first), pair[first]
        yield terms, pair // len(terms), pair % len(terms), total.astype(np.int64)
        at = to


def _key_codes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """A number per row, equal for equal keys (nulls are equal)."""
    code = np.zeros(batch.num_rows, np.int64)
    for k in keys:
        one = batch.column(k).dictionary_encode(null_encoding="encode")
        code = np.unique(code * max(1, len(one.dictionary)) + one.indices.to_numpy(), return_inverse=True)[1]
    return code


def row_statistics(df: DataFrame, terms: Column, keys=(), kind: str = "") -> DataFrame:
    """(keys..., term, df, cnt) with every row a document: each Arrow batch is
    counted where its rows are, and only its sums per term are shuffled."""
    keys = list(keys)

    def count(batches):
        for b in (part for whole in batches for part in pieces(whole, "_terms")):
            group = _key_codes(b, keys)
            for words, row, code, tf in _row_counts(b.column("_terms"), kind):
                if not keys:   # distinct (row, term) pairs: a term's rows are its pairs
                    n = np.bincount(code, minlength=len(words))
                    some = pa.array(n > 0)
                    yield pa.RecordBatch.from_arrays([words.cast(pa.string()).filter(some), pa.array(n).filter(some), pa.array(
                        np.bincount(code, tf, len(words)).astype(np.int64)).filter(some)], names=["term", "df", "cnt"])
                    continue
                slot, first, back = np.unique(group[row] * len(words) + code, return_index=True, return_inverse=True)
                cols = [b.column(k).take(pa.array(row[first])) for k in keys]
                cols += [words.take(pa.array(slot % len(words))).cast(pa.string()), pa.array(np.bincount(back)),
                         pa.array(np.bincount(back, tf).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "term", "df", "cnt"])

    fields = StructType([df.schema[k] for k in keys]).add("term", "string").add("df", "long").add("cnt", "long")
    return (df.select(*keys, terms.alias("_terms")).mapInArrow(count, fields)
            .groupBy(*keys, "term").agg(F.sum("df").alias("df"), F.sum("cnt").alias("cnt")))


def split_repeated(df: DataFrame, ids: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose ids no other row has, and the others (None if there are none)."""
    repeated = df.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = repeated.select(*[F.col(c).alias(f"_again_{i}") for i, c in enumerate(ids)])
    if repeated.isEmpty():
        return df, None
    same = None
    for i, c in enumerate(ids):
        equal = F.col(c).eqNullSafe(F.col(f"_again_{i}"))
        same = equal if same is None else same & equal
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def term_statistics(df: DataFrame, doc_col: str, terms: Column, keys=(), kind: str = "") -> DataFrame:
    """(keys..., term, df, cnt) from an array of terms: what grouping the long
    (doc, term, tf) table gives, without shuffling that table.  A document
    whose id no other row has is counted in its own task; only rows that share
    an id are counted in long form.  ``kind`` as in ``_row_counts``."""
    keys = list(keys)
    once, again = split_repeated(df, [*keys, doc_col])
    out = row_statistics(once, terms, keys, kind)
    if again is not None:
        if kind == "chars":
            tf = _char_ngrams_of_words(again, doc_col, terms, keys)
        else:
            tf = term_frequencies(again, doc_col, terms, keys, bigrams=kind == "bigrams")
        more = tf.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cnt"))
        out = out.unionByName(more).groupBy(*keys, "term").agg(F.sum("df").alias("df"), F.sum("cnt").alias("cnt"))
    return out


def tfidf_rows(df: DataFrame, doc_col: str, terms: Column, vocab: DataFrame, doc_counts: DataFrame, keys=(),
               sublinear: bool = False, kind: str = "") -> DataFrame:
    """``tfidf_weights`` for a vocabulary of bounded size (``max_features`` per
    key, a stated number of keys), which is sent to the tasks: a document is
    weighted and normalised in the task that holds its row, nothing is
    shuffled but rows that share an id."""
    keys = list(keys)
    v = attach(vocab.select(*keys, "term", "df"), doc_counts, keys)
    v = v.select(*keys, "term", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf")).toArrow()
    held: dict = {}
    for key, term, idf in zip(zip(*[v[k].to_pylist() for k in keys]) if keys else [()] * v.num_rows, v["term"].to_pylist(), v["idf"].to_pylist()):
        held.setdefault(key, ([], []))[0].append(term)
        held[key][1].append(idf)
    sent = df.sparkSession.sparkContext.broadcast({k: (t, np.array(w, np.float64)) for k, (t, w) in held.items()})

    def weigher(kind):
        def weigh(batches):
            known = {k: (pa.array(t, pa.string()), w) for k, (t, w) in sent.value.items()}
            for b in (part for whole in batches for part in pieces(whole, "_terms")):
                group = _key_codes(b, keys)
                for words, row, code, tf in _row_counts(b.column("_terms"), kind):
                    idf = np.zeros(len(row))
                    for g in np.unique(group[row]):
                        mine = group[row] == g
                        key = tuple(b.column(k)[int(row[mine][0])].as_py() for k in keys)
                        if key in known:
                            at = pc.index_in(words.cast(pa.string()), value_set=known[key][0]).fill_null(-1).to_numpy()
                            idf[mine] = np.where(at >= 0, known[key][1][at], 0)[code[mine]]
                    hit = idf > 0
                    row, code, w = row[hit], code[hit], (1 + np.log(tf[hit]) if sublinear else tf[hit]) * idf[hit]
                    norm = np.sqrt(np.bincount(row, w * w, minlength=b.num_rows))
                    cols = [b.column(c).take(pa.array(row)) for c in [*keys, doc_col]]
                    yield pa.RecordBatch.from_arrays([*cols, words.take(pa.array(code)).cast(pa.string()), pa.array(w / norm[row])],
                                                     names=[*keys, doc_col, "term", "weight"])
        return weigh

    fields = StructType([StructField(c, df.schema[c].dataType) for c in [*keys, doc_col]]).add("term", "string").add("weight", "double")
    once, again = split_repeated(df.dropna(subset=[*keys, doc_col]), [*keys, doc_col])
    out = once.select(*keys, doc_col, terms.alias("_terms")).mapInArrow(weigher(kind), fields)
    if again is not None:
        rows = again.select(*keys, doc_col, terms.alias("_terms"))
        whole = F.concat(F.col("_terms"), adjacent_pairs(F.col("_terms"))) if kind == "bigrams" else F.col("_terms")
        rows = rows.groupBy(*keys, doc_col).agg(F.flatten(F.collect_list(whole)).alias("_terms"))
        out = out.unionByName(rows.mapInArrow(weigher("chars" if kind == "chars" else ""), fields))
    return out


def vocabulary_from_arrays(df: DataFrame, terms: Column, min_df=1, max_df=1.0,
                           max_features: int | None = None) -> DataFrame:
    """E10 vocabulary straight from per-document term arrays: term totals
    and document frequencies are two aggregates keyed by term only, both
    map-side combined (a frequent term is summed inside every task before
    any shuffle) — no (document, term) table is shuffled."""
    base = df.select(terms.alias("_terms"))
    cnt = base.select(F.explode("_terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cnt"))
    dfs = (base.select(F.explode(F.array_distinct("_terms")).alias("term"))
           .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    nd = df.agg(F.count(F.lit(1)).alias("n_docs"))
    stats = attach(cnt.join(dfs, "term"), nd, [])
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.col("n_docs") * min_df)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.floor(F.col("n_docs") * max_df)
    stats = stats.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features:
        stats = top_k(stats, [F.col("cnt").desc(), F.col("term").asc()], max_features, rank_col=None)
    return stats


def select_vocabulary(tf: DataFrame, doc_counts: DataFrame, keys=(), min_df: float = 1,
                      max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """Vocabulary (keys..., term, df, cnt) after document-frequency limits and
    the ``max_features`` most frequent terms (ties: term order).

    ``min_df``/``max_df``: an int is a document count, a float a share of
    ``n_docs`` (from ``doc_counts``: keys..., n_docs).
    """
    stats = tf.groupBy(*list(keys), "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cnt"))
    return limit_vocabulary(stats, doc_counts, keys, min_df, max_df, max_features)


def limit_vocabulary(stats: DataFrame, doc_counts: DataFrame, keys=(), min_df: float = 1,
                     max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """``select_vocabulary`` from term statistics (keys..., term, df, cnt)."""
    keys = list(keys)
    stats = attach(stats, doc_counts, keys)
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.col("n_docs") * min_df)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.floor(F.col("n_docs") * max_df)
    stats = stats.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features:
        order = [F.col("cnt").desc(), F.col("term").asc()]
        if keys:
            stats = topk_per_group(stats, keys, order, max_features, rank_col="_vr", slice_cols=["term"])
        else:
            stats = top_k(stats, order, max_features, rank_col="_vr")
        stats = stats.drop("_vr")
    return stats


def tfidf_weights(tf: DataFrame, vocab: DataFrame, doc_counts: DataFrame, doc_col: str, keys=(),
                  sublinear: bool = False, norm: bool = True) -> DataFrame:
    """(keys..., doc, term, weight) with smooth idf
    ``ln((1+n)/(1+df)) + 1``, optional ``1 + ln(tf)``, rows L2-normalised."""
    keys = list(keys)
    v = attach(vocab.select(*keys, "term", "df"), doc_counts, keys)
    v = v.select(*keys, "term", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(v, [*keys, "term"])
    tfv = (1 + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    w = w.select(*keys, doc_col, "term", (tfv * F.col("idf")).alias("w"))
    if not norm:
        return w.withColumnRenamed("w", "weight")
    norms = w.groupBy(*keys, doc_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return (w.join(norms, [*keys, doc_col])
            .select(*keys, doc_col, "term", (F.col("w") / F.col("_norm")).alias("weight")))


def doc_counts(df: DataFrame, keys=()) -> DataFrame:
    return df.groupBy(*list(keys)).agg(F.count(F.lit(1)).alias("n_docs"))


#: Vocabulary terms of all categories together that are sent to the tasks.
SENT_TERMS = 1 << 18


def tfidf_by_category(df: DataFrame, doc_col: str, category: str, terms: Column, k: int = 8,
                      max_features: int = 4000, digits: int = 4) -> DataFrame:
    """For every category, a TF-IDF fitted inside the category (vocabulary
    of its ``max_features`` most frequent terms), the mean L2-normalised score
    of each term over the category's documents, top k with score > 0.

    The vocabularies are sent to the tasks where the number of categories bounds
    them by ``SENT_TERMS`` rows; those of more categories are joined."""
    nd = doc_counts(df, [category])
    vocab = limit_vocabulary(term_statistics(df, doc_col, terms, [category]), nd, [category], max_features=max_features)
    if nd.count() * max_features <= SENT_TERMS:
        w = tfidf_rows(df, doc_col, terms, vocab, nd, [category])
    else:
        w = tfidf_weights(term_frequencies(df, doc_col, terms, keys=[category]), vocab, nd, doc_col, keys=[category])
    mean = (w.groupBy(category, "term").agg(F.sum("weight").alias("_s")))
    mean = attach(mean, nd, [category]).select(category, "term", (F.col("_s") / F.col("n_docs")).alias("score"))
    best = topk_per_group(mean.where(F.col("score") > 0), category,
                          [F.col("score").desc(), F.col("term").asc()], k, slice_cols=["term"])
    return best.withColumn("score", F.round("score", digits))


def hashed_index(term: Column, num_features: int = 2 ** 20) -> Column:
    """Non-negative bucket of a term (murmur3 as Spark's HashingTF)."""
    return F.pmod(F.hash(term), F.lit(num_features))


def idf_table(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """Smooth idf per term from a (doc, term, tf) table."""
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return attach(df_, n_docs, []).select("term", "df", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)
                                          .alias("idf"))


def ln(x):
    return math.log(x)
