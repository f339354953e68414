"""Text statistics queries over ``documents`` (article stand-in: text,
category = lang, author = source)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import (STOPWORDS, english_stopwords, text_words, tokenize, without_english_stopwords,
                                   word_count, word_tokens)
from quarry.operators import text as tx
from quarry.operators import profile as prof
from quarry.operators.rank import top_k
from quarry.plans.registry import query
from quarry.sources.tables import Tables


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOPS_SQL = _sql_list(STOPWORDS)


def tokens_sql(col: str, remove: bool = True, min_len: int = 3) -> str:
    cond = f"length(x) >= {min_len} AND NOT starts_with(x, '''')"
    if remove:
        cond += f" AND NOT list_contains({STOPS_SQL}, x)"
    return f"list_filter(regexp_extract_all(lower(coalesce({col}, '')), '[a-z'']+'), lambda x: {cond})"


def word_tokens_sql(col: str) -> str:
    eng = _sql_list(english_stopwords())
    return (f"list_filter(regexp_extract_all(lower(coalesce({col}, '')), '[\\pL\\pN_]{{2,}}'), "
            f"lambda x: NOT list_contains({eng}, x))")


def bigrams_sql(toks: str) -> str:
    return f"list_transform(range(1, len({toks})), lambda i: {toks}[i] || ' ' || {toks}[i + 1])"


def _top_sql(inner: str, term: str, k: int, extra: str = "") -> str:
    return f"""
WITH c AS (SELECT {term}, count(*) AS cnt FROM (SELECT unnest(t) AS {term} FROM ({inner})) GROUP BY ALL)
SELECT {term}, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, {term}) AS INTEGER) AS rank {extra}
FROM c ORDER BY cnt DESC, {term} LIMIT {k}"""


@query("text_keyword_counts", "X1 F3 K2 D3", oracle=_top_sql(
    f"SELECT {tokens_sql('text')} AS t FROM documents", "term", 20))
def text_keyword_counts(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return tx.term_counts(d, tokenize("text", remove_stopwords=True), 20)


@query("udtf_tokens", "D3", oracle=_top_sql(f"SELECT {tokens_sql('text')} AS t FROM documents", "term", 20))
def udtf_tokens(spark, sf_dir):
    """The keyword counts again, by a registered table function in SQL."""
    from quarry.functions.udtf import register_tokens
    from quarry.operators.rank import top_k
    register_tokens(spark)
    counts = spark.sql("SELECT term, count(*) AS cnt FROM {docs} d, LATERAL report_tokens(d.text) GROUP BY term",
                       docs=Tables(spark, sf_dir).documents)
    return top_k(counts, [F.col("cnt").desc(), F.col("term")], 20)


@query("text_stopword_counts", "X2", oracle=f"""
WITH c AS (SELECT word, count(*) AS cnt FROM (
             SELECT unnest(list_filter({tokens_sql('text', False, 1)}, lambda x: list_contains({STOPS_SQL}, x))) AS word
             FROM documents) GROUP BY ALL),
top AS (SELECT word, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, word) AS INTEGER) AS rank FROM c
        ORDER BY cnt DESC, word LIMIT 20)
SELECT top.*, CAST((SELECT sum(cnt) FROM c) AS BIGINT) AS total_stopword_tokens,
       round((SELECT sum(cnt) FROM top) * 100.0 / (SELECT sum(cnt) FROM c), 2) AS share_top FROM top""")
def text_stopword_counts(spark, sf_dir):
    return tx.stopword_counts(Tables(spark, sf_dir).documents, F.col("text"))


@query("text_bigrams", "X3 W5", oracle=_top_sql(
    f"SELECT {bigrams_sql('tk')} AS t FROM (SELECT {tokens_sql('text')} AS tk FROM documents)", "bigram", 20))
def text_bigrams(spark, sf_dir):
    return tx.bigram_counts(Tables(spark, sf_dir).documents, F.col("text"))


@query("text_vocab_richness", "X4 F10", oracle=f"""
WITH d AS (SELECT {tokens_sql('text')} AS t FROM documents),
c AS (SELECT term, count(*) AS c FROM (SELECT unnest(t) AS term FROM d) GROUP BY ALL),
v AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS total_tokens, count(*) AS unique_tokens,
             count_if(c = 1) AS hapax_count, count_if(c = 2) AS dislegomena_count FROM c)
SELECT total_tokens, unique_tokens,
       coalesce(round(unique_tokens / nullif(total_tokens, 0), 4), 0.0) AS type_token_ratio,
       CAST(hapax_count AS BIGINT) AS hapax_count,
       coalesce(round(hapax_count / nullif(unique_tokens, 0), 4), 0.0) AS hapax_ratio,
       CAST(dislegomena_count AS BIGINT) AS dislegomena_count,
       coalesce(round((SELECT avg(len(list_distinct(t))) FROM d), 2), 0.0) AS avg_unique_per_doc FROM v""")
def text_vocab_richness(spark, sf_dir):
    return tx.vocabulary_richness(Tables(spark, sf_dir).documents, F.col("text"))


@query("text_terms_by_category", "X5 W1", oracle=f"""
WITH cats AS (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 6),
c AS (SELECT lang, term, count(*) AS cnt FROM (
        SELECT lang, unnest({tokens_sql('text')}) AS term FROM documents WHERE lang IN (SELECT lang FROM cats))
      GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, term) AS INTEGER) AS rank FROM c)
SELECT lang, term, cnt, rank FROM r WHERE rank <= 8""")
def text_terms_by_category(spark, sf_dir):
    """Top-8 terms inside each of the 6 largest categories."""
    d = Tables(spark, sf_dir).documents
    cats = top_k(d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")),
                 [F.col("n").desc(), F.col("lang").asc()], 6, rank_col=None).select("lang")
    d = d.join(F.broadcast(cats), "lang", "left_semi")  # at most 6 rows
    return tx.term_counts(d, tokenize("text", remove_stopwords=True), 8, group="lang")


@query("text_tfidf_by_category", "X6", oracle=f"""
WITH d AS (SELECT doc_id, lang, {word_tokens_sql('text')} AS toks FROM documents),
nd AS (SELECT lang, count(*) AS n_docs FROM d GROUP BY ALL),
tf AS (SELECT lang, doc_id, term, count(*) AS tf FROM (SELECT lang, doc_id, unnest(toks) AS term FROM d) GROUP BY ALL),
st AS (SELECT lang, term, count(*) AS df, sum(tf) AS cnt FROM tf GROUP BY ALL),
voc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, term) AS r FROM st)
        WHERE r <= 4000),
w AS (SELECT tf.lang, tf.doc_id, tf.term, tf.tf * (ln((1 + nd.n_docs) / (1 + voc.df)) + 1) AS w
      FROM tf JOIN voc USING (lang, term) JOIN nd USING (lang)),
nrm AS (SELECT lang, doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY ALL),
sc AS (SELECT w.lang, w.term, sum(w.w / nrm.nrm) / any_value(nd.n_docs) AS score
       FROM w JOIN nrm USING (lang, doc_id) JOIN nd USING (lang) GROUP BY ALL),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS INTEGER) AS rank
        FROM sc WHERE score > 0)
SELECT lang, term, round(score, 4) AS score, rank FROM top WHERE rank <= 8""")
def text_tfidf_by_category(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    toks = without_english_stopwords(word_tokens("text"))
    return tx.tfidf_by_category(d, "doc_id", "lang", toks)


@query("text_length_by_category", "X7 A8", oracle=r"""
SELECT lang, count(*) AS article_count,
       round(avg(len(regexp_extract_all(split_part(coalesce(text, ''), chr(10), 1), '\S+'))), 2) AS headline_mean,
       round(avg(len(regexp_extract_all(coalesce(text, ''), '\S+'))), 2) AS combined_mean,
       round(median(len(regexp_extract_all(coalesce(text, ''), '\S+'))), 2) AS combined_median
FROM documents GROUP BY ALL""")
def text_length_by_category(spark, sf_dir):
    """Per category: size, mean words of the first line and of the whole text, median words."""
    from quarry.operators.dist import group_summary
    d = Tables(spark, sf_dir).documents
    d = d.select("lang", word_count(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)).alias("hw"),
                 word_count("text").alias("cw"))
    out = group_summary(d, "lang", {"headline_mean": "hw", "combined_mean": "cw"}, "cw",
                        median_name="combined_median", digits=2)
    return out.withColumnRenamed("size", "article_count")


@query("top_authors", "K4 P9", oracle="""
WITH a AS (SELECT CASE WHEN source = 'src3' THEN '   ' ELSE source END AS author FROM documents)
SELECT author, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, author) AS INTEGER) AS rank
FROM (SELECT author, count(*) AS cnt FROM a WHERE trim(author) <> '' GROUP BY ALL)
ORDER BY cnt DESC, author LIMIT 15""")
def top_authors(spark, sf_dir):
    """15 most frequent non-blank authors (one source blanked)."""
    d = Tables(spark, sf_dir).documents
    a = d.select(F.when(F.col("source") == "src3", F.lit("   ")).otherwise(F.col("source")).alias("author"))
    a = a.where(F.trim("author") != "")
    counts = a.groupBy("author").agg(F.count(F.lit(1)).alias("cnt"))
    return top_k(counts, [F.col("cnt").desc(), F.col("author").asc()], 15)


_BOW_TOKENS_SQL = f"""
  SELECT doc_id, lang, list_concat(t, {bigrams_sql('t')}) AS grams
  FROM (SELECT doc_id, lang, {word_tokens_sql('text')} AS t FROM documents)"""


def _vocab_sql(grams_sql: str, min_df: int, max_df: float, max_features: int) -> str:
    return f"""
WITH g AS ({grams_sql}),
n AS (SELECT count(*) AS n_docs FROM g),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(grams) AS term FROM g) GROUP BY ALL),
st AS (SELECT term, count(*) AS df, sum(tf) AS cnt FROM tf GROUP BY ALL),
f AS (SELECT st.* FROM st, n WHERE df >= {min_df} AND df <= floor(n.n_docs * {max_df}))
SELECT term, df, CAST(cnt AS BIGINT) AS cnt, n.n_docs FROM f, n ORDER BY cnt DESC, term LIMIT {max_features}"""


def _bow(t):
    """Documents, their tokens, their number and the 1-2-gram vocabulary."""
    d, toks = t.documents, without_english_stopwords(word_tokens("text"))
    nd = tx.doc_counts(d)
    stats = tx.term_statistics(d, "doc_id", toks, kind="bigrams")
    return d, toks, nd, tx.limit_vocabulary(stats, nd, min_df=5, max_df=0.95, max_features=50000)


@query("feat_bow", "E10", oracle=_vocab_sql(_BOW_TOKENS_SQL, 5, 0.95, 50000))
def feat_bow(spark, sf_dir):
    """Word 1-2-gram vocabulary: English stop words, min_df 5, max_df .95, 50k terms."""
    return _bow(Tables(spark, sf_dir))[3]


@query("feat_tfidf", "E11", oracle=f"""
WITH v AS ({_vocab_sql(_BOW_TOKENS_SQL, 5, 0.95, 50000)}),
g AS ({_BOW_TOKENS_SQL}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(grams) AS term FROM g) GROUP BY ALL),
w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + v.n_docs) / (1 + v.df)) + 1) AS w FROM tf JOIN v USING (term)),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY ALL)
SELECT doc_id, count(*) AS n_terms, round(sum(w / nrm), 6) AS weight_sum, round(max(w / nrm), 6) AS weight_max
FROM w JOIN nrm USING (doc_id) GROUP BY doc_id""")
def feat_tfidf(spark, sf_dir):
    """Sublinear TF-IDF (smooth idf, L2 rows) on the E10 vocabulary; reported
    per document as term count, weight sum and max weight."""
    d, toks, nd, vocab = _bow(Tables(spark, sf_dir))
    w = tx.tfidf_rows(d, "doc_id", toks, vocab, nd, sublinear=True, kind="bigrams")  # ≤ 50k terms
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"),
                                   F.round(F.sum("weight"), 6).alias("weight_sum"),
                                   F.round(F.max("weight"), 6).alias("weight_max"))


def _char_grams_sql() -> str:
    # DuckDB twin of functions.text.char_ngrams (char_wb 3-5).
    p = "(' ' || w || ' ')"
    per_n = []
    for n in (3, 4, 5):
        per_n.append(f"CASE WHEN length({p}) > {n} THEN list_transform(range(1, length({p}) - {n} + 2), "
                     f"lambda i: substr({p}, i, {n})) WHEN length({p}) = {n} OR (length({p}) < {n} AND {n} = 3) "
                     f"THEN [{p}] ELSE [] END")
    grams = "flatten([" + ", ".join(per_n) + "])"
    return (f"SELECT doc_id, flatten(list_transform(list_filter(regexp_split_to_array(lower(trim(coalesce(text, ''))), "
            f"'\\s+'), lambda w: length(w) > 0), lambda w: {grams})) AS grams FROM documents")


@query("feat_char_ngrams", "E12", oracle=_vocab_sql(_char_grams_sql(), 5, 0.95, 50000))
def feat_char_ngrams(spark, sf_dir):
    """char_wb 3-5-gram vocabulary with document frequencies and counts."""
    d = Tables(spark, sf_dir).documents
    stats = tx.term_statistics(d, "doc_id", text_words("text"), kind="chars")
    return tx.limit_vocabulary(stats, tx.doc_counts(d), min_df=5, max_df=0.95, max_features=50000)


@query("stat_chi2_terms", "T4 E14", oracle=f"""
WITH g AS ({_BOW_TOKENS_SQL}),
nd AS (SELECT count(*) AS n FROM g),
cls AS (SELECT lang, count(*) / any_value(nd.n) AS p FROM g, nd GROUP BY lang),
tf AS (SELECT lang, term, count(*) AS o FROM (SELECT lang, unnest(grams) AS term FROM g) GROUP BY ALL),
tt AS (SELECT term, sum(o) AS t FROM tf GROUP BY term),
cell AS (SELECT tf.term, tf.o, cls.p * tt.t AS e, tt.t FROM tf JOIN cls USING (lang) JOIN tt USING (term)),
chi AS (SELECT term, sum(pow(o - e, 2) / e) + any_value(t) - sum(e) AS chi2 FROM cell GROUP BY term)
SELECT term, round(chi2, 6) AS chi2, CAST(row_number() OVER (ORDER BY round(chi2, 6) DESC, term) AS INTEGER) AS rank
FROM chi ORDER BY round(chi2, 6) DESC, term LIMIT 20""")
def stat_chi2_terms(spark, sf_dir):
    """χ² of 1-2-gram counts against the language; best 20 terms kept."""
    from quarry.operators.stats import chi2_terms
    d = Tables(spark, sf_dir).documents
    # (class, term) sums are made where the rows are; no (document, term)
    # table and no join back to the documents for their class.
    occ = tx.row_statistics(d, without_english_stopwords(word_tokens("text")), ["lang"], "bigrams")
    scores = chi2_terms(occ, "doc_id", "term", "cnt", "lang", docs=d.select("doc_id", "lang"))
    return top_k(scores, [F.col("chi2").desc(), F.col("term").asc()], 20)
