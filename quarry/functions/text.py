"""Text Column functions: counts, tokenisers, n-grams.

All are native expressions (regex extraction + higher-order array
functions), evaluated inside whole-stage-codegen'd projections; nothing
here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# The report's stop-word list (must match the reference set).
# --------------------------------------------------------------------------
STOPWORDS = [
    "the", "a", "an", "and", "or", "of", "to", "in", "for", "on", "at", "with",
    "from", "by", "is", "are", "was", "were", "be", "as", "after", "over", "up",
    "into", "about", "this", "that", "it", "its", "new", "says", "say", "amid",
    "why", "how", "what", "who", "your", "you", "have", "not", "but", "more",
    "can", "has", "our", "one", "all", "will", "out", "when", "his", "their",
    "her", "they", "people", "time", "just", "like", "day", "than", "year", "get",
    "some", "life", "he", "she", "we", "if", "no", "do", "did", "does", "so",
    "my", "me", "us", "them", "had", "been", "also", "here", "too", "off", "now",
    "want", "way", "first", "last", "make", "made", "because", "these", "those",
    "news", "week", "u", "s", "it's", "there", "said", "may", "would", "could",
    "don't", "many", "should", "being", "even", "back", "other", "take", "good",
    "two", "things", "only", "help", "while", "think", "old", "see", "much", "look",
]
# Token patterns.
LETTER_TOKEN = "[a-z']+"              # report tokeniser, applied to lower-cased text
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"     # two or more word characters (Unicode)
WHITESPACE_WORD = r"(?U)\S+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def word_count(col) -> Column:
    """whitespace-separated word count (null text → 0)."""
    return F.size(F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(WHITESPACE_WORD), 0))


def char_count(col) -> Column:
    """character count, null → 0."""
    return F.length(F.coalesce(_c(col), F.lit("")))


def stopword_array() -> Column:
    return F.array(*[F.lit(w) for w in STOPWORDS])


def tokenize(col, remove_stopwords: bool = False, min_len: int = 3) -> Column:
    """lower-case ``[a-z']+`` tokens of at least ``min_len`` characters,
    not starting with an apostrophe, optionally without stop words."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(LETTER_TOKEN), 0)

    def keep(t):
        cond = (F.length(t) >= min_len) & ~t.startswith("'")
        if remove_stopwords:
            cond = cond & ~t.isin(STOPWORDS)  # becomes a hash-set lookup (InSet)
        return cond
    return F.filter(toks, keep)


def word_tokens(col) -> Column:
    """Lower-cased runs of two or more Unicode word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(WORD_TOKEN), 0)


def adjacent_pairs(tokens: Column, sep: str = " ") -> Column:
    """Adjacent token pairs inside one document (never across documents)."""
    n = F.size(tokens)
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(
        F.zip_with(F.slice(tokens, 1, n - 1), F.slice(tokens, 2, n - 1),
                   lambda a, b: F.concat(a, F.lit(sep), b)))


def with_bigrams(tokens: Column) -> Column:
    """Unigrams followed by adjacent bigrams (1–2-gram features)."""
    return F.concat(tokens, adjacent_pairs(tokens))


def distinct_count(tokens: Column) -> Column:
    """number of distinct tokens."""
    return F.size(F.array_distinct(tokens))


def text_words(col) -> Column:
    """Lower-cased whitespace-separated words (empty strings dropped)."""
    words = F.split(F.lower(F.trim(F.coalesce(_c(col), F.lit("")))), r"(?U)\s+")
    return F.filter(words, lambda w: F.length(w) > 0)


def word_char_ngrams(word: Column, n_min: int = 3, n_max: int = 5) -> Column:
    """E12 for one word: the word padded with one blank on both sides;
    sliding n-grams while the padded word is longer than n, and the whole
    padded word once for the first n that reaches its length."""
    p = F.concat(F.lit(" "), word, F.lit(" "))
    ln = F.length(p)

    def windows(n):
        return F.transform(F.sequence(F.lit(1), ln - n + 1), lambda i: F.substring(p, i, F.lit(n)))
    per_n = [F.when(ln > n, windows(n))
             .when((ln == n) | ((ln < n) & F.lit(n == n_min)), F.array(p))
             .otherwise(F.array().cast("array<string>"))
             for n in range(n_min, n_max + 1)]
    return F.flatten(F.array(*per_n))


def char_ngrams(col, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams inside word boundaries for a whole text."""
    return F.flatten(F.transform(text_words(col), lambda w: word_char_ngrams(w, n_min, n_max)))


def english_stopwords() -> list[str]:
    """Spark ML's bundled English stop-word list (``StopWordsRemover``
    default), read from the installed MLlib jar so the query and its SQL
    oracle use the identical list without a JVM round trip."""
    global _ENGLISH
    if _ENGLISH is None:
        import glob
        import os
        import zipfile

        import pyspark
        jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
        if jars:
            with zipfile.ZipFile(jars[0]) as z:
                _ENGLISH = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split()
        else:  # pragma: no cover - cluster images always ship MLlib
            from pyspark.ml.feature import StopWordsRemover
            _ENGLISH = list(StopWordsRemover.loadDefaultStopWords("english"))
    return _ENGLISH


_ENGLISH = None


def without_english_stopwords(tokens: Column) -> Column:
    stops = english_stopwords()
    return F.filter(tokens, lambda t: ~t.isin(stops))


def strip(col) -> Column:
    """Remove leading/trailing whitespace of any kind (Python ``str.strip``);
    ``trim`` only removes spaces."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")
