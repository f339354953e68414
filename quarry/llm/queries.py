"""The registered queries of this package and, where SQL can express them,
their DuckDB oracles.  Each query applies its operator with production
parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir, ship_package

from . import (bpe, collocations, decontaminate, exact_dedup, hard_negatives, hpylm, langid, licences, line_dedup, simhash,
               suffix_dedup, toxicity, url_filter)
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register ``f`` under its name; the package reaches the Python workers first."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checkpoint_dir(spark)
        ship_package(spark)
        return f(spark, sf_dir)
    QUERIES[f.__name__] = run
    return run


@query
def op1_licences(spark, sf_dir):
    return licences.licence_report(documents(spark, sf_dir))


@query
def op2_language(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@query
def op3_decontaminate(spark, sf_dir):
    return decontaminate.decontamination_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLES["op3_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i) WHERE len(w) > 0),
dg AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM d, (SELECT DISTINCT k FROM win), LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i) WHERE len(w) >= k),
hit AS (SELECT doc_id, i, dg.k, item_id FROM dg JOIN win ON dg.k = win.k AND dg.g = win.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir))


ORACLES["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""


@query
def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeated_passages(documents(spark, sf_dir)).drop("rk")


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_report(documents(spark, sf_dir))


@query
def op8_bpe(spark, sf_dir):
    return bpe.encode_documents(documents(spark, sf_dir), _tokenizer(), ids=False)


@query
def op9_language_model(spark, sf_dir):
    return hpylm.score_documents(documents(spark, sf_dir))


@query
def op10_simhash(spark, sf_dir):
    return simhash.near_groups(documents(spark, sf_dir))


@query
def op12_hard_negatives(spark, sf_dir):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=relabelled)


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op13_collocations(spark, sf_dir):
    return collocations.mine_collocations(documents(spark, sf_dir))


ORACLES["op13_collocations"] = r"""
WITH piece AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents)),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM piece, (SELECT unnest([1, 2, 3, 4]) AS k), LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i)
  WHERE len(w) >= k GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE k > 1 AND f >= 30),
cut AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM cand) c
  JOIN gram x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:j], ' ')
  JOIN gram y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:c.k], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1),
inner_part AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS around
  FROM cand, (SELECT unnest([2, 3]) AS size), LATERAL (SELECT unnest(generate_series(1, k - size + 1)) AS i)
  WHERE size < k GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM cut JOIN total USING (lang) LEFT JOIN inner_part USING (lang, phrase)
WHERE around IS NULL OR 100 * CAST(around AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY rank <= 2000
"""


@query
def op11_url_filter(spark, sf_dir):
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLES["op11_url_filter"] = r"""
WITH RECURSIVE page AS (
  SELECT page_id, html, translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path, regexp_extract(u, '^.*?://[^?#]*(\?[^#]*)?', 1, 's') AS query
  FROM (SELECT *, coalesce(url, '') AS u FROM pages)),
tag AS (
  SELECT host, path, CASE WHEN host <> '' THEN host || path || query END AS src,
         unnest(regexp_extract_all(html, '<(?:link|meta)\b[^<>]*>', 0, 'i')) AS t FROM page),
target AS (
  SELECT host, path, src, regexp_replace(replace(trim(t), '&amp;', '&'), '#.*$', '', 's') AS t FROM (
    SELECT host, path, src, concat(regexp_extract(t, '\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1, 'is'),
      regexp_extract(t, '\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2, 'is'),
      regexp_extract(t, '\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3, 'is')) AS t
    FROM tag WHERE regexp_matches(t, '^<link\b.*\brel\s*=\s*(?:"[^"]*\bcanonical\b|''[^'']*\bcanonical\b|canonical\b)', 'i')
    UNION ALL
    SELECT host, path, src, regexp_extract(t, '\bcontent\s*=\s*["'']?[\s0-9.]*[;,]\s*url\s*=\s*["'']?([^"''>\s]+)', 1, 'is')
    FROM tag WHERE regexp_matches(t, '\bhttp-equiv\s*=\s*["'']?refresh\b', 'i'))),
whole AS (
  SELECT src, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN t LIKE '//%' THEN 'x:' || t
    WHEN t = '' OR host = '' OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN t LIKE '/%' THEN 'x://' || host || t
    WHEN t LIKE '?%' THEN 'x://' || host || path || t
    ELSE 'x://' || host || regexp_replace(CASE path WHEN '' THEN '/' ELSE path END, '[^/]*$', '') || t END AS u FROM target),
edge AS (
  SELECT src AS a, dst AS b FROM (
    SELECT src, translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           || regexp_extract(u, '^.*?://[^/?#]*([^#]*)', 1, 's') AS dst, regexp_extract(u, '^.*?://([^/?#]*)', 1, 's') AS h
    FROM whole WHERE u IS NOT NULL AND src IS NOT NULL) WHERE src <> dst AND h <> ''),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
rule(action, rule, h, p) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
node AS (SELECT a, regexp_extract(a, '^([^/?#]*)', 1) AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT DISTINCT a FROM both_ways)),
bad AS (
  SELECT a FROM (
    SELECT a, action, row_number() OVER (PARTITION BY a ORDER BY length(rule) DESC) AS i
    FROM node JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) WHERE i = 1 AND action = 'block'
  UNION SELECT b FROM bad JOIN both_ways ON bad.a = both_ways.a),
judged AS (
  SELECT page.*, rule.rule, rule.action FROM page LEFT JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule.rule) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN host <> '' AND host || path || query IN (SELECT a FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""
