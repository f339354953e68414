"""Distribution queries: grouped statistics, box plots, histograms, densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as sc
from quarry.functions.text import char_count, word_count
from quarry.operators import dist
from quarry.operators.crosstab import _lit_sql
from quarry.plans.common import OUTCOME_SQL, outcome
from quarry.plans.registry import query
from quarry.sources.tables import Tables


@query("agg_group_multi", "A8", oracle="""
SELECT l_returnflag, count(*) AS size, round(avg(l_quantity), 4) AS mean_qty,
       round(avg(l_extendedprice), 4) AS mean_price, round(median(l_extendedprice), 4) AS median
FROM lineitem GROUP BY ALL""")
def agg_group_multi(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return dist.group_summary(li, "l_returnflag", {"mean_qty": "l_quantity", "mean_price": "l_extendedprice"},
                              "l_extendedprice")


@query("agg_group_median_rank", "A9", oracle="""
SELECT p_type, count(p_retailprice) AS n, round(median(p_retailprice), 4) AS median
FROM part GROUP BY ALL""")
def agg_group_median_rank(spark, sf_dir):
    return dist.group_median_rank(Tables(spark, sf_dir).part, "p_type", "p_retailprice")


@query("agg_count_and_median", "A10 J8", oracle="""
SELECT source, count(*) AS size, round(median(n_chars), 4) AS median FROM documents GROUP BY ALL""")
def agg_count_and_median(spark, sf_dir):
    """Frequency of each document source next to its median length."""
    return dist.group_summary(Tables(spark, sf_dir).documents, "source", {}, "n_chars")


@query("agg_five_number", "A11", oracle=f"""
SELECT {OUTCOME_SQL} AS outcome, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
       round(quantile_cont(o_totalprice, 0.25), 4) AS q1, round(median(o_totalprice), 4) AS median,
       round(quantile_cont(o_totalprice, 0.75), 4) AS q3
FROM orders GROUP BY ALL""")
def agg_five_number(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(outcome(), "o_totalprice")
    return dist.five_number(o, "outcome", "o_totalprice")


def _box_sql(table: str, groups: list[str], x: str, where: str = "") -> str:
    g = ", ".join(groups)
    return f"""
WITH t AS (SELECT {g}, CAST({x} AS DOUBLE) AS x FROM {table} WHERE {x} IS NOT NULL {where}),
q AS (SELECT {g}, count(x) AS n, quantile_cont(x, 0.25) AS q1, median(x) AS med,
             quantile_cont(x, 0.75) AS q3 FROM t GROUP BY ALL),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT {", ".join('f.' + c for c in groups)}, any_value(f.n) AS n, round(any_value(f.q1), 4) AS q1,
       round(any_value(f.med), 4) AS median, round(any_value(f.q3), 4) AS q3,
       round(any_value(f.lf), 4) AS lower_fence, round(any_value(f.uf), 4) AS upper_fence,
       round(min(t.x) FILTER (WHERE t.x >= f.lf AND t.x <= f.uf), 4) AS whisker_low,
       round(max(t.x) FILTER (WHERE t.x >= f.lf AND t.x <= f.uf), 4) AS whisker_high,
       CAST(count(*) FILTER (WHERE t.x < f.lf OR t.x > f.uf) AS BIGINT) AS outliers
FROM f JOIN t USING ({g}) GROUP BY {", ".join('f.' + c for c in groups)}"""


@query("agg_box_by_group", "A12", oracle=_box_sql("orders", ["o_orderpriority"], "o_totalprice"))
def agg_box_by_group(spark, sf_dir):
    return dist.box_stats(Tables(spark, sf_dir).orders, "o_orderpriority", "o_totalprice")


@query("agg_box_by_two_groups", "A13", oracle=_box_sql("orders", ["o_orderpriority", "o_orderstatus"],
                                                       "o_totalprice"))
def agg_box_by_two_groups(spark, sf_dir):
    return dist.box_stats(Tables(spark, sf_dir).orders, ["o_orderpriority", "o_orderstatus"], "o_totalprice")


@query("flt_cap_outliers", "P11", oracle=_box_sql("lineitem", ["l_returnflag"], "l_quantity",
                                                  "AND l_quantity <= 40"))
def flt_cap_outliers(spark, sf_dir):
    """Display cap (quantity ≤ 40) applied before the box statistics."""
    li = Tables(spark, sf_dir).lineitem.where(F.col("l_quantity") <= 40)
    return dist.box_stats(li, "l_returnflag", "l_quantity")


@query("agg_conditional_means", "A14", oracle=f"""
SELECT round(avg(o_totalprice) FILTER (WHERE {OUTCOME_SQL} <= 1), 4) AS low_mean,
       round(avg(o_totalprice) FILTER (WHERE {OUTCOME_SQL} >= 3), 4) AS high_mean FROM orders""")
def agg_conditional_means(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(outcome(), "o_totalprice")
    return dist.conditional_means(o, "outcome", "o_totalprice", 1, 3)


@query("agg_timeline_peak", "A25", oracle="""
WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS cnt FROM orders GROUP BY ALL),
s AS (SELECT max(cnt) AS peak_count, max(year) AS latest_key FROM c),
p AS (SELECT min(year) AS peak_key FROM c, s WHERE c.cnt = s.peak_count),
l AS (SELECT cnt AS latest_count FROM c, s WHERE c.year = s.latest_key)
SELECT c.year, c.cnt, p.peak_key, s.peak_count, s.latest_key, l.latest_count FROM c, s, p, l""")
def agg_timeline_peak(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("year"))
    return dist.timeline_peak(o, "year")


WORD_EDGES = [0, 50, 100, 200, 500, 1000, 2000, 5000, 20000]
CHAR_EDGES = [0, 250, 500, 1000, 2500, 5000, 10000, 50000, 150000]


def _hist_sql(value_sql: str, table: str, edges, name: str = "") -> str:
    n = len(edges) - 1
    conds = []
    for i in range(n):
        hi_op = "<=" if i == n - 1 else "<"
        conds.append(f"WHEN v >= {edges[i]} AND v {hi_op} {edges[i + 1]} THEN {i}")
    labels = " UNION ALL ".join(
        f"SELECT {i} AS bin, '{dist._fmt_edge(edges[i])}-{dist._fmt_edge(edges[i + 1] - 1)}' AS label, "
        f"CAST({edges[i]} AS DOUBLE) AS lo, CAST({edges[i + 1]} AS DOUBLE) AS hi" for i in range(n))
    measure = f"'{name}' AS measure, " if name else ""
    return f"""
SELECT {measure}CAST(d.bin AS INTEGER) AS bin, d.label, d.lo, d.hi, CAST(count(b.bin) AS BIGINT) AS cnt
FROM ({labels}) d LEFT JOIN (SELECT CASE {' '.join(conds)} END AS bin
                             FROM (SELECT {value_sql} AS v FROM {table})) b ON b.bin = d.bin
GROUP BY ALL"""


WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '\S+'))"
CHARS_SQL = "length(coalesce(text, ''))"


@query("agg_histogram_edges", "A27 F1", oracle=_hist_sql(WORDS_SQL, "documents", WORD_EDGES))
def agg_histogram_edges(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select(word_count("text").alias("words"))
    return dist.histogram_edges(d, "words", WORD_EDGES)


@query("text_length_histograms", "X8 F1 F2", oracle=(
    _hist_sql(WORDS_SQL, "documents", WORD_EDGES, "document_words") + " UNION ALL " +
    _hist_sql(CHARS_SQL, "documents", CHAR_EDGES, "document_chars") + " UNION ALL " +
    _hist_sql(WORDS_SQL, "conversations", WORD_EDGES, "turn_words") + " UNION ALL " +
    _hist_sql(CHARS_SQL, "conversations", CHAR_EDGES, "turn_chars")))
def text_length_histograms(spark, sf_dir):
    """Word and character histograms for two text columns (documents, conversation turns)."""
    t = Tables(spark, sf_dir)
    out = None
    for name, df, expr, edges in [
            ("document_words", t.documents, word_count("text"), WORD_EDGES),
            ("document_chars", t.documents, char_count("text"), CHAR_EDGES),
            ("turn_words", t.conversations, word_count("text"), WORD_EDGES),
            ("turn_chars", t.conversations, char_count("text"), CHAR_EDGES)]:
        h = dist.histogram_edges(df.select(expr.alias("v")), "v", edges)
        h = h.select(F.lit(name).alias("measure"), "*")
        out = h if out is None else out.unionByName(h)
    return out


@query("agg_histogram_equal", "A28", oracle="""
WITH t AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
r AS (SELECT l_returnflag, min(v) AS lo, max(v) AS hi FROM t GROUP BY ALL),
b AS (SELECT t.l_returnflag, CAST(CASE WHEN r.hi = r.lo THEN 0
          ELSE least(floor((t.v - r.lo) / ((r.hi - r.lo) / 40)), 39) END AS INTEGER) AS bin
      FROM t JOIN r USING (l_returnflag)),
c AS (SELECT l_returnflag, bin, count(*) AS cnt FROM b GROUP BY ALL),
g AS (SELECT l_returnflag, lo, hi, CAST(unnest(range(0, 40)) AS INTEGER) AS bin FROM r)
SELECT g.l_returnflag, g.bin, round(g.lo + g.bin * ((g.hi - g.lo) / 40), 4) AS lo,
       round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / 40), 4) AS hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
FROM g LEFT JOIN c USING (l_returnflag, bin)""")
def agg_histogram_equal(spark, sf_dir):
    """40 equal-width bins of line price inside each return flag."""
    return dist.histogram_equal(Tables(spark, sf_dir).lineitem, "l_extendedprice", 40, "l_returnflag")


# Photo-count bins and labels of the heat map (right-closed).
PHOTO_EDGES = [0, 1, 2, 3, 5, 10, 30]
PHOTO_LABELS = ["1", "2", "3", "4-5", "6-10", "10+"]
QTY_EDGES = [0, 10, 20, 30, 40, 50]
QTY_LABELS = ["1-10", "11-20", "21-30", "31-40", "41-50"]


def _cut_sql(x: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {x} > {edges[i]} AND {x} <= {edges[i + 1]} THEN '{lab}'"
                     for i, lab in enumerate(labels))
    return f"CASE {whens} END"


@query("agg_heatmap_binned", "A29", oracle=f"""
WITH b AS (SELECT {_cut_sql('l_linenumber', PHOTO_EDGES, PHOTO_LABELS)} AS x_bin,
                  {_cut_sql('l_quantity', QTY_EDGES, QTY_LABELS)} AS y_bin, l_discount FROM lineitem)
SELECT x_bin, y_bin, round(avg(l_discount), 4) AS mean_target, count(*) AS cnt
FROM b WHERE x_bin IS NOT NULL AND y_bin IS NOT NULL GROUP BY ALL""")
def agg_heatmap_binned(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return dist.heatmap_binned(li, "l_linenumber", PHOTO_EDGES, PHOTO_LABELS,
                               "l_quantity", QTY_EDGES, QTY_LABELS, "l_discount")


@query("agg_length_summary", "A30", oracle=f"""
SELECT 'words' AS measure, round(avg({WORDS_SQL}), 2) AS mean,
       CAST(trunc(median({WORDS_SQL})) AS INTEGER) AS median_int FROM documents
UNION ALL
SELECT 'chars', round(avg({CHARS_SQL}), 2), CAST(trunc(median({CHARS_SQL})) AS INTEGER) FROM documents""")
def agg_length_summary(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return dist.length_summary(d, {"words": word_count("text"), "chars": char_count("text")})


_EMB_METRICS = [f"e{i}" for i in range(5)]


def _emb_metrics(t: Tables):
    e = t.embeddings
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(5)])


@query("agg_metric_median_table", "A31", oracle=f"""
WITH t AS (SELECT label, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(5))}
           FROM embeddings),
m AS ({" UNION ALL ".join(f"SELECT label, 'e{i}' AS metric, round(median(e{i}), 4) AS median FROM t GROUP BY label"
                           for i in range(5))}),
d AS (SELECT CAST(l AS INTEGER) AS label, metric FROM range(0, 11) r(l),
      (VALUES {", ".join(f"('e{i}')" for i in range(5))}) v(metric))
SELECT d.label, d.metric, coalesce(m.median, 0.0) AS median FROM d LEFT JOIN m USING (label, metric)""")
def agg_metric_median_table(spark, sf_dir):
    """Median of five embedding metrics per label over the label domain 0-10 (empty → 0)."""
    return dist.metric_medians(_emb_metrics(Tables(spark, sf_dir)), "label", _EMB_METRICS,
                               domain=list(range(11)))


@query("agg_type_quality", "A32 E3 E4", oracle="""
WITH r AS (SELECT min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_discount) AS b0, max(l_discount) AS b1,
                  min(l_tax) AS c0, max(l_tax) AS c1 FROM lineitem),
t AS (SELECT l_linestatus, l_quantity, l_discount, l_tax,
             ((CASE WHEN a1 > a0 THEN (l_quantity - a0) / (a1 - a0) ELSE 0.0 END)
            + (CASE WHEN b1 > b0 THEN (l_discount - b0) / (b1 - b0) ELSE 0.0 END)
            + (CASE WHEN c1 > c0 THEN (l_tax - c0) / (c1 - c0) ELSE 0.0 END)) / 3 AS score
      FROM lineitem, r)
SELECT l_linestatus, 'l_quantity' AS metric, round(median(l_quantity), 4) AS median FROM t GROUP BY ALL
UNION ALL SELECT l_linestatus, 'l_discount', round(median(l_discount), 4) FROM t GROUP BY ALL
UNION ALL SELECT l_linestatus, 'l_tax', round(median(l_tax), 4) FROM t GROUP BY ALL
UNION ALL SELECT l_linestatus, 'score', round(median(score), 4) FROM t GROUP BY ALL""")
def agg_type_quality(spark, sf_dir):
    """Median metrics and composite min-max score per line status."""
    from quarry.operators.features import composite_score
    li = Tables(spark, sf_dir).lineitem.select("l_linestatus", "l_quantity", "l_discount", "l_tax")
    scored = composite_score(li, ["l_quantity", "l_discount", "l_tax"], "score")
    return dist.metric_medians(scored, "l_linestatus", ["l_quantity", "l_discount", "l_tax", "score"])


@query("agg_mean_std", "A33", oracle="""
SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std FROM orders""")
def agg_mean_std(spark, sf_dir):
    return dist.mean_std(Tables(spark, sf_dir).orders, "o_totalprice")


@query("agg_size_estimate", "A34 V2", oracle="""
WITH s AS (SELECT round(n_chars / 1024.0, 1) AS kb FROM documents
           ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')) LIMIT 100)
SELECT (SELECT count(*) FROM documents) AS population, count(*) AS sampled,
       round(avg(kb), 4) AS avg_kb,
       round(avg(kb) * (SELECT count(*) FROM documents) / 1024, 4) AS total_mb FROM s""")
def agg_size_estimate(spark, sf_dir):
    """Total size ≈ mean size of a seeded 100-row sample × row count."""
    from quarry.operators.sampling import sample_n
    d = Tables(spark, sf_dir).documents
    s = sample_n(d, "doc_id", 100, seed=42).select(F.round(F.col("n_chars") / 1024.0, 1).alias("kb"))
    pop = d.agg(F.count(F.lit(1)).alias("population"))
    est = s.agg(F.count(F.lit(1)).alias("sampled"), F.avg("kb").alias("_kb"))
    return est.crossJoin(pop).select(  # two one-row aggregates
        "population", "sampled", F.round("_kb", 4).alias("avg_kb"),
        F.round(F.col("_kb") * F.col("population") / 1024, 4).alias("total_mb"))


@query("agg_group_mean_vector", "A35", oracle="""
WITH s AS (SELECT label, count(*) AS n FROM embeddings GROUP BY ALL HAVING count(*) >= 10
           ORDER BY n DESC, label LIMIT 20),
l AS (SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS x
      FROM embeddings)
SELECT l.label, s.n, l.pos, round(avg(l.x), 6) AS mean FROM l JOIN s USING (label) GROUP BY ALL""")
def agg_group_mean_vector(spark, sf_dir):
    return dist.group_mean_vector(Tables(spark, sf_dir).embeddings, "label", "embedding", 10, 20)


@query("agg_class_weights", "A36", oracle="""
WITH c AS (SELECT lang, count(*) AS cnt FROM documents GROUP BY ALL)
SELECT lang, cnt, round((SELECT sum(cnt) FROM c) / ((SELECT count(*) FROM c) * cnt), 4) AS weight FROM c""")
def agg_class_weights(spark, sf_dir):
    return dist.class_weights(Tables(spark, sf_dir).documents, "lang")


@query("agg_kde", "A38", oracle="""
WITH s AS (SELECT count(*) AS n, stddev_samp(p_retailprice) AS sd, min(p_retailprice) AS mn,
                  max(p_retailprice) AS mx FROM part),
h AS (SELECT n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, mn, mx FROM s),
g AS (SELECT n, h, mn - 3.0 * h AS lo, (mx - mn + 2 * 3.0 * h) / 199 AS step,
             CAST(unnest(range(0, 200)) AS INTEGER) AS point FROM h)
SELECT g.point, round(any_value(g.lo + g.point * g.step), 6) AS x,
       round(sum(exp(-0.5 * ((g.lo + g.point * g.step - p.p_retailprice) / g.h)
                          * ((g.lo + g.point * g.step - p.p_retailprice) / g.h))
                 / (g.n * g.h * sqrt(2 * pi()))), 6) AS density
FROM g, part p GROUP BY g.point""")
def agg_kde(spark, sf_dir):
    """Gaussian density of part prices on a 200-point grid."""
    return dist.kde(Tables(spark, sf_dir).part, "p_retailprice")


@query("agg_scatter_grid", "A39", oracle="""
SELECT p_type, CAST(floor(p_size / 5.0) AS BIGINT) AS x_bin, CAST(floor(p_retailprice / 100.0) AS BIGINT) AS y_bin,
       count(*) AS cnt, floor(p_size / 5.0) * 5.0 AS x_lo, floor(p_retailprice / 100.0) * 100.0 AS y_lo
FROM part GROUP BY ALL""")
def agg_scatter_grid(spark, sf_dir):
    return dist.scatter_grid(Tables(spark, sf_dir).part, "p_size", "p_retailprice", 5.0, 100.0, "p_type")


# Reference aspect ratios and their labels.
REFERENCE_RATIOS = {0.75: "3:4", 1.0: "1:1", 1.33: "4:3", 1.5: "3:2", 2.0: "2:1"}


@query("proj_aspect_ratio", "P19", oracle=f"""
WITH r AS (SELECT CASE WHEN l_quantity * 1000 > 0 THEN round(l_extendedprice / (l_quantity * 1000), 4)
                  ELSE 1.0 END AS ratio FROM lineitem),
d AS (SELECT ratio, {", ".join(f"abs(ratio - {k}) AS d{i}" for i, k in enumerate(REFERENCE_RATIOS))} FROM r)
SELECT CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 AND d0 <= d4 THEN '3:4'
            WHEN d1 <= d2 AND d1 <= d3 AND d1 <= d4 THEN '1:1'
            WHEN d2 <= d3 AND d2 <= d4 THEN '4:3' WHEN d3 <= d4 THEN '3:2' ELSE '2:1' END AS reference,
       count(*) AS cnt, round(avg(ratio), 4) AS mean_ratio
FROM d GROUP BY ALL""")
def proj_aspect_ratio(spark, sf_dir):
    """Width/height ratio (price per 1000 units stand-in), bucketed to reference ratios."""
    li = Tables(spark, sf_dir).lineitem
    ratio = sc.safe_ratio(F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    r = li.select(ratio.alias("ratio"))
    return (r.groupBy(sc.nearest_reference(F.col("ratio"), REFERENCE_RATIOS).alias("reference"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.round(F.avg("ratio"), 4).alias("mean_ratio")))
