"""Evaluation queries on deterministic prediction tables.

Prediction stand-ins (rule-based classifiers over the driver tables, so
every metric has an exact SQL oracle):

* language of each document predicted by three rules — a keyword rule, a
  character-set rule and the majority class;
* the order outcome (0-4) predicted from price buckets, and the order
  status predicted from the order date;
* order price predicted from its line items (two regressors).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import code_labels
from quarry.operators import evaluate as ev
from quarry.operators.rank import label_union, top_k
from quarry.plans.common import OUTCOME_SQL, outcome
from quarry.plans.registry import query
from quarry.sources.tables import Tables

RULES_SQL = {
    "keyword": "CASE WHEN text LIKE '% der %' THEN 'de' WHEN text LIKE '% le %' THEN 'fr' "
               "WHEN text LIKE '% el %' THEN 'es' ELSE 'en' END",
    "charset": "CASE WHEN text LIKE '%ü%' THEN 'de' WHEN text LIKE '%é%' THEN 'fr' "
               "WHEN text LIKE '%ñ%' THEN 'es' ELSE 'en' END",
    "majority": "'en'",
}
FAMILY = {"keyword": "rules", "charset": "rules", "majority": "baseline"}


def lang_predictions(t: Tables) -> DataFrame:
    """(doc_id, model, actual, predicted, text) for the three rule models."""
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(rule).alias("predicted"))
                      for m, rule in RULES_SQL.items()])
    return t.documents.select("doc_id", F.col("lang").alias("actual"), "text", F.explode(rules).alias("rule")) \
        .select("doc_id", "rule.model", "actual", "rule.predicted", "text")


PRED_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{m}' AS model, lang AS actual, {r} AS predicted, text FROM documents"
    for m, r in RULES_SQL.items())

# Price buckets of the outcome predictor (fixed values).
PRICE_EDGES = [50000, 100000, 200000, 300000]
OUTCOME_PRED_SQL = ("CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 100000 THEN 1 "
                    "WHEN o_totalprice < 200000 THEN 2 WHEN o_totalprice < 300000 THEN 3 ELSE 4 END")


def outcome_predictions(t: Tables) -> DataFrame:
    o = t.orders
    p = F.lit(4)
    for i, e in reversed(list(enumerate(PRICE_EDGES))):
        p = F.when(F.col("o_totalprice") < e, F.lit(i)).otherwise(p)
    return o.select("o_orderkey", outcome().alias("actual"), p.alias("predicted"))


def _metrics_sql(pred_sql: str, keys: str) -> str:
    k = keys + ", " if keys else ""
    on = " AND ".join(f"a.{x.strip()} = b.{x.strip()}" for x in keys.split(",")) if keys else "TRUE"
    return f"""
WITH p AS ({pred_sql}),
cells AS (SELECT {k}actual, predicted, count(*) AS cnt FROM p GROUP BY ALL),
lab AS (SELECT DISTINCT {k}l FROM (SELECT {k}actual AS l FROM cells UNION ALL SELECT {k}predicted FROM cells)),
per AS (SELECT {', '.join('lab.' + x.strip() for x in keys.split(',')) + ', ' if keys else ''}lab.l,
               coalesce((SELECT sum(cnt) FROM cells b WHERE b.actual = lab.l AND b.predicted = lab.l
                         {'AND ' + ' AND '.join(f'b.{x.strip()} = lab.{x.strip()}' for x in keys.split(',')) if keys else ''}), 0) AS tp,
               coalesce((SELECT sum(cnt) FROM cells b WHERE b.actual = lab.l
                         {'AND ' + ' AND '.join(f'b.{x.strip()} = lab.{x.strip()}' for x in keys.split(',')) if keys else ''}), 0) AS support,
               coalesce((SELECT sum(cnt) FROM cells b WHERE b.predicted = lab.l
                         {'AND ' + ' AND '.join(f'b.{x.strip()} = lab.{x.strip()}' for x in keys.split(',')) if keys else ''}), 0) AS n_pred
        FROM lab),
m AS (SELECT *, coalesce(tp / nullif(n_pred, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall
      FROM per),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM m)"""


@query("eval_classification", "Q1", oracle=_metrics_sql(PRED_SQL, "model") + """
SELECT model, round(sum(tp) / sum(support), 4) AS accuracy, round(avg(f1), 4) AS macro_f1,
       round(sum(f1 * support) / sum(support), 4) AS weighted_f1, round(avg(precision), 4) AS macro_precision,
       round(avg(recall), 4) AS macro_recall, CAST(sum(support) AS BIGINT) AS n FROM f GROUP BY model""")
def eval_classification(spark, sf_dir):
    p = lang_predictions(Tables(spark, sf_dir))
    return ev.classification_metrics(p, "actual", "predicted", "model")


@query("eval_class_report", "Q2", oracle=_metrics_sql(PRED_SQL, "model") + """
SELECT model, l AS label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL
SELECT model, 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4),
       CAST(sum(support) AS BIGINT) FROM f GROUP BY model
UNION ALL
SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 4),
       round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4),
       CAST(sum(support) AS BIGINT) FROM f GROUP BY model""")
def eval_class_report(spark, sf_dir):
    p = lang_predictions(Tables(spark, sf_dir))
    return ev.class_report(p, "actual", "predicted", "model")


@query("eval_confusion", "Q3 U1", oracle=f"""
WITH p AS ({PRED_SQL}),
cells AS (SELECT model, actual, predicted, count(*) AS cnt FROM p GROUP BY ALL),
lab AS (SELECT DISTINCT model, l FROM (SELECT model, actual AS l FROM cells UNION ALL SELECT model, predicted FROM cells))
SELECT a.model, a.l AS actual, b.l AS predicted, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
FROM lab a JOIN lab b ON a.model = b.model
LEFT JOIN cells c ON c.model = a.model AND c.actual = a.l AND c.predicted = b.l""")
def eval_confusion(spark, sf_dir):
    p = lang_predictions(Tables(spark, sf_dir))
    return ev.confusion_full(p, "actual", "predicted", "model")


@query("eval_confusion_top_norm", "Q4", oracle=f"""
WITH p AS ({PRED_SQL}),
top AS (SELECT actual AS l FROM (SELECT actual, count(*) AS c FROM p WHERE model = 'keyword' GROUP BY ALL)
        ORDER BY c DESC, actual LIMIT 3),
cells AS (SELECT model, actual, predicted, count(*) AS cnt FROM p
          WHERE actual IN (SELECT l FROM top) AND predicted IN (SELECT l FROM top) GROUP BY ALL),
lab AS (SELECT DISTINCT model, l FROM (SELECT model, actual AS l FROM p UNION ALL SELECT model, predicted FROM p)
        WHERE l IN (SELECT l FROM top)),
g AS (SELECT a.model, a.l AS actual, b.l AS predicted, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
      FROM lab a JOIN lab b ON a.model = b.model
      LEFT JOIN cells c ON c.model = a.model AND c.actual = a.l AND c.predicted = b.l)
SELECT g.*, coalesce(round(cnt / nullif(sum(cnt) OVER (PARTITION BY model, actual), 0), 4), 0.0) AS share FROM g""")
def eval_confusion_top_norm(spark, sf_dir):
    """Row-normalised confusion over the 3 most frequent true labels."""
    p = lang_predictions(Tables(spark, sf_dir))
    counts = p.where(F.col("model") == "keyword").groupBy("actual").agg(F.count(F.lit(1)).alias("c"))
    top = top_k(counts, [F.col("c").desc(), F.col("actual")], 3, rank_col=None).select("actual")
    return ev.confusion_top_normalized(p, "actual", "predicted", top, "model")


@query("top_confusions", "K6", oracle=f"""
WITH p AS ({PRED_SQL}),
c AS (SELECT actual, predicted, count(*) AS cnt FROM p WHERE model = 'keyword' AND actual <> predicted GROUP BY ALL)
SELECT actual, predicted, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, actual, predicted) AS INTEGER) AS rank
FROM c ORDER BY cnt DESC, actual, predicted LIMIT 12""")
def top_confusions(spark, sf_dir):
    p = lang_predictions(Tables(spark, sf_dir)).where(F.col("model") == "keyword")
    return ev.top_confusions(p, "actual", "predicted", 12)


@query("set_label_union", "U1", oracle=f"""
WITH p AS ({PRED_SQL}) SELECT DISTINCT l AS label FROM (SELECT actual AS l FROM p UNION ALL SELECT predicted FROM p)""")
def set_label_union(spark, sf_dir):
    return label_union(lang_predictions(Tables(spark, sf_dir)), "actual", "predicted")


# Outcome display names used by the evaluation reports.
REPORT_OUTCOME_NAMES = {0: "Same day", 1: "1–7 days", 2: "8–30 days", 3: "31–90 days", 4: "No adoption"}
_OUT_PRED_SQL = f"SELECT o_orderkey, {OUTCOME_SQL} AS actual, {OUTCOME_PRED_SQL} AS predicted FROM orders"


@query("eval_named_classes", "Q5 P5", oracle=_metrics_sql(_OUT_PRED_SQL, "") + """
SELECT CASE l """ + " ".join(f"WHEN {k} THEN '{v}'" for k, v in REPORT_OUTCOME_NAMES.items()) + """ ELSE 'Unknown' END
       AS label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       CAST(support AS BIGINT) AS support FROM f""")
def eval_named_classes(spark, sf_dir):
    """Per-class report of the outcome predictor with display names."""
    p = outcome_predictions(Tables(spark, sf_dir))
    rep = ev.class_report(p, "actual", "predicted")
    rep = rep.where(~F.col("label").isin("macro avg", "weighted avg"))
    return rep.select(code_labels(F.col("label").try_cast("int"), REPORT_OUTCOME_NAMES).alias("label"),
                      "precision", "recall", "f1", "support")


def _qwk_sql(pred_sql: str, keys: str = "") -> str:
    k = keys + ", " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""
WITH p AS ({pred_sql}),
cells AS (SELECT {k}actual, predicted, count(*) AS cnt FROM p GROUP BY ALL),
lab AS (SELECT DISTINCT {k}l FROM (SELECT {k}actual AS l FROM cells UNION ALL SELECT {k}predicted FROM cells)),
pos AS (SELECT {k}l, CAST(row_number() OVER ({part}ORDER BY l) - 1 AS DOUBLE) AS ps FROM lab),
c AS (SELECT cells.*, a.ps AS i, b.ps AS j FROM cells
      JOIN pos a ON a.l = cells.actual {''.join(f' AND a.{x.strip()} = cells.{x.strip()}' for x in keys.split(',')) if keys else ''}
      JOIN pos b ON b.l = cells.predicted {''.join(f' AND b.{x.strip()} = cells.{x.strip()}' for x in keys.split(',')) if keys else ''}),
rs AS (SELECT {k}i, sum(cnt) AS r FROM c GROUP BY ALL),
cs AS (SELECT {k}j, sum(cnt) AS s FROM c GROUP BY ALL),
o AS (SELECT {k}sum(cnt * (i - j) * (i - j)) AS wo, sum(cnt) AS n FROM c {'GROUP BY ' + keys if keys else ''}),
e AS (SELECT {', '.join('rs.' + x.strip() for x in keys.split(',')) + ', ' if keys else ''}sum(rs.r * cs.s * (rs.i - cs.j) * (rs.i - cs.j)) AS we FROM rs JOIN cs
      {'ON ' + ' AND '.join(f'rs.{x.strip()} = cs.{x.strip()}' for x in keys.split(',')) if keys else 'ON TRUE'}
      {'GROUP BY ' + ', '.join('rs.' + x.strip() for x in keys.split(',')) if keys else ''})"""


@query("eval_qwk", "Q6", oracle=_qwk_sql(_OUT_PRED_SQL) + """
SELECT round(1 - wo / (we / n), 4) AS qwk FROM o, e""")
def eval_qwk(spark, sf_dir):
    return ev.quadratic_kappa(outcome_predictions(Tables(spark, sf_dir)), "actual", "predicted")


_ATTR_SQL = f"""
SELECT 'outcome' AS attribute, o_orderkey, CAST({OUTCOME_SQL} AS VARCHAR) AS actual,
       CAST({OUTCOME_PRED_SQL} AS VARCHAR) AS predicted FROM orders
UNION ALL
SELECT 'status', o_orderkey, o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'F' ELSE 'O' END FROM orders"""


@query("eval_per_attribute", "Q7", oracle=_qwk_sql(_ATTR_SQL, "attribute") + """
SELECT o.attribute, round(1 - o.wo / (e.we / o.n), 4) AS qwk,
       round((SELECT count_if(actual = predicted) / count(*) FROM p WHERE p.attribute = o.attribute), 4) AS accuracy
FROM o JOIN e USING (attribute)""")
def eval_per_attribute(spark, sf_dir):
    """Accuracy and QWK per predicted attribute (outcome, status)."""
    t = Tables(spark, sf_dir)
    oc = outcome_predictions(t).select(F.lit("outcome").alias("attribute"), "o_orderkey",
                                       F.col("actual").cast("string").alias("actual"),
                                       F.col("predicted").cast("string").alias("predicted"))
    st = t.orders.select(F.lit("status").alias("attribute"), "o_orderkey", F.col("o_orderstatus").alias("actual"),
                         F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("F"))
                         .otherwise(F.lit("O")).alias("predicted"))
    p = oc.unionByName(st)
    acc = p.groupBy("attribute").agg(F.round(F.avg((F.col("actual") == F.col("predicted")).cast("double")), 4)
                                     .alias("accuracy"))
    return ev.quadratic_kappa(p, "actual", "predicted", "attribute").join(acc, "attribute")


_REG_SQL = """
WITH li AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS s FROM lineitem GROUP BY ALL),
pm AS (SELECT o_orderpriority, avg(o_totalprice) AS m FROM orders GROUP BY ALL),
p AS (SELECT 'line_sum' AS model, o.o_totalprice AS y, li.s AS yhat FROM orders o JOIN li ON li.l_orderkey = o.o_orderkey
      UNION ALL
      SELECT 'priority_mean', o.o_totalprice, pm.m FROM orders o JOIN pm USING (o_orderpriority)),
m AS (SELECT model, avg(y) AS my FROM p GROUP BY ALL)"""


def regression_predictions(t: Tables) -> DataFrame:
    li = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
          .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("yhat")))
    a = t.orders.join(li, "o_orderkey").select(F.lit("line_sum").alias("model"), F.col("o_totalprice").alias("y"),
                                               "yhat")
    pm = t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("yhat"))
    b = t.orders.join(pm, "o_orderpriority").select(F.lit("priority_mean").alias("model"),
                                                    F.col("o_totalprice").alias("y"), "yhat")
    return a.unionByName(b)


@query("eval_regression", "Q8", oracle=_REG_SQL + """
SELECT p.model, count(*) AS n, round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
       round(CASE WHEN sum((y - my) * (y - my)) = 0 THEN 0.0
             ELSE 1 - sum((y - yhat) * (y - yhat)) / sum((y - my) * (y - my)) END, 4) AS r2
FROM p JOIN m USING (model) GROUP BY p.model""")
def eval_regression(spark, sf_dir):
    """MAE, RMSE, R² of two order-price predictors (line-item sum, priority mean)."""
    return ev.regression_metrics(regression_predictions(Tables(spark, sf_dir)), "y", "yhat", "model")


@query("clf_voting", "M12", oracle=f"""
WITH v AS (SELECT doc_id, [{RULES_SQL['keyword']}, {RULES_SQL['charset']}, {RULES_SQL['majority']}] AS ps FROM documents)
SELECT doc_id, list_sort(list_transform(ps, lambda p: {{'neg': -len(list_filter(ps, lambda q: q = p)), 'label': p}}))[1].label
       AS vote FROM v""")
def clf_voting(spark, sf_dir):
    """Hard majority vote of the three rule models (ties → smallest label)."""
    d = Tables(spark, sf_dir).documents
    preds = d.select("doc_id", *[F.expr(r).alias(m) for m, r in RULES_SQL.items()])
    return preds.select("doc_id", ev.hard_vote(preds, list(RULES_SQL)))


_LEADER_SQL = _metrics_sql(PRED_SQL, "model") + """,
r AS (SELECT model, round(avg(f1), 4) AS macro_f1, round(sum(f1 * support) / sum(support), 4) AS weighted_f1
      FROM f GROUP BY model),
q AS (SELECT r.*, CASE model """ + " ".join(f"WHEN '{m}' THEN '{fam}'" for m, fam in FAMILY.items()) + """ END AS family,
             CASE WHEN macro_f1 IS NULL THEN 'failed' ELSE 'ok' END AS status FROM r)"""


@query("eval_leaderboard", "Q12 K5 W2 P12", oracle=_LEADER_SQL + """
SELECT model, family, macro_f1, weighted_f1,
       CAST(row_number() OVER (ORDER BY macro_f1 DESC NULLS LAST, weighted_f1 DESC NULLS LAST, model) AS INTEGER) AS rank,
       round(max(macro_f1) OVER () - macro_f1, 4) AS gap_to_best,
       CAST(row_number() OVER (PARTITION BY family ORDER BY macro_f1 DESC NULLS LAST, weighted_f1 DESC NULLS LAST, model)
            AS INTEGER) AS family_rank,
       row_number() OVER (ORDER BY macro_f1 DESC NULLS LAST, weighted_f1 DESC NULLS LAST, model) = 1 AS is_best
FROM q WHERE status <> 'failed'""")
def eval_leaderboard(spark, sf_dir):
    """Runs sorted by (macro-F1, weighted-F1), failed runs dropped, best per family and gap to best."""
    m = ev.classification_metrics(lang_predictions(Tables(spark, sf_dir)), "actual", "predicted", "model")
    fam = F.create_map(*[x for kv in FAMILY.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    runs = m.select("model", fam[F.col("model")].alias("family"), "macro_f1", "weighted_f1",
                    F.when(F.col("macro_f1").isNull(), F.lit("failed")).otherwise(F.lit("ok")).alias("status"))
    runs = runs.where(F.col("status") != "failed").drop("status")
    return ev.leaderboard(runs, "model", family="family")


@query("set_family_union", "U2", oracle=_LEADER_SQL + """,
best_clf AS (SELECT model, family, macro_f1, CAST(NULL AS DOUBLE) AS r2 FROM q
             ORDER BY macro_f1 DESC, weighted_f1 DESC, model LIMIT 1)
SELECT * FROM best_clf UNION ALL
SELECT model, 'regression' AS family, CAST(NULL AS DOUBLE), r2 FROM (""" + _REG_SQL.replace("WITH li", "WITH li", 1) + """
SELECT p.model, round(1 - sum((y - yhat) * (y - yhat)) / sum((y - my) * (y - my)), 4) AS r2
FROM p JOIN m USING (model) GROUP BY p.model ORDER BY r2 DESC, p.model LIMIT 1)""")
def set_family_union(spark, sf_dir):
    """Best row of the classifier family and of the regressor family, stacked
    with their differing columns (missing ones null)."""
    t = Tables(spark, sf_dir)
    clf = eval_leaderboard(spark, sf_dir).where(F.col("rank") == 1).select("model", "family", "macro_f1")
    reg = ev.regression_metrics(regression_predictions(t), "y", "yhat", "model")
    reg = top_k(reg, [F.col("r2").desc(), F.col("model")], 1, rank_col=None) \
        .select("model", F.lit("regression").alias("family"), "r2")
    return clf.unionByName(reg, allowMissingColumns=True)


@query("proj_preview", "P18", oracle=f"""
SELECT doc_id, actual, predicted, substr(text, 1, 240) AS text_preview FROM ({PRED_SQL})
WHERE model = 'keyword' AND actual <> predicted ORDER BY doc_id LIMIT 12""")
def proj_preview(spark, sf_dir):
    """First 12 misclassified documents of the keyword model, 240-character preview."""
    p = lang_predictions(Tables(spark, sf_dir)).where((F.col("model") == "keyword") &
                                                      (F.col("actual") != F.col("predicted")))
    return p.orderBy("doc_id").limit(12).select("doc_id", "actual", "predicted",
                                                F.substring("text", 1, 240).alias("text_preview"))


@query("agg_split_distribution", "A37", oracle="""
WITH s AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')), doc_id) AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM documents),
t AS (SELECT lang, CASE WHEN pos <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM s),
c AS (SELECT split, lang, count(*) AS cnt FROM t GROUP BY ALL)
SELECT split, lang, cnt, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY cnt DESC, lang) AS rank FROM c) WHERE rank <= 15""")
def agg_split_distribution(spark, sf_dir):
    """Class counts in train and test of the stratified split, top 15 each."""
    from quarry.operators.rank import topk_per_group
    from quarry.operators.sampling import split_stratified
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    s = split_stratified(d, "lang", "doc_id", test=0.2, val=0.0, seed=42)
    c = s.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("cnt"))
    return topk_per_group(c, "split", [F.col("cnt").desc(), F.col("lang")], 15, slice_cols=["lang"])


@query("eval_run_summary", "Q16 A3 A7", oracle=r"""
WITH s AS (SELECT doc_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')), doc_id) AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM documents),
t AS (SELECT *, CASE WHEN pos <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split,
             len(regexp_extract_all(coalesce(text, ''), '\S+')) AS words FROM s),
tc AS (SELECT lang, count(*) AS c FROM t WHERE split = 'train' GROUP BY ALL)
SELECT CAST(count_if(split = 'train') AS BIGINT) AS train_size, CAST(count_if(split = 'test') AS BIGINT) AS test_size,
       count(DISTINCT lang) AS class_count, round(avg(words), 2) AS avg_words,
       CAST(trunc(median(words)) AS INTEGER) AS median_words,
       (SELECT round(max(c) / min(c), 2) FROM tc) AS imbalance_ratio FROM t""")
def eval_run_summary(spark, sf_dir):
    """One-row run overview: split sizes, classes, words per document, train imbalance."""
    from quarry.functions.text import word_count
    from quarry.operators.profile import imbalance
    from quarry.operators.quantiles import exact_quantiles
    from quarry.operators.rank import attach
    from quarry.operators.sampling import split_stratified
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang", word_count("text").alias("words"))
    s = split_stratified(d, "lang", "doc_id", test=0.2, val=0.0, seed=42)
    base = s.agg(F.count_if(F.col("split") == "train").alias("train_size"),
                 F.count_if(F.col("split") == "test").alias("test_size"),
                 F.count_distinct("lang").alias("class_count"), F.round(F.avg("words"), 2).alias("avg_words"))
    med = exact_quantiles(s, [], "words", {"median": 0.5}, count_col=None) \
        .select(F.col("median").cast("int").alias("median_words"))
    imb = imbalance(s.where(F.col("split") == "train"), "lang").select("imbalance_ratio")
    return attach(attach(base, med, []), imb, [])
