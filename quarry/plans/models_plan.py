"""Model queries: tabular encoders (SQL-checked), regression and text
classification model sets, two-stage model, ablation and attributions.

Stand-ins: salary table = orders with line-item counts, customer segment
and nation; text = documents (category = lang); image vectors =
embeddings (outcome = label, attributes derived from it).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import evaluate as ev
from quarry.operators import models as md
from quarry.operators.blocks import compact, spread
from quarry.operators.ml import MedianImputer, OrdinalEncoder, TargetEncoder
from quarry.operators.rank import feature_subsets, top_k
from quarry.operators.sampling import split_stratified, split_train_test
from quarry.plans.registry import query
from quarry.sources.tables import Tables

# Ordinal orders of the two ordered categoricals.
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENT_ORDER = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD"]
NUMERIC = ["n_lines", "qty"]
ORDINAL = {"o_orderpriority": PRIORITY_ORDER, "c_mktsegment": SEGMENT_ORDER}
NOMINAL = ["n_name", "o_orderstatus", "r_name", "order_year"]
TARGET = "o_totalprice"


def salary_table(t: Tables):
    """One row per order: target price, line count, quantity (null for
    partially shipped orders), priority, segment, nation, region, year."""
    li = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("_qty"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", TARGET,
                        F.year("o_orderdate").cast("string").alias("order_year"))
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    df = o.join(li, "o_orderkey", "left").join(c, "o_custkey").join(n, "c_nationkey").join(r, "n_regionkey")
    return df.withColumn("qty", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("_qty"))) \
        .drop("_qty", "o_custkey", "c_nationkey", "n_regionkey")


SALARY_SQL = """
WITH li AS (SELECT l_orderkey AS o_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS q
            FROM lineitem GROUP BY ALL),
s AS (SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
             CAST(year(o.o_orderdate) AS VARCHAR) AS order_year, c.c_mktsegment, n.n_name, r.r_name, li.n_lines,
             CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE li.q END AS qty
      FROM orders o LEFT JOIN li USING (o_orderkey) JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
sp AS (SELECT s.*, CASE WHEN row_number() OVER (ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), ':42')), o_orderkey)
                    <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split FROM s)"""


def salary_split(t: Tables):
    return split_train_test(salary_table(t), "o_orderkey", 0.8, seed=42)


@query("feat_impute_median", "E1", oracle=SALARY_SQL + """,
m AS (SELECT median(qty) AS med FROM sp WHERE split = 'train')
SELECT o_orderkey, split, coalesce(qty, m.med) AS qty_imp FROM sp, m""")
def feat_impute_median(spark, sf_dir):
    """Quantity median-imputed with the median of the training split."""
    s = salary_split(Tables(spark, sf_dir))
    model = MedianImputer(["qty"]).fit(s.where(F.col("split") == "train"))
    return model.transform(s).select("o_orderkey", "split", "qty_imp")


@query("feat_ordinal_encode", "E5", oracle="""
SELECT o.o_orderkey,
       CAST(coalesce(CASE o.o_orderpriority """ + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(PRIORITY_ORDER)) + """ END, -1) AS INTEGER) AS o_orderpriority_ord,
       CAST(coalesce(CASE c.c_mktsegment """ + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(SEGMENT_ORDER)) + """ END, -1) AS INTEGER) AS c_mktsegment_ord
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def feat_ordinal_encode(spark, sf_dir):
    t = Tables(spark, sf_dir)
    df = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return OrdinalEncoder(ORDINAL).transform(df).select("o_orderkey", "o_orderpriority_ord", "c_mktsegment_ord")


_TE_SQL = SALARY_SQL + """,
pr AS (SELECT avg(o_totalprice) AS prior FROM sp WHERE split = 'train'),
lv AS (SELECT n_name, count(*) AS n, avg(o_totalprice) AS m FROM sp WHERE split = 'train' AND n_name IS NOT NULL
       GROUP BY ALL),
te AS (SELECT n_name, n, CASE WHEN n = 1 THEN prior
                  ELSE prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0))) + m * (1 / (1 + exp(-(n - 20) / 10.0))) END AS value
       FROM lv, pr)"""


@query("feat_target_encode", "E6", oracle=_TE_SQL + """
SELECT sp.o_orderkey, sp.split, round(coalesce(te.value, pr.prior), 4) AS n_name_te
FROM sp LEFT JOIN te USING (n_name), pr""")
def feat_target_encode(spark, sf_dir):
    """Nation target-encoded on the training split (smoothing 10, min leaf 20)."""
    s = salary_split(Tables(spark, sf_dir))
    model = TargetEncoder(["n_name"], TARGET).fit(s.where(F.col("split") == "train"))
    return model.transform(s).select("o_orderkey", "split", F.round("n_name_te", 4).alias("n_name_te"))


@query("feat_encoder_mappings", "E7", oracle=_TE_SQL + """,
tops AS (SELECT 'n_name' AS feature, n_name AS category, round(value, 4) AS value FROM te
         ORDER BY value DESC, n_name LIMIT 10)
SELECT * FROM tops
UNION ALL SELECT 'n_name', '-1 (unknown)', round(prior, 4) FROM pr
UNION ALL SELECT 'n_name', '-2 (missing)', round(prior, 4) FROM pr
UNION ALL SELECT feature, category, value FROM (VALUES """ + ", ".join(
    f"('o_orderpriority', '{v}', {float(i)})" for i, v in enumerate(PRIORITY_ORDER)) + ", " + ", ".join(
    f"('c_mktsegment', '{v}', {float(i)})" for i, v in enumerate(SEGMENT_ORDER)) + """) v(feature, category, value)""")
def feat_encoder_mappings(spark, sf_dir):
    """Fitted encoder tables: ordinal codes, the 10 highest target-encoded
    nations and the fallback rows for unknown (-1) and missing (-2)."""
    s = salary_split(Tables(spark, sf_dir)).where(F.col("split") == "train")
    te = TargetEncoder(["n_name"], TARGET).fit(s)
    table = te.tables["n_name"]
    tops = top_k(table, [F.col("value").desc(), F.col("level")], 10, rank_col=None).select(
        F.lit("n_name").alias("feature"), F.col("level").alias("category"), F.round("value", 4).alias("value"))
    prior = te.prior.select(F.round("prior", 4).alias("value"))
    fallback = prior.select(F.lit("n_name").alias("feature"), F.lit("-1 (unknown)").alias("category"), "value") \
        .unionByName(prior.select(F.lit("n_name").alias("feature"), F.lit("-2 (missing)").alias("category"), "value"))
    ords = spark.createDataFrame([(f, v, float(i)) for f, order in ORDINAL.items() for i, v in enumerate(order)],
                                 "feature string, category string, value double")
    return tops.unionByName(fallback).unionByName(ords)


def _regression(spark, sf_dir, name):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    from pyspark import StorageLevel
    s = salary_split(Tables(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    reg = {"linear_regression": LinearRegression(labelCol=TARGET),
           "random_forest": RandomForestRegressor(labelCol=TARGET, numTrees=100, seed=42),
           "gbt": GBTRegressor(labelCol=TARGET, maxIter=200, stepSize=0.05, seed=42)}[name]
    stages = md.tabular_stages(NUMERIC, ORDINAL, NOMINAL, TARGET, linear=(name == "linear_regression"))
    model = md.fit_persisted(stages + [reg], train)
    s.unpersist()
    pred = model.transform(test).select(F.lit(name).alias("model"), F.col(TARGET).alias("y"),
                                        F.col("prediction").alias("yhat"))
    return model, pred


@query("reg_linear", "M1 E2 E8 Q8 P14 D4")
def reg_linear(spark, sf_dir):
    _, pred = _regression(spark, sf_dir, "linear_regression")
    return ev.regression_metrics(pred, "y", "yhat", "model")


@query("reg_random_forest", "M2 Q8")
def reg_random_forest(spark, sf_dir):
    _, pred = _regression(spark, sf_dir, "random_forest")
    return ev.regression_metrics(pred, "y", "yhat", "model")


@query("reg_gbt", "M3 Q8")
def reg_gbt(spark, sf_dir):
    _, pred = _regression(spark, sf_dir, "gbt")
    return ev.regression_metrics(pred, "y", "yhat", "model")


@query("eval_feature_importance", "Q9")
def eval_feature_importance(spark, sf_dir):
    """Random-forest importances joined with the assembled feature names."""
    model, _ = _regression(spark, sf_dir, "random_forest")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    names = md.feature_names(NUMERIC, ORDINAL, NOMINAL)
    return spark.createDataFrame(list(zip(names, imp)), "feature string, importance double") \
        .orderBy(F.col("importance").desc(), "feature")


# ---------------------------------------------------------------------------
# Text classification
# ---------------------------------------------------------------------------
class text_split:
    """Stratified 80/20 document split, persisted while models are fitted
    (context manager: unpersisted on exit; later actions recompute it)."""

    def __init__(self, t: Tables):
        from pyspark import StorageLevel
        text = F.coalesce("text", F.lit("")).alias("text")   # a document without a text has no words
        d = spread(t.documents.select("doc_id", text, F.col("lang").alias("category")))
        self.s = split_stratified(d, "category", "doc_id", test=0.2, val=0.0, seed=42) \
            .persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self):
        return self.s.where(F.col("split") == "train"), self.s.where(F.col("split") == "test")

    def __exit__(self, *exc):
        self.s.unpersist()


def _one_text_model(spark, sf_dir, name):
    with text_split(Tables(spark, sf_dir)) as (train, test):
        metrics, _ = md.model_set_run(train, test, {name: md.text_models()[name]}, parallelism=1)
        return metrics


for _name, _key, _tag in [("multinomial_nb", "clf_multinomial_nb", "M4 E10 E11"),
                          ("complement_nb", "clf_complement_nb", "M5"),
                          ("logistic_regression", "clf_logistic_ovr", "M6"),
                          ("linear_svc", "clf_linear_svc", "M7"),
                          ("char_linear_svc", "clf_char_linear_svc", "M8 E12"),
                          ("passive_aggressive", "clf_passive_aggressive", "M10"),
                          ("voting_ensemble", "clf_voting_fitted", "M12"),
                          ("ridge_classifier", "clf_ridge", "M9"),
                          ("sgd_log_loss", "clf_sgd_log", "M10"),
                          ("sgd_hinge", "clf_sgd_hinge", "M10"),
                          ("hashing_sgd_hinge", "clf_hashing_hinge", "M11 E13"),
                          ("boosted_lsa", "clf_boosted_lsa", "M13 E15")]:
    query(_key, _tag)(lambda spark, sf_dir, _n=_name: _one_text_model(spark, sf_dir, _n))


@query("model_set_run", "M18 K5 Q12")
def model_set_run(spark, sf_dir):
    """All twelve text models fitted and scored on one split (two concurrent
    fits), ranked by (macro-F1, weighted-F1); an error if one of them failed."""
    with text_split(Tables(spark, sf_dir)) as (train, test):
        metrics, _ = md.model_set_run(train, test, md.text_models(), parallelism=2)
    return ev.leaderboard(metrics, "model")


@query("sink_best_model", "S10 D4 M12")
def sink_best_model(spark, sf_dir):
    """The best of a model set (own and built-in stages) saved, loaded again
    and compared with the model in memory, row by row."""
    from quarry.plans.files_plan import scratch
    from quarry.sources.sinks import load_model
    path, names = scratch(spark, "best-model"), ["complement_nb", "linear_svc", "voting_ensemble"]
    with text_split(Tables(spark, sf_dir)) as (train, test):
        metrics, fitted = md.model_set_run(train, test, {n: md.text_models()[n] for n in names}, model_path=path)
        best = metrics.orderBy(F.desc("macro_f1"), F.desc("weighted_f1"), "model").first()["model"]
        was = fitted[best].transform(test).select("doc_id", "category", F.col("prediction").alias("was"))
        now = load_model(path).transform(test).select("doc_id", F.col("prediction").alias("now"))
        both = was.join(now, "doc_id").checkpoint()
    return both.groupBy("category").agg(F.count(F.lit(1)).alias("docs"),
                                        F.sum((F.col("was") == F.col("now")).cast("long")).alias("same"))


@query("clf_mlp", "M14 E15")
def clf_mlp(spark, sf_dir):
    """128-unit ReLU network on 300-component LSA features (grid cell tfidf__svd_300__mlp)."""
    with text_split(Tables(spark, sf_dir)) as (train, test):
        return md.grid_run(train, test, [("tfidf", "svd_300", "mlp")])


@query("grid_run", "M17 S9 S10 F13 E14 T4 M14")
def grid_run(spark, sf_dir):
    """All 22 cells of the feature × reducer × model grid, rows kept as they
    finish, the best pipeline fitted again and saved."""
    from quarry.plans.files_plan import scratch
    with text_split(Tables(spark, sf_dir)) as (train, test):
        return md.grid_run(train, test, progress_path=scratch(spark, "grid-progress"), model_path=scratch(spark, "grid-best"))


@query("eval_top_class_features", "Q10")
def eval_top_class_features(spark, sf_dir):
    """12 heaviest terms per class: log probabilities of the complement NB
    model and coefficients of the linear SVC."""
    names, rows = ["complement_nb", "linear_svc"], []
    with text_split(Tables(spark, sf_dir)) as (train, test):
        _, fitted = md.model_set_run(train, test, {n: md.text_models()[n] for n in names})
    for n in names:
        rows += [(n, *r) for r in md.top_class_terms(fitted[n], 12)]
    out = spark.createDataFrame(rows, "model string, category string, term string, weight double")
    return out.withColumn("weight", F.round("weight", 4))


# ---------------------------------------------------------------------------
# Two-stage model on image vectors (embeddings)
# ---------------------------------------------------------------------------
ATTRIBUTES = ["attr_type", "attr_size"]


def embedding_table(t: Tables):
    e = t.embeddings
    return e.select("vec_id", "embedding", F.col("label").alias("outcome"),
                    (F.col("label") % 2).alias("attr_type"), (F.col("label") / 4).cast("int").alias("attr_size"),
                    (F.size("embedding") % 7 + F.col("vec_id") % 3).cast("double").alias("photo_count"))


def _two_stage(spark, sf_dir):
    s = split_train_test(embedding_table(Tables(spark, sf_dir)), "vec_id", 0.8, seed=42)
    train, test = compact(s.where(F.col("split") == "train")), compact(s.where(F.col("split") == "test"))
    return md.two_stage(train, test, "embedding", ATTRIBUTES, "outcome", "photo_count")


@query("clf_two_stage", "M16 M15 E18 Q7")
def clf_two_stage(spark, sf_dir):
    """Stage-1 accuracies per attribute, then stage-2 accuracy and QWK."""
    res = _two_stage(spark, sf_dir)
    te = res["test"]
    rows = None
    for a, m in res["stage1"].items():
        from pyspark.ml.functions import array_to_vector
        p = m.transform(te.withColumn("_v", array_to_vector(F.col("embedding"))).drop("prediction", "probability",
                                                                                     "rawPrediction"))
        r = p.select(F.lit(a).alias("target"), F.col(a).cast("int").alias("actual"),
                     F.col("prediction").cast("int").alias("predicted"))
        rows = r if rows is None else rows.unionByName(r)
    final = res["final"].transform(res["test"]).select(F.lit("outcome").alias("target"),
                                                       F.col("outcome").cast("int").alias("actual"),
                                                       F.col("prediction").cast("int").alias("predicted"))
    rows = rows.unionByName(final)
    acc = rows.groupBy("target").agg(F.round(F.avg((F.col("actual") == F.col("predicted")).cast("double")), 4)
                                     .alias("accuracy"))
    return acc.join(ev.quadratic_kappa(rows, "actual", "predicted", "target"), "target")


def _groups_table(res, spark):
    return spark.createDataFrame([(g,) for g in res["slices"]], "g string")


@query("eval_ablation_single", "Q13")
def eval_ablation_single(spark, sf_dir):
    res = _two_stage(spark, sf_dir)
    subs = feature_subsets(_groups_table(res, spark), "g", 1)
    return md.ablate(res["final"], res["test"], "outcome", res["slices"], subs)


@query("eval_ablation_subsets", "Q14 U4")
def eval_ablation_subsets(spark, sf_dir):
    res = _two_stage(spark, sf_dir)
    subs = feature_subsets(_groups_table(res, spark), "g", len(res["slices"]))
    return md.ablation_report(md.ablate(res["final"], res["test"], "outcome", res["slices"], subs, baseline=True))


class VectorRule:
    """A fixed scorer in the place of a fitted model: a class from sums of the vector."""

    def transform(self, df):
        from pyspark.ml.functions import vector_to_array
        x = vector_to_array("features")
        total = F.aggregate(F.slice(x, 1, 8), F.lit(0.0), lambda a, v: a + v) + 2 * x[8] - x[9] + x[10]
        return df.withColumn("prediction", F.pmod(F.floor(total * 4), F.lit(10)).cast("double"))


@query("eval_ablation_fixed", "Q13 Q14 U4 Q6", oracle="""
WITH e AS (SELECT list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS v, CAST(label AS INTEGER) AS actual FROM embeddings),
x AS (SELECT actual, list_sum(v[1:4]) AS a, list_sum(v[5:8]) AS b, 2 * v[9] - v[10] AS c, v[11] AS d FROM e),
m AS (SELECT * FROM (VALUES ('<none>', 1, 1, 1, 1), ('a', 0, 1, 1, 1), ('b', 1, 0, 1, 1), ('c', 1, 1, 0, 1), ('a+b', 0, 0, 1, 1),
  ('a+c', 0, 1, 0, 1), ('b+c', 1, 0, 0, 1), ('a+b+c', 0, 0, 0, 1), ('d', 1, 1, 1, 0), ('a+d', 0, 1, 1, 0), ('b+d', 1, 0, 1, 0),
  ('c+d', 1, 1, 0, 0), ('a+b+d', 0, 0, 1, 0), ('a+c+d', 0, 1, 0, 0), ('b+c+d', 1, 0, 0, 0), ('a+b+c+d', 0, 0, 0, 0)) t(subset_name, ka, kb, kc, kd)),
p AS (SELECT subset_name, actual, CAST(((CAST(floor((a * ka + b * kb + c * kc + d * kd) * 4) AS BIGINT) % 10) + 10) % 10 AS INTEGER) AS predicted FROM x, m),
o AS (SELECT subset_name, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS acc,
             sum((actual - predicted) * (actual - predicted)) AS obs, count(*) AS n, sum(actual) AS sa, sum(predicted) AS sp,
             sum(actual * actual) AS saa, sum(predicted * predicted) AS spp FROM p GROUP BY 1),
q AS (SELECT subset_name, acc, 1 - CAST(obs AS DOUBLE) / (saa + spp - 2.0 * sa * sp / n) AS qwk FROM o),
r AS (SELECT q.subset_name, round(q.acc, 4) AS accuracy, round(q.qwk, 4) AS qwk, round(q.acc - b.acc, 4) AS delta_accuracy,
             round(q.qwk - b.qwk, 4) AS delta_qwk FROM q, (SELECT * FROM q WHERE subset_name = '<none>') b),
s AS (SELECT * FROM r WHERE subset_name <> '<none>')
SELECT 'baseline' AS kind, CAST(1 AS BIGINT) AS place, * FROM r WHERE subset_name = '<none>'
UNION ALL SELECT 'combination', row_number() OVER (ORDER BY delta_qwk, subset_name), * FROM s
UNION ALL (SELECT 'worst', row_number() OVER (ORDER BY delta_qwk, subset_name) AS place, * FROM s QUALIFY place <= 5)
UNION ALL (SELECT 'best', row_number() OVER (ORDER BY delta_qwk DESC, subset_name DESC) AS place, * FROM s QUALIFY place <= 5)""")
def eval_ablation_fixed(spark, sf_dir):
    """The ablation report of a fixed scorer over four slices of the embeddings."""
    from pyspark.ml.functions import array_to_vector
    e = Tables(spark, sf_dir).embeddings.select(F.col("label").alias("outcome"),
                                                array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    slices = {"a": (0, 4), "b": (4, 8), "c": (8, 10), "d": (10, 11)}
    subs = feature_subsets(spark.createDataFrame([(g,) for g in slices], "g string"), "g", 4)
    return md.ablation_report(md.ablate(VectorRule(), e, "outcome", slices, subs, baseline=True))


@query("clf_factory", "M15")
def clf_factory(spark, sf_dir):
    """Every named classifier with its first-stage defaults: accuracy on the
    test rows for the two-valued attribute of the embeddings."""
    from pyspark.ml.functions import array_to_vector
    e = embedding_table(Tables(spark, sf_dir)).withColumn("features", array_to_vector(F.col("embedding")))
    s = split_train_test(e, "vec_id", 0.8, seed=42).select("vec_id", "features", "attr_type", "split").checkpoint()
    train, test, out = compact(s.where("split = 'train'")), s.where("split = 'test'"), None
    for name in md.CLASSIFIERS:
        model = md.build_classifier(name).setLabelCol("attr_type").fit(train)
        hit = (F.col("attr_type") == F.col("prediction")).cast("double")
        row = model.transform(test).agg(F.lit(name).alias("model"), F.round(F.avg(hit), 4).alias("accuracy"))
        out = row if out is None else out.unionByName(row)
    train.unpersist()
    return out


def _attribution_report(mean_abs, spark, slices):
    """The 20 features of largest mean |attribution| and the sums of the feature groups."""
    rows = [(f"{g}_{j - s}", g, float(mean_abs[j]), j) for g, (s, e) in slices.items() for j in range(s, e)]
    contrib = spark.createDataFrame(rows, "feature string, group string, mean_abs double, pos int")
    per_group = contrib.groupBy("group").agg(F.round(F.sum("mean_abs"), 6).alias("mean_abs")) \
        .select(F.lit("group").alias("level"), F.col("group").alias("name"), "mean_abs")
    top = top_k(contrib, [F.col("mean_abs").desc(), F.col("pos")], 20, rank_col=None) \
        .select(F.lit("feature").alias("level"), F.col("feature").alias("name"), F.round("mean_abs", 6).alias("mean_abs"))
    return top.unionByName(per_group)


@query("eval_attribution", "Q15")
def eval_attribution(spark, sf_dir):
    """Path-dependent Shapley values of the stage-2 forest: mean |value| per
    feature over test rows and classes, summed per feature group, top 20."""
    from quarry.operators.attribution import mean_absolute
    res = _two_stage(spark, sf_dir)
    return _attribution_report(mean_absolute(res["final"], res["test"]), spark, res["slices"])


@query("eval_attribution_linear", "Q15")
def eval_attribution_linear(spark, sf_dir):
    """Linear attributions of a multinomial logistic model on the stage-2
    features: mean |w·(x - x̄)| per feature, summed per feature group, top 20."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    res = _two_stage(spark, sf_dir)
    lr = LogisticRegression(labelCol="outcome", maxIter=100).fit(res["train"])
    coef = lr.coefficientMatrix.toArray()   # classes × features model parameters
    coef_rows = spark.createDataFrame([(j, float(coef[c, j])) for c in range(coef.shape[0])
                                       for j in range(coef.shape[1])], "pos int, coef double")
    names = spark.createDataFrame([(j, f"{g}_{j - s}", g) for g, (s, e) in res["slices"].items()
                                   for j in range(s, e)], "pos int, feature string, group string")
    x = res["test"].select(vector_to_array("features").alias("x"))
    contrib = md.linear_attribution(coef_rows, x, "x", names)
    per_group = contrib.groupBy("group").agg(F.round(F.sum("mean_abs"), 6).alias("mean_abs")) \
        .select(F.lit("group").alias("level"), F.col("group").alias("name"), "mean_abs")
    top = top_k(contrib, [F.col("mean_abs").desc(), F.col("pos")], 20, rank_col=None) \
        .select(F.lit("feature").alias("level"), F.col("feature").alias("name"), F.round("mean_abs", 6).alias("mean_abs"))
    return top.unionByName(per_group)


@query("feat_assemble", "E8 P14 E1 E5 E6", oracle=_TE_SQL + """,
m AS (SELECT median(n_lines) AS med_lines, median(qty) AS med_qty FROM sp WHERE split = 'train'),
one AS (SELECT sp.*, coalesce(n_lines, med_lines) AS lines_imp, coalesce(qty, med_qty) AS qty_imp FROM sp, m)
SELECT o_orderkey, split, round(lines_imp, 4) AS f0, round(qty_imp, 4) AS f1,
       CAST(CASE o_orderpriority """ + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(PRIORITY_ORDER)) + """ ELSE -1 END AS DOUBLE) AS f2,
       CAST(CASE c_mktsegment """ + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(SEGMENT_ORDER)) + """ ELSE -1 END AS DOUBLE) AS f3,
       round(coalesce(te.value, prior), 4) AS f4
FROM one LEFT JOIN te USING (n_name), pr""")
def feat_assemble(spark, sf_dir):
    """The assembled feature vector of every order (two imputed numbers, two
    ordinal codes, one target-encoded nation), the target left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    s = salary_split(Tables(spark, sf_dir))
    stages = md.tabular_stages(NUMERIC, ORDINAL, ["n_name"], TARGET, linear=False)
    x = vector_to_array("features")
    out = Pipeline(stages=stages).fit(s.where("split = 'train'")).transform(s)
    return out.select("o_orderkey", "split", *[F.round(x[i], 4).alias(f"f{i}") for i in range(5)])


@query("win_cumulative", "W3", oracle="""
WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders GROUP BY 1)
SELECT year, orders, CAST(sum(orders) OVER (ORDER BY year) AS BIGINT) AS cumulative FROM m""")
def win_cumulative(spark, sf_dir):
    """Orders per year and their running total (one row per year)."""
    from quarry.operators.rank import cumulative
    years = Tables(spark, sf_dir).orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders"))
    return cumulative(years, "orders", "year")


@query("feat_pca", "E16 E2 W3")
def feat_pca(spark, sf_dir):
    """Standardised five-metric PCA: explained-variance ratios and their running total."""
    from pyspark.ml.feature import PCA, VectorAssembler
    from quarry.operators.features import standardize
    from quarry.operators.rank import cumulative
    from quarry.plans.similarity import METRICS, merged
    # Joined once: the statistics and the fit read the written rows.
    z = standardize(merged(Tables(spark, sf_dir)).select(METRICS).checkpoint(), METRICS)
    vec = VectorAssembler(inputCols=METRICS, outputCol="features").transform(z)
    pca = PCA(k=len(METRICS), inputCol="features", outputCol="pcs").fit(vec)
    ratios = pca.explainedVariance.toArray().tolist()
    df = spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratios)], "component int, ratio double")
    return cumulative(df, "ratio", "component").select("component", F.round("ratio", 4).alias("ratio"),
                                                        F.round("cumulative", 4).alias("cumulative"))


@query("feat_pca_2d", "E17")
def feat_pca_2d(spark, sf_dir):
    """Rows projected on the first two principal components, with outcome and type."""
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from quarry.operators.features import standardize
    from quarry.plans.similarity import METRICS, merged
    # Joined once: the statistics, the fit and the projection read the written rows.
    rows = merged(Tables(spark, sf_dir)).select("l_orderkey", "outcome", "l_linestatus", *METRICS).checkpoint()
    vec = VectorAssembler(inputCols=METRICS, outputCol="features").transform(standardize(rows, METRICS))
    out = PCA(k=2, inputCol="features", outputCol="pcs").fit(vec).transform(vec)
    arr = vector_to_array("pcs")
    return out.select("l_orderkey", "outcome", "l_linestatus", F.round(arr[0], 4).alias("pc1"),
                      F.round(arr[1], 4).alias("pc2"))


@query("feat_svd", "E15")
def feat_svd(spark, sf_dir):
    """100-component truncated SVD of the document TF-IDF matrix (k capped
    at n_features - 1); reported as per-document projection norms."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from quarry.operators.ml import TruncatedSVD
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    stages = md.tfidf_stages(out="tfidf") + [TruncatedSVD(inputCol="tfidf", outputCol="lsa", k=100)]
    out = Pipeline(stages=stages).fit(d).transform(d)
    arr = vector_to_array("lsa")
    return out.select("doc_id", F.size(arr).alias("k"),
                      F.round(F.sqrt(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)), 6).alias("norm"))
