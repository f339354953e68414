"""Learners on sparse blocks and writable stages against dense numpy."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import learners as ln
from quarry.operators import models as md
from quarry.operators.blocks import sparse_blocks
from quarry.operators.ml import (MedianImputer, OrdinalEncoder, SelectChi2, SklearnTfidf, TargetEncoder, TruncatedSVD)


def sample(n=240, d=12, k=3, seed=1):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, d)) < 0.4, rng.normal(size=(n, d)), 0)
    y = np.argmax(x[:, :k] + 0.3 * rng.normal(size=(n, k)), axis=1)
    x[5] = 0
    return x, y


def vector(row, dense):
    at = np.flatnonzero(row)
    return Vectors.dense(row) if dense else Vectors.sparse(len(row), at.tolist(), row[at].tolist())


def table(spark, x, y, parts=3):
    rows = [(i, vector(r, i % 4 == 0), float(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(parts, "id")


def test_blocks_multiply_like_dense_arrays(spark):
    x, y = sample()
    blocks = sparse_blocks(table(spark, x, y), "features", ["label", F.col("id") * 2])
    m = np.arange(24.0).reshape(12, 2)

    def step(state, bs):
        total = np.zeros((13, 2))
        for b in bs:
            total[:12] += b.transposed_times(b.times(state, budget=64), 12, budget=64)
            total[12] += b.extra.sum(axis=0)
        return total
    got = blocks.fold(m, step, 26).reshape(13, 2)
    assert (blocks.n, blocks.width) == x.shape
    assert np.allclose(got[:12], x.T @ (x @ m)) and got[12].tolist() == [y.sum(), 239 * 240]
    assert ln.class_counts(blocks).tolist() == np.bincount(y).tolist()
    empty = sparse_blocks(table(spark, x, y).where("false"), "features", ["label"])
    assert empty.n == 0 and empty.fold(m, step, 26).tolist() == [0.0] * 26


def test_sums_in_levels_equal_one_sum(spark, monkeypatch):
    from quarry.operators import blocks as bl
    monkeypatch.setattr(bl, "FAN_IN", 2)
    monkeypatch.setattr(bl, "CHUNK", 5)
    x, y = sample()
    b = sparse_blocks(table(spark, x, y, 9), "features", ["label"])
    got = b.fold(None, lambda _, bs: sum((c.transposed_times(np.ones((len(c), 1)), 12) for c in bs), np.zeros((12, 1))), 12)
    assert np.allclose(got, x.sum(axis=0))


@pytest.mark.parametrize("loss, weighting, intercept", [("squared_hinge", "classes", True), ("log", "inside", True), ("squared", "rows", False)])
def test_linear_models_reach_the_minimum(spark, loss, weighting, intercept):
    x, y = sample()
    model = ln.LinearOvR(loss=loss, weighting=weighting, penalise_intercept=intercept, tol=1e-7).fit(table(spark, x, y))
    a, w, counts = np.c_[x, np.ones(len(x))], model.coefficients, np.bincount(y)
    penalty, n, k = np.r_[np.ones(12), float(intercept)], len(y), 3
    for c in range(k):
        sign = np.where(y == c, 1.0, -1.0)
        s = {"classes": np.where(y == c, n / (k * counts[c]), 1.0), "rows": n / (k * counts[y]),
             "inside": np.where(y == c, n / (2 * counts[c]), n / (2 * (n - counts[c])))}[weighting]
        value, slope = ln._LOSSES[loss]
        at = lambda v: (penalty * v * v).sum() / 2 + (s * value(sign * (a @ v))).sum()
        assert np.isclose(at(w[:, c]), model.losses[c])
        grad = penalty * w[:, c] + a.T @ (s * slope(sign * (a @ w[:, c])) * sign)
        assert np.abs(grad).max() < 1e-3
        if loss == "squared":
            best = np.linalg.solve(a.T @ (s[:, None] * a) + np.diag(penalty), a.T @ (s * sign))
            assert np.allclose(w[:, c], best, atol=1e-4)


def numpy_sgd(x, y, k, loss, alpha, epochs, aggressive):
    """One row, one class at a time."""
    n, counts = len(y), np.bincount(y)
    w, b, t0 = np.zeros((x.shape[1], k)), np.zeros(k), 1 / (alpha * alpha ** -0.25)
    for c in range(k):
        t = 1
        for _ in range(epochs):
            for row, label in zip(x, y):
                sign = 1.0 if label == c else -1.0
                s, m = (n / (k * counts[c]) if sign > 0 else 1.0), sign * (row @ w[:, c] + b[c])
                if aggressive:
                    move = s * sign * min(1.0, max(0, 1 - m) / (row @ row)) if row @ row > 0 else 0.0
                else:
                    eta = 1 / (alpha * (t0 + t - 1))
                    w[:, c] *= max(0.0, 1 - eta * alpha)
                    g = (-1.0 if m < 1 else 0.0) if loss == "hinge" else -1 / (1 + np.exp(m))
                    move = -eta * s * g * sign
                w[:, c] += move * row
                b[c] += ln.INTERCEPT_STEP * move
                t += 1
    return np.vstack([w, b])


@pytest.mark.parametrize("loss, aggressive", [("hinge", False), ("log", False), ("hinge", True)])
def test_sgd_equals_numpy_on_one_task(spark, loss, aggressive):
    x, y = sample(90)
    df = table(spark, x, y)
    blocks = sparse_blocks(df, "features", ["label"], rows_per_task=1000)
    order = [int(i) for i in np.concatenate([np.frombuffer(r[0], np.float64).reshape(r[1], -1)[:, 1] for r in sparse_blocks(
        df, "features", ["label", "id"], rows_per_task=1000).table.select("extra", "n").collect()])]
    assert sorted(order) == list(range(90))
    got = ln.SGDLinear(loss=loss, alpha=1e-3, maxIter=3, tol=-1e9, passive_aggressive=aggressive).fit_blocks(blocks)
    same = sparse_blocks(df.withColumn("other", F.lit(0.0)), "features", ["label", "id"], rows_per_task=1000)
    again = ln.SGDLinear(loss=loss, alpha=1e-3, maxIter=3, tol=-1e9, passive_aggressive=aggressive).fit_blocks(same)
    assert np.allclose(again.coefficients, numpy_sgd(x[order], y[order], 3, loss, 1e-3, 3, aggressive))
    assert got.coefficients.shape == (13, 3)


def test_averaged_sgd_has_nearly_the_loss_of_one_sgd(spark):
    x, y = sample(3000, seed=4)
    df = table(spark, x, y)
    rate = dict(loss="log", alpha=1e-4, maxIter=30, tol=-1e9)

    def loss(w):
        f = np.c_[x, np.ones(len(x))] @ w
        return np.logaddexp(0, -np.where(np.arange(3) == y[:, None], f, -f)).mean()
    one = ln.SGDLinear(**rate).fit_blocks(sparse_blocks(df, "features", ["label"], rows_per_task=5000))
    many = sparse_blocks(df, "features", ["label"], rows_per_task=700)
    assert many.table.rdd.getNumPartitions() > 3
    assert loss(ln.SGDLinear(**rate).fit_blocks(many).coefficients) < 1.01 * loss(one.coefficients)


def test_relu_net_learns_what_no_line_can(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (800, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = table(spark, x, y)
    model = ln.ReluNet(hidden=32, rate=2e-2, batch=50).fit(df)
    hit = model.transform(df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    linear = ln.LinearOvR().fit(df).transform(df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert hit > 0.93 > 0.7 > linear
    assert len(model.accuracy) <= 81 and max(model.accuracy) > 0.9


def test_majority_takes_the_smallest_of_ties(spark):
    rows = [([2.0, 1.0, 0.0], 0.0), ([2.0, 2.0, 0.0], 2.0), ([3.0, 1.0, 3.0], 3.0), ([5.0], 5.0), ([4.0, 1.0, 1.0, 4.0], 1.0)]
    got = spark.createDataFrame(rows, "votes array<double>, want double").withColumn("got", ln.majority(F.col("votes"))).collect()
    assert all(r["got"] == r["want"] for r in got)


def test_svd_has_numpys_singular_values(spark):
    x, y = sample()
    model = TruncatedSVD(inputCol="features", outputCol="out", k=4, oversample=8).fit(table(spark, x, y))
    assert np.allclose(model.singular_values, np.linalg.svd(x, compute_uv=False)[:4], rtol=1e-6)
    one = table(spark, x[:, :1], y)
    assert TruncatedSVD(inputCol="features", outputCol="out", k=4).fit(one).transform(one).where("out <> features").count() == 0


def test_chi2_selection(spark):
    x, y = sample()
    x = np.abs(x)
    obs = np.stack([x[y == c].sum(axis=0) for c in range(3)])
    exp = np.outer(np.bincount(y) / len(y), x.sum(axis=0))
    want = sorted(np.argsort(-((obs - exp) ** 2 / exp).sum(axis=0), kind="stable")[:5].tolist())
    assert SelectChi2(inputCol="features", outputCol="out", k=5).fit(table(spark, x, y)).getIndices() == want


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(6)
    words = {"a": ["red", "green", "blue", "paint"], "b": ["goal", "team", "ball", "score"], "c": ["bank", "rate", "loan", "green"]}
    rows = [(i, " ".join(rng.choice(words[c], 6)), c, float(i % 7) if i % 5 else None, ["x", "y"][i % 2])
            for i, c in enumerate(np.tile(list("aabc"), 60))]
    return spark.createDataFrame(rows, "doc_id long, text string, category string, num double, level string")


@pytest.mark.parametrize("name", ["voting_ensemble", "char_linear_svc", "ridge_classifier", "hashing_sgd_hinge"])
def test_saved_text_models_predict_the_same(spark, texts, tmp_path, name):
    model, pred, _ = md.fit_and_score(name, md.text_models()[name](), texts, texts)
    model.write().overwrite().save(f"file://{tmp_path}/m")
    back = PipelineModel.load(f"file://{tmp_path}/m")
    assert [type(s) for s in back.stages] == [type(s) for s in model.stages]
    a, b = (dict(m.transform(texts).select("doc_id", "prediction").collect()) for m in (model, back))
    assert a == b and pred.where("actual = predicted").count() > 200


def test_saved_encoders_transform_the_same(spark, texts, tmp_path):
    df = texts.withColumn("y", F.col("doc_id").cast("double"))
    model = Pipeline(stages=[MedianImputer(["num"]), OrdinalEncoder({"category": ["c", "a"]}), TargetEncoder(["level"], "y")]).fit(df)
    model.save(f"file://{tmp_path}/m")
    back = PipelineModel.load(f"file://{tmp_path}/m")
    assert sorted(model.transform(df).collect()) == sorted(back.transform(df).collect())


def test_saved_vectors_and_net_transform_the_same(spark, tmp_path):
    x, y = sample()
    df = table(spark, np.abs(x), y)
    model = Pipeline(stages=[SklearnTfidf(inputCol="features", outputCol="t"), TruncatedSVD(inputCol="t", outputCol="s", k=5),
                             ln.ReluNet(featuresCol="s", maxIter=3)]).fit(df)
    model.save(f"file://{tmp_path}/m")
    back = PipelineModel.load(f"file://{tmp_path}/m")
    assert sorted(model.transform(df).select("id", "s", "prediction").collect()) == sorted(back.transform(df).select("id", "s", "prediction").collect())
    assert np.allclose(back.stages[1].singular_values, model.stages[1].singular_values)


def test_grid_goes_on_where_it_stopped(spark, texts, tmp_path, monkeypatch):
    assert len(md.grid_cells()) == 22
    cells = [("bow", "chi2_k5", "sgd_hinge"), ("bow", "svd_2", "mlp"), ("tfidf", "svd_2", "logistic_regression"), ("tfidf", "svd_2", "linear_svc")]
    train, test = texts.where("doc_id % 5 <> 0"), texts.where("doc_id % 5 = 0")
    path, fitted = f"file://{tmp_path}/rows", []
    was = md.grid_stages
    monkeypatch.setattr(md, "grid_stages", lambda kind, name, seed=42: (fitted.append((kind, name)), was(kind, name, seed))[1])
    first = md.grid_run(train, test, cells, limit=2, progress_path=path).collect()
    assert len(first) == 2 and {n for k, n in fitted if k == "feature"} == {"bow"}
    fitted.clear()
    rows = md.grid_run(train, test, cells, progress_path=path, model_path=f"file://{tmp_path}/best").collect()
    assert [r["status"] for r in rows] == ["ok"] * 4
    assert ("feature", "tfidf") in fitted and ("model", "logistic_regression") in fitted
    assert sorted(r["macro_f1"] for r in rows)[::-1] == [r["macro_f1"] for r in rows]
    kept = {r["run"]: r["macro_f1"] for r in first}
    assert all(r["macro_f1"] == kept.get(r["run"], r["macro_f1"]) for r in rows)
    best = PipelineModel.load(f"file://{tmp_path}/best").transform(test)
    hit = best.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert abs(hit - rows[0]["accuracy"]) < 1e-3
    fitted.clear()
    md.grid_run(train, test, cells, progress_path=path).collect()
    assert not fitted


def test_grid_keeps_failed_cells_as_rows(spark, texts):
    rows = md.grid_run(texts, texts, [("bow", "svd_2", "no_such_model"), ("bow", "svd_2", "sgd_hinge")]).collect()
    assert [r["status"] for r in rows] == ["ok", "failed"] and "no_such_model" in rows[1]["error"]


def test_model_set_with_a_failed_model_is_no_result(spark, texts):
    def broken():
        raise ValueError("no such stage")
    models = {"broken": broken, "sgd_hinge": md.text_models()["sgd_hinge"]}
    with pytest.raises(RuntimeError, match="(?s)1 of 2 models failed: broken.*no such stage"):
        md.model_set_run(texts, texts, models, parallelism=1)
    metrics, fitted = md.model_set_run(texts, texts, {"sgd_hinge": models["sgd_hinge"]})
    assert [r["status"] for r in metrics.collect()] == ["ok"] and list(fitted) == ["sgd_hinge"]


def test_documents_without_text_are_classified(spark, texts, tmp_path):
    from quarry.plans.models_plan import text_split
    from quarry.sources.tables import Tables
    docs = texts.select("doc_id", F.when(F.col("doc_id") % 11 > 0, F.col("text")).alias("text"), F.col("category").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    with text_split(Tables(spark, str(tmp_path))) as (train, test):
        out, _ = md.model_set_run(train, test, {"sgd_hinge": md.text_models()["sgd_hinge"]})
        row = out.first()
        assert row["n"] == test.count() and row["accuracy"] > 0.8


def test_models_of_a_set_share_their_feature_steps(spark, texts, monkeypatch):
    from quarry.operators import ml
    fits, was = [], ml.VocabularyVectorizer._fit
    monkeypatch.setattr(ml.VocabularyVectorizer, "_fit", lambda self, df: (fits.append(self.kind), was(self, df))[1])
    train, test = texts.where("doc_id % 5 <> 0"), texts.where("doc_id % 5 = 0")
    names = ["complement_nb", "sgd_hinge", "char_linear_svc", "voting_ensemble"]
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    out, fitted = md.model_set_run(train, test, {n: md.text_models()[n] for n in names})
    assert sorted(fits) == ["bigrams", "chars"]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    rows = {r["model"]: r for r in out.collect()}
    assert list(rows) == names and rows["char_linear_svc"]["macro_f1"] > 0.9
    for n in names:
        model, alone, _ = md.fit_and_score(n, md.text_models()[n](), train, test)
        both = [sorted(m.transform(test).select("doc_id", "prediction").collect()) for m in (model, fitted[n])]
        assert both[0] == both[1]
        hit = alone.agg(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).first()[0]
        assert abs(hit - rows[n]["accuracy"]) < 1e-3
    same, other = (md.SharedFeatures._key(md.tfidf_stages(vocab=v)) for v in (10, 11))
    assert same == md.SharedFeatures._key(md.tfidf_stages(vocab=10)) != other


def test_top_class_terms_of_coefficients_and_log_probabilities(spark, texts):
    for name in ("linear_svc", "complement_nb"):
        model, _, _ = md.fit_and_score(name, md.text_models()[name](), texts, texts)
        top = md.top_class_terms(model, 2)
        assert [c for c, _, _ in top] == ["a", "a", "b", "b", "c", "c"]
        if name == "linear_svc":
            assert set(t for c, t, _ in top if c == "b") <= {"goal", "team", "ball", "score"}


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_tree_attributions_sum_to_the_prediction(spark, kind):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import RandomForestRegressor
    from quarry.operators import attribution as at
    x, y = sample(d=5)
    df = table(spark, x, y)
    est = RandomForestClassifier if kind == "classifier" else RandomForestRegressor
    model = est(numTrees=6, maxDepth=4, seed=3).fit(df)
    out = model.transform(df).orderBy("id")
    got = out.select(vector_to_array("probability")) if kind == "classifier" else out.select(F.array("prediction"))
    pred = np.array([r[0] for r in got.collect()])
    leaves = at.forest_leaves(model)
    phi = at.attributions(leaves, x)
    assert np.allclose(phi.sum(axis=1) + at.base_value(leaves), pred)
    assert np.allclose(at.mean_absolute(model, df), np.abs(phi).mean(axis=(0, 2)))


def test_tree_attributions_are_shapley_values():
    from itertools import combinations
    from math import factorial
    from quarry.operators import attribution as at
    leaves = [at._leaf(p, np.array([v])) for p, v in [
        ([(0, -np.inf, 0.5, 0.3), (1, -np.inf, 0.0, 0.4)], 5.0), ([(0, -np.inf, 0.5, 0.3), (1, 0.0, np.inf, 0.6)], -2.0),
        ([(0, 0.5, np.inf, 0.7), (2, -np.inf, 1.0, 0.2)], 1.0),
        ([(0, 0.5, np.inf, 0.7), (2, 1.0, np.inf, 0.8), (0, -np.inf, 2.0, 0.5)], 7.0),
        ([(0, 0.5, np.inf, 0.7), (2, 1.0, np.inf, 0.8), (0, 2.0, np.inf, 0.5)], 3.0)]]
    x = np.array([[0.0, 1.0, 2.0], [1.0, -1.0, 2.0], [3.0, 0.0, 0.0]])

    def pays(row, known):
        return sum(leaf.value[0] * np.prod([float(lo < row[f] <= hi) if f in known else r for f, lo, hi, r in
                                            zip(leaf.features, leaf.low, leaf.high, leaf.share)]) for leaf in leaves)
    want = [[sum(factorial(len(s)) * factorial(2 - len(s)) / 6 * (pays(row, {*s, j}) - pays(row, set(s)))
                 for n in range(3) for s in combinations([i for i in range(3) if i != j], n)) for j in range(3)] for row in x]
    assert np.allclose(at.attributions(leaves, x)[:, :, 0], want)


def test_kernel_density_of_groups(spark):
    from quarry.operators.dist import kde
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.normal(size=50).round(1)] + [("b", float(v)) for v in rng.normal(3, 2, 40).round(0)]
    rows += [("c", 1.0), ("d", None), ("e", 2.0), ("e", 2.0)]  # no spread, no curve
    df = spark.createDataFrame(rows, "g string, v double")
    got = kde(df, "v", grid=9, group="g").collect()
    assert {r["g"] for r in got} == {"a", "b"} and len(got) == 18
    for g in "ab":
        v = np.array([x for k, x in rows if k == g])
        h = v.std(ddof=1) * len(v) ** -0.2
        xs = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 9)
        want = np.exp(-0.5 * ((xs[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        mine = sorted((r["point"], r["x"], r["density"]) for r in got if r["g"] == g)
        assert np.allclose([m[1] for m in mine], xs, atol=1e-5) and np.allclose([m[2] for m in mine], want, atol=1e-5)
    assert kde(df.where("false"), "v", grid=9).count() == 0


def test_classifier_defaults_of_both_stages():
    assert set(md.CLASSIFIERS) == {"lightgbm", "xgboost", "catboost", "decision_tree", "random_forest", "svm"}
    assert [md.build_classifier("decision_tree", stage=s).getMaxDepth() for s in (1, 2)] == [10, 15]
    for name in md.BOOSTED:
        late = md.build_classifier(name, stage=2)
        assert (late.getMaxIter(), late.getStepSize(), late.getMaxDepth()) == (200, 0.05, 5)
        assert md.build_classifier(name).getMaxIter() == 100


def test_dominant_colours_are_those_of_the_best_start():
    from quarry.operators import images as im
    rng = np.random.RandomState(1)
    blocks = np.array([[250, 10, 10], [10, 250, 10], [10, 10, 250], [240, 240, 20]], float)
    img = blocks[rng.choice(4, (64, 64), p=[0.5, 0.3, 0.15, 0.05])] + rng.normal(0, 2, (64, 64, 3))
    px = im.resize_bilinear(img, 64, 64)[:, :, ::-1].reshape(-1, 3)

    def inertia(colours):
        return ((px[:, None] - np.array(colours, float)) ** 2).sum(-1).min(axis=1).sum()
    many, one = im.dominant_colors(img, 4), im.dominant_colors(img, 4, starts=1)
    assert inertia(many) <= inertia(one) * 1.001
    assert np.abs(np.array(many) - blocks[:, ::-1]).max() < 4  # RGB, largest cluster first


@pytest.mark.parametrize("kind", ["bigrams", "chars"])
def test_vectors_of_words_are_those_of_their_terms(spark, kind):
    """Pairs and n-grams made beside the counting give the vectors of the written-out
    terms, words that hold blanks and rows without words too, after saving as well."""
    from quarry.functions.text import with_bigrams, word_char_ngrams
    from quarry.operators.ml import TermVectors, VocabularyVectorizer
    words = [["a b", "c", "a"], ["a", "b c", "c", "a"], ["abc", "abcdef", "abc", "c", "a"], [], ["c", "a", "c", "a"]]
    df = spark.createDataFrame(list(enumerate(words)), "doc int, words array<string>")
    grams = with_bigrams(F.col("words")) if kind == "bigrams" else F.flatten(F.transform("words", lambda w: word_char_ngrams(w)))
    for rows, tfidf in ((df, False), (df, True), (df.where("doc > 1"), True)):
        made = VocabularyVectorizer("words", "v", 1, 1.0, 100, tfidf, kind=kind).fit(rows)
        told = rows.withColumn("grams", grams)
        want = VocabularyVectorizer("grams", "v", 1, 1.0, 100, tfidf).fit(told)
        assert made.models[0].vocabulary == want.models[0].vocabulary
        got, expected = ({r["doc"]: r["v"] for r in x.collect()} for x in (made.transform(rows), want.transform(told)))
        assert got == expected
        again = TermVectors._from_parts(made.models[0]._parts())
        assert {r["doc"]: r["v"] for r in again.transform(rows).collect()} == expected


def test_products_of_few_columns(monkeypatch):
    """Runs of non-zeros, empty rows and a row longer than a run give the plain products."""
    from quarry.operators import blocks
    monkeypatch.setattr(blocks, "RUN", 3)
    rng = np.random.RandomState(0)
    size = np.array([0, 2, 7, 0, 1, 3, 0])
    at = np.r_[0, np.cumsum(size)]
    index = np.concatenate([np.sort(rng.choice(4 if n < 5 else 9, n, replace=False)) for n in size]).astype(np.int32)
    block = blocks.Block(at, index, rng.rand(len(index)), np.zeros((len(size), 0)))
    dense = np.zeros((len(size), 9))
    dense[block.rows(), index] = block.data
    m, y = rng.rand(9, 3), rng.rand(len(size), 3)
    assert np.allclose(block.times(m), dense @ m) and np.allclose(block.transposed_times(y, 9), dense.T @ y)


def test_text_rows_of_one_row_group_go_over_the_cluster(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from quarry.operators.blocks import spread
    from quarry.plans.models_plan import text_split
    from quarry.sources.tables import Tables
    ids = [None, 7, 7, *range(10, 207)]
    rows = {"doc_id": pa.array(ids, pa.int64()), "text": [f"text {i}" for i in ids], "lang": ["a" if (i or 0) % 2 else "b" for i in ids]}
    pq.write_table(pa.table(rows), tmp_path / "documents.parquet")
    with text_split(Tables(spark, str(tmp_path))) as (train, test):
        tasks = train.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 80
        assert train.count() + test.count() == 200 and train.where("doc_id = 7").count() in (0, 2)
    even = spark.range(0, 1000, 1, 2 * spark.sparkContext.defaultParallelism)
    assert spread(even) is even and spread(even.limit(0)).count() == 0
    assert sorted(r["id"] for r in spread(even.coalesce(1)).collect()) == list(range(1000))


@pytest.mark.parametrize("kind", ["", "bigrams", "chars"])
def test_batches_are_counted_in_pieces(spark, texts, monkeypatch, kind):
    from quarry.operators import text as tx
    import pyarrow as pa
    lists = pa.array([["a"] * 5, None, [], ["b", "c"], ["d"] * 9, ["e"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([lists], names=["w"])
    cut = list(tx.pieces(batch.slice(1), "w", 4))
    assert [p.num_rows for p in cut] == [3, 1, 1] and pa.Table.from_batches(cut).to_pylist() == batch.slice(1).to_pylist()
    assert [p.num_rows for p in tx.pieces(batch.slice(0, 0), "w", 4)] == [0]
    df = texts.select("doc_id", "category", F.split("text", " ").alias("w")).coalesce(1)
    whole = sorted(tx.row_statistics(df, F.col("w"), ["category"], kind).collect())
    sizes, was = [], tx._row_counts

    def counted(lists, kind):
        sizes.append(len(lists.flatten()))
        return was(lists, kind)
    batch = pa.Table.from_pandas(df.toPandas()).to_batches()[0]
    held = []

    class Table:   # gives the task's function instead of running it
        schema = df.schema

        def select(self, *_):
            return self

        def mapInArrow(self, f, _):
            held.append(f)
            raise StopIteration
    monkeypatch.setattr(tx, "_row_counts", counted)
    monkeypatch.setattr(tx, "_WORDS", 60)
    with pytest.raises(StopIteration):
        tx.row_statistics(Table(), F.col("w"), ["category"], kind)
    got = {}
    for b in held[0](iter([batch.rename_columns(["doc_id", "category", "_terms"])])):
        for r in b.to_pylist():
            n = got.setdefault((r["category"], r["term"]), [0, 0])
            n[0], n[1] = n[0] + r["df"], n[1] + r["cnt"]
    assert max(sizes) <= 60 and sorted((*k, *v) for k, v in got.items()) == [tuple(r) for r in whole]


def test_sums_leave_no_shuffle_files_and_few_partial_arrays(spark, monkeypatch):
    import time
    from quarry.operators import blocks as bl
    monkeypatch.setattr(bl, "FAN_IN", 2)
    x, y = sample()
    b = sparse_blocks(table(spark, x, y, 9), "features", ["label"])
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f.getName() for f in (lambda all_: [all_.apply(i) for i in range(all_.size())])(disk.getAllFiles()) if "shuffle" in f.getName()}

    def step(_, bs):
        total, at_all = np.zeros((13, 1)), False
        for c in bs:
            at_all = True
            c.transposed_times(np.ones((len(c), 1)), 12, out=total[:12])
        total[12] = at_all
        return total
    before = files()
    got = b.fold(None, step, 13, sums=True)
    assert np.allclose(got[:12], x.sum(axis=0)) and got[12] <= max(2, spark.sparkContext.defaultParallelism) < b.tasks
    assert b.fold(None, step, 13)[12] == b.tasks
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    b.release()


def test_blocks_of_full_rows_hold_no_indices(spark):
    x = np.random.default_rng(3).normal(size=(30, 4))
    rows = spark.createDataFrame([(vector(r, i % 2 == 0), float(i)) for i, r in enumerate(x)], ["features", "label"])
    held = rows.persist()
    b = sparse_blocks(held, "features", ["label"], rows_per_task=10)
    assert b.n == 30 and {len(r["indices"]) for r in b.table.where("n > 0").collect()} == {0}

    def step(_, bs):
        total = np.zeros((4, 1))
        for c in bs:
            assert c.indices.tolist() == list(range(4)) * len(c)
            total += c.transposed_times(c.extra, 4)
        return total
    assert np.allclose(b.fold(None, step, 4), x.T @ np.arange(30.0))
    assert sparse_blocks(rows, "features", ["label"], rows_per_task=10, n=30).n == 30


def test_sliced_features_are_those_of_mllib(spark, tmp_path):
    from pyspark.ml.feature import VectorSlicer
    from quarry.operators.ml import CompactFeatures, SliceFeatures
    x, y = sample()
    x[:, [2, 7]] = 0
    df = table(spark, x, y)
    model = CompactFeatures(inputCol="features", outputCol="out").fit(df)
    assert isinstance(model, SliceFeatures) and model.getIndices() == [i for i in range(12) if i not in (2, 7)]
    model.save(f"file://{tmp_path}/m")
    model = SliceFeatures.load(f"file://{tmp_path}/m")
    want = VectorSlicer(inputCol="features", outputCol="want", indices=model.getIndices())
    for r in want.transform(model.transform(df)).collect():
        assert r["out"].size == 10 and (r["out"].toArray() == r["want"].toArray()).all()
    few = SliceFeatures("features", "out", np.array([0, 3])).transform(df).collect()
    assert all((r["out"].toArray() == r["features"].toArray()[[0, 3]]).all() for r in few)
    none = CompactFeatures(inputCol="features", outputCol="out").fit(df.where("false"))
    assert none.getIndices() == [0] and none.transform(df).first()["out"].size == 1
