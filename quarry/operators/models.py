"""Model sets, grids and model-based reports (SURVEY M1-M18, E8-E18,
Q9, Q10, Q13-Q15).

Fits are MLlib jobs; the driver only orchestrates (a small thread pool
launches independent fits concurrently) and keeps model parameters, whose
size is bounded by features × classes.  Predictions stay DataFrames and
every metric is computed by the distributed evaluation operators.
"""

from __future__ import annotations

import threading
import time
import traceback
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import (HashingTF, IndexToString, NGram, RegexTokenizer,
                                SQLTransformer, StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.param import Param
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import WORD_TOKEN, english_stopwords
from quarry.operators import evaluate as ev
from quarry.operators.blocks import ROWS_PER_PASS, compact, sparse_blocks
from quarry.operators.learners import ROWS_PER_TASK, LinearOvR, ReluNet, SGDLinear, Voting
from quarry.operators.ml import DropColumns, SelectChi2, SklearnTfidf, TruncatedSVD, class_probabilities
from quarry.operators.rank import attach


# ---------------------------------------------------------------------------
# Text features
# ---------------------------------------------------------------------------
def label_indexer(label: str = "category", out: str = "label") -> StringIndexer:
    """Sorted label → index (alphabetical, as a label encoder)."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="keep")


def word_stages(text: str = "text", out: str = "words") -> list:
    """Unicode word tokens (≥ 2 chars), English stop words removed."""
    return [RegexTokenizer(inputCol=text, outputCol="_tok", pattern=WORD_TOKEN, gaps=False, toLowercase=True),
            StopWordsRemover(inputCol="_tok", outputCol=out, stopWords=english_stopwords())]


def word_ngram_stages(text: str = "text", out: str = "grams") -> list:
    """The words of ``word_stages``, then unigrams + adjacent bigrams."""
    return word_stages(text, "_tok_ns") + [
        NGram(n=2, inputCol="_tok_ns", outputCol="_bi"),
        SQLTransformer(statement=f"SELECT *, concat(_tok_ns, _bi) AS {out} FROM __THIS__"),
    ]


_INTERMEDIATE = ["_tok", "_tok_ns", "_bi", "grams", "words", "text"]


def count_vectorizer(df: DataFrame, grams: str, out: str, min_df: int, max_df: float, vocab: int, text: str = "text"):
    """MLlib's vectoriser (a built-in, writable stage) with the vocabulary that
    ``bow_stages`` chooses.  MLlib's own fit sums the terms in as many tasks as
    the input has; here the sums are an aggregate over the shuffle partitions."""
    from pyspark.ml.feature import CountVectorizerModel
    fitted = Pipeline(stages=bow_stages(text, "_v", min_df, max_df, vocab)).fit(df)
    return CountVectorizerModel.from_vocabulary(fitted.stages[-1].models[0].vocabulary, inputCol=grams, outputCol=out)


def bow_stages(text: str = "text", out: str = "tf", min_df: int = 5, max_df: float = 0.95, vocab: int = 50000) -> list:
    """Bag of words and bigrams with document-frequency limits and a vocabulary cap."""
    from quarry.operators.ml import VocabularyVectorizer
    return word_stages(text) + [VocabularyVectorizer(inputCol="words", outputCol=out, min_df=min_df, max_df=max_df, vocab_size=vocab,
                                                     tfidf=False, drop_cols=_INTERMEDIATE, kind="bigrams")]


def tfidf_stages(text: str = "text", out: str = "features", analyzer: str = "word", sublinear: bool = True,
                 min_df: int = 5, max_df: float = 0.95, vocab: int = 50000) -> list:
    """Sklearn-style TF-IDF (smooth idf, sublinear tf, L2) of words and
    bigrams, or of char_wb 3-5-grams."""
    from quarry.operators.ml import TextWords, VocabularyVectorizer
    words = word_stages(text) if analyzer == "word" else [TextWords(text)]
    return words + [VocabularyVectorizer(inputCol="words", outputCol=out, min_df=min_df, max_df=max_df,
                                         vocab_size=vocab, tfidf=True, sublinear=sublinear, drop_cols=_INTERMEDIATE,
                                         kind="bigrams" if analyzer == "word" else "chars")]


def hashing_tfidf_stages(text: str = "text", out: str = "features", num_features: int = 2 ** 20) -> list:
    """Hashed 1-2-grams (no sign flip), then sublinear smooth TF-IDF."""
    from quarry.operators.ml import CompactFeatures
    return word_ngram_stages(text) + [HashingTF(inputCol="grams", outputCol="_htf", numFeatures=num_features),
                                      DropColumns(_INTERMEDIATE),
                                      SklearnTfidf(inputCol="_htf", outputCol="_htfidf", sublinear=True),
                                      CompactFeatures(inputCol="_htfidf", outputCol=out),
                                      DropColumns(["_htf", "_htfidf"])]


# ---------------------------------------------------------------------------
# Text model set
# ---------------------------------------------------------------------------
def logistic(features: str = "features") -> LinearOvR:
    """M6: balanced inside each one-vs-rest problem, 300 steps."""
    return LinearOvR(featuresCol=features, loss="log", weighting="inside", maxIter=300, tol=1e-4)


def linear_svc(features: str = "features") -> LinearOvR:
    """M7: squared hinge, own rows of a class weighted, 1000 steps."""
    return LinearOvR(featuresCol=features, loss="squared_hinge", weighting="classes", maxIter=1000, tol=1e-4)


def complement_nb(features: str = "features") -> NaiveBayes:
    return NaiveBayes(featuresCol=features, modelType="complement", smoothing=0.15)


def voting(features: str = "features") -> Voting:
    """Logistic, SVC and complement naive Bayes on one feature table."""
    return Voting({"lr": logistic(features), "svm": linear_svc(features), "nb": complement_nb(features)})


def boosted(seed: int = 42) -> OneVsRest:
    return OneVsRest(classifier=GBTClassifier(maxIter=160, maxDepth=4, stepSize=0.08, subsamplingRate=0.9,
                                              featureSubsetStrategy="0.9", seed=seed), parallelism=4)


def text_models(seed: int = 42) -> dict[str, Callable[[], list]]:
    """name → factory of the pipeline stages after the label indexer (M18: all twelve)."""
    return {
        "multinomial_nb": lambda: tfidf_stages() + [NaiveBayes(modelType="multinomial", smoothing=0.15)],
        "complement_nb": lambda: tfidf_stages() + [complement_nb()],
        "logistic_regression": lambda: tfidf_stages() + [logistic()],
        "linear_svc": lambda: tfidf_stages() + [linear_svc()],
        "passive_aggressive": lambda: tfidf_stages() + [SGDLinear(loss="hinge", passive_aggressive=True, maxIter=50)],
        "ridge_classifier": lambda: tfidf_stages() + [
            LinearOvR(loss="squared", weighting="rows", penalise_intercept=False, maxIter=100)],
        "char_linear_svc": lambda: tfidf_stages(analyzer="char") + [linear_svc()],
        "sgd_log_loss": lambda: tfidf_stages() + [SGDLinear(loss="log", alpha=1e-5, maxIter=30)],
        "sgd_hinge": lambda: tfidf_stages() + [SGDLinear(loss="hinge", alpha=1e-5, maxIter=30)],
        "hashing_sgd_hinge": lambda: hashing_tfidf_stages() + [SGDLinear(loss="hinge", alpha=1e-5, maxIter=30)],
        "voting_ensemble": lambda: tfidf_stages() + [voting()],
        "boosted_lsa": lambda: tfidf_stages(out="_tfidf") + [
            TruncatedSVD(inputCol="_tfidf", outputCol="features", k=300), DropColumns(["_tfidf"]), boosted(seed)],
    }


def fit_persisted(stages: list, train: DataFrame) -> PipelineModel:
    """Fit a pipeline whose last stage is an iterative learner: the feature
    stages are fitted first and their output is persisted (memory, spilling
    to disk; recomputable from lineage if an executor is lost) so that the
    learner's passes do not recompute tokenisation and weighting."""
    feats = Pipeline(stages=stages[:-1]).fit(train)
    data = compact(feats.transform(train))
    try:
        last = stages[-1].fit(data)
    finally:
        data.unpersist()
    return PipelineModel(stages=list(feats.stages) + [last])


def _description(stage) -> str:
    """What a stage does; stages of equal descriptions do the same.  One with
    attributes that are not plain values is like no other."""
    own = {k: v for k, v in vars(stage).items() if not k.startswith("_") and k != "uid" and not isinstance(v, Param)}
    plain = all(isinstance(x, (str, int, float, bool, type(None))) for v in own.values() for x in (v if isinstance(v, (list, tuple)) else [v]))
    given = sorted((p.name, str(v)) for p, v in stage.extractParamMap().items())
    return f"{type(stage).__name__} {given} {sorted(own.items()) if plain else id(stage)}"


class SharedFeatures:
    """The feature steps of a model set on one split: models of equal steps
    share one fit and its persisted vectors, which go when the last of
    the ``uses`` of these steps has ended."""

    def __init__(self, train: DataFrame, test: DataFrame, uses: Sequence[list] = ()):
        self.train, self.test, self.made, self.lock = train, test, {}, threading.Lock()
        self.left = Counter(self._key(stages) for stages in uses)

    @staticmethod
    def _key(stages: list) -> str:
        return "; ".join(map(_description, stages))

    @contextmanager
    def of(self, stages: list):
        """The fitted steps, the vectors of both parts and the seconds of the fit."""
        key = self._key(stages)
        with self.lock:
            one = self.made.setdefault(key, {"lock": threading.Lock()})
        try:
            with one["lock"]:
                if "test" not in one:
                    t0 = time.perf_counter()
                    one["feats"] = Pipeline(stages=stages).fit(self.train)
                    one["train"] = compact(one["feats"].transform(self.train))
                    one["secs"] = time.perf_counter() - t0
                    test = one["feats"].transform(self.test)
                    one["test"] = test.persist(StorageLevel.MEMORY_AND_DISK) if self.left[key] > 1 else test
            yield one["feats"], one["train"], one["test"], one["secs"]
        finally:
            with self.lock:
                self.left[key] -= 1
                if self.left[key] <= 0:
                    for part in ("train", "test"):
                        if part in one and one[part].is_cached:
                            one[part].unpersist()
                    self.made.pop(key, None)


def fit_and_score(name: str, stages: list, train: DataFrame, test: DataFrame,
                  label: str = "category", shared: SharedFeatures | None = None) -> tuple[PipelineModel, DataFrame, float]:
    """Fit one named model (label indexer + stages) and score the test set;
    returns (model, predictions with ``actual``/``predicted`` strings, seconds
    of the whole fit, shared steps included)."""
    shared = shared or SharedFeatures(train, test)
    with shared.of([label_indexer(label), *stages[:-1]]) as (feats, data, rest, secs):
        t0 = time.perf_counter()
        last = stages[-1].fit(data)
        secs = round(secs + time.perf_counter() - t0, 2)
        back = IndexToString(inputCol="prediction", outputCol="predicted", labels=feats.stages[0].labels)
        scored = back.transform(last.transform(rest))
        pred = scored.select(F.lit(name).alias("model"), F.col(label).alias("actual"), "predicted",
                             *[c for c in ("doc_id",) if c in scored.columns])
        # Reports read the predictions several times; a reliable checkpoint in
        # the shared folder keeps them from re-running the model each time.
        pred = pred.checkpoint()
    return PipelineModel(stages=[*feats.stages, last]), pred, secs


def model_set_run(train: DataFrame, test: DataFrame, models: Mapping[str, Callable[[], list]],
                  label: str = "category", parallelism: int = 2, model_path: str | None = None) -> tuple[DataFrame, dict]:
    """Fit and score every named model on one split; independent fits
    run concurrently from a small driver thread pool, models of the same
    feature steps on one fit of these.  All models are tried; if
    any failed, an error that names them is raised, so that a set without some
    of its models never passes for the whole.  With ``model_path`` the best
    model by (macro-F1, weighted-F1) is saved there (S10).  Returns (metrics
    DataFrame, fitted models)."""
    results, fitted, failed, uses = [], {}, {}, []
    for name, factory in models.items():
        try:
            uses.append([label_indexer(label), *factory()[:-1]])
        except Exception:  # noqa: BLE001 - fails again, and is told, in its turn
            pass
    shared = SharedFeatures(train, test, uses)

    def one(item):
        name, factory = item
        try:
            model, pred, secs = fit_and_score(name, factory(), train, test, label, shared)
            m = ev.classification_metrics(pred, "actual", "predicted", "model")
            return name, model, m.withColumn("train_seconds", F.lit(secs)).withColumn("status", F.lit("ok")), None
        except Exception:  # noqa: BLE001 - raised when the others have been tried
            return name, None, None, traceback.format_exc()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for name, model, m, err in pool.map(one, models.items()):
            if err is None:
                fitted[name] = model
                results.append(m)
            else:
                failed[name] = err
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(models)} models failed: " + "\n".join(f"{n}: {e}" for n, e in failed.items()))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    if model_path and fitted:
        from quarry.sources.sinks import save_model
        best = out.orderBy(F.desc("macro_f1"), F.desc("weighted_f1"), "model").first()["model"]
        save_model(fitted[best], model_path)
    return out, fitted


def top_class_terms(model: PipelineModel, k: int = 12) -> list[tuple[str, str, float]]:
    """Q10: ``(class, term, weight)`` of the k heaviest terms of every class of
    a fitted vocabulary model: coefficients of a linear model, log
    probabilities of naive Bayes.  Model parameters only; no row is read."""
    import numpy as np
    inner = [m for st in model.stages for m in getattr(st, "models", [st])]
    vocab = np.array(next(s for s in inner if hasattr(s, "vocabulary")).vocabulary)
    last = model.stages[-1]
    weights = last.coefficients[:-1] if hasattr(last, "coefficients") else last.theta.toArray().T
    out = []
    for c, name in enumerate(model.stages[0].labels[:weights.shape[1]]):
        order = np.lexsort((vocab, -weights[:, c]))[:k]
        out += [(name, str(vocab[j]), float(weights[j, c])) for j in order]
    return out


# ---------------------------------------------------------------------------
# Grid (M17): feature × reducer × model, shared stages fitted once per level
# ---------------------------------------------------------------------------
_GRID_SCHEMA = ("run string, feature string, reducer string, model string, accuracy double, macro_f1 double, "
                "weighted_f1 double, macro_precision double, macro_recall double, feature_seconds double, "
                "reduction_seconds double, train_seconds double, status string, error string")
_METRICS = ["accuracy", "macro_f1", "weighted_f1", "macro_precision", "macro_recall"]
GRID_FEATURES, GRID_REDUCERS = ["bow", "tfidf"], ["chi2_k20000", "svd_100", "svd_300"]
GRID_MODELS, GRID_DENSE_MODELS = ["logistic_regression", "linear_svc", "sgd_hinge"], ["mlp"]


def grid_cells(features=GRID_FEATURES, reducers=GRID_REDUCERS, models=GRID_MODELS, dense_models=GRID_DENSE_MODELS) -> list[tuple]:
    """(feature, reducer, model); the dense models run on SVD features only."""
    return [(f, r, m) for f in features for r in reducers
            for m in [*models, *(dense_models if r.startswith("svd_") else [])]]


def grid_stages(kind: str, name: str, seed: int = 42) -> list:
    """The pipeline stages behind a name of the grid."""
    if kind == "feature":
        return tfidf_stages(out="_f") if name == "tfidf" else bow_stages(out="_f")
    if kind == "reducer":
        k = int(name.split("_")[1].lstrip("k"))
        return [SelectChi2(inputCol="_f", outputCol="_r", k=k) if name.startswith("chi2") else
                TruncatedSVD(inputCol="_f", outputCol="_r", k=k, seed=seed)]
    return {"logistic_regression": lambda: [logistic("_r")], "linear_svc": lambda: [linear_svc("_r")],
            "sgd_hinge": lambda: [SGDLinear(featuresCol="_r", loss="hinge", alpha=1e-5, maxIter=30)],
            "mlp": lambda: [ReluNet(featuresCol="_r", seed=seed)]}[name]()


def grid_run(train: DataFrame, test: DataFrame, cells: Sequence[tuple] | None = None, label: str = "category",
             limit: int | None = None, seed: int = 42, progress_path: str | None = None, model_path: str | None = None,
             parallelism: int = 2) -> DataFrame:
    """Run the grid cells and return their rows, best (macro-F1, weighted-F1)
    first.

    A feature step is fitted once and its vectors persisted for all its
    reducers; a reducer is fitted once and its rows persisted, as blocks for
    the learners, for all its models; ``parallelism`` models are fitted at a
    time.  Errors become rows.  With ``progress_path`` every finished row is
    appended there at once (S9), and a run that finds rows there goes on with
    the cells that have none, fitting only the steps they need.  With
    ``model_path`` the whole best pipeline is fitted again on the training
    rows and saved (S10)."""
    from quarry.sources.sinks import append_rows, save_model
    spark = train.sparkSession
    cells = list(cells or grid_cells())[:limit]
    names = [c.split()[0] for c in _GRID_SCHEMA.split(", ")]
    rows = _finished(spark, progress_path, cells)
    lock = threading.Lock()

    def finish(cell, secs, metrics=None, error=None):
        row = (f"{cell[0]}__{cell[1]}__{cell[2]}", *cell, *[metrics[m] if metrics else None for m in _METRICS], *secs,
               "failed" if error else "ok", error)
        with lock:
            rows[cell] = dict(zip(names, row))
            if progress_path:
                append_rows(spark.createDataFrame([row], _GRID_SCHEMA), progress_path)

    indexer = label_indexer(label).fit(train)
    for feature in dict.fromkeys(f for f, _, _ in cells):
        left = [c for c in cells if c[0] == feature and c not in rows]
        if not left:
            continue
        t0 = time.perf_counter()
        vectors = Pipeline(stages=grid_stages("feature", feature)).fit(train)
        tr, te = (indexer.transform(vectors.transform(d)).select("label", "_f").persist() for d in (train, test))
        feature_blocks = sparse_blocks(tr, "_f", ["label"], rows_per_task=ROWS_PER_PASS)
        secs = [round(time.perf_counter() - t0, 2)]
        for reducer in dict.fromkeys(r for _, r, _ in left):
            t1, todo = time.perf_counter(), [c for c in left if c[1] == reducer]
            try:
                reduced = grid_stages("reducer", reducer, seed)[0].fit_blocks(feature_blocks)
                small = reduced.transform(tr).select("label", "_r")
                dealt = sparse_blocks(small, "_r", ["label"], rows_per_task=ROWS_PER_TASK, n=feature_blocks.n)
                scored = reduced.transform(te).select("label", "_r").persist()
            except Exception:  # noqa: BLE001 - recorded as failed rows
                for cell in todo:
                    finish(cell, [*secs, round(time.perf_counter() - t1, 2), None], error=traceback.format_exc())
                continue
            took = [*secs, round(time.perf_counter() - t1, 2)]

            def run(cell):
                t2 = time.perf_counter()
                try:
                    model = grid_stages("model", cell[2], seed)[0].fit_blocks(dealt)
                    fitted = round(time.perf_counter() - t2, 2)
                    pred = model.transform(scored).select(F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
                    finish(cell, [*took, fitted], ev.classification_metrics(pred, "actual", "predicted").first())
                except Exception:  # noqa: BLE001 - recorded as a failed row
                    finish(cell, [*took, round(time.perf_counter() - t2, 2)], error=traceback.format_exc())

            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                list(pool.map(run, todo))
            dealt.release()
            scored.unpersist()
        feature_blocks.release()
        tr.unpersist()
        te.unpersist()
    ranked = sorted((rows[c] for c in cells if rows[c]["status"] == "ok"), key=lambda r: (-r["macro_f1"], -r["weighted_f1"]))
    if model_path and ranked:
        best = ranked[0]
        stages = [indexer, *grid_stages("feature", best["feature"]), *grid_stages("reducer", best["reducer"], seed),
                  *grid_stages("model", best["model"], seed)]
        save_model(fit_persisted(stages, train), model_path)
    out = spark.createDataFrame([tuple(rows[c][n] for n in names) for c in cells], _GRID_SCHEMA)
    return out.orderBy(F.col("macro_f1").desc_nulls_last(), F.col("weighted_f1").desc_nulls_last(), "run")


def _finished(spark, path: str | None, cells: Sequence[tuple]) -> dict[tuple, dict]:
    """The cells with an ``ok`` row under ``path`` (at most one row per cell is read back)."""
    from pyspark.errors import AnalysisException
    if not path:
        return {}
    try:
        kept = spark.read.schema(_GRID_SCHEMA).json(path).where("status = 'ok'")
        kept = kept.dropDuplicates(["run"]).where(F.col("run").isin(["__".join(c) for c in cells])).collect()
    except AnalysisException:  # no row was written yet
        return {}
    return {(r["feature"], r["reducer"], r["model"]): r.asDict() for r in kept}


# ---------------------------------------------------------------------------
# Tabular regression
# ---------------------------------------------------------------------------
def tabular_stages(numeric: Sequence[str], ordinal: Mapping[str, Sequence[str]], nominal: Sequence[str],
                   target: str, linear: bool) -> list:
    """Numeric (median-imputed, z-scored for linear models) ∥ ordinal
    codes ∥ target-encoded nominals → one vector; other columns dropped."""
    from pyspark.ml.feature import StandardScaler
    from quarry.operators.ml import MedianImputer, OrdinalEncoder, TargetEncoder
    imp = MedianImputer(numeric)
    stages = [imp, OrdinalEncoder(ordinal), TargetEncoder(nominal, target)]
    cols = [f"{c}_imp" for c in numeric] + [f"{c}_ord" for c in ordinal] + [f"{c}_te" for c in nominal]
    if linear:
        stages += [VectorAssembler(inputCols=[f"{c}_imp" for c in numeric], outputCol="_num"),
                   StandardScaler(inputCol="_num", outputCol="_num_z", withMean=True, withStd=True),
                   VectorAssembler(inputCols=["_num_z"] + cols[len(numeric):], outputCol="features")]
    else:
        stages += [VectorAssembler(inputCols=cols, outputCol="features")]
    return stages


def feature_names(numeric, ordinal, nominal) -> list[str]:
    return list(numeric) + list(ordinal) + list(nominal)


# ---------------------------------------------------------------------------
# Two-stage model (M15, M16, E18), ablation (Q13, Q14), attribution (Q15)
# ---------------------------------------------------------------------------
#: Trees, step and depth of the boosted families, in the first stage and in the second.
BOOSTED = {"lightgbm": (100, 0.1, 5), "xgboost": (100, 0.3, 6), "catboost": (100, 0.1, 6)}
BOOSTED_STAGE2 = (200, 0.05, 5)
TREE_DEPTH, TREE_DEPTH_STAGE2 = 10, 15
CLASSIFIERS = [*BOOSTED, "decision_tree", "random_forest", "svm"]


def build_classifier(name: str, seed: int = 42, n_classes: int = 2, stage: int = 1):
    """Named classifier with the defaults of its stage; the three
    boosted-tree names map to MLlib gradient-boosted trees (one-vs-rest when
    multi-class), the SVM to the linear one."""
    if name in BOOSTED:
        trees, step, depth = BOOSTED[name] if stage == 1 else BOOSTED_STAGE2
        gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)
        return gbt if n_classes <= 2 else OneVsRest(classifier=gbt)
    if name == "decision_tree":
        return DecisionTreeClassifier(maxDepth=TREE_DEPTH if stage == 1 else TREE_DEPTH_STAGE2, seed=seed)
    if name == "random_forest":
        return RandomForestClassifier(numTrees=100, seed=seed)
    if name == "svm":
        return OneVsRest(classifier=LinearSVC(maxIter=1000))
    raise ValueError(f"unsupported classifier {name}")


def two_stage(train: DataFrame, test: DataFrame, vec: str, attributes: Sequence[str], outcome: str,
              count_col: str, stage1: str = "random_forest", stage2: str = "random_forest",
              seed: int = 42) -> dict:
    """Stage 1 fits one classifier per attribute on the vector; the
    stage-2 input is vector ∥ stage-1 class probabilities ∥ count column.
    Training rows get stage-1 probabilities from the model that saw them
    (kept on purpose, as the reference does)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    slices, cur_tr, cur_te, stage1_models, pos = {}, train, test, {}, 0
    dim = len(train.select(vec).first()[0])
    slices["image"] = (0, dim)
    pos = dim
    for a in attributes:
        n_cls = train.select(a).distinct().count()
        clf = build_classifier(stage1, seed, n_cls).setFeaturesCol("_v").setLabelCol(a)
        tr_in = cur_tr.withColumn("_v", array_to_vector(F.col(vec)))
        m = clf.fit(tr_in)
        stage1_models[a] = m
        cur_tr = class_probabilities(m, tr_in, f"_p_{a}").drop("_v", "prediction", "rawPrediction", "probability")
        cur_te = class_probabilities(m, cur_te.withColumn("_v", array_to_vector(F.col(vec))), f"_p_{a}") \
            .drop("_v", "prediction", "rawPrediction", "probability")
        slices[a] = (pos, pos + n_cls)
        pos += n_cls
    slices["count"] = (pos, pos + 1)
    concat = F.concat(F.col(vec).cast("array<double>"), *[F.col(f"_p_{a}") for a in attributes],
                      F.array(F.col(count_col).cast("double")))
    tr2 = cur_tr.withColumn("features", array_to_vector(concat))
    te2 = cur_te.withColumn("features", array_to_vector(concat))
    n_out = train.select(outcome).distinct().count()
    final = build_classifier(stage2, seed, n_out, stage=2).setLabelCol(outcome).fit(tr2)
    return {"stage1": stage1_models, "final": final, "train": tr2, "test": te2, "slices": slices}


def ablate(model, test: DataFrame, outcome: str, slices: Mapping[str, tuple[int, int]], subsets: DataFrame,
           features: str = "features", baseline: bool = False) -> DataFrame:
    """Q13/Q14: for every subset of feature groups, zero those slices and
    re-score; one ``transform`` over rows × subsets (the subset table is a
    small broadcast list), then grouped accuracy / QWK and deltas to the
    unmasked baseline."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    spark = test.sparkSession
    bounds = spark.createDataFrame([(g, s, e) for g, (s, e) in slices.items()], "grp string, s int, e int")
    subs = (subsets.select("subset_name", F.explode("subset").alias("grp")).join(F.broadcast(bounds), "grp")
            .groupBy("subset_name").agg(F.collect_list(F.struct("s", "e")).alias("_mask")))
    base = subs.select("subset_name", "_mask").unionByName(
        spark.createDataFrame([("<none>", [])], "subset_name string, _mask array<struct<s:int,e:int>>"))
    rows = test.select(outcome, vector_to_array(F.col(features)).alias("_x"))
    crossed = rows.crossJoin(F.broadcast(base))  # subsets: ≤ Σ C(groups, ≤3) rows
    masked = F.transform("_x", lambda x, i: F.when(
        F.exists("_mask", lambda m: (i >= m.s) & (i < m.e)), F.lit(0.0)).otherwise(x))
    scored = model.transform(crossed.withColumn(features, array_to_vector(masked)))
    pred = scored.select("subset_name", F.col(outcome).cast("int").alias("actual"),
                         F.col("prediction").cast("int").alias("predicted"))
    # The rows are scored once, into the cells of a confusion table per subset.
    cells = ev.confusion_cells(pred, "actual", "predicted", ["subset_name"]).checkpoint()
    hit = F.col("actual") == F.col("predicted")
    acc = cells.where(hit.isNotNull()).groupBy("subset_name").agg((F.sum(F.when(hit, F.col("cnt")).otherwise(0)) / F.sum("cnt")).alias("accuracy"))
    qwk = ev.kappa_of_cells(cells, "subset_name", digits=12)
    res = acc.join(qwk, "subset_name").checkpoint()
    b = res.where(F.col("subset_name") == "<none>").select(F.col("accuracy").alias("_ba"), F.col("qwk").alias("_bq"))
    out = attach(res, b, [])
    return out.select("subset_name", F.round("accuracy", 4).alias("accuracy"), F.round("qwk", 4).alias("qwk"),
                      F.round(F.col("accuracy") - F.col("_ba"), 4).alias("delta_accuracy"),
                      F.round(F.col("qwk") - F.col("_bq"), 4).alias("delta_qwk")) \
        .where(F.lit(baseline) | (F.col("subset_name") != "<none>"))


def ablation_report(scored: DataFrame, k: int = 5) -> DataFrame:
    """Q14: the ``baseline`` row, all ``combination`` rows and, once more, the
    k ``worst`` (largest loss of kappa) and k ``best`` of them, each in order."""
    order = [F.col("delta_qwk"), F.col("subset_name")]
    last = [F.col("delta_qwk").desc(), F.col("subset_name").desc()]
    subsets = scored.where("subset_name <> '<none>'")

    def ranked(kind, rows, by, limit=None):
        # a handful of rows: the subsets of the feature groups
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(kind)).orderBy(*by)).cast("long"))
        return (rows.where(F.col("place") <= limit) if limit else rows).select(F.lit(kind).alias("kind"), "place", *scored.columns)

    return ranked("baseline", scored.where("subset_name = '<none>'"), order).unionByName(
        ranked("combination", subsets, order)).unionByName(ranked("worst", subsets, order, k)).unionByName(
        ranked("best", subsets, last, k))


def linear_attribution(coef_rows: DataFrame, x: DataFrame, vec: str, names: DataFrame, k: int = 20) -> DataFrame:
    """Q15: mean |w·(x - mean)| per feature, averaged over rows and classes.

    For a linear model the average factorises into mean|w| (model table,
    one row per feature) × mean|x - x̄| (one aggregate over the rows), so
    no row × feature × class product is materialised."""
    long = x.select(F.posexplode(vec).alias("pos", "_v"))
    means = long.groupBy("pos").agg(F.avg("_v").alias("_m"))
    mad = long.join(means, "pos").groupBy("pos").agg(F.avg(F.abs(F.col("_v") - F.col("_m"))).alias("_mad"))
    w = coef_rows.groupBy("pos").agg(F.avg(F.abs("coef")).alias("_w"))
    contrib = mad.join(w, "pos").join(names, "pos").select("pos", "feature", "group",
                                                          (F.col("_mad") * F.col("_w")).alias("mean_abs"))
    return contrib
