"""MLlib building blocks that MLlib does not ship (SURVEY D4, E5, E6, E11,
E13, E15, M9): custom Estimators/Transformers used inside ``Pipeline``s.

Heavy lifting stays in Spark: statistics are DataFrame aggregates, vector
maths runs in Arrow batches through ``mapInPandas`` (numpy per batch, never
per row), and fitted parameters are bounded by the model size (vocabulary,
number of classes, number of levels), not by the data size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.blocks import ROWS_PER_PASS, csr, dense_vectors, sparse_blocks, sparse_vectors, with_scores
from quarry.operators.persist import Parts, Saved


def _with_column_schema(df: DataFrame, name: str, dtype) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name != name]
    return T.StructType(fields + [T.StructField(name, dtype, True)])


class SklearnTfidf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """TF-IDF with smooth idf ``ln((1+n)/(1+df)) + 1``, optional
    sublinear tf ``1 + ln(tf)`` and L2-normalised rows.

    MLlib's ``IDF`` uses ``ln((n+1)/(df+1))`` and does not normalise; its
    fitted document frequencies are reused here and the weighting is
    applied per Arrow batch."""

    sublinear = Param(Params._dummy(), "sublinear", "use 1 + ln(tf)", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol="tf", outputCol="features", sublinear=True):
        super().__init__()
        self._setDefault(sublinear=True)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        from pyspark.ml.feature import IDF
        idf = IDF(inputCol=self.getInputCol(), outputCol="_idf_unused", minDocFreq=0).fit(df)
        n = float(idf.numDocs)
        dfreq = np.asarray(idf.docFreq, dtype=np.float64)
        weights = np.log((1.0 + n) / (1.0 + dfreq)) + 1.0
        return SklearnTfidfModel(self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.sublinear),
                                 weights)


class SklearnTfidfModel(Model, HasInputCol, HasOutputCol, Saved):
    def __init__(self, inputCol: str, outputCol: str, sublinear: bool, idf: np.ndarray):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.sublinear_tf = sublinear
        self.idf = idf

    def _parts(self) -> Parts:
        return Parts(plain={"names": [self.getInputCol(), self.getOutputCol()], "sublinear": self.sublinear_tf}, arrays={"idf": self.idf})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "SklearnTfidfModel":
        return cls(*parts.plain["names"], parts.plain["sublinear"], parts.arrays["idf"])

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.linalg import VectorUDT
        spark = df.sparkSession
        idf_b = spark.sparkContext.broadcast(self.idf)
        inp, out, sub = self.getInputCol(), self.getOutputCol(), self.sublinear_tf
        schema = _with_column_schema(df, out, VectorUDT())

        names = [f.name for f in schema]

        def weigh(batches):
            w = idf_b.value
            for b in batches:
                width, indptr, indices, data = csr(b.column(inp))
                full = data != 0   # dense vectors bring their zeros
                indptr, indices, data = np.r_[0, np.cumsum(full)][indptr], indices[full], data[full]
                x = ((1.0 + np.log(data)) if sub else data) * w[indices]
                row = np.repeat(np.arange(b.num_rows), np.diff(indptr))
                norm = np.sqrt(np.bincount(row, x * x, minlength=b.num_rows))
                x = x / np.where(norm > 0, norm, 1)[row]
                got = sparse_vectors(len(w), indptr, indices, x)
                yield pa.RecordBatch.from_arrays([got if n == out else b.column(n) for n in names], names=names)
        return df.mapInArrow(weigh, schema)


class TruncatedSVD(Estimator, HasInputCol, HasOutputCol):
    """Truncated SVD (LSA) by randomized range finding (Halko et al.,
    the algorithm behind the reference's default solver).  k is capped at
    n_features - 1; with at most one feature the input passes through.

    The rows become sparse blocks that are persisted once.  Each pass over
    them sums ``Xᵀ(X·M)`` and ``(X·M)ᵀ(X·M)`` for the current d × l matrix M
    (l = k + oversampling), so the input is computed once and read
    ``n_iter + 1`` times, and only d × l / l × l matrices (bounded by the
    vocabulary size and k) reach the driver, where M gets its QR step."""

    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)
    n_iter = Param(Params._dummy(), "n_iter", "power iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="svd", k=300, n_iter=5, oversample=10, seed=42):
        super().__init__()
        self._setDefault(k=300, n_iter=5)
        kw = dict(self._input_kwargs)
        self.oversample = kw.pop("oversample", 10)
        self.seed = kw.pop("seed", 42)
        self._set(**kw)

    def _fit(self, df: DataFrame):
        blocks = sparse_blocks(df, self.getInputCol(), rows_per_task=ROWS_PER_PASS)
        try:
            return self.fit_blocks(blocks)
        finally:
            blocks.release()

    def fit_blocks(self, blocks) -> "TruncatedSVDModel":
        d = blocks.width
        k = min(self.getOrDefault(self.k), d - 1)
        if k < 1:
            return TruncatedSVDModel(self.getInputCol(), self.getOutputCol(), None)
        ell = min(k + self.oversample, d)

        def products(m, bs):
            total = np.zeros((d + ell, ell))
            for b in bs:
                y = b.times(m)
                b.transposed_times(y, d, out=total[:d])
                total[d:] += y.T @ y
            return total

        def one_pass(m):
            t = blocks.fold(m, products, (d + ell) * ell, sums=True).reshape(d + ell, ell)
            return t[:d], t[d:]

        m = np.random.RandomState(self.seed).standard_normal((d, ell))
        for _ in range(self.getOrDefault(self.n_iter)):
            m, _ = np.linalg.qr(one_pass(m)[0])
        a, g = one_pass(m)
        lam, w = np.linalg.eigh(g)
        keep = lam > lam.max() * 1e-12
        z = a @ (w[:, keep] / np.sqrt(lam[keep]))     # = Xᵀ Q, Q orthonormal basis of X·M
        u, svals, _ = np.linalg.svd(z, full_matrices=False)
        return TruncatedSVDModel(self.getInputCol(), self.getOutputCol(), u[:, :k], svals[:k])


class TruncatedSVDModel(Model, HasInputCol, HasOutputCol, Saved):
    """Rows projected on the fitted components; without any, passed through."""

    def __init__(self, inputCol: str, outputCol: str, v: np.ndarray | None, singular_values=()):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.v, self.singular_values = v, np.asarray(singular_values, np.float64)

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.linalg import VectorUDT
        inp, out = self.getInputCol(), self.getOutputCol()
        if self.v is None:
            return df.withColumn(out, F.col(inp))
        matrix = np.concatenate([self.v, np.zeros((1, self.v.shape[1]))])
        return with_scores(df, inp, matrix, {out: VectorUDT()}, lambda s: {out: dense_vectors(s)})

    def _parts(self) -> Parts:
        arrays = {} if self.v is None else {"v": self.v, "singular_values": self.singular_values}
        return Parts(plain={"names": [self.getInputCol(), self.getOutputCol()]}, arrays=arrays)

    @classmethod
    def _from_parts(cls, parts: Parts) -> "TruncatedSVDModel":
        values = parts.arrays.get("singular_values", np.zeros(0)).reshape(-1)
        return cls(*parts.plain["names"], parts.arrays.get("v"), values)


class SelectChi2(Estimator, HasInputCol, HasOutputCol):
    """The k features with the best χ² of their class sums against the
    classes' shares (ties: lower index), kept by ``SliceFeatures``.  One pass
    sums the features by class; the scores are bounded by the vocabulary."""

    k = Param(Params._dummy(), "k", "features kept", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="selected", labelCol="label", k=20000):
        super().__init__()
        kw = dict(self._input_kwargs)
        self.labelCol = kw.pop("labelCol", "label")
        self._set(**{"k": 20000, **kw})

    def _fit(self, df: DataFrame):
        blocks = sparse_blocks(df, self.getInputCol(), [self.labelCol], rows_per_task=ROWS_PER_PASS)
        try:
            return self.fit_blocks(blocks)
        finally:
            blocks.release()

    def fit_blocks(self, blocks):
        from quarry.operators.learners import class_counts
        counts, d = class_counts(blocks), blocks.width
        n_classes = len(counts)

        def sums(_, bs):
            total = np.zeros((d, n_classes))
            for b in bs:
                b.transposed_times(np.eye(n_classes)[b.extra[:, 0].astype(int)], d, out=total)
            return total

        observed = blocks.fold(None, sums, d * n_classes, sums=True).reshape(d, n_classes)
        expected = np.outer(observed.sum(axis=1), counts / max(counts.sum(), 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            chi2 = np.where(expected > 0, (observed - expected) ** 2 / expected, 0).sum(axis=1)
        keep = np.sort(np.argsort(-chi2, kind="stable")[:self.getOrDefault(self.k)])
        return SliceFeatures(self.getInputCol(), self.getOutputCol(), keep if len(keep) else np.zeros(1))


class TargetEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed target mean per level: ``prior·(1-w) + mean·w`` with
    ``w = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))``; levels seen
    once, unseen levels and nulls get the prior (category-encoders rule).

    The level table is one grouped aggregate; applying it is a join (the
    table is broadcast by AQE only when its measured size allows)."""

    def __init__(self, inputCols: Sequence[str], labelCol: str, outputSuffix: str = "_te",
                 smoothing: float = 10.0, min_samples_leaf: int = 20):
        super().__init__()
        self.inputCols, self.labelCol, self.suffix = list(inputCols), labelCol, outputSuffix
        self.smoothing, self.min_samples_leaf = smoothing, min_samples_leaf

    def _fit(self, df: DataFrame):
        y = F.col(self.labelCol).cast("double")
        prior_df = df.agg(F.avg(y).alias("prior"))
        tables = {}
        for c in self.inputCols:
            st = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("m"))
            st = st.crossJoin(F.broadcast(prior_df))  # one-row scalar
            w = 1.0 / (1.0 + F.exp(-(F.col("n") - self.min_samples_leaf) / self.smoothing))
            val = F.when(F.col("n") == 1, F.col("prior")).otherwise(F.col("prior") * (1 - w) + F.col("m") * w)
            # Level tables are bounded by the number of categories; a reliable
            # checkpoint (shared checkpoint folder) cuts their lineage so
            # applying the model never re-runs the training aggregation.
            tables[c] = st.select(F.col(c).alias("level"), F.col("n"), val.alias("value")).checkpoint()
        return TargetEncoderModel(self.inputCols, self.suffix, tables, prior_df.checkpoint())


class TargetEncoderModel(Model, Saved):
    def __init__(self, inputCols, suffix, tables: Mapping[str, DataFrame], prior: DataFrame):
        super().__init__()
        self.inputCols, self.suffix, self.tables, self.prior = inputCols, suffix, tables, prior

    def _parts(self) -> Parts:
        levels = {f"levels_{i}": self.tables[c] for i, c in enumerate(self.inputCols)}
        return Parts(plain={"columns": self.inputCols, "suffix": self.suffix}, tables=levels | {"prior": self.prior})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "TargetEncoderModel":
        columns = parts.plain["columns"]
        return cls(columns, parts.plain["suffix"], {c: parts.tables[f"levels_{i}"] for i, c in enumerate(columns)}, parts.tables["prior"])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.crossJoin(F.broadcast(self.prior.withColumnRenamed("prior", "_prior")))  # one-row scalar
        for c in self.inputCols:
            t = self.tables[c].select(F.col("level").alias(f"_{c}_lvl"), F.col("value").alias(f"_{c}_val"))
            out = out.join(t, F.col(c) == F.col(f"_{c}_lvl"), "left")
            out = out.withColumn(f"{c}{self.suffix}", F.coalesce(F.col(f"_{c}_val"), F.col("_prior"))) \
                .drop(f"_{c}_lvl", f"_{c}_val")
        return out.drop("_prior")


class OrdinalEncoder(Transformer, Saved):
    """E5: fixed ordered mapping → int; unknown values and nulls → -1."""

    def __init__(self, mappings: Mapping[str, Sequence[str]], suffix: str = "_ord"):
        super().__init__()
        self.mappings, self.suffix = dict(mappings), suffix

    def _parts(self) -> Parts:
        return Parts(plain={"mappings": [[c, list(v)] for c, v in self.mappings.items()], "suffix": self.suffix})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "OrdinalEncoder":
        return cls(dict(parts.plain["mappings"]), parts.plain["suffix"])

    def _transform(self, df: DataFrame) -> DataFrame:
        from quarry.functions.scalar import code_labels
        for c, order in self.mappings.items():
            m = {v: i for i, v in enumerate(order)}
            df = df.withColumn(f"{c}{self.suffix}", code_labels(c, m, default=None).cast("int"))
            df = df.withColumn(f"{c}{self.suffix}", F.coalesce(F.col(f"{c}{self.suffix}"), F.lit(-1)))
        return df


def class_probabilities(model, df: DataFrame, out: str = "proba") -> DataFrame:
    """Class-probability array for any fitted classifier: the model's own
    ``probability`` column, or — for one-vs-rest models, which have none —
    the normalised positive-class probabilities of the inner binary models."""
    from pyspark.ml.classification import OneVsRestModel
    from pyspark.ml.functions import vector_to_array
    if isinstance(model, OneVsRestModel):
        cols = []
        cur = df
        for i, m in enumerate(model.models):
            m = m.copy()
            names = {"probabilityCol": f"_p{i}", "rawPredictionCol": f"_r{i}", "predictionCol": f"_y{i}"}
            for k, v in names.items():
                if m.hasParam(k):
                    m = m._set(**{k: v})
            cur = m.transform(cur)
            if m.hasParam("probabilityCol"):
                cols.append(vector_to_array(F.col(f"_p{i}"))[1])
            else:  # margin models: logistic of the margin
                cols.append(1 / (1 + F.exp(-vector_to_array(F.col(f"_r{i}"))[1])))
        arr = F.array(*cols)
        tot = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
        cur = cur.withColumn(out, F.transform(arr, lambda x: F.when(tot > 0, x / tot).otherwise(1.0 / len(cols))))
        drop = [c for i in range(len(model.models)) for c in (f"_p{i}", f"_r{i}", f"_y{i}") if c in cur.columns]
        return cur.drop(*drop)
    res = model.transform(df)
    return res.withColumn(out, vector_to_array(F.col(model.getOrDefault("probabilityCol"))))


class MedianImputer(Estimator):
    """Median imputation fitted on the training rows, with the exact
    linear-interpolated median (numpy rule) — MLlib's ``Imputer`` returns
    an order statistic instead.  The medians of all columns come from one pass
    of ``exact_quantiles_of``; applying them is a one-row attach."""

    def __init__(self, inputCols: Sequence[str], suffix: str = "_imp"):
        super().__init__()
        self.inputCols, self.suffix = list(inputCols), suffix

    def _fit(self, df: DataFrame):
        from quarry.operators.quantiles import exact_quantiles_of
        q = exact_quantiles_of(df, [], self.inputCols, {"median": 0.5}, count_col=None)
        row = q.agg(*[F.max(F.when(F.col("measure") == c, F.col("median"))).alias(f"_med_{c}") for c in self.inputCols])
        return MedianImputerModel(self.inputCols, self.suffix, row.checkpoint())


class MedianImputerModel(Model, Saved):
    def __init__(self, inputCols, suffix, medians: DataFrame):
        super().__init__()
        self.inputCols, self.suffix, self.medians = inputCols, suffix, medians

    def _parts(self) -> Parts:
        return Parts(plain={"columns": self.inputCols, "suffix": self.suffix}, tables={"medians": self.medians})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "MedianImputerModel":
        return cls(parts.plain["columns"], parts.plain["suffix"], parts.tables["medians"])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.crossJoin(F.broadcast(self.medians))  # one-row scalar
        for c in self.inputCols:
            out = out.withColumn(f"{c}{self.suffix}", F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")))
        return out.drop(*[f"_med_{c}" for c in self.inputCols])


class VocabularyVectorizer(Estimator, HasInputCol, HasOutputCol):
    """Count vectoriser whose vocabulary is chosen with DataFrame
    aggregates (term totals and document frequencies, map-side combined).

    ``kind`` says what the terms of the input arrays are: the strings
    themselves, ``bigrams`` (adjacent pairs added) or ``chars`` (n-grams of the
    words); pairs and n-grams are made in the task that counts them, so only
    the words leave the JVM.  ``min_df``/``max_df``: int = document count, float
    = share of documents; ``vocab_size`` most frequent terms kept (ties: term
    order).  With ``tfidf`` the counts are turned into sklearn-style TF-IDF
    (smooth idf, optional sublinear tf, L2 rows) from the same document
    frequencies — no second pass for an IDF fit."""

    def __init__(self, inputCol="grams", outputCol="features", min_df=5, max_df=0.95, vocab_size=50000,
                 tfidf=True, sublinear=True, drop_cols=(), kind=""):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.min_df, self.max_df, self.vocab_size = min_df, max_df, vocab_size
        self.tfidf, self.sublinear, self.drop_cols, self.kind = tfidf, sublinear, list(drop_cols), kind

    def _fit(self, df: DataFrame):
        from quarry.operators.text import row_statistics
        n_docs = df.count()
        lo = self.min_df if isinstance(self.min_df, int) else math.ceil(self.min_df * n_docs)
        hi = self.max_df if isinstance(self.max_df, int) else math.floor(self.max_df * n_docs)
        stats = row_statistics(df, F.col(self.getInputCol()), kind=self.kind).where((F.col("df") >= lo) & (F.col("df") <= hi))
        # The vocabulary is a model parameter bounded by vocab_size.
        top = stats.orderBy(F.col("cnt").desc(), F.col("term")).limit(self.vocab_size).collect()
        idf = None
        if self.tfidf:
            dfs = np.asarray([r["df"] for r in top] or [0], dtype=np.float64)
            idf = np.log((1.0 + n_docs) / (1.0 + dfs)) + 1.0
        # Intermediate columns are dropped before the Arrow step.
        before = DropColumns([c for c in self.drop_cols if c != self.getInputCol()])
        vectors = TermVectors(self.getInputCol(), self.getOutputCol(), [r["term"] for r in top] or [""], self.kind, idf, self.sublinear)
        return _ChainModel([vectors], drop=self.drop_cols, before=before)


class TermVectors(Model, HasInputCol, HasOutputCol, Saved):
    """Sparse vectors of a vocabulary's counts in an array of words, or with
    ``idf`` their TF-IDF weights, made in the task that holds the row."""

    def __init__(self, inputCol: str, outputCol: str, vocabulary: list[str], kind: str = "", idf: np.ndarray | None = None,
                 sublinear: bool = True):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.vocabulary, self.kind, self.idf, self.sublinear_tf = vocabulary, kind, idf, sublinear

    def _parts(self) -> Parts:
        from pyspark.sql import SparkSession
        terms = SparkSession.active().createDataFrame(pa.table({"i": np.arange(len(self.vocabulary)), "term": pa.array(self.vocabulary, pa.string())}))
        return Parts(plain={"names": [self.getInputCol(), self.getOutputCol()], "kind": self.kind, "sublinear": self.sublinear_tf},
                     arrays={} if self.idf is None else {"idf": self.idf}, tables={"terms": terms})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "TermVectors":
        terms = [r["term"] for r in parts.tables["terms"].orderBy("i").collect()]   # the vocabulary
        idf = parts.arrays.get("idf")
        return cls(*parts.plain["names"], terms, parts.plain["kind"], None if idf is None else idf.reshape(-1), parts.plain["sublinear"])

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.linalg import VectorUDT
        from quarry.operators.text import _row_counts, pieces
        inp, out, kind, sub, width = self.getInputCol(), self.getOutputCol(), self.kind, self.sublinear_tf, len(self.vocabulary)
        sent = df.sparkSession.sparkContext.broadcast((pa.array(self.vocabulary, pa.string()), self.idf))
        schema = _with_column_schema(df, out, VectorUDT())
        names = [f.name for f in schema]

        def vectors(batches):
            known, idf = sent.value
            for b in (part for whole in batches for part in pieces(whole, inp)):
                found = []
                for words, row, code, tf in _row_counts(b.column(inp), kind):
                    at = pc.index_in(words.cast(pa.string()), value_set=known).fill_null(-1).to_numpy()[code]
                    hit = at >= 0
                    found.append((row[hit], at[hit], tf[hit]))
                row, index, x = (np.concatenate(v) for v in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                order = np.argsort(row * width + index)
                row, index, x = row[order], index[order], x[order].astype(np.float64)
                if idf is not None:
                    x = ((1.0 + np.log(x)) if sub else x) * idf[index]
                    norm = np.sqrt(np.bincount(row, x * x, minlength=b.num_rows))
                    x = x / np.where(norm > 0, norm, 1)[row]
                got = sparse_vectors(width, np.r_[0, np.cumsum(np.bincount(row, minlength=b.num_rows))], index, x)
                yield pa.RecordBatch.from_arrays([got if n == out else b.column(n) for n in names], names=names)
        return df.mapInArrow(vectors, schema)


class DropColumns(Transformer, Saved):
    """Drop intermediate columns (token arrays, raw text), so that only the
    vector crosses into Python in the next stage."""

    def __init__(self, cols: Sequence[str] = ()):
        super().__init__()
        self.cols = list(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in self.cols if c in df.columns])

    def _parts(self) -> Parts:
        return Parts(plain={"cols": self.cols})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "DropColumns":
        return cls(parts.plain["cols"])


class TextWords(Transformer, HasInputCol, HasOutputCol, Saved):
    """Lower-cased words of a text column between white space (see functions.text.text_words)."""

    def __init__(self, inputCol: str = "text", outputCol: str = "words"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        from quarry.functions.text import text_words
        return df.withColumn(self.getOutputCol(), text_words(F.col(self.getInputCol())))

    def _parts(self) -> Parts:
        return Parts()

    @classmethod
    def _from_parts(cls, parts: Parts) -> "TextWords":
        return cls()


class _ChainModel(Model, Saved):
    def __init__(self, models, drop=(), before=None):
        super().__init__()
        self.models, self.drop_cols, self.before = models, list(drop), before or DropColumns()

    def _transform(self, df: DataFrame) -> DataFrame:
        for m in [self.before, *self.models]:
            df = m.transform(df)
        return df.drop(*[c for c in self.drop_cols if c in df.columns])

    def _parts(self) -> Parts:
        return Parts(plain={"drop": self.drop_cols}, stages=[self.before, *self.models])

    @classmethod
    def _from_parts(cls, parts: Parts) -> "_ChainModel":
        return cls(parts.stages[1:], parts.plain["drop"], parts.stages[0])


class CompactFeatures(Estimator, HasInputCol, HasOutputCol):
    """Keep only the feature indices that occur in the training vectors
    (``SliceFeatures``).  For hashed features this shrinks 2^20-wide vectors
    to the buckets actually used; with L2-regularised linear models the
    weights of never-seen buckets are zero, so the fitted model is the same
    while every optimiser pass moves far smaller gradients.  The index list
    is bounded by the vector width."""

    @keyword_only
    def __init__(self, inputCol="features", outputCol="compact"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        inp = self.getInputCol()

        def used(batches):
            for b in batches:
                width, indptr, indices, data = csr(b.column(0))
                dense = np.repeat(b.column(0).field("type").to_numpy(zero_copy_only=False) == 1, np.diff(indptr))
                yield pa.RecordBatch.from_pydict({"i": np.unique(indices[(data != 0) | ~dense]).astype(np.int64)})
        found = df.select(inp).mapInArrow(used, "i long").distinct().toArrow()["i"].to_numpy()
        return SliceFeatures(inp, self.getOutputCol(), np.sort(found) if len(found) else np.zeros(1))


class SliceFeatures(Model, HasInputCol, HasOutputCol, Saved):
    """The features of the given rising indices, as sparse vectors.  Each row is
    looked up by its own entries; MLlib's ``VectorSlicer`` goes through all
    indices for every row."""

    def __init__(self, inputCol: str, outputCol: str, indices: np.ndarray):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.indices = np.asarray(indices, np.int64)

    def getIndices(self) -> list[int]:
        return self.indices.tolist()

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.linalg import VectorUDT
        inp, out = self.getInputCol(), self.getOutputCol()
        sent = df.sparkSession.sparkContext.broadcast(self.indices)
        schema = _with_column_schema(df, out, VectorUDT())
        names = [f.name for f in schema]

        def cut(batches):
            kept = sent.value
            place = np.full(int(kept.max(initial=0)) + 2, -1, np.int32)   # the last for all indices beyond
            place[kept] = np.arange(len(kept))
            for b in batches:
                _, indptr, indices, data = csr(b.column(inp))
                at = place[np.minimum(indices, len(place) - 1)]
                hit = at >= 0
                got = sparse_vectors(len(kept), np.r_[0, np.cumsum(hit)][indptr], at[hit], data[hit])
                yield pa.RecordBatch.from_arrays([got if n == out else b.column(n) for n in names], names=names)
        return df.mapInArrow(cut, schema)

    def _parts(self) -> Parts:
        return Parts(plain={"names": [self.getInputCol(), self.getOutputCol()]}, arrays={"indices": self.indices})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "SliceFeatures":
        return cls(*parts.plain["names"], parts.arrays["indices"].reshape(-1))
