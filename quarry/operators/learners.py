"""Learners on sparse blocks: one-vs-rest linear models by L-BFGS (M6-M9),
mini-batch-free SGD with averaged weights (M10, M11), a ReLU network trained
with Adam (M14) and the voting ensemble (M12).

A pass over the data is one ``Blocks.fold``: every class is trained in the
same pass, and only arrays of the model's size reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quarry.operators.blocks import ROWS_PER_PASS, Block, Blocks, sparse_blocks, with_scores
from quarry.operators.persist import Parts, Saved


class _Base(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    def _names(self) -> dict:
        return {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "predictionCol": self.getPredictionCol()}


def argmax_label(scores: np.ndarray) -> pa.Array:
    """The best class, of equal ones the smallest."""
    return pa.array(np.argmax(scores, axis=1).astype(np.float64))


class LinearModel(Model, _Base, Saved):
    """Scores of all classes as one matrix product, the best class predicted.
    ``coefficients`` is features x classes with the intercepts as last row."""

    def __init__(self, coefficients: np.ndarray | None = None, losses: list[float] = (), **names):
        super().__init__()
        self.coefficients, self.losses = coefficients, list(losses)
        self._set(**names)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.getPredictionCol()
        return with_scores(df, self.getFeaturesCol(), self.coefficients, {out: DoubleType()}, lambda s: {out: argmax_label(s)})

    def _parts(self) -> Parts:
        return Parts(plain={"losses": self.losses}, arrays={"coefficients": self.coefficients})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "LinearModel":
        return cls(parts.arrays["coefficients"], parts.plain["losses"])


def class_counts(blocks: Blocks) -> np.ndarray:
    """Rows of every class 0 .. k-1, from the label (first extra column)."""
    def count(batches):
        for b in batches:
            for n, extra in zip(b.column("n").to_pylist(), b.column("extra").to_pylist()):
                label, rows = np.unique(np.frombuffer(extra, np.float64).reshape(n, -1)[:, 0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"label": label.astype(np.int64), "rows": rows})
    found = blocks.table.where("n > 0").mapInArrow(count, "label long, rows long").groupBy("label").agg(F.sum("rows")).collect()
    out = np.zeros(max((x[0] for x in found), default=-1) + 1)
    for label, rows in found:
        out[label] = rows
    return out


def class_weights(counts: np.ndarray, kind: str) -> np.ndarray:
    """(rows of the class, other rows) x class weights of the one-vs-rest
    problems.  ``inside``: balanced within each problem; ``classes``: the
    class's rows by n / (k n_c), the others by 1; ``none``."""
    n, k = counts.sum(), len(counts)
    safe = np.maximum(counts, 1)
    if kind == "inside":
        return np.stack([n / (2 * safe), n / (2 * np.maximum(n - counts, 1))])
    if kind == "classes":
        return np.stack([n / (k * safe), np.ones(k)])
    return np.ones((2, k))


_LOSSES = {
    "log": (lambda m: np.logaddexp(0, -m), lambda m: -1 / (1 + np.exp(np.clip(m, -500, 500)))),
    "squared_hinge": (lambda m: np.maximum(0, 1 - m) ** 2, lambda m: -2 * np.maximum(0, 1 - m)),
    "squared": (lambda m: (1 - m) ** 2 / 2, lambda m: m - 1),
    "hinge": (lambda m: np.maximum(0, 1 - m), lambda m: -(m < 1).astype(float)),
}


class LinearOvR(Estimator, _Base):
    """One-vs-rest linear models: ½‖w‖² + C Σ s·loss(y·f), all classes in the
    same passes, each with its own L-BFGS direction and step.

    ``weighting`` sets s: ``inside`` and ``classes`` as ``class_weights`` says,
    ``rows`` weighs every row by n / (k n_y) in every problem.  With
    ``penalise_intercept`` the intercept counts as one more feature.  A class
    stops at ``tol`` of its first gradient (scaled by the share of its smaller
    side) or after ``maxIter`` steps."""

    maxIter = Param(Params._dummy(), "maxIter", "steps", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "gradient tolerance", TypeConverters.toFloat)
    c = Param(Params._dummy(), "c", "weight of the loss", TypeConverters.toFloat)
    loss = Param(Params._dummy(), "loss", "log, squared_hinge or squared", TypeConverters.toString)
    weighting = Param(Params._dummy(), "weighting", "inside, classes, rows or none", TypeConverters.toString)
    penalise_intercept = Param(Params._dummy(), "penalise_intercept", "intercept in the penalty", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", loss="log", weighting="inside",
                 c=1.0, maxIter=300, tol=1e-4, penalise_intercept=True):
        super().__init__()
        self._set(**{**dict(featuresCol="features", labelCol="label", predictionCol="prediction", loss="log", weighting="inside",
                            c=1.0, maxIter=300, tol=1e-4, penalise_intercept=True), **self._input_kwargs})

    def _fit(self, df: DataFrame) -> LinearModel:
        blocks = sparse_blocks(df, self.getFeaturesCol(), [self.getLabelCol()], rows_per_task=ROWS_PER_PASS)
        try:
            return self.fit_blocks(blocks)
        finally:
            blocks.release()

    def fit_blocks(self, blocks: Blocks) -> LinearModel:
        """Fit on blocks whose first extra column is the label."""
        g = self.getOrDefault
        counts = class_counts(blocks)
        k, d = len(counts), blocks.width
        if not k:
            raise ValueError("no labelled rows")
        by_row = g("weighting") == "rows"
        weights = np.stack([blocks.n / (k * np.maximum(counts, 1))] * 2) if by_row else class_weights(counts, g("weighting"))
        value, slope = _LOSSES[g("loss")]

        def step(w, bs):
            total = np.zeros((d + 2, k))
            for b in bs:
                y = b.extra[:, 0].astype(int)
                scores = b.times(w[:-1]) + w[-1]
                sign = np.full_like(scores, -1.0)
                sign[np.arange(len(y)), y] = 1
                s = weights[0][y][:, None] if by_row else np.where(sign > 0, weights[0], weights[1])
                margin = scores * sign
                down = s * slope(margin) * sign
                b.transposed_times(down, d, out=total[:d])
                total[d] += down.sum(axis=0)
                total[d + 1] += (s * value(margin)).sum(axis=0)
            return total

        penalty = np.ones((d + 1, 1))
        penalty[d] = float(g("penalise_intercept"))

        def objective(w):
            t = blocks.fold(w, step, (d + 2) * k, sums=True).reshape(d + 2, k)
            return (penalty * w * w).sum(axis=0) / 2 + g("c") * t[-1], penalty * w + g("c") * t[:-1]

        share = np.maximum(np.minimum(counts, blocks.n - counts), 1) / max(blocks.n, 1)
        w, losses = minimise(objective, np.zeros((d + 1, k)), g("maxIter"), g("tol") * share)
        return LinearModel(w, losses.tolist(), **self._names())


def minimise(objective, w: np.ndarray, steps: int, tol: np.ndarray, memory: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """L-BFGS on the columns of ``w``, which are separate problems evaluated
    together: each has its own history, its own step (halved until the loss
    falls enough) and its own end."""
    f, grad = objective(w)
    first = np.linalg.norm(grad, axis=0)
    history: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = first > 0
    for _ in range(steps):
        live &= np.linalg.norm(grad, axis=0) > tol * first
        if not live.any():
            break
        q, used = grad.copy(), []
        for s, y, rho in reversed(history):
            a = rho * (s * q).sum(axis=0)
            q -= a * y
            used.append(a)
        if history:
            s, y, rho = history[-1]
            yy = (y * y).sum(axis=0)
            q *= np.where((rho > 0) & (yy > 0), 1 / np.maximum(rho * yy, 1e-300), 1)
        else:
            q /= np.maximum(first, 1)
        for (s, y, rho), a in zip(history, reversed(used)):
            q += s * (a - rho * (y * q).sum(axis=0))
        down = (q * grad).sum(axis=0)
        step = live.astype(float)
        for _ in range(30):
            new = w - step * q
            f_new, grad_new = objective(new)
            ok = ~live | (f_new <= f - 1e-4 * step * down)
            if ok.all():
                break
            step = np.where(ok, step, step / 2)
        else:
            live &= ok
        moved = live & ok
        s, y = np.where(moved, new - w, 0), np.where(moved, grad_new - grad, 0)
        sy = (s * y).sum(axis=0)
        history = (history + [(s, y, np.where(sy > 1e-12, 1 / np.maximum(sy, 1e-300), 0))])[-memory:]
        w, f, grad = np.where(moved, new, w), np.where(moved, f_new, f), np.where(moved, grad_new, grad)
    return w, f


#: Rows that a task trains on in an epoch; more rows mean more tasks, whose weights are averaged.
ROWS_PER_TASK = 20_000
#: Step of the intercept, relative to the weights', for sparse rows.
INTERCEPT_STEP = 0.01


class SGDLinear(Estimator, _Base):
    """One-vs-rest linear models by stochastic gradient descent.

    In an epoch every task runs over its rows one by one from the common
    weights, all classes at a time, and the tasks' weights are averaged by
    their rows.  The step is 1 / (alpha (t0 + t)) with t the rows that all
    tasks saw in earlier epochs and the task's own of this one, or for ``passive_aggressive`` min(1, loss / ‖x‖²) without penalty.
    A class ends when its mean loss has not improved by ``tol`` for five
    epochs.  A class's own rows weigh n / (k n_c), others 1."""

    maxIter = Param(Params._dummy(), "maxIter", "epochs", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least improvement of the mean loss", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    loss = Param(Params._dummy(), "loss", "log or hinge", TypeConverters.toString)
    passive_aggressive = Param(Params._dummy(), "passive_aggressive", "step by the loss", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", loss="hinge", alpha=1e-5,
                 maxIter=30, tol=1e-3, passive_aggressive=False):
        super().__init__()
        self._set(**{**dict(featuresCol="features", labelCol="label", predictionCol="prediction", loss="hinge", alpha=1e-5,
                            maxIter=30, tol=1e-3, passive_aggressive=False), **self._input_kwargs})

    def _fit(self, df: DataFrame) -> LinearModel:
        blocks = sparse_blocks(df, self.getFeaturesCol(), [self.getLabelCol()], rows_per_task=ROWS_PER_TASK)
        try:
            return self.fit_blocks(blocks)
        finally:
            blocks.release()

    def fit_blocks(self, blocks: Blocks) -> LinearModel:
        g = self.getOrDefault
        counts = class_counts(blocks)
        k, d = len(counts), blocks.width
        if not k:
            raise ValueError("no labelled rows")
        weights, aggressive, alpha = class_weights(counts, "classes"), g("passive_aggressive"), g("alpha")
        hinge = g("loss") == "hinge"
        t0 = 1 / (alpha * alpha ** -0.25)
        value, slope = _LOSSES[g("loss")]

        def epoch(state, bs):
            w, seen, live = state
            w, scale, loss, n = w.copy(), np.ones(k), np.zeros(k), 0
            # Signs and row weights of a row by its class.
            signs = np.where(np.eye(k, dtype=bool), 1.0, -1.0)
            shares = np.where(signs > 0, weights[0], weights[1]) * live
            for b in bs:
                labels, ends = b.extra[:, 0].astype(int).tolist(), b.indptr.tolist()
                for i, label in enumerate(labels):
                    at, x = b.indices[ends[i]:ends[i + 1]], b.data[ends[i]:ends[i + 1]]
                    sign, s = signs[label], shares[label]
                    rows = w.take(at, axis=0)
                    margin = sign * (scale * (x @ rows) + w[d])
                    lost = value(margin)
                    loss += lost
                    n += 1
                    if not aggressive:
                        eta = 1 / (alpha * (t0 + seen + n - 1))
                        scale *= np.where(live, max(0.0, 1 - eta * alpha), 1)
                    if not hinge or lost.any():  # a row beyond all margins moves nothing
                        if aggressive:
                            norm = x @ x
                            move = s * sign * np.minimum(1.0, lost / norm) if norm > 0 else np.zeros(k)
                        else:
                            move = -eta * s * slope(margin) * sign
                        if move.any():
                            w[at] = rows + x[:, None] * (move / scale)
                            w[d] += INTERCEPT_STEP * move
                    if not aggressive and scale.min() < 1e-9:
                        w[:d] *= scale
                        scale = np.ones(k)
            if not n:
                return None
            w[:d] *= scale
            return np.concatenate([(w * n).reshape(-1), loss, [n]])

        w, seen = np.zeros((d + 1, k)), 0
        live, best, stale, last = np.ones(k, bool), np.full(k, np.inf), np.zeros(k, int), np.zeros(k)
        for _ in range(g("maxIter")):
            got = blocks.fold((w, seen, live), epoch, (d + 1) * k + k + 1)
            n = got[-1]
            if not n:
                break
            new, loss = got[:-k - 1].reshape(d + 1, k) / n, got[-k - 1:-1] / n
            w, last = np.where(live, new, w), np.where(live, loss, last)
            seen += n
            stale = np.where(loss > best - g("tol"), stale + 1, 0)
            best = np.minimum(best, loss)
            live &= stale < 5
            if not live.any():
                break
        return LinearModel(w, last.tolist(), **self._names())


class ReluNetModel(Model, _Base, Saved):
    def __init__(self, layers: list[np.ndarray] = (), accuracy: list[float] = (), **names):
        super().__init__()
        self.layers, self.accuracy = list(layers), list(accuracy)
        self._set(**names)

    def _transform(self, df: DataFrame) -> DataFrame:
        (w1, w2), out = self.layers, self.getPredictionCol()
        return with_scores(df, self.getFeaturesCol(), w1, {out: DoubleType()},
                           lambda h: {out: argmax_label(np.maximum(h, 0) @ w2[:-1] + w2[-1])})

    def _parts(self) -> Parts:
        return Parts(plain={"accuracy": self.accuracy}, arrays={"hidden": self.layers[0], "output": self.layers[1]})

    @classmethod
    def _from_parts(cls, parts: Parts) -> "ReluNetModel":
        return cls([parts.arrays["hidden"], parts.arrays["output"]], parts.plain["accuracy"])


class ReluNet(Estimator, _Base):
    """One hidden ReLU layer and a softmax, trained with Adam.

    In an epoch every task runs Adam over its rows in batches from the common
    weights and moments, which are then averaged by rows.  Every tenth row is
    held out; training ends when its accuracy has not improved by ``tol`` for
    ten epochs, and the best weights are kept."""

    hidden = Param(Params._dummy(), "hidden", "hidden units", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "epochs", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    rate = Param(Params._dummy(), "rate", "Adam's step", TypeConverters.toFloat)
    batch = Param(Params._dummy(), "batch", "rows of a batch", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least improvement of the held-out accuracy", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", hidden=128, maxIter=80, alpha=1e-4,
                 rate=1e-3, batch=200, tol=1e-4, seed=42):
        super().__init__()
        self._set(**{**dict(featuresCol="features", labelCol="label", predictionCol="prediction", hidden=128, maxIter=80,
                            alpha=1e-4, rate=1e-3, batch=200, tol=1e-4, seed=42), **self._input_kwargs})

    def _fit(self, df: DataFrame) -> ReluNetModel:
        blocks = sparse_blocks(df, self.getFeaturesCol(), [self.getLabelCol()], rows_per_task=ROWS_PER_TASK)
        try:
            return self.fit_blocks(blocks)
        finally:
            blocks.release()

    def fit_blocks(self, blocks: Blocks) -> ReluNetModel:
        g = self.getOrDefault
        k, d = len(class_counts(blocks)), blocks.width
        if not k:
            raise ValueError("no labelled rows")
        rng, hidden, batch, alpha, rate = np.random.RandomState(g("seed")), g("hidden"), g("batch"), g("alpha"), g("rate")
        sizes = [(d + 1, hidden), (hidden + 1, k)]
        bound = [np.sqrt(6 / (a - 1 + b)) for a, b in sizes]
        theta = np.concatenate([rng.uniform(-x, x, (a, b)).reshape(-1) for x, (a, b) in zip(bound, sizes)])
        cut = sizes[0][0] * sizes[0][1]

        def split(v):
            return v[:cut].reshape(sizes[0]), v[cut:].reshape(sizes[1])

        def gradient(v, b, rows, y):
            (w1, w2), lo, hi = split(v), b.indptr[rows[0]], b.indptr[rows[-1] + 1]
            part = Block(b.indptr[rows[0]:rows[-1] + 2] - lo, b.indices[lo:hi], b.data[lo:hi], b.extra[rows[0]:rows[-1] + 1])
            use = np.arange(rows[0], rows[-1] + 1) % 10 != 9
            pre = part.times(w1[:-1]) + w1[-1]
            act = np.maximum(pre, 0)
            z = act @ w2[:-1] + w2[-1]
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p[~use] = 0
            n = max(1, int(use.sum()))
            back = (p @ w2[:-1].T) * (pre > 0)
            g1 = np.concatenate([part.transposed_times(back, d) + alpha * w1[:-1], back.sum(axis=0)[None]])
            g2 = np.concatenate([act.T @ p + alpha * w2[:-1], p.sum(axis=0)[None]])
            return np.concatenate([g1.reshape(-1), g2.reshape(-1)]) / n

        def epoch(state, bs):
            theta, m, v, t = (x.copy() if isinstance(x, np.ndarray) else x for x in state)
            start, hit, held, n = split(state[0]), 0, 0, 0
            for b in bs:
                y = b.extra[:, 0].astype(int)
                out = np.maximum(b.times(start[0][:-1]) + start[0][-1], 0) @ start[1][:-1] + start[1][-1]
                apart = np.arange(len(b)) % 10 == 9
                hit, held, n = hit + int((out.argmax(axis=1) == y)[apart].sum()), held + int(apart.sum()), n + len(b)
                for at in range(0, len(b), batch):
                    rows = np.arange(at, min(at + batch, len(b)))
                    grad, t = gradient(theta, b, rows, y[rows]), t + 1
                    m = 0.9 * m + 0.1 * grad
                    v = 0.999 * v + 0.001 * grad * grad
                    theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            return np.concatenate([theta * n, m * n, v * n, [t * n, hit, held, n]]) if n else None

        m, v, t, size = np.zeros_like(theta), np.zeros_like(theta), 0.0, len(theta)
        best, kept, stale, seen = -1.0, theta, 0, []
        for _ in range(g("maxIter") + 1):  # the last pass only scores
            got = blocks.fold((theta, m, v, t), epoch, 3 * size + 4)
            tn, hit, held, n = got[-4:]
            accuracy = hit / held if held else 0.0
            seen.append(float(accuracy))
            stale = stale + 1 if accuracy < best + g("tol") else 0
            if accuracy > best or not held:
                best, kept = accuracy, theta
            if not n or stale >= 10:
                break
            theta, m, v, t = got[:size] / n, got[size:2 * size] / n, got[2 * size:3 * size] / n, tn / n
        return ReluNetModel(list(split(kept)), seen, **self._names())


class Voting(Estimator, _Base):
    """Hard voting (M12): the members are fitted on the same features, the most
    frequent prediction wins, of equally frequent ones the smallest label."""

    def __init__(self, members: dict[str, Estimator] | None = None, predictionCol: str = "prediction"):
        super().__init__()
        self.members = dict(members or {})
        self._set(predictionCol=predictionCol)

    def _fit(self, df: DataFrame) -> "VotingModel":
        models, made = [], {}
        try:
            for e in self.members.values():
                if not isinstance(e, LinearOvR):
                    models.append(e.fit(df))
                    continue
                key = e.getFeaturesCol(), e.getLabelCol()   # the linear members read the same blocks
                if key not in made:
                    made[key] = sparse_blocks(df, key[0], [key[1]], rows_per_task=ROWS_PER_PASS)
                models.append(e.fit_blocks(made[key]))
        finally:
            for blocks in made.values():
                blocks.release()
        return VotingModel(list(self.members), models, self.getPredictionCol())


def majority(votes: Column) -> Column:
    """The most frequent value of an array column, of ties the smallest."""
    counted = F.transform(votes, lambda x: F.struct(F.size(F.filter(votes, lambda y: y == x)).alias("n"), (-x).alias("least")))
    return -F.array_max(counted)["least"]


class VotingModel(Model, _Base, Saved):
    """``votes`` (array, one prediction per member) and their majority."""

    def __init__(self, names: list[str] = (), models: list = (), predictionCol: str = "prediction"):
        super().__init__()
        self.names, self.models = list(names), list(models)
        self._set(predictionCol=predictionCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        out, columns = self.getPredictionCol(), df.columns
        for i, m in enumerate(self.models):
            df = m.transform(df).withColumnRenamed(m.getPredictionCol(), f"_vote{i}")
            df = df.select(*columns, *[f"_vote{j}" for j in range(i + 1)])
        votes = F.array(*[F.col(f"_vote{i}") for i in range(len(self.models))])
        return df.select(*columns, votes.alias("votes")).withColumn(out, majority(F.col("votes")))

    def _parts(self) -> Parts:
        return Parts(plain={"names": self.names}, stages=self.models)

    @classmethod
    def _from_parts(cls, parts: Parts) -> "VotingModel":
        return cls(parts.plain["names"], parts.stages)
