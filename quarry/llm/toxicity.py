"""Toxic passages by maximum-scoring segment search.

Token log-odds between toxic and clean documents, shrunk by an informative
Dirichlet prior, are scanned in linear time for every maximal segment of
positive score.  Segment scores of clean text follow an extreme-value law, so
a segment's expected number of chance equals in a text of n words is
K n exp(-lambda S); the evidence of the significant ones is summed and a
logistic curve turns it into a probability.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, materialize, texts_of
from .decontaminate import original_spans, words_of

#: Labelled documents of each class that are fitted on, at most in expectation.
MAX_ROWS_PER_CLASS = 20_000
PRIOR_STRENGTH = 500.0
MIN_LOG_ODDS = 1.0
#: A word tells if, of all words tested, this many such would be expected by chance.
FALSE_WORDS = 1.0
#: A passage is significant if a clean text of its length has at most so many of its score by chance.
MAX_E_VALUE = 1.0
THRESHOLD = 0.3


@dataclass
class Model:
    """Scores of the words that tell (all others score ``rest``), the
    extreme-value parameters and the calibration curve."""
    words: dict[bytes, float] = field(default_factory=dict)
    rest: float = -0.01
    lam: float = 1.0
    k: float = 0.1
    curve: tuple[float, float, float] = (-2.0, 0.0, 0.0)


def segments(at: list[int], scores: list[float], rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, [start, end) in words, of a text whose
    word ``at[i]`` scores ``scores[i]`` and whose other words score ``rest`` < 0
    (linear-time search over cumulative scores)."""
    found: list[list[float]] = []  # start, end, score before, score up to the end
    total, before = 0.0, 0
    for p, s in zip(at, scores):
        total += rest * (p - before)
        before = p + 1
        if s <= 0:
            total += s
            continue
        new = [p, p + 1, total, total + s]
        total += s
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
        found.append(new)
    return [(int(a), int(b), r - left) for a, b, left, r in found]


def evidence(words: list[bytes], m: Model) -> tuple[float, float, list[tuple[int, int, float]]]:
    """Summed evidence of the significant segments, the best segment score, and
    those segments."""
    at = [i for i, w in enumerate(words) if w in m.words]
    if not at:
        return 0.0, 0.0, []
    all_ = segments(at, [m.words[words[i]] for i in at], m.rest)
    chance = np.log(max(m.k * len(words), 1e-300))
    good = [(a, b, s) for a, b, s in all_ if m.lam * s - chance >= -np.log(MAX_E_VALUE)]
    return float(sum(m.lam * s - chance for _, _, s in good)), max((s for *_, s in all_), default=0.0), good


def probability(x: np.ndarray, curve: tuple[float, float, float]) -> np.ndarray:
    a, b, c = curve
    return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(x) + c * (x > 0), -30, 30)))


def _log_odds(counts: list[tuple[bytes, float, float]], tested: int) -> tuple[dict[bytes, float], float, float]:
    """Scores of telling words, the score of all others, and lambda.  A word
    tells if the likelihood ratio of its two counts against one common rate is
    significant among all words tested."""
    n1, n0 = (sum(c[k] for c in counts) for k in (1, 2))
    if not n1 or not n0:
        return {}, -0.01, 1.0
    both, scores, rest1, rest0 = n1 + n0, {}, 0.0, 0.0
    clean: list[tuple[float, float]] = []
    for w, c1, c0 in counts:
        if not w:  # the pool of all words that are not told apart
            rest1, rest0 = rest1 + c1, rest0 + c0
            continue
        prior = PRIOR_STRENGTH * (c1 + c0) / both
        d = (np.log((c1 + prior) / (n1 + PRIOR_STRENGTH - c1 - prior)) - np.log((c0 + prior) / (n0 + PRIOR_STRENGTH - c0 - prior)))
        e1, e0 = n1 * (c1 + c0) / both, n0 * (c1 + c0) / both
        half_g2 = (c1 * np.log(c1 / e1) if c1 else 0.0) + (c0 * np.log(c0 / e0) if c0 else 0.0)
        if abs(d) >= MIN_LOG_ODDS and half_g2 >= np.log(max(tested, 1) / FALSE_WORDS):
            scores[w] = float(d)
            clean.append((c0 / n0, float(d)))
        else:
            rest1, rest0 = rest1 + c1, rest0 + c0
    rest = min(float(np.log(max(rest1, 0.5) / n1) - np.log(max(rest0, 0.5) / n0)), -1e-4)
    p = np.array([max(1 - sum(q for q, _ in clean), 1e-9), *(max(q, 0.1 / n0) for q, _ in clean)])
    s = np.array([rest, *(d for _, d in clean)])
    low, high = 1e-3, 8.0
    for _ in range(60):  # the positive root of E exp(lambda s) = 1 in clean text
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * s)).sum() < p.sum() else (low, mid)
    return scores, rest, low if scores else 1.0


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """Weighted logistic curve in log1p(x) and [x > 0], lightly penalised."""
    feats = np.stack([np.ones_like(x), np.log1p(x), (x > 0).astype(float)], 1)
    beta, penalty = np.zeros(3), np.diag([1e-6, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(feats @ beta, -30, 30)))
        h = feats.T @ (feats * (w * p * (1 - p))[:, None]) + penalty
        step = np.linalg.solve(h, feats.T @ (w * (y - p)) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), max(float(beta[1]), 0.0), float(beta[2])


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> tuple[DataFrame, dict[int, float]]:
    """Whole texts of the labelled training documents (the held-out ones never
    among them): ``text, toxic, fold``, at most about ``max_rows`` of each class,
    chosen by a hash of the doc_id; and the rate at which each class was taken.
    A document with several labels is toxic if any says so; null labels are
    none."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.where(~held_out("_id", 4, 2)).groupBy("_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = materialize(known)
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {c: min(1.0, max_rows / n) for c, n in count.items()}
    draw = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = known.where(draw < F.when(F.col("toxic") == 1, rate.get(1, 1.0)).otherwise(rate.get(0, 1.0)))
    # Bounded by 2 * max_rows ids.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(taken), F.col("doc_id") == F.col("_id"))
    return rows.select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).cast("int").alias("fold")), rate


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> Model:
    """Train on the labelled, not held-out documents.  Without both classes the
    model is flat."""
    rows, rate = training_rows(docs, labels, max_rows)
    rows = materialize(rows)

    def count(cols):
        sums: Counter = Counter()
        for t, y, f in zip(texts_of(cols["text"]), cols["toxic"].to_pylist(), cols["fold"].to_pylist()):
            sums.update((w, y, f) for w in set(words_of(t)))
        return {"word": [k[0] for k in sums], "toxic": [k[1] for k in sums], "fold": [k[2] for k in sums], "n": list(sums.values())}

    by = map_batches(rows, count, "word binary, toxic int, fold int, n long").groupBy("word").agg(
        *[F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"n{y}{f}") for y in (0, 1) for f in (0, 1)])
    by = materialize(by)
    total = by.agg(*[F.sum(f"n{y}{f}").alias(f"n{y}{f}") for y in (0, 1) for f in (0, 1)],
                   F.sum(F.when(F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11") >= 5, 1).otherwise(0)).alias("tested")).first()
    if total[0] is None or not (total["n10"] + total["n11"]) or not (total["n00"] + total["n01"]):
        return Model(curve=(-30.0 if 1 not in rate else 30.0 if 0 not in rate else -2.0, 0.0, 0.0))

    def words(folds: tuple[int, ...]) -> Model:
        c1, c0 = (sum(F.col(f"n{y}{f}") for f in folds) for y in (1, 0))
        t1, t0 = (sum(total[f"n{y}{f}"] for f in folds) for y in (1, 0))
        # A wide net for words that may tell; the rest is summed in Spark.
        lift = F.abs(F.log((c1 + 0.5) / (t1 + 1.0)) - F.log((c0 + 0.5) / (t0 + 1.0))) >= MIN_LOG_ODDS / 2
        wide = lift & (c1 + c0 >= 5)
        found = [(bytes(r[0]), float(r[1]), float(r[2])) for r in by.where(wide).select("word", c1, c0).collect()]
        r1, r0 = t1 - sum(x[1] for x in found), t0 - sum(x[2] for x in found)
        scores, rest, lam = _log_odds([*found, (b"", r1, r0)], total["tested"])
        return Model(words=scores, rest=rest, lam=lam)

    def judged(models: list[Model]) -> tuple[np.ndarray, ...]:
        """Length, best segment and evidence of each training text under the
        model of the other fold."""
        sent = docs.sparkSession.sparkContext.broadcast(models)

        def f(cols):
            out = {"n": [], "best": [], "x": [], "toxic": cols["toxic"]}
            for t, fold in zip(texts_of(cols["text"]), cols["fold"].to_pylist()):
                w = words_of(t)
                x, best, _ = evidence(w, sent.value[1 - fold])
                out["n"].append(len(w))
                out["best"].append(best)
                out["x"].append(x)
            return out
        got = map_batches(rows, f, "n long, best double, x double, toxic int").collect()  # bounded by 2 * max_rows
        return tuple(np.array([r[i] for r in got], float) for i in range(4))

    halves = [words((0,)), words((1,))]
    n, best, _, y = judged(halves)
    clean = (y == 0) & (n > 0)
    for m in halves:
        m.k = float(clean.sum() / max((n[clean] * np.exp(-m.lam * best[clean])).sum(), 1e-9)) if clean.any() else 0.1
    _, _, x, y = judged(halves)
    weight = np.where(y == 1, 1 / rate.get(1, 1.0), 1 / rate.get(0, 1.0))
    model = words((0, 1))
    model.k, model.curve = (halves[0].k + halves[1].k) / 2, _logistic(x, y, weight)
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, rk`` (xxhash64 of the text), ``score``
    (0 to 1), ``predicted`` and ``passages``: the significant segments as
    struct(start, end, score) in characters of the original text.

    Null, empty and wordless texts have no evidence and get the curve's value
    at zero.  Each row is judged alone, so repeats and ties need no rule."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def f(cols):
        m, x, passages = sent.value, [], []
        for t in texts_of(cols["text"]):
            value, _, good = evidence(words_of(t), m)
            x.append(value)
            spans = original_spans(t, [(a, b) for a, b, _ in good])
            passages.append([{"start": s, "end": e, "score": g[2]} for (s, e), g in zip(spans, good)])
        p = probability(np.array(x, float), m.curve)
        return {"doc_id": cols["doc_id"], "rk": cols["rk"], "score": p, "predicted": (p >= THRESHOLD).astype(np.int32), "passages": passages}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("rk"),
                       F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, f, "doc_id long, rk long, score double, predicted int, passages array<struct<start:int,end:int,score:double>>")


def toxicity_report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> DataFrame:
    """Train, then score every document: ``doc_id, held_out, score, predicted, n_passages``."""
    scored = score_documents(docs, fit(docs, labels, max_rows))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic, all columns kept."""
    bad = score_documents(docs, fit(docs, labels, max_rows)).where("predicted = 1").select(
        F.col("doc_id").alias("_bad_id"), F.col("rk").alias("_bad_key")).distinct()
    bad = materialize(bad)
    rk = F.xxhash64(docs["text"].cast("string"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]) & (rk == bad["_bad_key"]), "left_anti")
