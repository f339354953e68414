"""Language identification by a string kernel.

A text is the set of its character n-grams (lengths 1 to 3, non-letters folded
to a blank); the blended-spectrum presence kernel of two texts is the number
of n-grams that both have, over the root of the product of their set sizes.
Nystroem landmarks give its feature map, ridge regression fits one column per
language, and batches are scored by one product of their presence rows with
the folded matrix landmarks x weights.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, materialize

MAX_N = 3
#: Documents that serve as landmarks, and that the ridge is fitted on, at most in expectation.
LANDMARKS = 200
FIT_ROWS = 4000
RIDGE = 1.0
_BLOCK = 1 << 20
_OTHER = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> np.ndarray | None:
    """Sorted distinct n-grams as 63-bit codes (three code points of 21 bits,
    plus one, so that shorter n-grams differ); None without a letter."""
    if not text:
        return None
    clean = _OTHER.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, clean)):
        return None
    points = np.frombuffer(f" {clean} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    parts = []
    for at in range(0, len(points), _BLOCK):
        p = points[at:at + _BLOCK + MAX_N - 1]
        for n in range(1, MAX_N + 1):
            if len(p) >= n:
                code = p[:len(p) - n + 1].copy()
                for k in range(1, n):
                    code = (code << 21) | p[k:len(p) - n + 1 + k]
                parts.append(np.unique(code))
    return np.unique(np.concatenate(parts))


@dataclass
class Model:
    langs: list[str]
    vocab: np.ndarray  # sorted n-gram codes of the landmarks
    weights: np.ndarray  # n-grams x columns
    bias: np.ndarray | float = 0.0

    def products(self, sets: list[np.ndarray]) -> np.ndarray:
        """Presence rows of a batch times the matrix, over the root of each set's size."""
        size = np.array([len(s) for s in sets])
        row, code = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
        at = np.minimum(np.searchsorted(self.vocab, code), len(self.vocab) - 1)
        known = self.vocab[at] == code
        row, at = row[known], at[known]
        out = np.stack([np.bincount(row, self.weights[at, c], len(sets)) for c in range(self.weights.shape[1])], 1)
        return out / np.sqrt(size)[:, None]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))


def fit(docs: DataFrame, landmarks: int = LANDMARKS, fit_rows: int = FIT_ROWS, ridge: float = RIDGE) -> Model | None:
    """Train on the documents that are not held out and have a text and a
    language; None without any.  Both samples are equal parts of each language,
    drawn by a hash of the doc_id; whole texts are used."""
    known = _rows(docs).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", 4, 2))
    count = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not count:
        return None
    langs = sorted(count)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.create_map(*[x for l in langs for x in (F.lit(l), F.lit(fit_rows / len(langs) / count[l]))])
    rows = known.where(draw < rate[F.col("lang")]).withColumn("draw", draw / rate[F.col("lang")])

    def sets(cols):
        got = [grams(t) for t in cols["text"].to_pylist()]
        keep = [i for i, g in enumerate(got) if g is not None]
        lang, d = cols["lang"].to_pylist(), cols["draw"].to_pylist()
        return {"grams": [got[i] for i in keep], "lang": [lang[i] for i in keep], "draw": [d[i] for i in keep]}
    rows = materialize(map_batches(rows.select("text", "lang", "draw"), sets, "grams array<long>, lang string, draw double"))
    share = landmarks / fit_rows
    marks = [(np.array(r["grams"], np.int64), r["lang"]) for r in rows.where(F.col("draw") < share).collect()]
    if len(marks) < min(2 * len(langs), 8):  # few rows: all of them are landmarks
        marks = [(np.array(r["grams"], np.int64), r["lang"]) for r in rows.orderBy("draw").limit(landmarks).collect()]
    if not marks:
        return None
    vocab = np.unique(np.concatenate([g for g, _ in marks]))
    b = np.zeros((len(vocab), len(marks)))
    for j, (g, _) in enumerate(marks):
        b[np.searchsorted(vocab, g), j] = 1 / np.sqrt(len(g))
    to_marks = docs.sparkSession.sparkContext.broadcast(Model(langs, vocab, b))

    def kernel(cols):
        k = to_marks.value.products([np.array(x, np.int64) for x in cols["grams"].to_pylist()])
        return {"lang": cols["lang"], "k": list(k)}
    got = map_batches(rows.select("grams", "lang"), kernel, "lang string, k array<double>").collect()  # bounded by fit_rows x landmarks
    k_nm = np.array([r["k"] for r in got])
    y = np.array([[1.0 if r["lang"] == l else 0.0 for l in langs] for r in got])
    value, vector = np.linalg.eigh(b.T @ b)
    root = vector / np.sqrt(np.maximum(value, 1e-8)) * (value > 1e-8)
    phi = np.hstack([k_nm @ root, np.ones((len(k_nm), 1))])
    w = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]) * np.append(np.ones(len(root.T)), 0.0)[:, None]
                        + 1e-9 * np.eye(phi.shape[1]), phi.T @ y)
    return Model(langs, vocab, b @ (root @ w[:-1]), w[-1])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    Only the text is looked at.  Null texts and texts without a letter are
    ``und`` with score 0 (so is everything without a model).  Each row is
    judged alone; equal best scores go to the language first in the alphabet."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def f(cols):
        m, got = sent.value, [grams(t) for t in cols["text"].to_pylist()]
        keep = [i for i, g in enumerate(got) if g is not None] if m else []
        lang, score = ["und"] * len(got), np.zeros(len(got))
        if keep:
            s = np.clip(m.products([got[i] for i in keep]) + m.bias, 1e-6, None)
            s /= s.sum(axis=1, keepdims=True)
            for i, k, v in zip(keep, s.argmax(axis=1), s.max(axis=1)):
                lang[i], score[i] = m.langs[k], v
        return {"doc_id": cols["doc_id"], "lang_pred": lang, "score": score}
    out = map_batches(_rows(docs).select("doc_id", "text"), f, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, **kw) -> DataFrame:
    return predict(docs, fit(docs, **kw))
