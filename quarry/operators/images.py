"""Image jobs: per-image numpy kernels run inside Spark
tasks over Arrow batches of the ``image`` source; grouping, sampling and
joins are ordinary DataFrame operators.

Pixel data is BGR, row-major (Spark image source layout)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------------------
# numpy kernels (one image at a time, called inside mapInArrow)
# ---------------------------------------------------------------------------
def to_array(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        a = np.repeat(a, 3, axis=2)
    return a[:, :, :3]


def resize_bilinear(img: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear resize with half-pixel centres (OpenCV INTER_LINEAR rule)."""
    src_h, src_w = img.shape[:2]
    ys = np.clip((np.arange(h) + 0.5) * src_h / h - 0.5, 0, src_h - 1)
    xs = np.clip((np.arange(w) + 0.5) * src_w / w - 0.5, 0, src_w - 1)
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    y1, x1 = np.minimum(y0 + 1, src_h - 1), np.minimum(x0 + 1, src_w - 1)
    wy, wx = (ys - y0)[None, None, :], (xs - x0)[None, :, None]
    # Each channel lies by itself, column by column, and only the rows that are needed
    # are interpolated along x, once.
    rows, at = np.unique(np.concatenate([y0, y1]), return_inverse=True)
    f = np.ascontiguousarray(img[rows].transpose(2, 1, 0), dtype=np.float64)
    f = f.take(x0, axis=1) * (1 - wx) + f.take(x1, axis=1) * wx
    return (f.take(at[:h], axis=2) * (1 - wy) + f.take(at[h:], axis=2) * wy).transpose(2, 1, 0)


def gray(bgr: np.ndarray) -> np.ndarray:
    return 0.114 * bgr[:, :, 0] + 0.587 * bgr[:, :, 1] + 0.299 * bgr[:, :, 2]


def laplacian_var(g: np.ndarray) -> float:
    """Variance of the 4-neighbour Laplacian (reflect-101 borders)."""
    p = np.pad(g, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    return float(lap.var())


def colorfulness(bgr: np.ndarray) -> float:
    b, g, r = bgr[:, :, 0], bgr[:, :, 1], bgr[:, :, 2]
    rg = np.abs(r - g)
    yb = np.abs(0.5 * (r + g) - b)
    return float(np.sqrt(rg.std() ** 2 + yb.std() ** 2) + 0.3 * np.sqrt(rg.mean() ** 2 + yb.mean() ** 2))


def saturation(bgr: np.ndarray) -> float:
    b, g, r = bgr[:, :, 0], bgr[:, :, 1], bgr[:, :, 2]
    mx, mn = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    s = np.where(mx > 0, (mx - mn) / np.where(mx > 0, mx, 1) * 255.0, 0.0)
    return float(s.mean())


def quality_metrics(img: np.ndarray, size: int = 256) -> dict:
    """I2 per-image metrics on a size × size resize."""
    r = resize_bilinear(img, size, size)
    g = gray(r)
    return {"brightness": round(float(g.mean()), 2), "sharpness": round(laplacian_var(g), 2),
            "contrast": round(float(g.std()), 2), "colorfulness": round(colorfulness(r), 2),
            "saturation": round(saturation(r), 2), "r_mean": round(float(r[:, :, 2].mean()), 1),
            "g_mean": round(float(r[:, :, 1].mean()), 1), "b_mean": round(float(r[:, :, 0].mean()), 1)}


def _lloyd(px: np.ndarray, k: int, iters: int, rng) -> tuple[float, np.ndarray, np.ndarray]:
    """One start of k-means: (inertia, centres, cluster sizes)."""
    centres = [px[rng.randint(len(px))]]
    for _ in range(1, k):
        d = np.min(((px[:, None, :] - np.array(centres)[None]) ** 2).sum(-1), axis=1)
        tot = d.sum()
        centres.append(px[rng.choice(len(px), p=d / tot)] if tot > 0 else px[rng.randint(len(px))])
    c = np.array(centres, dtype=np.float64)
    for _ in range(iters):
        lab = np.argmin(((px[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
        new = np.array([px[lab == j].mean(0) if np.any(lab == j) else c[j] for j in range(k)])
        if np.allclose(new, c):
            break
        c = new
    d = ((px[:, None, :] - c[None]) ** 2).sum(-1)
    return float(d.min(axis=1).sum()), c, np.bincount(np.argmin(d, axis=1), minlength=k)


def dominant_colors(img: np.ndarray, k: int = 3, size: int = 64, iters: int = 300, seed: int = 42, starts: int = 5) -> list:
    """K-means (Lloyd, k-means++ starts, the one of least inertia) on the
    RGB pixels of a size × size resize; centres ordered by cluster size."""
    px = resize_bilinear(img, size, size)[:, :, ::-1].reshape(-1, 3)
    rng = np.random.RandomState(seed)
    _, c, counts = min((_lloyd(px, k, iters, rng) for _ in range(starts)), key=lambda x: x[0])
    return [[int(v) for v in c[j]] for j in np.argsort(-counts, kind="stable")]


# ---------------------------------------------------------------------------
# Spark jobs
# ---------------------------------------------------------------------------
QUALITY_FIELDS = ["brightness", "sharpness", "contrast", "colorfulness", "saturation", "r_mean", "g_mean",
                  "b_mean"]


def _per_image(images: DataFrame, key_cols, fields: list[T.StructField], rows_of) -> DataFrame:
    """``rows_of(image)``'s rows of ``fields`` for every image, behind its key
    columns; the keys stay Arrow columns."""
    keys = list(key_cols)
    schema = T.StructType([images.schema[k] for k in keys] + fields)
    types = [pa.float64() if isinstance(f.dataType, T.DoubleType) else pa.int32() for f in fields]

    def run(batches):
        for b in batches:
            at, found = [], []
            pixels = zip(b.column("data"), *(b.column(c).to_pylist() for c in ("height", "width", "channels")))
            for i, (data, h, w, c) in enumerate(pixels):
                rows = rows_of(to_array(data.as_py(), h, w, c))
                at += [i] * len(rows)
                found += rows
            values = list(zip(*found)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [b.column(k).take(pa.array(at, pa.int64())) for k in keys] + [pa.array(v, t) for v, t in zip(values, types)],
                names=keys + [f.name for f in fields])
    return images.select(*keys, "data", "height", "width", "channels").mapInArrow(run, schema)


def image_quality(images: DataFrame, key_cols=("path",)) -> DataFrame:
    """Quality metrics per image (Arrow batches, numpy per image)."""
    def rows_of(img):
        m = quality_metrics(img)
        return [[m[f] for f in QUALITY_FIELDS]]
    return _per_image(images, key_cols, [T.StructField(f, T.DoubleType()) for f in QUALITY_FIELDS], rows_of)


def image_dominant_colors(images: DataFrame, key_cols=("path",), k: int = 3) -> DataFrame:
    """Dominant colours per image as (rank, r, g, b) rows."""
    def rows_of(img):
        return [(i, *colour) for i, colour in enumerate(dominant_colors(img, k))]
    return _per_image(images, key_cols, [T.StructField(f, T.IntegerType()) for f in ("rank", "r", "g", "b")], rows_of)


def embed_images(images: DataFrame, make_model, out: str = "embedding", dim: int = 8,
                 size: int = 32, batch_size: int = 64) -> DataFrame:
    """Batch feature extraction with a *given* model function (made once a
    task); ``batch_size`` images at a time are resized, scored and sent on, so
    that a task's memory does not grow with its rows."""
    fields = [f for f in images.schema if f.name != out]
    schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.FloatType()))])
    names = [f.name for f in schema]

    def run(batches):
        predict = make_model()
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                b = whole.slice(at, batch_size)
                pixels = zip(b.column("data"), *(b.column(c).to_pylist() for c in ("height", "width", "channels")))
                x = np.stack([(resize_bilinear(to_array(d.as_py(), h, w, c), size, size) / 255.0).astype(np.float32).ravel()
                              for d, h, w, c in pixels])
                y = np.asarray(predict(x), np.float32).reshape(b.num_rows, -1)
                got = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.reshape(-1)))
                yield pa.RecordBatch.from_arrays([got if n == out else b.column(n) for n in names], names=names)
    return images.mapInArrow(run, schema)


def projection_model(in_dim: int, out_dim: int = 8, seed: int = 7):
    """A fixed random projection standing in for a network (I6 tests)."""
    def make():
        w = np.random.RandomState(seed).standard_normal((in_dim, out_dim)).astype(np.float32) / np.sqrt(in_dim)

        def predict(x: np.ndarray) -> np.ndarray:
            return x @ w
        return predict
    return make
