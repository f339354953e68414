"""Attributions of tree ensembles (Q15): path-dependent Shapley values.

A leaf pays its value to a coalition S of features as the product, over the
features on its path, of 1 or 0 for those in S (does the row follow the path
at that feature?) and of the share of training rows that follow it for the
others.  The Shapley values of such a product are sums over coalition sizes,
which one polynomial per leaf and batch of rows gives, so all rows of a batch
go through a leaf in a few array operations.  Over all leaves they sum to the
row's prediction less the mean prediction.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np
from pyspark.sql import DataFrame

from quarry.operators.blocks import ROWS_PER_PASS, Blocks, sparse_blocks


@dataclass
class Leaf:
    """Per feature of its path: an interval (low, high] and the share of rows
    that stay in it; ``value`` per class."""
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def forest_leaves(model) -> list[Leaf]:
    """The leaves of a fitted MLlib forest or tree with continuous features;
    values are class shares (or the prediction) over the number of trees."""
    trees = list(getattr(model, "trees", [model]))
    classes = getattr(model, "numClasses", 1)
    out: list[Leaf] = []

    def walk(node, path):
        stats = node.impurityStats()
        count = float(stats.count())
        if not hasattr(node, "leftChild") or node.getClass().getSimpleName() == "LeafNode":
            if classes > 1:
                v = np.asarray(list(stats.stats()), float)
                value = v / max(v.sum(), 1e-300) / len(trees)
            else:
                value = np.array([float(node.prediction())]) / len(trees)
            out.append(_leaf(path, value))
            return
        split, left, right = node.split(), node.leftChild(), node.rightChild()
        f, at = split.featureIndex(), float(split.threshold())
        walk(left, [*path, (f, -np.inf, at, float(left.impurityStats().count()) / count)])
        walk(right, [*path, (f, at, np.inf, float(right.impurityStats().count()) / count)])

    for t in trees:
        walk(t._java_obj.rootNode(), [])
    return out


def _leaf(path: list[tuple], value: np.ndarray) -> Leaf:
    by: dict[int, list[float]] = {}
    for f, low, high, share in path:
        was = by.get(f, [-np.inf, np.inf, 1.0])
        by[f] = [max(was[0], low), min(was[1], high), was[2] * share]
    side = np.array([by[f] for f in by], float).reshape(-1, 3)
    return Leaf(np.array(list(by), int), side[:, 0], side[:, 1], side[:, 2], value)


def base_value(leaves: list[Leaf]) -> np.ndarray:
    """The mean prediction over the training rows."""
    return sum(leaf.share.prod() * leaf.value for leaf in leaves)


def attributions(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """rows x features x classes."""
    out = np.zeros((*x.shape, len(leaves[0].value)))
    for leaf in leaves:
        m = len(leaf.features)
        if not m:
            continue
        at = x[:, leaf.features]
        follows = ((at > leaf.low) & (at <= leaf.high)).astype(float)
        weight = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
        for j in range(m):
            # by coalition size: the sum, over coalitions of the other features, of what the path pays
            paid = np.zeros((len(x), m))
            paid[:, 0] = 1
            for i in range(m):
                if i != j:
                    paid[:, 1:] = paid[:, 1:] * leaf.share[i] + paid[:, :-1] * follows[:, i, None]
                    paid[:, 0] *= leaf.share[i]
            gain = (follows[:, j] - leaf.share[j]) * (paid @ weight)
            out[:, leaf.features[j], :] += gain[:, None] * leaf.value
    return out


def mean_absolute(model, df: DataFrame, features: str = "features", batch: int = 512) -> np.ndarray:
    """Mean |attribution| of every feature over rows and classes."""
    leaves = forest_leaves(model)
    classes, blocks = len(leaves[0].value), sparse_blocks(df, features, rows_per_task=ROWS_PER_PASS)
    try:
        return _summed(blocks, leaves, batch) / max(1, blocks.n * classes)
    finally:
        blocks.release()


def _summed(blocks: Blocks, leaves: list[Leaf], batch: int) -> np.ndarray:
    width = blocks.width

    def step(leaves, bs):
        total = np.zeros(width)
        for b in bs:
            x = np.zeros((len(b), width))
            x[b.rows(), b.indices] = b.data
            for i in range(0, len(x), batch):
                total += np.abs(attributions(leaves, x[i:i + batch])).sum(axis=(0, 2))
        return total

    return blocks.fold(leaves, step, width)
