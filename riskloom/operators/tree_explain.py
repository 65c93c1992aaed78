"""Additive attributions of tree ensembles.

The value of a set of features is the expected output of a tree when these
features are known and every other split is averaged by the training rows on
either side. Attributions are the Shapley values of that game. A leaf takes part
in it as a product over the features on its path, one factor each, so its share
for one feature is an integral of a polynomial of low degree in one variable,
which Gauss-Legendre points give exactly. The cost grows with leaves, path
length and points; no subset of features is listed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name

# task functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers in the arrays that a batch of rows makes at one time, and rows of the long result per batch.
BLOCK, LONG_ROWS = 2_000_000, 200_000


@dataclass(frozen=True)
class Tree:
    """A binary tree in flat lists. Node 0 is the root; ``feature`` is -1 at leaves.

    Rows with ``value <= threshold`` go left, all others (missing values too) right. ``cover`` is the weight of the
    training rows at a node (where it is 0 both children count alike), ``value`` what a leaf adds to the margin.
    """

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    cover: list[float]


@dataclass(frozen=True)
class _Paths:
    """All leaves whose paths use the same number of features: the interval and the averaged share of each feature."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    zero: np.ndarray
    value: np.ndarray


@dataclass(frozen=True)
class TreeEnsemble:
    """Trees whose leaf values add up to the margin of a row."""

    features: list[str]
    trees: list[Tree]

    @cached_property
    def paths(self) -> list[_Paths]:
        found: dict[int, list] = {}
        for tree in self.trees:
            walk = [(0, {})]
            while walk:
                node, path = walk.pop()
                f = tree.feature[node]
                if f < 0:
                    rows = [(k, *v) for k, v in sorted(path.items())]
                    found.setdefault(len(rows), []).append((rows, tree.value[node]))
                    continue
                low, high, zero = path.get(f, (-np.inf, np.inf, 1.0))
                at = tree.threshold[node]
                for child, bounds in ((tree.left[node], (low, min(high, at))), (tree.right[node], (max(low, at), high))):
                    share = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.5
                    walk.append((child, {**path, f: (*bounds, zero * share)}))
        out = []
        for size, leaves in sorted(found.items()):
            table = np.array([r for r, _ in leaves], dtype=float).reshape(len(leaves), size, 4)
            out.append(_Paths(table[:, :, 0].astype(np.int64), *(table[:, :, k] for k in (1, 2, 3)), np.array([v for _, v in leaves])))
        return out

    @property
    def base(self) -> float:
        """The margin expected when nothing is known of a row."""
        return float(sum((p.zero.prod(axis=1) * p.value).sum() for p in self.paths))

    def _blocks(self, x: np.ndarray):
        for p in self.paths:
            step = max(1, BLOCK // max(1, p.feature.size))
            for a in range(0, len(x), step):
                values = x[a:a + step][:, p.feature]
                # a missing value is in no "at most", hence above every threshold
                yield p, slice(a, a + step), ((p.low == -np.inf) | ~(values <= p.low)) & ((p.high == np.inf) | (values <= p.high))

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Output of each row; a row reaches one leaf of every tree."""
        out = np.zeros(len(x))
        for p, rows, inside in self._blocks(x):
            out[rows] += inside.all(axis=2) @ p.value
        return out

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """One number per row and feature; with ``base`` they add up to the margin of the row."""
        out = np.zeros((len(x), len(self.features)))
        for p, rows, inside in self._blocks(x):
            size = p.feature.shape[1]
            if not size:
                continue
            points, weights = np.polynomial.legendre.leggauss((size + 1) // 2)
            one = inside.astype(float)
            share = np.zeros_like(one)
            for t, w in zip((points + 1) / 2, weights / 2):
                factor = p.zero * (1 - t) + one * t
                others = np.ones_like(factor)
                others[:, :, 1:] = factor[:, :, :-1].cumprod(axis=2)
                others[:, :, :-1] *= factor[:, :, :0:-1].cumprod(axis=2)[:, :, ::-1]
                share += w * others
            parts = (p.value[:, None] * (one - p.zero) * share).reshape(len(one), -1)
            order = np.argsort(p.feature.ravel(), kind="stable")
            used, first = np.unique(p.feature.ravel()[order], return_index=True)
            out[rows, used] += np.add.reduceat(parts[:, order], first, axis=1)
        return out


def from_spark(model, features: Sequence[str]) -> TreeEnsemble:
    """The trees of a fitted Spark model as lists.

    Boosted classifiers add to their margin (half the log odds), regressors to the prediction, forests and single
    classification trees to the probability of class 1.
    """
    trees = list(getattr(model, "trees", [model]))
    weights = list(getattr(model, "treeWeights", [1.0]))
    if type(model).__name__.startswith("RandomForest"):
        weights = [1.0 / len(trees)] * len(trees)
    return TreeEnsemble(list(features), [_flat(tree, float(w)) for tree, w in zip(trees, weights)])


def _flat(model, weight: float) -> Tree:
    classes = "Classification" in type(model).__name__
    feature, threshold, left, right, value, cover = [], [], [], [], [], []
    waiting = [(model._call_java("rootNode"), None, None)]
    while waiting:
        node, parent, side = waiting.pop()
        here = len(feature)
        if parent is not None:
            side[parent] = here
        stats, inner = node.impurityStats(), node.getClass().getSimpleName() == "InternalNode"
        cover.append(float(stats.count()))
        left.append(-1)
        right.append(-1)
        if inner:
            split = node.split()
            if split.getClass().getSimpleName() != "ContinuousSplit":
                raise ValueError("only splits at thresholds can be explained; index categories as numbers or codes")
            feature.append(split.featureIndex())
            threshold.append(split.threshold())
            value.append(0.0)
            waiting += [(node.rightChild(), here, right), (node.leftChild(), here, left)]
        else:
            feature.append(-1)
            threshold.append(0.0)
            counts = list(stats.stats()) if classes else None
            value.append(weight * (counts[1] / sum(counts) if classes and len(counts) > 1 else node.prediction()))
    return Tree(feature, threshold, left, right, value, cover)


def with_covers(df: DataFrame, ensemble: TreeEnsemble) -> TreeEnsemble:
    """The same trees with the rows of ``df`` as training rows, counted in one pass."""
    counts, places = [], []
    for t, tree in enumerate(ensemble.trees):
        walk = [(0, "TRUE")]
        while walk:
            node, inside = walk.pop()
            places.append((t, node))
            counts.append(F.expr(f"count_if({inside})").alias(f"n{len(counts)}"))
            if tree.feature[node] >= 0:
                low = f"coalesce(CAST({name(ensemble.features[tree.feature[node]])} AS DOUBLE) <= {tree.threshold[node]!r}D, FALSE)"
                walk += [(tree.left[node], f"{inside} AND {low}"), (tree.right[node], f"{inside} AND NOT {low}")]
    row = df.agg(*counts).first()
    covers = [[0.0] * len(tree.feature) for tree in ensemble.trees]
    for i, (t, node) in enumerate(places):
        covers[t][node] = float(row[i])
    return TreeEnsemble(ensemble.features, [Tree(t.feature, t.threshold, t.left, t.right, t.value, c) for t, c in zip(ensemble.trees, covers)])


def tree_contributions(df: DataFrame, ensemble: TreeEnsemble, key: str) -> DataFrame:
    """(key, feature, value, contribution), one row per row of ``df`` and feature; no shuffle.

    The contributions of a row and ``ensemble.base`` add up to its margin. Null values are missing and go right.
    """
    features = ensemble.features
    ensemble.paths  # built once here, not in every task

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(features, pa.string())
        step = max(1, LONG_ROWS // max(1, len(features)))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                given = batch.column(1).flatten()
                x = given.to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(features))
                n = np.repeat(np.arange(batch.num_rows), len(features))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(n)), names.take(pa.array(np.tile(np.arange(len(features)), batch.num_rows))), given,
                     pa.array(ensemble.contributions(x).ravel())], [key, "feature", "value", "contribution"])

    kind = df.schema[key].dataType.simpleString()
    values = ", ".join(f"CAST({name(c)} AS DOUBLE)" for c in features)
    return df.select(as_column(key), F.expr(f"array({values})").alias("values")).mapInArrow(
        rows, f"{name(key)} {kind}, feature string, value double, contribution double")
