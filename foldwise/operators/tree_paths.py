"""Exact attribution for models made of trees, in time polynomial in their depth.

The game is the usual one of trees: a coalition's value is the tree's expectation when only
its features are known, nodes on other features splitting by the share of training rows. A
leaf counts on its own: with ``z`` the shares on its path, feature by feature, and ``o`` saying
which features' conditions a row meets, feature ``j`` gets

    value * (o_j - z_j) * integral over t in (0, 1) of prod_{k != j} (z_k * (1 - t) + o_k * t)

since the integral of ``t**s * (1 - t)**(d - 1 - s)`` is the Shapley weight of ``s`` among ``d``.
The integrand is a polynomial, so Gauss-Legendre points give the integral exactly. A row only
matters through the conditions it meets; every pattern of them is worked out once per leaf, and
every cell of the thresholds once per tree if they are few.

Attributions of a row sum to its prediction less the expectation. All rows are explained, in
Arrow batches, with a model's leaves sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.regression import (DecisionTreeRegressionModel, GBTRegressionModel,
                                   RandomForestRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.errors import DataError
from foldwise.functions.names import q, qs
from foldwise.operators.boosting import BoostedTreesRegressorModel, Tree
from foldwise.operators.linear import PARTIAL_SCHEMA, merge_partials
from foldwise.operators.table import ModelTable
from foldwise.sources.settle import Scratch, shared_folder

TREE_MODELS = (DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel,
               BoostedTreesRegressorModel)
#: Features on a path up to which all patterns are worked out beforehand.
_TABLE_FEATURES = 8
#: Cells of a tree up to which the attributions of all are worked out beforehand.
_TABLE_CELLS = 1 << 14


def weighted_trees(model: Model) -> tuple[float, list[float], list[Tree]]:
    """Constant, weight of every tree, and the trees, read from the stored model."""
    if isinstance(model, BoostedTreesRegressorModel):
        return model.base, list(model.weights), list(model.trees)
    if not isinstance(model, TREE_MODELS):
        raise DataError(f"{type(model).__name__} is not made of trees")
    spark = SparkSession.active()
    scratch = Scratch(spark)
    path = f"{shared_folder(spark)}/foldwise-trees-{model.uid}"
    scratch.paths.append(path)
    try:
        model.write().overwrite().save(path)
        nodes = spark.read.parquet(f"{path}/data")
        if "nodeData" in nodes.columns:
            nodes = nodes.select("treeID", "nodeData.*")
        else:
            nodes = nodes.withColumn("treeID", F.lit(0))
        nodes = nodes.select("treeID", "id", "prediction", "rawCount", "leftChild", "rightChild",
                             "split.*").orderBy("treeID", "id").toPandas()
    finally:
        scratch.drop()
    if (nodes["numCategories"] >= 0).any():
        raise DataError("trees with categorical splits are not explained")
    trees = []
    for _, part in nodes.groupby("treeID"):
        place = {int(i): k for k, i in enumerate(part["id"])}
        child = lambda c: np.array([place.get(int(i), -1) for i in part[c]])
        threshold = [t[0] if len(t) else 0.0 for t in part["leftCategoriesOrThreshold"]]
        feature = np.where(child("leftChild") >= 0, part["featureIndex"], -1)
        trees.append(Tree(feature, np.array(threshold), child("leftChild"), child("rightChild"),
                          part["prediction"].to_numpy(), part["rawCount"].to_numpy()))
    if isinstance(model, GBTRegressionModel):
        weights = list(model.treeWeights)
    else:
        weights = [1 / len(trees)] * len(trees)
    return 0.0, weights, trees


@dataclass
class Path:
    """A leaf: its value, and per feature on its path the allowed range and share of rows."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    table: np.ndarray | None = None

    def shares(self, met: np.ndarray) -> np.ndarray:
        """What each feature gets, by patterns of conditions met."""
        d = len(self.features)
        points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
        t, w = (points + 1) / 2, weights / 2
        factor = self.share[:, None] * (1 - t) + met[:, :, None] * t
        whole = factor.prod(axis=1)
        return self.value * (met - self.share) * ((whole[:, None, :] / factor) @ w)

    def prepared(self) -> Path:
        d = len(self.features)
        if d <= _TABLE_FEATURES:
            self.table = self.shares((np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float))
        return self

    def add(self, x: np.ndarray, phi: np.ndarray) -> None:
        own = x[:, self.features]
        met = (own > self.low) & (own <= self.high)
        if self.table is not None:
            phi[:, self.features] += self.table[met @ (1 << np.arange(len(self.features)))]
        else:
            kinds, which = np.unique(met, axis=0, return_inverse=True)
            phi[:, self.features] += self.shares(kinds.astype(float))[which.ravel()]


def paths(weights: Sequence[float], trees: Sequence[Tree]) -> tuple[float, list[Path]]:
    """Expectation of the weighted sum, and the path of every leaf below a split."""
    expected, out = 0.0, []
    for weight, tree in zip(weights, trees):
        todo = [(0, {}, 1.0)]
        while todo:
            node, ranges, reach = todo.pop()
            f = int(tree.feature[node])
            if f < 0:
                value = weight * float(tree.value[node])
                expected += value * reach
                if ranges:
                    low, high, share = (np.array(v) for v in zip(*ranges.values()))
                    out.append(Path(value, np.array(list(ranges)), low, high, share).prepared())
                continue
            low, high, share = ranges.get(f, (-np.inf, np.inf, 1.0))
            cut = float(tree.threshold[node])
            for child, sides in ((int(tree.left[node]), (low, min(high, cut))),
                                 (int(tree.right[node]), (max(low, cut), high))):
                part = float(tree.cover[child]) / float(tree.cover[node])
                todo.append((child, {**ranges, f: (*sides, share * part)}, reach * part))
    return expected, out


class TreeTable:
    """Attributions of one tree by the cell its thresholds put a row in."""

    def __init__(self, tree: Tree, found: Sequence[Path], width: int):
        self.features = [int(f) for f in np.unique(tree.feature[tree.feature >= 0])]
        self.cuts = [np.unique(tree.threshold[tree.feature == f]) for f in self.features]
        points = np.meshgrid(*[np.append(c, np.inf) for c in self.cuts], indexing="ij")
        x, phi = np.zeros((points[0].size, width)), np.zeros((points[0].size, width))
        for f, values in zip(self.features, points):
            x[:, f] = values.ravel()
        for path in found:
            path.add(x, phi)
        self.phi = np.ascontiguousarray(phi[:, self.features].T)

    def add(self, x: np.ndarray, phi: np.ndarray) -> None:
        cell = np.zeros(len(x), dtype=np.int64)
        for f, cuts in zip(self.features, self.cuts):
            cell *= len(cuts) + 1
            cell += np.searchsorted(cuts, x[:, f])
        for f, values in zip(self.features, self.phi):
            phi[:, f] += values.take(cell)


def explainers(weights: Sequence[float], trees: Sequence[Tree], width: int) -> list:
    """A table per tree that cuts the features into few cells, else its paths."""
    out = []
    for weight, tree in zip(weights, trees):
        found = paths([weight], [tree])[1]
        cells = np.prod([1.0 + len(np.unique(tree.threshold[tree.feature == f]))
                         for f in np.unique(tree.feature[tree.feature >= 0])])
        out += [TreeTable(tree, found, width)] if found and cells <= _TABLE_CELLS else found
    return out


def _explained(batch: pa.RecordBatch, at: int, found: Sequence, width: int) -> np.ndarray:
    x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    x, phi = np.asfortranarray(x), np.zeros((len(x), width), order="F")
    for part in found:
        part.add(x, phi)
    return phi


def tree_attribution(model: Model, table: ModelTable, rows: DataFrame | None = None) -> DataFrame:
    """``(row id, feature, phi)`` for every row of ``rows``, or of the whole table."""
    ids, names, width = list(table.row_id), list(table.features), len(table.features)
    _, weights, trees = weighted_trees(model)
    found = explainers(weights, trees, width)
    source = (table.df if rows is None else rows).select(
        *qs(ids), F.array(*[q(c).cast("double") for c in names]).alias("_x"))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phi = _explained(batch, len(ids), found, width)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(phi) + 1) * width, pa.int32()), pa.array(phi.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*ids, "_phi"])

    schema = source.drop("_x").schema.add("_phi", T.ArrayType(T.DoubleType()))
    parts = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in names]).alias("feature"),
                                   F.col("_phi").alias("phi")))
    return (source.mapInArrow(explain, schema).select(*qs(ids), parts.alias("p"))
            .select(*qs(ids), "p.feature", "p.phi"))


def tree_importance(model: Model, table: ModelTable) -> DataFrame:
    """``(feature, importance)``: mean absolute attribution over all rows, largest first.

    Tasks add up their rows, so no row per feature is ever made.
    """
    names, width = list(table.features), len(table.features)
    _, weights, trees = weighted_trees(model)
    found = explainers(weights, trees, width)
    source = table.df.select(F.array(*[q(c).cast("double") for c in names]).alias("_x"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(width)
        for batch in batches:
            total += np.abs(_explained(batch, 0, found, width)).sum(axis=0)
            rows += batch.num_rows
        if rows:
            yield pa.RecordBatch.from_pydict({
                "by": ["all"], "n": pa.array([rows], pa.int64()),
                "s": pa.array([total], pa.list_(pa.float64())),
                "g": pa.array([[]], pa.list_(pa.float64()))})

    named = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in names]).alias("feature"),
                                   F.transform("s", lambda v: v / F.col("n")).alias("importance")))
    return (merge_partials(source.mapInArrow(add, PARTIAL_SCHEMA)).select(named.alias("p"))
            .select("p.feature", "p.importance").orderBy(F.desc("importance"), "feature"))


def expectation(model: Model) -> float:
    """The prediction when nothing is known; attributions of a row add up from here."""
    base, weights, trees = weighted_trees(model)
    return base + paths(weights, trees)[0]
