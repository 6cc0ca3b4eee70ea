"""Boosted regression trees whose fold models share every scan, with patience.

Features are cut into at most 256 bins once and rows kept as bytes. A level of a tree then
takes one scan: each task adds up gradients per (model, node, feature, bin), partial sums are
merged in two steps, and the driver, which sees histograms only, picks the splits. All models
of a cross-validation grow in the same scans: a row's gradient goes to every model that does
not hold its fold out. The first scan of a round also measures the rounds before it, so the
patience rule costs no scan of its own.

Predictions so far are kept with the rows and renewed every ``WRITE_ROUNDS`` rounds; between
two writes tasks add the few trees grown since. Sums of the same rows do not depend on how
they are spread, but for the rounding of floating-point addition.

Rows are packed in blocks and spread evenly over the tasks. Features of few bins share a group
whose cell, one number, stands for the bins of all of them. A table per group tells by cell
which leaves its conditions leave open, a bit each; the bits that all groups leave are the
leaves a row ends at, so trees are read from tables instead of being walked.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol,
                                     HasSeed, HasStepSize)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.errors import DataError
from foldwise.functions.names import q
from foldwise.operators.linear import PARTIAL_SCHEMA, merge_partials
from foldwise.sources.settle import Scratch, spread

#: Rounds between two writes of the predictions, and models that share a scan.
WRITE_ROUNDS, MODELS_PER_SCAN = 8, 32
MEASURES = ("mse", "mae", "huber_loss")
#: Cells of a group of features, bytes of a block of rows, and rows worked on at once.
_GROUP_CELLS, _BLOCK_BYTES, _STEP_ROWS = 1 << 10, 1 << 13, 1 << 14


@dataclass
class Tree:
    """Nodes of one tree; ``feature`` is -1 at leaves, rows with ``x <= threshold`` go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Node at which each row of ``x`` ends."""
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            low = x[rows, np.maximum(f, 0)] <= self.threshold[node]
            node = np.where(inner, np.where(low, self.left[node], self.right[node]), node)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(x)]


@dataclass
class _Growing:
    """One model on its way: the trees done, the one in growth and its open nodes."""

    fold: str | None
    base: float
    trees: list[Tree] = field(default_factory=list)
    binned: list[Tree] = field(default_factory=list)
    written: int = 0
    history: list[tuple] = field(default_factory=list)
    best: float = np.inf
    stale: int = 0
    done: bool = False
    nodes: list[list] = field(default_factory=list)
    open: list[int] = field(default_factory=list)

    def start_tree(self) -> None:
        self.nodes, self.open = [[-1, 0, -1, -1, 0.0, 0]], [0]

    def current(self) -> Tree:
        f, t, l, r, v, c = zip(*self.nodes)
        return Tree(*(np.array(a, dtype=k) for a, k in zip(
            (f, t, l, r, v, c), (np.int64, float, np.int64, np.int64, float, np.int64))))


def _gradient(loss: str, away: np.ndarray) -> np.ndarray:
    if loss == "mae":
        return np.sign(away)
    return np.clip(away, -1.0, 1.0) if loss == "huber_loss" else away


def _sums(away: np.ndarray) -> list[float]:
    """Rows and sums of squared, absolute and Huber errors."""
    size = np.abs(away)
    huber = np.where(size <= 1, 0.5 * size * size, size - 0.5)
    return [float(len(away)), float((size * size).sum()), float(size.sum()), float(huber.sum())]


def bin_cuts(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Ascending cuts per feature, from quantile sketches merged over all tasks in one job."""
    probs = [i / bins for i in range(1, bins)]
    columns = rows.select(*[F.col("x")[i].alias(f"x{i}") for i in range(width)])
    found = columns.approxQuantile(columns.columns, probs, 1 / (4 * bins))
    return [np.unique(np.asarray(c, dtype=np.float64)) for c in found]


class Cells:
    """Bins of the features, in groups; the bins of a group are the digits of its cell."""

    def __init__(self, cuts: Sequence[np.ndarray]):
        self.cuts = [np.asarray(c, dtype=np.float64) for c in cuts]
        self.sizes = [len(c) + 1 for c in self.cuts]
        self.groups: list[list[int]] = []
        self.counts: list[int] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            at = next((g for g, n in enumerate(self.counts)
                       if n * self.sizes[f] <= _GROUP_CELLS), len(self.counts))
            if at == len(self.counts):
                self.groups.append([])
                self.counts.append(1)
            self.groups[at].append(f)
            self.counts[at] *= self.sizes[f]

    def of(self, x: np.ndarray) -> list[np.ndarray]:
        """Cell of each row of ``x`` in every group."""
        out = []
        for features in self.groups:
            cell = np.zeros(len(x), dtype=np.int64)
            for f in features:
                cell *= self.sizes[f]
                cell += np.searchsorted(self.cuts[f], x[:, f])
            out.append(cell)
        return out

    def shape(self, group: int) -> list[int]:
        return [self.sizes[f] for f in self.groups[group]]


def _open_bits(tree: Tree) -> Iterator[tuple[int, dict[int, tuple[float, float]]]]:
    """Leaves of a binned tree with the bins ``low < bin <= high`` of the features on the path."""
    todo = [(0, {})]
    while todo:
        node, ranges = todo.pop()
        f = int(tree.feature[node])
        if f < 0:
            yield node, ranges
            continue
        low, high = ranges.get(f, (-1, np.inf))
        cut = int(tree.threshold[node])
        todo.append((int(tree.left[node]), {**ranges, f: (low, min(high, cut))}))
        todo.append((int(tree.right[node]), {**ranges, f: (max(low, cut), high)}))


class Lookup:
    """Sum over trees of the values of the leaves that rows end at, from tables by cell."""

    def __init__(self, trees: Sequence[Tree], values: Sequence[np.ndarray], cells: Cells):
        leaves = [(v[node], ranges) for tree, v in zip(trees, values)
                  for node, ranges in _open_bits(tree)]
        kind = values[0].dtype if len(values) else np.dtype(float)
        self.words, self.sums = [], []
        for at in range(0, len(leaves), 64):
            part = leaves[at:at + 64]
            by_feature: dict[int, np.ndarray] = {}
            for bit, (_, ranges) in enumerate(part):
                shut = ~np.uint64(1 << bit)
                for f, (low, high) in ranges.items():
                    table = by_feature.setdefault(f, np.full(cells.sizes[f], ~np.uint64(0), "<u8"))
                    table[:int(low) + 1] &= shut
                    if high < len(table):
                        table[int(high) + 1:] &= shut
            tables = []
            for g, features in enumerate(cells.groups):
                if not by_feature.keys() & set(features):
                    continue
                table = np.full(cells.shape(g), ~np.uint64(0), "<u8")
                for axis, f in enumerate(features):
                    if f in by_feature:
                        table &= by_feature[f].reshape(
                            [-1 if a == axis else 1 for a in range(len(features))])
                tables.append((g, table.ravel()))
            self.words.append(tables)
            sums = []
            for b in range(0, len(part), 8):
                total = np.zeros(256, dtype=kind)
                for bit, (value, _) in enumerate(part[b:b + 8]):
                    total[np.arange(256) >> bit & 1 == 1] += value
                sums.append(total)
            self.sums.append(sums)

    def add(self, out: np.ndarray, at: Sequence[np.ndarray]) -> np.ndarray:
        """Add each row's sum to ``out``; ``at`` holds the rows' cells by group."""
        for tables, sums in zip(self.words, self.sums):
            if not tables:  # trees without a split
                out += sum(s[-1] for s in sums)
                continue
            bits = tables[0][1].take(at[tables[0][0]])
            for g, table in tables[1:]:
                bits &= table.take(at[g])
            left = bits.view(np.uint8).reshape(-1, 8)
            for b, total in enumerate(sums):
                out += total.take(left[:, b])
        return out


def _binned_trees(trees: Sequence[Tree], width: int) -> tuple[list[Tree], Cells]:
    """Trees whose thresholds are places among all thresholds of a feature, and these as cells."""
    cuts = [np.unique(np.concatenate([[], *[t.threshold[t.feature == f] for t in trees]]))
            for f in range(width)]
    binned = []
    for t in trees:
        at = [np.searchsorted(cuts[f], v) if f >= 0 else 0 for f, v in zip(t.feature, t.threshold)]
        binned.append(Tree(t.feature, np.array(at), t.left, t.right, t.value, t.cover))
    return binned, Cells(cuts)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """Lists of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


_BLOCKS = "cells binary, y binary, fold binary, held binary, raw binary"
#: Types of a block's columns; cells and predictions have several values a row.
_TYPES = (np.uint16, np.float64, np.int16, np.bool_, np.float64)


def _block(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of ``values`` in blocks that end at ``ends``."""
    size = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    offsets = np.concatenate([[0], ends * size]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(batches: Iterator[pa.RecordBatch], cells: Cells, folds: Sequence[str | None],
            base: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows as blocks of cells, target, place of the fold in ``folds`` (else -1), flag, base."""
    rows = max(1, _BLOCK_BYTES // (2 * len(cells.groups) + 11 + base.nbytes))
    names = pa.array(folds, pa.string())
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = _vectors(batch.column(0), len(cells.cuts))
        fold = pc.fill_null(pc.index_in(batch.column(2), value_set=names, skip_nulls=True), -1)
        ends = np.minimum(np.arange(rows, n + rows, rows), n)
        columns = (np.stack(cells.of(x), axis=1).astype(np.uint16), batch.column(1).to_numpy(),
                   fold.to_numpy(zero_copy_only=False).astype(np.int16),
                   batch.column(3).to_numpy(zero_copy_only=False).astype(bool),
                   np.tile(base, (n, 1)))
        yield pa.RecordBatch.from_arrays([_block(c, ends) for c in columns],
                                         names=[c.split()[0] for c in _BLOCKS.split(", ")])


def _steps(batches: Iterator[pa.RecordBatch], groups: int, models: int, step: int = _STEP_ROWS
           ) -> Iterator[tuple]:
    """Blocks of about ``step`` rows, each with its columns as arrays, cells and raw by group
    and by model."""
    for batch in batches:
        if not batch.num_rows:
            continue
        first = max(1, len(batch.column(1)[0].as_py()) // 8)
        size = max(1, step // first)
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            cells, y, fold, held, raw = (
                np.frombuffer(b"".join(c.to_pylist()), t) for c, t in zip(part.columns, _TYPES))
            yield (part, [c.astype(np.int64) for c in cells.reshape(-1, groups).T], y, fold, held,
                   np.array(raw.reshape(-1, models).T, order="C"))


def _values(trees: Sequence[Tree], weights: Sequence[float]) -> list[np.ndarray]:
    return [w * np.asarray(t.value, dtype=float) for t, w in zip(trees, weights)]


def _histograms(batches: Iterator[pa.RecordBatch], models: list[tuple], cells: Cells, count: int,
                loss: str, rate: float, measure: bool) -> Iterator[pa.RecordBatch]:
    """Counts and gradient sums per open node, feature and bin, for every model at once."""
    ready = []
    for at, out, pending, tree, slots in models:
        # Place 0 is for rows that are not in an open node or not trained on.
        place = np.zeros(len(tree.feature), dtype=np.int64)
        place[slots] = np.arange(1, len(slots) + 1)
        ready.append((at, out, Lookup(pending, _values(pending, [rate] * len(pending)), cells),
                      Lookup([tree], [place], cells), len(slots)))
    kept: dict[int, list] = {}
    most = max((len(slots) + 1 for *_, slots in models), default=1) * max(cells.counts)
    for _, at_cells, y, fold, held, raw in _steps(batches, len(cells.groups), count,
                                                  max(_STEP_ROWS, most)):
        for k, (at, out, pending, places, slots) in enumerate(ready):
            mine = None if out is None else fold != at
            train = ~held if mine is None else mine & ~held
            if mine is not None and not mine.any():
                continue
            away = y - pending.add(raw[at].copy(), at_cells)
            have = kept.setdefault(k, [0, np.zeros(8), [
                np.zeros((2, (slots + 1) * n)) for n in cells.counts]])
            have[0] += int(train.sum())
            if measure:
                watched = held if mine is None else mine & held
                have[1] += [*_sums(away[train]), *_sums(away[watched])]
            pull = _gradient(loss, away)
            place = places.add(np.zeros(len(y), dtype=np.int64), at_cells)
            place *= train
            for g, n in enumerate(cells.counts):
                cell = place * n
                cell += at_cells[g]
                have[2][g][0] += np.bincount(cell, minlength=(slots + 1) * n)
                have[2][g][1] += np.bincount(cell, weights=pull, minlength=(slots + 1) * n)
    if kept:
        yield pa.RecordBatch.from_pydict({
            "by": pa.array([str(k) for k in kept]), "n": pa.array([v[0] for v in kept.values()], pa.int64()),
            "s": pa.array([v[1] for v in kept.values()], pa.list_(pa.float64())),
            "g": pa.array([_by_feature(v[2], cells).ravel() for v in kept.values()],
                          pa.list_(pa.float64()))})


def _by_feature(sums: Sequence[np.ndarray], cells: Cells) -> np.ndarray:
    """Sums per open node, feature and bin from those per place and cell of each group."""
    size = max(cells.sizes)
    slots = sums[0].shape[1] // cells.counts[0] - 1
    out = np.zeros((2, slots, len(cells.sizes), size))
    for g, features in enumerate(cells.groups):
        whole = sums[g].reshape(2, slots + 1, *cells.shape(g))[:, 1:]
        for axis, f in enumerate(features):
            others = tuple(a + 2 for a in range(len(features)) if a != axis)
            out[:, :, f, :cells.sizes[f]] = whole.sum(axis=others)
    return out


def _renewed(batches: Iterator[pa.RecordBatch], pending: list[list[Tree]], cells: Cells, rate: float
             ) -> Iterator[pa.RecordBatch]:
    ready = [Lookup(trees, _values(trees, [rate] * len(trees)), cells) for trees in pending]
    for part, at_cells, _, _, _, raw in _steps(batches, len(cells.groups), len(pending)):
        for k, trees in enumerate(ready):
            trees.add(raw[k], at_cells)
        ends = np.cumsum([len(v) // 8 for v in part.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([*part.columns[:4], _block(raw.T, ends)],
                                         names=part.schema.names)


def fold_errors(dataset: DataFrame, forests: Sequence[tuple], folds: Sequence[str], fold_col: str,
                features_col: str, label_col: str, held_col: str | None = None,
                every_round: bool = False) -> dict[tuple[str, int], np.ndarray]:
    """Error sums of all fold models from one scan.

    A forest is ``(constant, weights, trees)``. By ``(fold, trees)`` comes an array whose rows are
    train, train but held out, and evaluation rows; columns are rows and sums of squared, absolute
    and Huber errors. ``trees`` is the whole number, or every one from 1 with ``every_round``.
    Rows without a fold count nowhere.
    """
    held = F.coalesce(q(held_col), F.lit(False)) if held_col else F.lit(False)
    rows = dataset.select(vector_to_array(q(features_col)).alias("x"),
                          q(label_col).cast("double").alias("y"),
                          q(fold_col).cast("string").alias("fold"), held.alias("held"))
    steps = [[*(range(1, len(trees) + 1) if every_round else [len(trees)])]
             for _, _, trees in forests]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ready = pa.array(folds, pa.string()), None
        kept = [np.zeros((len(s), 3, 4)) for s in steps]
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            width = len(column.flatten()) // len(column)
            if ready is None:
                every, cells = _binned_trees([t for _, _, trees in forests for t in trees], width)
                left, ready = iter(every), []
                for (base, weights, trees), ends in zip(forests, steps):
                    binned = [next(left) for _ in trees]
                    values = _values(trees, weights)
                    ready.append((base, [Lookup(binned[a:b], values[a:b], cells)
                                         for a, b in zip([0, *ends], ends)]))
            x, y = _vectors(column, width), batch.column(1).to_numpy(zero_copy_only=False)
            code = pc.fill_null(pc.index_in(batch.column(2), value_set=names, skip_nulls=True), -1)
            code, known = code.to_numpy(zero_copy_only=False), batch.column(2).is_valid()
            known = known.to_numpy(zero_copy_only=False)
            side = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            at_cells = cells.of(x)
            for k, (base, parts) in enumerate(ready):
                group = np.where(known, np.where(code == k, 2, side), 3)
                guess = np.full(len(y), float(base))
                for i, part in enumerate(parts):
                    size = np.abs(part.add(guess, at_cells) - y)
                    huber = np.where(size <= 1, 0.5 * size * size, size - 0.5)
                    for j, v in enumerate((None, size * size, size, huber)):
                        kept[k][i, :, j] += np.bincount(group, v, minlength=4)[:3]
        yield pa.RecordBatch.from_pydict({
            "by": ["all"], "n": pa.array([0], pa.int64()),
            "s": pa.array([np.concatenate([v.ravel() for v in kept])], pa.list_(pa.float64())),
            "g": pa.array([[]], pa.list_(pa.float64()))})

    found = merge_partials(rows.mapInArrow(add, PARTIAL_SCHEMA)).first()
    sums = np.array(found["s"]).reshape(-1, 3, 4)
    keys = [(fold, n) for fold, ends in zip(folds, steps) for n in ends]
    return dict(zip(keys, sums))


def _split(model: _Growing, g: np.ndarray, width: int, size: int, cuts: list[np.ndarray],
           least: int, last: bool, cut_value: list[list]) -> None:
    """Open the best split of every open node, or close the node."""
    n, s = g.reshape(2, len(model.open), width, size)
    opened = []
    for k, node in enumerate(model.open):
        rows, total = n[k, 0].sum(), s[k, 0].sum()
        model.nodes[node][4:] = [total / max(rows, 1), int(rows)]
        ln, ls = np.cumsum(n[k], axis=1)[:, :-1], np.cumsum(s[k], axis=1)[:, :-1]
        rn, rs = rows - ln, total - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ls ** 2 / ln + rs ** 2 / rn - total ** 2 / max(rows, 1)
        gain[(ln < least) | (rn < least)] = -np.inf
        # The first of the cuts that are equal but for the rounding of their sums.
        at = int(np.argmax(gain >= gain.max() - 1e-11 * abs(gain.max()))) if gain.size else 0
        f, cut = divmod(at, size - 1)
        if not gain.size or not gain[f, cut] > 1e-12 * max(1.0, total ** 2):
            continue
        left = len(model.nodes)
        for rows_, total_ in ((ln[f, cut], ls[f, cut]), (rn[f, cut], rs[f, cut])):
            model.nodes.append([-1, 0, -1, -1, total_ / rows_, int(rows_)])
        model.nodes[node][:4] = [f, cut, left, left + 1]
        cut_value.append([node, cuts[f][cut]])
        opened += [left, left + 1]
    model.open = [] if last else opened


def grow(dataset: DataFrame, estimator: BoostedTreesRegressor, folds: Sequence[str | None],
         fold_col: str | None = None) -> list[BoostedTreesRegressorModel]:
    """One model per entry of ``folds``, each without the rows of that fold; ``None`` takes all.

    Rows whose indicator column is true are never fitted on; a model stops when ``patience``
    rounds have brought no gain on them.
    """
    models = []
    for at in range(0, len(folds), MODELS_PER_SCAN):
        models += _grow(dataset, estimator, list(folds[at:at + MODELS_PER_SCAN]), fold_col)
    return models


def _grow(dataset, estimator, folds, fold_col):
    get, spark, scratch = estimator._get, dataset.sparkSession, Scratch(dataset.sparkSession)
    rate, loss, depth = estimator.getStepSize(), get("loss"), get("maxDepth")
    shown = "mse" if loss == "rmse" else loss
    held = (F.coalesce(q(get("validationIndicatorCol")), F.lit(False))
            if estimator.isDefined("validationIndicatorCol") else F.lit(False))
    rows = dataset.select(
        vector_to_array(q(estimator.getFeaturesCol())).alias("x"),
        q(estimator.getLabelCol()).cast("double").alias("y"),
        (q(fold_col).cast("string") if fold_col else F.lit("")).alias("fold"), held.alias("held"))
    head = rows.first()
    if head is None:
        raise DataError("the trees have no row to train on")
    width = len(head["x"])
    by_fold = rows.where("NOT held").groupBy("fold").agg(
        F.count("*").alias("n"), F.sum("y").alias("s")).collect()
    growing = []
    for fold in folds:
        seen = [r for r in by_fold if fold is None or r["fold"] != fold]
        if not seen:
            raise DataError("the trees have no row to train on")
        growing.append(_Growing(fold, sum(r["s"] for r in seen) / sum(r["n"] for r in seen)))
    watched = estimator.isDefined("validationIndicatorCol")
    cuts = bin_cuts(rows, width, get("maxBins"))
    cells, size = Cells(cuts), max(len(c) for c in cuts) + 1
    base = np.array([m.base for m in growing])
    try:
        # Blocks are dealt evenly, so that every scan has work for all tasks.
        state = scratch.write(spread(rows.mapInArrow(
            lambda b: _packed(b, cells, folds, base), _BLOCKS)), "boosted-rows")
        schema = state.schema
        for number in range(get("maxIter") + 1):
            for m in growing:
                m.start_tree()
            chosen: dict[int, list] = {k: [] for k in range(len(growing))}
            for level in range(depth if number < get("maxIter") else 1):
                live = [k for k, m in enumerate(growing) if not m.done and m.open]
                if not live:
                    break
                sent = [(k, growing[k].fold, growing[k].binned[growing[k].written:],
                         growing[k].current(), np.array(growing[k].open)) for k in live]
                first = level == 0
                parts = state.mapInArrow(
                    lambda b, sent=sent, first=first: _histograms(
                        b, sent, cells, len(growing), loss, rate, first), PARTIAL_SCHEMA)
                for r in merge_partials(parts).toLocalIterator():
                    k = live[int(r["by"])]
                    m = growing[k]
                    if first:
                        _measure(m, number, np.array(r["s"]), shown, estimator, watched)
                        if m.done or number == get("maxIter"):
                            m.open, m.done = [], True
                            continue
                    _split(m, np.array(r["g"]), width, size, cuts, get("minInstancesPerNode"),
                           level == depth - 1, chosen[k])
            for k, m in enumerate(growing):
                if not m.done:
                    tree = m.current()
                    m.binned.append(tree)
                    real = tree.threshold.copy()
                    for node, value in chosen[k]:
                        real[node] = value
                    m.trees.append(Tree(tree.feature, real, tree.left, tree.right, tree.value, tree.cover))
            if all(m.done for m in growing):
                break
            if (number + 1) % WRITE_ROUNDS == 0:
                pending = [m.binned[m.written:] for m in growing]
                state = scratch.write(state.mapInArrow(
                    lambda b, pending=pending: _renewed(b, pending, cells, rate), schema), "boosted-rows")
                scratch.drop((state,))
                for m in growing:
                    m.written = len(m.binned)
        return [estimator._copyValues(BoostedTreesRegressorModel(
            m.base, [rate] * len(m.trees), m.trees, m.history)) for m in growing]
    finally:
        scratch.drop()


def _measure(m: _Growing, number: int, sums: np.ndarray, shown: str, estimator, watched: bool) -> None:
    """Record the rounds done so far and apply the patience rule."""
    if not number:
        return
    names = dict.fromkeys(x for x in (estimator._get("loss"), estimator._get("metric")) if x)
    value = np.inf
    for group, part in (("train", sums[:4]), ("validation", sums[4:])):
        if not part[0]:
            continue
        for name in names:
            mean = part[1 + MEASURES.index("mse" if name == "rmse" else name)] / part[0]
            m.history.append((number, name, group, float(np.sqrt(mean) if name == "rmse" else mean)))
            if group == "validation" and name == estimator._get("loss"):
                value = mean
    if watched:
        m.best, m.stale = (value, 0) if value < m.best else (m.best, m.stale + 1)
        m.done = m.stale >= estimator._get("patience")


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed):
    loss = Param(Params._dummy(), "loss", "mse, rmse, mae or huber_loss", TypeConverters.toString)
    metric = Param(Params._dummy(), "metric", "a second measure to record, or empty",
                   TypeConverters.toString)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits in a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature, 2 to 256", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "fewest rows of a node",
                                TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "rounds without gain before stopping",
                     TypeConverters.toInt)
    validationIndicatorCol = Param(Params._dummy(), "validationIndicatorCol",
                                   "boolean column of held-out rows", TypeConverters.toString)


class BoostedTreesRegressor(Estimator, _BoostParams):
    """Gradient-boosted trees on binned features; fold models of one run share their scans."""

    @keyword_only
    def __init__(self, *, maxIter=100, maxDepth=5, maxBins=64, stepSize=0.1, loss="mse", metric="",
                 minInstancesPerNode=1, patience=10, seed=0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction",
                         maxIter=100, maxDepth=5, maxBins=64, stepSize=0.1, loss="mse", metric="",
                         minInstancesPerNode=1, patience=10, seed=0)
        self._set(**self._input_kwargs)
        if not 2 <= self._get("maxBins") <= 256:
            raise DataError("maxBins must be from 2 to 256")

    def _get(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def _fit(self, dataset: DataFrame) -> BoostedTreesRegressorModel:
        return grow(dataset, self, [None])[0]


class BoostedTreesRegressorModel(Model, _BoostParams):
    def __init__(self, base: float, weights: Sequence[float], trees: Sequence[Tree],
                 history: Sequence[tuple]):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction")
        self.base, self.weights = float(base), [float(w) for w in weights]
        self.trees, self.history = list(trees), list(history)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, weights, trees = self.base, self.weights, self.trees  # as large as the model

        @F.arrow_udf(T.DoubleType())
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            ready = None
            for xs in batches:
                out = np.full(len(xs), base)
                if len(xs):
                    x = _vectors(xs, len(xs.flatten()) // len(xs))
                    if ready is None:
                        binned, cells = _binned_trees(trees, x.shape[1])
                        ready = Lookup(binned, _values(trees, weights), cells)
                    ready.add(out, cells.of(x))
                yield pa.array(out)

        return dataset.withColumn(
            self.getPredictionCol(), predict(vector_to_array(q(self.getFeaturesCol()))))

    def save(self, path: str) -> None:
        """Nodes as rows of a table, the rest as one line of text."""
        spark = SparkSession.active()
        nodes = [(t, i, int(tree.feature[i]), float(tree.threshold[i]), int(tree.left[i]),
                  int(tree.right[i]), float(tree.value[i]), int(tree.cover[i]))
                 for t, tree in enumerate(self.trees) for i in range(len(tree.feature))]
        spark.createDataFrame(nodes, "tree int, node int, feature int, threshold double, left int, "
                              "right int, value double, cover bigint").write.parquet(f"{path}/nodes")
        meta = json.dumps({"base": self.base, "weights": self.weights, "history": self.history,
                           "columns": [self.getFeaturesCol(), self.getLabelCol(),
                                       self.getPredictionCol()]})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/layout")

    @classmethod
    def load(cls, path: str) -> BoostedTreesRegressorModel:
        spark = SparkSession.active()
        meta = json.loads(spark.read.text(f"{path}/layout").first()[0])
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        trees = [Tree(*(part[c].to_numpy() for c in (
            "feature", "threshold", "left", "right", "value", "cover")))
            for _, part in nodes.groupby("tree")]
        model = cls(meta["base"], meta["weights"], trees, [tuple(h) for h in meta["history"]])
        return model._set(**dict(zip(("featuresCol", "labelCol", "predictionCol"), meta["columns"])))
