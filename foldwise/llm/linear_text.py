"""Fitting small text classifiers on a bounded sample of labelled rows.

The sample bound is a parameter of every caller. Which rows enter it follows from a hash
of their id, so it does not depend on how the table is laid out. Only hashed features of
sampled rows reach the driver, never texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textbytes import Chunk, chunks

#: Sampled rows a feature has to occur in; rarer ones would only be learned by heart.
LEAST_ROWS = 3


@dataclass(frozen=True)
class Examples:
    """Sparse rows: row ``i`` owns ``slots[bounds[i]:bounds[i + 1]]`` with their values."""

    bounds: np.ndarray
    slots: np.ndarray
    values: np.ndarray
    labels: np.ndarray

    def only(self, wanted: np.ndarray) -> Examples:
        sizes = np.diff(self.bounds)
        keep = np.repeat(wanted, sizes)
        return Examples(np.append(0, np.cumsum(sizes[wanted])), self.slots[keep],
                        self.values[keep], self.labels[wanted])

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.labels)), np.diff(self.bounds))

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.slots] * self.values,
                           minlength=len(self.labels))


def labelled_sample(labels: DataFrame, id_col: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` ids with one label each, the first by a hash of the id."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    single = usable.groupBy(id_col).agg(F.min(label).cast("int").alias("__label"))
    return single.orderBy(F.xxhash64(id_col), F.col(id_col)).limit(rows)


def gather_examples(docs: DataFrame, chosen: DataFrame, features: Callable, id_col: str,
                    text_col: str) -> Examples:
    """Features of the chosen rows; ``features(chunk)`` gives text numbers, slots, values."""
    # At most as many rows as the sample parameter allows, two numbers each.
    rows = docs.where(F.col(id_col).isNotNull()).join(F.broadcast(chosen), id_col)

    def run(batches):
        for chunk in chunks(batches, text_col):
            yield sparse_rows(chunk, *features(chunk), id_col)

    kind = docs.schema[id_col].dataType.simpleString()
    table = rows.select(id_col, text_col, "__label").mapInArrow(
        run, f"id {kind}, label int, slots binary, vals binary").toArrow()
    table = table.sort_by("id")
    slots = [np.frombuffer(x, np.int32) for x in table["slots"].to_pylist()]
    values = [np.frombuffer(x, np.float32) for x in table["vals"].to_pylist()]
    return Examples(np.append(0, np.cumsum([len(x) for x in slots], dtype=np.int64)),
                    np.concatenate([*slots, np.zeros(0, np.int32)]),
                    np.concatenate([*values, np.zeros(0, np.float32)]),
                    np.array(table["label"].to_pylist(), dtype=np.int64))


def sparse_rows(chunk: Chunk, text: np.ndarray, slot: np.ndarray, value: np.ndarray,
                id_col: str) -> pa.RecordBatch:
    """One row per text of a chunk, equal slots summed."""
    keys = text.astype(np.int64) << 32 | slot
    order = np.argsort(keys, kind="stable")
    keys, value = keys[order], value[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    value = np.add.reduceat(value, first) if len(first) else value
    keys = keys[first]
    cuts = np.searchsorted(keys >> 32, np.arange(len(chunk) + 1))
    slots = (keys & 0xFFFFFFFF).astype(np.int32)
    names = chunk.rows.schema.names
    return pa.RecordBatch.from_pydict({
        "id": chunk.rows.column(names.index(id_col)),
        "label": chunk.rows.column(names.index("__label")),
        "slots": pa.array([slots[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        "vals": pa.array([value[a:b].astype(np.float32).tobytes()
                          for a, b in zip(cuts, cuts[1:])], pa.binary())})


def adam(gradient: Callable, size: int, steps: int, rate: float) -> np.ndarray:
    """Minimise by Adam; ``gradient(parameters, step)`` gives the direction."""
    x, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(x, t)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        x -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return x


def known_slots(slots: np.ndarray, size: int) -> np.ndarray:
    """Slots that occur in enough rows; ``slots`` lists each once per row."""
    return np.bincount(slots, minlength=size) >= LEAST_ROWS


def fit_logistic(examples: Examples, size: int, steps: int = 80, rate: float = 0.5,
                 penalty: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias of a penalised logistic regression on features scaled to unit spread."""
    known = known_slots(examples.slots, size)
    use = known[examples.slots]
    back = np.flatnonzero(known)
    dense = np.cumsum(known) - 1
    slots, owner = dense[examples.slots[use]], examples.owner[use]
    rows = max(len(examples.labels), 1)
    spread = np.sqrt(np.bincount(slots, weights=examples.values[use].astype(float) ** 2,
                                 minlength=len(back)) / rows) + 1e-9
    values = examples.values[use] / spread[slots]
    y = examples.labels.astype(float)
    scale = 1 / np.sqrt(max(len(back), 1))

    def gradient(x: np.ndarray, step: int) -> np.ndarray:
        z = np.bincount(owner, weights=x[slots] * values, minlength=len(y)) * scale + x[-1]
        off = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / rows
        g = np.bincount(slots, weights=off[owner] * values, minlength=len(back)) * scale
        return np.append(g + penalty * x[:-1], off.sum())

    x = adam(gradient, len(back) + 1, steps, rate / 10)
    weights = np.zeros(size, dtype=np.float32)
    weights[back] = x[:-1] * scale / spread
    return weights, float(x[-1])


def fit_calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (two-parameter logistic fit)."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    centre, spread = margins.mean(), margins.std() + 1e-9
    z = (margins - centre) / spread

    def gradient(x: np.ndarray, step: int) -> np.ndarray:
        off = 1 / (1 + np.exp(-np.clip(x[0] * z + x[1], -40, 40))) - labels
        return np.array([(off * z).mean() + 1e-3 * x[0], off.mean()])

    a, b = adam(gradient, 2, 400, 0.05)
    return float(a / spread), float(b - a * centre / spread)
