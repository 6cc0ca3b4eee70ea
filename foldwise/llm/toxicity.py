"""Toxicity by multiple-instance learning: sentences explain a label of the whole text.

A sentence score is a logistic function of hashed words and word beginnings, so that
inflected forms of one stem help each other. The text is toxic unless no sentence is: ``P = 1 - prod(1 - p)`` (noisy-or). Training sees labels of texts
only; its gradient reaches the sentences that explain them, which then locates the offence.

Nulls: a null text counts as empty and scores 0, as do texts without a word. A null or
missing label, or a label of a null id, teaches nothing. Without labels of both kinds every
score is 0. Repeated rows each give a row; of repeated labels the smaller counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.array_sums import summed
from foldwise.llm.linear_text import LEAST_ROWS, adam, labelled_sample
from foldwise.llm.shared import Shipped
from foldwise.llm.textbytes import Chunk, RangeHash, chunks, laid, mix, pick

FEATURE_BITS = 18
#: Labelled rows the sentence model is fitted on, chosen by a hash of the id.
SAMPLE_ROWS = 12_000
#: Probability from which a text, or a sentence, is called toxic.
TOXIC_FROM = 0.3
#: Bytes of a word's beginning that are features of their own.
STEMS = (4, 5)
#: Standard errors by which a feature's share must differ between labels to be learned.
SCREEN = 2.5

_WORD = np.zeros(256, dtype=bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'")] = True
_WORD[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?\n")] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


@dataclass
class Bags:
    """Features of sentences: ``slots`` belong to sentence ``owner``, sentences to texts."""

    slots: np.ndarray
    owner: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def bags(chunk: Chunk) -> Bags:
    """Cut texts at stop marks and line ends; words and their beginnings are features."""
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    begin, end, text = chunk.runs(_WORD[chunk.data])
    stops = np.zeros(len(chunk.data) + 1, dtype=np.int64)
    np.cumsum(_STOP[chunk.data], out=stops[1:])
    number = stops[begin] + text
    first = np.flatnonzero(np.diff(number, prepend=-1)) if len(begin) else begin
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(begin))))
    hashed = RangeHash(chunk.lowered)
    slots, owners = [hashed.of(begin, end) & mask], [owner]
    for n in STEMS:
        longer = np.flatnonzero(end - begin > n)
        slots.append(mix(hashed.of(begin[longer], begin[longer] + n) + np.uint64(n)) & mask)
        owners.append(owner[longer])
    last = np.append(first[1:], len(begin)) - 1 if len(first) else first
    return Bags(np.concatenate(slots).astype(np.int32), np.concatenate(owners), text[first],
                begin[first], end[last])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``sample_rows`` labelled texts.

    A first pass counts in how many texts of either label a feature occurs; only features
    that tell the labels apart reach the driver, with the number of each text's sentences.
    """
    spark, size = docs.sparkSession, 1 << FEATURE_BITS
    chosen = spark.createDataFrame(
        labelled_sample(pick(labels, id_col, label), id_col, label, sample_rows).toArrow())
    source = pick(docs, id_col, text_col)
    # At most ``sample_rows`` rows of two numbers.
    rows = source.where(F.col(id_col).isNotNull()).join(F.broadcast(chosen), id_col).select(
        id_col, text_col, "__label")

    def count(batches):
        total = np.zeros(2 * size + 2, dtype=np.int64)
        for chunk in chunks(batches, text_col):
            marked = chunk.rows.column(2).to_numpy() == 1
            found = bags(chunk)
            once = np.unique(found.text[found.owner] << FEATURE_BITS | found.slots)
            text, slot = once >> FEATURE_BITS, once & (size - 1)
            total[:-2] += np.bincount(slot + size * ~marked[text], minlength=2 * size)
            total[-2:] += marked.sum(), (~marked).sum()
        return total

    # The join with few rows keeps the tasks of the scan.
    tasks = source.rdd.getNumPartitions()
    known = screened(summed(rows, count, 2 * size + 2, 16, "<u4", tasks=tasks))
    shared = spark.sparkContext.broadcast(known)  # one byte a feature

    def run(batches):
        for chunk in chunks(batches, text_col):
            found = bags(chunk)
            use = shared.value[found.slots]
            order = np.argsort(found.owner[use], kind="stable")
            owner, slots = found.owner[use][order], found.slots[use][order]
            bounds = np.arange(len(chunk) + 1)
            cuts = np.searchsorted(found.text[owner], bounds)
            first = np.searchsorted(found.text, bounds)  # sentences before each text
            yield pa.RecordBatch.from_pydict({
                "id": chunk.rows.column(0), "label": chunk.rows.column(2),
                "sentences": pa.array(np.diff(first), pa.int64()),
                "slots": pa.array([slots[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                                  pa.binary()),
                "owner": pa.array([(owner[a:b] - f).astype(np.int32).tobytes()
                                   for a, b, f in zip(cuts, cuts[1:], first)], pa.binary())})

    kind = source.schema[id_col].dataType.simpleString()
    table = rows.mapInArrow(
        run, f"id {kind}, label int, sentences long, slots binary, owner binary").toArrow(
        ).sort_by("id")
    return fit_bags([np.frombuffer(x, np.int32) for x in table["slots"].to_pylist()],
                    [np.frombuffer(x, np.int32) for x in table["owner"].to_pylist()],
                    np.array(table["sentences"].to_pylist(), dtype=np.int64),
                    np.array(table["label"].to_pylist(), dtype=np.int64), known)


def screened(counts: np.ndarray) -> np.ndarray:
    """Features whose share of toxic texts differs clearly from their share of clean ones."""
    toxic, clean = counts[:-2].reshape(2, -1)
    n_toxic, n_clean = np.maximum(counts[-2:], 1)
    share = (toxic + clean) / (n_toxic + n_clean)
    error = np.sqrt(share * (1 - np.minimum(share, 1)) * (1 / n_toxic + 1 / n_clean)) + 1e-9
    return ((toxic + clean >= LEAST_ROWS)
            & (np.abs(toxic / n_toxic - clean / n_clean) >= SCREEN * error))


def fit_bags(slots: list[np.ndarray], owners: list[np.ndarray], sentences: np.ndarray,
             labels: np.ndarray, known: np.ndarray, steps: int = 150, rate: float = 0.1,
             penalty: float = 2e-5) -> Model:
    """Maximise the noisy-or likelihood of the labels, with a small penalty on weights."""
    size = len(known)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(size, np.float32), -60.0)
    base = np.append(0, np.cumsum(sentences))
    owner = np.concatenate([o + b for o, b in zip(owners, base)])
    text = np.repeat(np.arange(len(labels)), sentences)
    dense, back = np.cumsum(known) - 1, np.flatnonzero(known)
    slot = dense[np.concatenate(slots)]
    y = labels.astype(float)
    start = -4.0

    def gradient(x: np.ndarray, step: int) -> np.ndarray:
        z = np.bincount(owner, weights=x[slot], minlength=len(text)) + x[-1] + start
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        none = np.bincount(text, weights=np.logaddexp(0, z), minlength=len(y))
        whole = np.clip(-np.expm1(-none), 1e-9, 1)
        pull = np.where(y == 1, -np.exp(-none) / whole, 1.0)[text] * p / len(y)
        g = np.bincount(slot, weights=pull[owner], minlength=len(back))
        return np.append(g + penalty * x[:-1], pull.sum())

    x = adam(gradient, len(back) + 1, steps, rate)
    weights = np.zeros(size, dtype=np.float32)
    weights[back] = x[:-1]
    return Model(weights, float(x[-1] + start))


def score(chunk: Chunk, model: Model) -> tuple[np.ndarray, Bags, np.ndarray]:
    """Probability per text, the sentences and their probabilities."""
    found = bags(chunk)
    z = np.bincount(found.owner, weights=model.weights[found.slots],
                    minlength=len(found.text)) + model.bias
    z = np.clip(z, -60, 60)
    none = chunk.per_text(found.text, np.logaddexp(0, z)) if len(z) else np.zeros(len(chunk))
    return -np.expm1(-none), found, 1 / (1 + np.exp(-z))


def apply(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          toxic_from: float = TOXIC_FROM) -> DataFrame:
    """Score, verdict and offending sentences per row.

    Returns ``id_col, score double, predicted int, offending array<struct<start, end,
    score>>``, offsets in code points, ends exclusive.
    """
    source = pick(docs, id_col, text_col)
    shared = Shipped(docs.sparkSession, model)  # 2**18 floats

    def run(batches):
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                    ("score", pa.float64())]))
        for chunk in chunks(batches, text_col):
            p, found, each = score(chunk, shared.value)
            hits = np.flatnonzero(each >= toxic_from)
            listed: list[list] = [[] for _ in range(len(chunk))]
            before = chunk.chars_before
            for h in hits.tolist():
                t = int(found.text[h])
                zero = before[chunk.starts[t]]
                listed[t].append({"start": int(before[found.begin[h]] - zero),
                                  "end": int(before[found.end[h]] - zero),
                                  "score": float(each[h])})
            yield pa.RecordBatch.from_pydict({
                id_col: chunk.rows.column(0), "score": pa.array(p),
                "predicted": pa.array((p >= toxic_from).astype(np.int32)),
                "offending": pa.array(listed, spans)})

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int, offending "
                                  "array<struct<start: bigint, end: bigint, score: double>>")


def keep(docs: DataFrame, model: Model, text_col: str = "text",
         toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The given rows, all columns kept, without those that score ``toxic_from`` or more."""
    shared = Shipped(docs.sparkSession, model)  # 2**18 floats

    plain, at = laid(docs, text_col)

    def run(batches):
        for chunk in chunks(batches, at[text_col]):
            yield chunk.rows.filter(pa.array(score(chunk, shared.value)[0] < toxic_from))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
