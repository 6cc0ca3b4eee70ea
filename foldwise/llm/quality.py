"""Quality rules: plain text counts and a calibrated n-gram classifier.

``base_counts`` computes, per text, the figures of the plain rules. ``fit`` trains a
logistic regression on hashed word and character n-grams of labelled texts, and maps its
margin to a probability on rows it did not train on. ``apply`` scores Arrow batches and
compares with fixed thresholds.

Nulls: a null text counts as empty; a null or missing label is no label. A null id is kept
and labels nothing. Texts without words get n_words 0 and fail the base rule. Without
labels of both kinds the model scores every text 0.5 and keeps what the base rules keep.
Repeated rows each give a row; of repeated labels of one id the smaller counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.linear_text import (Examples, fit_calibration, fit_logistic, gather_examples,
                                      labelled_sample)
from foldwise.llm.shared import Shipped
from foldwise.llm.textbytes import SPACE, Chunk, RangeHash, chunks, mix, pick, sequence_hash

FEATURE_BITS = 18
WORD_ORDERS = (1, 2)
CHAR_ORDERS = (4,)
#: Labelled rows the classifier is fitted on, chosen by a hash of the id.
SAMPLE_ROWS = 3000
#: Probability of good quality from which a text is kept.
KEEP_FROM = 0.2
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _repeats(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys within texts, first-of-group flags and group sizes in that order."""
    tagged = mix(keys ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(tagged, kind="stable")
    tagged = tagged[order]
    first = np.ones(len(tagged), dtype=bool)
    first[1:] = tagged[1:] != tagged[:-1]
    sizes = np.diff(np.append(np.flatnonzero(first), len(tagged)))
    return order, first, sizes


def base_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    """The plain figures of each text of a chunk."""
    begin, end, text = chunk.words
    hashed = RangeHash(chunk.data)
    data = chunk.data
    out = {"n_words": chunk.per_text(text).astype(np.int64)}
    out["word_chars"] = chunk.count(~SPACE[data] & ((data & 0xC0) != 0x80))
    out["n_symbols"] = chunk.count(SYMBOLS[data])

    # Lines that hold a word; all but the first of equal ones within a text count.
    cut_before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data == 10, out=cut_before[1:])
    line_no = cut_before[begin] + text  # differs between texts, grows along the chunk
    opens = np.flatnonzero(np.diff(line_no, prepend=-1)) if len(begin) else begin
    newlines = np.flatnonzero(data == 10)
    at = begin[opens]
    where = np.searchsorted(newlines, at)
    left = np.where(where > 0, np.append(newlines, 0)[where - 1] + 1, 0)
    left = np.maximum(left, chunk.starts[text[opens]])
    right = np.minimum(np.append(newlines, len(data))[where], chunk.ends[text[opens]])
    order, first, _ = _repeats(hashed.of(left, right), text[opens])
    out["n_dup_lines"] = chunk.per_text(text[opens][order][~first]).astype(np.int64)

    # Words in three-word windows that occur twice or more in their text.
    covered = np.zeros(len(begin) + 1, dtype=np.int64)
    if len(begin) >= 3:
        inside = text[2:] == text[:-2]
        windows = np.flatnonzero(inside)
        grams = sequence_hash(hashed.of(begin, end), 3)[windows]
        order, first, sizes = _repeats(grams, text[windows])
        repeated = windows[order[np.repeat(sizes, sizes) > 1]]
        np.add.at(covered, repeated, 1)
        np.add.at(covered, repeated + 3, -1)
    hit = np.cumsum(covered[:-1]) > 0
    out["n_repeat_words"] = chunk.per_text(text[hit]).astype(np.int64)
    return out


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hashed feature and value of each n-gram of a chunk.

    The values of one kind of n-gram in a text sum to one, so length does not matter.
    """
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    begin, end, text = chunk.words
    hashed = RangeHash(chunk.lowered)
    words = hashed.of(begin, end)
    texts, slots, values = [], [], []

    def add(kind: int, grams: np.ndarray, owner: np.ndarray) -> None:
        texts.append(owner)
        slots.append((mix(grams + np.uint64(kind)) & mask).astype(np.int32))
        totals = np.maximum(chunk.per_text(owner), 1)
        values.append((1.0 / totals)[owner].astype(np.float32))

    for n in WORD_ORDERS:
        grams = sequence_hash(words, n)
        inside = text[n - 1:] == text[:len(grams)] if len(grams) else np.zeros(0, bool)
        add(n, grams[inside], text[:len(grams)][inside])
    owner = chunk.text_of(np.arange(len(chunk.data)))
    for n in CHAR_ORDERS:
        if len(chunk.data) < n:
            continue
        grams = hashed.grams(n)
        inside = owner[n - 1:] == owner[:len(grams)]
        add(100 + n, grams[inside], owner[:len(grams)][inside])
    return np.concatenate(texts), np.concatenate(slots), np.concatenate(values)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``sample_rows`` labelled texts; every fourth calibrates."""
    chosen = labelled_sample(pick(labels, id_col, label), id_col, label, sample_rows)
    examples = gather_examples(pick(docs, id_col, text_col), chosen, features, id_col, text_col)
    return fit_examples(examples)


def fit_examples(examples: Examples) -> Model:
    if len(set(examples.labels.tolist())) < 2:
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), 0.0, 0.0, 0.0)
    aside = np.arange(len(examples.labels)) % 4 == 3
    weights, bias = fit_logistic(examples.only(~aside), 1 << FEATURE_BITS)
    held = examples.only(aside)
    slope, offset = fit_calibration(held.margins(weights) + bias, held.labels)
    return Model(weights, bias, slope, offset)


def score(chunk: Chunk, model: Model) -> np.ndarray:
    text, slot, value = features(chunk)
    margin = chunk.per_text(text, model.weights[slot] * value) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -40, 40)))


def apply(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep_from: float = KEEP_FROM) -> DataFrame:
    """Counts, base verdict, probability and final verdict per row.

    Returns ``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, probability``.
    """
    source = pick(docs, id_col, text_col)
    shared = Shipped(docs.sparkSession, model)  # 2**18 floats

    def run(batches):
        for chunk in chunks(batches, text_col):
            counts = base_counts(chunk)
            failed = ((counts["n_words"] < 50)
                      | (100 * counts["n_repeat_words"] > 50 * counts["n_words"]))
            p = score(chunk, shared.value)
            yield pa.RecordBatch.from_pydict({
                id_col: chunk.rows.column(0),
                **{k: pa.array(v) for k, v in counts.items()},
                "base_failed": pa.array(failed), "kept": pa.array(~failed & (p >= keep_from)),
                "probability": pa.array(p)})

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, {COUNTS_SCHEMA}, base_failed boolean, "
                                  "kept boolean, probability double")
