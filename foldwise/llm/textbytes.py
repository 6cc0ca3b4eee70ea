"""Texts of an Arrow batch as one byte array, cut into words, lines and hashes with NumPy.

Spark hands a Python task Arrow batches whose strings already lie end to end in one
buffer. Everything here works on that buffer: no Python object is made per word.
White space is bytes 9 to 13 and 32; a word is a run of other bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 19
#: Bytes up to which a range is hashed by sums.
PLAIN_BYTES = 96

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns, also where others differ only in case or repeat a name.

    A wanted column that is missing is an error; of several equal ones the first counts.
    """
    columns = list(df.columns)
    absent = [n for n in names if n not in columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"c{columns.index(n)}").alias(n) for n in names])


def laid(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """All columns under plain names that cannot clash, and those of the wanted ones.

    ``toDF(*df.columns)`` gives the rows their names back.
    """
    columns = list(df.columns)
    absent = [n for n in names if n not in columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return (df.toDF(*[f"c{i}" for i in range(len(columns))]),
            {n: f"c{columns.index(n)}" for n in names})


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << n.bit_length(), CHUNK_BYTES + 1024)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


class RangeHash:
    """64-bit hashes of any byte range of an array after one pass over it.

    Sums modulo 2**64 are made for short ranges: long ones can be built to meet in every such
    sum, so ranges of more than ``PLAIN_BYTES`` bytes get a cryptographic digest instead.
    """

    def __init__(self, data: np.ndarray):
        up, self.down = _tables(len(data) + 1)
        self.data = data
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[begin]) * self.down[begin]
        out = mix(raw + (end - begin).astype(np.uint64))
        long = np.flatnonzero(end - begin > PLAIN_BYTES)
        if len(long):
            data = memoryview(np.ascontiguousarray(self.data))
            out[long] = [int.from_bytes(blake2b(data[b:e], digest_size=8).digest(), "little")
                         for b, e in zip(begin[long].tolist(), end[long].tolist())]
        return out

    def grams(self, k: int) -> np.ndarray:
        """Hash of the ``k`` bytes from each position on; ``k`` is at most ``PLAIN_BYTES``."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


@dataclass
class Chunk:
    """Some neighbouring rows of a batch: ``data[starts[i]:ends[i]]`` is text ``i``."""

    rows: pa.RecordBatch
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @cached_property
    def lowered(self) -> np.ndarray:
        return LOWER[self.data]

    @cached_property
    def chars_before(self) -> np.ndarray:
        """Code points before each byte offset."""
        out = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and text number of each run of true bytes; no run crosses a text."""
        if not len(member):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        full = self.ends > self.starts
        before = np.empty_like(member)
        before[0], before[1:] = False, member[:-1]
        before[self.starts[full]] = False
        after = np.empty_like(member)
        after[-1], after[:-1] = False, member[1:]
        after[self.ends[full] - 1] = False
        begin = np.flatnonzero(member & ~before)
        end = np.flatnonzero(member & ~after) + 1
        return begin, end, self.text_of(begin)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """Number of the text that holds each of the ascending positions."""
        cuts = np.searchsorted(positions, np.append(self.starts, len(self.data)))
        return np.repeat(np.arange(len(self)), np.diff(cuts))

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    @cached_property
    def coded_words(self) -> pa.DictionaryArray:
        """The words, each different one held once."""
        begin, end, _ = self.words
        cuts = np.zeros(len(begin) + 1, dtype=np.int64)
        np.cumsum(end - begin, out=cuts[1:])
        letters = np.ascontiguousarray(self.data[~SPACE[self.data]])
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin),
            [None, pa.py_buffer(cuts), pa.py_buffer(letters)]).dictionary_encode()

    def count(self, member: np.ndarray) -> np.ndarray:
        """True bytes per text."""
        sums = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum(member, out=sums[1:])
        return sums[self.ends] - sums[self.starts]

    def per_text(self, text: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(text, weights=weights, minlength=len(self))


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut batches into chunks of at most ``limit`` bytes, null texts read as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.names.index(text))
        column = column.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64,
                                count=len(column) + 1, offset=8 * column.offset)
        held = column.buffers()[2]
        data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(column):
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), len(column))
            base = offsets[first]
            cut = offsets[first:last + 1] - base
            yield Chunk(batch.slice(first, last - first), data[base:offsets[last]], cut[:-1],
                        cut[1:])
            first = last


def sequence_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` neighbouring word hashes, in order."""
    out = words[:len(words) - n + 1].copy() if len(words) >= n else words[:0].copy()
    for k in range(1, n):
        out = mix(out * np.uint64(_MULTIPLIER) + words[k:len(words) - n + 1 + k])
    return out


def strings(parts: list[str]) -> pa.Array:
    return pa.array(parts, type=pa.string())
