"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs, and decoding.

The leaves of the tree are the symbols of a word; each holds the rank of the pair that
begins there. Every inner node keeps the smaller of its two children, a rank together with
its place, so the root names the leftmost pair of lowest rank. A merge changes three
leaves and with them their paths to the root. Encoding ends when the root holds no pair.

Words of one batch are encoded side by side: the trees of equally long words form one
matrix and every step merges one pair of each word. Long words get a tree of their own.

The vocabulary is a ``tokenizers`` JSON file of the word-end kind: texts are brought to
composed form, white space and case are folded, words are cut by the file's pattern, their
bytes mapped to printable letters. Letters that Unicode added after the versions known to
the installed libraries may be cut otherwise. Marks of the file's added tokens in a text
become those tokens, as the library does by default.

Nulls: a null text counts as empty and gives no token. A null id is kept. Repeated rows
each give a row.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from foldwise.llm.shared import Shipped
from foldwise.llm.textbytes import chunks, pick

#: Words a task remembers; beyond that it forgets all and starts again.
REMEMBERED = 250_000
#: Symbols from which a word gets a tree of its own.
LONG = 64
#: Precedes an added token among words; no text holds half a surrogate pair.
MARK = "\ud800"
_NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The printable letter for each byte, by the usual rule of byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


@dataclass
class Vocabulary:
    tokens: list[str]
    first: list[int]
    last: list[int]
    pair_rank: dict[int, int]
    merged: np.ndarray
    added: dict[str, int]
    pattern: str
    keys: np.ndarray = field(init=False)
    ranks: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        # Open addressing with a quarter of the places in use, looked up by whole arrays.
        size = 1 << (4 * max(len(self.pair_rank), 1) - 1).bit_length()
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.zeros(size, dtype=np.int64)
        for key, rank in self.pair_rank.items():
            at = self._place(key) & (size - 1)
            while self.keys[at] >= 0:
                at = (at + 1) & (size - 1)
            self.keys[at], self.ranks[at] = key, rank

    @staticmethod
    def _place(key):
        return (key * 0x9E3779B1) >> 13

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge."""
        key = left.astype(np.int64) << 20 | right
        out = np.full(len(key), _NONE)
        open_, at = np.arange(len(key)), self._place(key) & (len(self.keys) - 1)
        while len(open_):
            held = self.keys[at]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            more = ~hit & (held >= 0)
            open_, at = open_[more], (at[more] + 1) & (len(self.keys) - 1)
        return out


def load(path: str) -> Vocabulary:
    """Read a vocabulary file; only its contents travel to the executors."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    ids = file["model"]["vocab"]
    end = file["model"]["end_of_word_suffix"]
    letters = byte_letters()
    pairs, merged = {}, np.zeros(len(file["model"]["merges"]), dtype=np.int64)
    for rank, (left, right) in enumerate(file["model"]["merges"]):
        pairs.setdefault(ids[left] << 20 | ids[right], rank)
        merged[rank] = ids[left + right]
    added = {t["content"]: t["id"] for t in file["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *added.values()]) + 1)
    for token, i in [*ids.items(), *added.items()]:
        tokens[i] = token
    pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return Vocabulary(tokens, [ids[c] for c in letters], [ids[c + end] for c in letters], pairs,
                      merged, added, pattern)


def _symbols(word: str, vocabulary: Vocabulary) -> list[int]:
    raw = word.encode("utf-8")
    return [*map(vocabulary.first.__getitem__, raw[:-1]), vocabulary.last[raw[-1]]]


def merge_one(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """Merge the symbols of one word with a tree of its own."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols, width = list(symbols), 1 << (n - 1).bit_length()
    ranks, none = vocabulary.pair_rank, (_NONE, 0)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))

    def leaf(i: int) -> tuple[int, int]:
        j = after[i]
        rank = ranks.get(symbols[i] << 20 | symbols[j]) if j >= 0 else None
        return none if rank is None else (rank, i)

    tree = [none] * (2 * width)
    tree[width:width + n] = [leaf(i) for i in range(n)]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low

    while tree[1][0] != _NONE:
        rank, i = tree[1]
        gone = after[i]
        symbols[i] = int(vocabulary.merged[rank])
        after[i] = after[gone]
        if after[i] >= 0:
            before[after[i]] = i
        put(gone, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i >= 0:
        out.append(symbols[i])
        i = after[i]
    return out


def merge_many(words: list[list[int]], vocabulary: Vocabulary) -> list[list[int]]:
    """Merge words side by side, trees of one width in one matrix."""
    out: list[list[int]] = [[]] * len(words)
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if len(w) < 2:
            out[k] = w
        elif len(w) > LONG:
            out[k] = merge_one(w, vocabulary)
        else:
            groups.setdefault((len(w) - 1).bit_length(), []).append(k)
    for depth, members in groups.items():
        merged = _merge_matrix([words[k] for k in members], 1 << depth, vocabulary)
        for k, ids in zip(members, merged):
            out[k] = ids
    return out


def _merge_matrix(words: list[list[int]], width: int, vocabulary: Vocabulary) -> list[list[int]]:
    m = len(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    inside = np.arange(width) < lengths[:, None]
    symbols = np.full((m, width), -1, dtype=np.int64)
    symbols[inside] = np.fromiter((s for w in words for s in w), np.int64, int(lengths.sum()))
    # One more column stands for "none": links to it are read and written without harm.
    after = np.full((m, width + 1), width, dtype=np.int64)
    after[:, :width] = np.where(np.arange(1, width + 1) < lengths[:, None],
                                np.arange(1, width + 1), width)
    before = np.full((m, width + 1), width, dtype=np.int64)
    before[:, 1:width] = np.arange(width - 1)
    alive = np.zeros((m, width), dtype=bool)
    alive[:] = inside
    tree = np.full((m, 2 * width), _NONE, dtype=np.int64)
    row, col = np.nonzero(inside[:, 1:])
    rank = vocabulary.rank(symbols[row, col], symbols[row, col + 1])
    tree[row, width + col] = np.where(rank == _NONE, _NONE, rank * width + col)
    low = width
    while low > 1:
        low >>= 1
        both = tree[:, 2 * low:4 * low]
        tree[:, low:2 * low] = np.minimum(both[:, ::2], both[:, 1::2])

    def climb(rows: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        node = place + width
        tree[rows, node] = value
        while node[0] > 1:  # all paths are equally long
            value = np.minimum(value, tree[rows, node ^ 1])
            node = node >> 1
            tree[rows, node] = value

    def leaf(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        nxt = after[rows, place]
        value = np.full(len(rows), _NONE)
        real = np.flatnonzero(nxt < width)
        rank = vocabulary.rank(symbols[rows[real], place[real]], symbols[rows[real], nxt[real]])
        value[real] = np.where(rank == _NONE, _NONE, rank * width + place[real])
        return value

    rows = np.flatnonzero(tree[:, 1] != _NONE)
    while len(rows):
        best = tree[rows, 1]
        place = best & (width - 1)
        symbols[rows, place] = vocabulary.merged[best // width]
        gone = after[rows, place]
        follow = after[rows, gone]
        after[rows, place] = follow
        before[rows, follow] = place
        alive[rows, gone] = False
        climb(rows, gone, np.full(len(rows), _NONE))
        climb(rows, place, leaf(rows, place))
        left = before[rows, place]
        real = np.flatnonzero(left < width)
        if len(real):
            climb(rows[real], left[real], leaf(rows[real], left[real]))
        rows = rows[tree[rows, 1] != _NONE]
    flat = symbols[alive].tolist()
    cuts = np.append(0, np.cumsum(alive.sum(axis=1))).tolist()
    return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    """Encodes texts, remembering the words it has met."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.find = regex.compile(vocabulary.pattern).findall
        self.space = regex.compile(r"\s+").sub
        marks = "|".join(regex.escape(t) for t in vocabulary.added)
        self.marks = regex.compile(f"({marks})") if marks else None
        self.ids: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}

    def words(self, text: str) -> list[str]:
        """Words of a text, marks of added tokens in place."""
        if self.marks is None or not self.marks.search(text):
            return self._cut(text)
        out: list[str] = []
        for k, part in enumerate(self.marks.split(text)):
            out += [MARK + part] if k % 2 else self._cut(part)
        return out

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.find(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Case is folded letter by letter: a sigma at a word's end gets no form of its own.
        return self.find(self.space(" ", text).replace("Σ", "σ").lower())

    def learn(self, texts: list[list[str]]) -> None:
        """Encode all words that are not remembered yet."""
        new = list(set().union(*texts) - self.ids.keys())
        if len(self.ids) + len(new) > self.remembered:
            self.ids.clear()
            self.shown.clear()
            new = list(set().union(*texts))
        known = [w for w in new if w[0] != MARK]
        for w in new:
            if w[0] == MARK:
                i = self.vocabulary.added[w[1:]]
                self.ids[w], self.shown[w] = np.uint32(i).tobytes(), w[1:]
        names = self.vocabulary.tokens
        merged = merge_many([_symbols(w, self.vocabulary) for w in known], self.vocabulary)
        for w, ids in zip(known, merged):
            self.ids[w] = np.array(ids, dtype="<u4").tobytes()
            self.shown[w] = " ".join([names[i] for i in ids])

    def encode(self, words: list[str]) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.ids.__getitem__, words))


def decode(ids: bytes, vocabulary: Vocabulary) -> str:
    """The tokens of the ids joined by blanks, as a vocabulary without decoder gives them."""
    names = vocabulary.tokens
    return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def apply(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode every text.

    Returns ``id_col``, the columns named by ``carry``, ``n_tokens long`` and either
    ``ids array<int>, decoded string`` or, with ``digest``, their SHA-256 in lower-case
    hexadecimal as ``ids_sha256, decoded_sha256``.
    """
    source = pick(docs, id_col, text_col, *carry)
    shared = Shipped(docs.sparkSession, load(path))  # one vocabulary

    def run(batches):
        encoder = Encoder(shared.value)
        shown = encoder.shown
        for chunk in chunks(batches, text_col, limit=1 << 20):
            texts = [encoder.words(t or "") for t in chunk.rows.column(1).to_pylist()]
            encoder.learn(texts)
            ids = [encoder.encode(w) for w in texts]
            columns = {id_col: chunk.rows.column(0),
                       **{c: chunk.rows.column(2 + k) for k, c in enumerate(carry)},
                       "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            if digest:
                columns["ids_sha256"] = pa.array(
                    [hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                columns["decoded_sha256"] = pa.array(
                    [hashlib.sha256(" ".join(map(shown.__getitem__, w)).encode()).hexdigest()
                     for w in texts], pa.string())
            else:
                columns["ids"] = pa.array([np.frombuffer(x, "<i4") for x in ids],
                                          pa.list_(pa.int32()))
                columns["decoded"] = pa.array([decode(x, shared.value) for x in ids],
                                              pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}"
                      for c in (id_col, *carry))
    rest = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return source.mapInArrow(run, f"{kinds}, n_tokens long, {rest}")
