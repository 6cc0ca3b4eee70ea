"""Masked pseudo-likelihood of texts under a bidirectional window network.

Every token is hidden in turn and predicted from the tokens on both its sides; the sum of
the log-probabilities scores the text. Words (ASCII letters lower-cased) are counted one by
one over the whole corpus. A word that makes up at least ``SHARE`` of all words, and
``LEAST`` of them, is a token. Any other word is spelled out, each piece a token of its own:
four bytes where these reach the same count among spelled-out words, else two, else single
bytes, all of which are tokens. Pieces that begin a word are apart from pieces that go on, so
two texts with different words never give the same tokens.

The network (a table of tokens, a matrix per neighbouring place, a hidden layer) predicts
the token itself, by a softmax over classes and a softmax over the tokens of the class, both
on the hidden layer. Tokens are sorted by count; the classes of frequent ones are narrow.

Training covers every text once, in rounds of growing size. In a round each task starts
from the same weights and walks its texts in small steps; the tasks' weights are averaged
by the tokens they saw.

Nulls: null, empty and blank texts have no word, sum 0 and a null mean; a null id is kept.
Repeated rows each count and each give a row. An empty corpus leaves the network as it
starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.array_sums import summed
from foldwise.llm.shared import Scratch, Shipped
from foldwise.llm.textbytes import Chunk, RangeHash, chunks, pick

#: Share and number of words from which on a word, or a piece, is a token.
SHARE, LEAST = 1e-5, 5
#: Bytes of the pieces of other words, tried in turn; single bytes always are tokens.
PIECES = (4, 2, 1)
#: Bits of four bytes that belong to a piece, by its length.
KEPT = np.array([0xFFFFFFFF ^ 0xFFFFFFFF >> 8 * k for k in range(PIECES[0] + 1)])
#: Classes of tokens.
CLASSES = 96
#: Places a token is predicted from, and hidden units.
PLACES = (-2, -1, 1, 2)
HIDDEN = 16
#: Sixteenths of the corpus per training round; every text is in one of them.
ROUNDS = ((0, 1), (1, 4), (4, 16))
#: Tokens of a first and of a late training step.
BATCHES, RATE = (512, 16384), 0.1
#: Bytes of text whose words are counted before they leave a task.
COUNTED_BYTES = 4 << 20
#: Odd factor that spreads values over slots.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Tokens whose scores are held at once, so that they stay in a core's cache.
BLOCK = 1024
#: Rows of scores are summed by a product with these.
ONES = np.ones(1 << 12, dtype=np.float32)
#: Size of scores up to which their exponentials need no shift.
SAFE = 60.0


class Places:
    """Finds values in a fixed list: they are dealt into slots by a product, few to each."""

    def __init__(self, values: np.ndarray, ids: np.ndarray):
        bits = max(len(values), 1).bit_length() + 3
        self.shift = np.uint64(64 - bits)
        slots = self._slot(values)
        order = np.argsort(slots)
        counts = np.bincount(slots, minlength=1 << bits)
        self.starts, self.counts = np.cumsum(counts) - counts, counts.astype(np.int32)
        self.most = int(counts.max())
        # Beyond the end stands the first value again, so that looking there finds what is there.
        order = np.append(order, order[:1].repeat(self.most))
        self.values, self.ids = values[order], ids[order]

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return (values.view(np.uint64) * SPREAD >> self.shift).view(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Id of each wanted value, -1 where there is none.

        After the first look only those are sought whose slot holds more."""
        slot = self._slot(wanted)
        at = self.starts.take(slot)
        out = self.ids.take(at)
        left = np.flatnonzero(self.values.take(at) != wanted)
        out[left] = -1
        for k in range(1, self.most):
            left = left[self.counts.take(slot.take(left)) > k]
            next_at = at.take(left) + k
            hit = self.values.take(next_at) == wanted.take(left)
            out[left[hit]] = self.ids.take(next_at[hit])
        return out


@dataclass(frozen=True)
class Tokens:
    """Hashes of words and keys of pieces, sorted, with the token of each."""

    words: np.ndarray
    word_ids: np.ndarray
    pieces: np.ndarray
    piece_ids: np.ndarray

    def __len__(self) -> int:
        return len(self.words) + len(self.pieces)

    @cached_property
    def by_word(self) -> Places:
        return Places(self.words, self.word_ids)

    @cached_property
    def by_piece(self) -> Places:
        return Places(self.pieces, self.piece_ids)


def cut(begin: np.ndarray, end: np.ndarray, size: np.ndarray
        ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut ranges into pieces of at most ``size`` bytes: begin, end, range, number in it."""
    n = -(-(end - begin) // size)
    of = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    low = begin[of] + k * size[of]
    return low, np.minimum(low + size[of], end[of]), of, k


def keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of each piece of up to four bytes: bytes, length, whether it begins a word."""
    padded = np.append(data, np.zeros(PIECES[0], dtype=np.uint8))
    four = np.ndarray(len(data) + 1, ">u4", padded, strides=(1,))[begin].astype(np.int64)
    size = end - begin
    return size * 2 + first << 32 | four & KEPT.take(size)


def spelled(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray,
            known: Tokens, sizes: tuple[int, ...] = PIECES) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the pieces of each range, and the range of each; unknown ones are cut again."""
    begin, end, of, k = cut(begin, end, np.full(len(begin), sizes[0]))
    first = first[of] * (k == 0)
    ids = known.by_piece.find(keys(data, begin, end, first))
    new = np.flatnonzero(ids < 0)
    if len(new) and sizes[1:]:
        ids, back = inserted(ids, new, *spelled(data, begin[new], end[new], first[new], known,
                                                sizes[1:]))
        of = of[back]
    return ids, of


def inserted(ids: np.ndarray, new: np.ndarray, parts: np.ndarray, of: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the parts of ``new[of]`` in place of each unknown one, and where each was."""
    n = np.ones(len(ids), dtype=np.int64)
    n[new] = np.bincount(of, minlength=len(new))
    back = np.repeat(np.arange(len(ids)), n)
    out = ids[back]
    out[out < 0] = parts
    return out, back


def tokens(chunk: Chunk, known: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers in order and the number of the text of each."""
    begin, end, text = chunk.words
    ids = known.by_word.find(RangeHash(chunk.lowered).of(begin, end))
    new = np.flatnonzero(ids < 0)
    if len(new):
        ids, back = inserted(ids, new, *spelled(chunk.lowered, begin[new], end[new],
                                                np.ones(len(new), dtype=np.int64), known))
        text = text[back]
    return ids, text


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word binary, n long``: how often each word of the corpus occurs."""

    def run(batches):
        for chunk in chunks(batches, text_col, COUNTED_BYTES):
            coded = replace(chunk, data=chunk.lowered).coded_words
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_pydict({"word": coded.dictionary.cast(pa.binary()),
                                              "n": pa.array(n, pa.int64())})

    return (pick(docs, text_col).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def piece_counts(words: DataFrame) -> DataFrame:
    """``piece long, n long``: pieces of four and of two bytes in the given counted words."""

    def run(batches):
        for chunk in chunks(batches, "word"):
            n = chunk.rows.column(1).to_numpy()
            for size in PIECES[:-1]:
                low, high, of, k = cut(chunk.starts, chunk.ends, np.full(len(n), size))
                key, back = np.unique(keys(chunk.data, low, high, (k == 0).astype(np.int64)),
                                      return_inverse=True)
                held = np.bincount(back, weights=n[of], minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"piece": pa.array(key), "n": pa.array(held)})

    return words.mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text_col: str = "text") -> Tokens:
    """Tokens of a corpus, numbered from the most frequent on.

    At most ``1 / SHARE`` words and some more pieces reach the driver.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(word_counts(docs, text_col), "lm-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, SHARE * total)
    own = words.where(F.col("n") >= least).toArrow().to_pydict()
    parts = (piece_counts(words.where(F.col("n") < least)).where(F.col("n") >= least)
             .toArrow().to_pydict())
    scratch.drop()
    held = np.frombuffer(b"".join(own["word"]), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in own["word"]], dtype=np.int64)
    starts = np.append(0, ends)[:-1].astype(np.int64)
    hashed = RangeHash(held).of(starts, ends)
    byte = np.arange(256, dtype=np.uint8)
    single = np.concatenate([keys(byte, np.arange(256), np.arange(1, 257), np.full(256, f))
                             for f in (0, 1)])
    many = dict.fromkeys(single.tolist(), 0) | dict(zip(parts["piece"], parts["n"]))
    pieces = np.array(list(many), dtype=np.int64)
    count = np.array(own["n"] + list(many.values()), dtype=np.int64)
    tie = np.concatenate([hashed, pieces.astype(np.uint64)])
    rank = np.empty(len(count), dtype=np.int32)
    rank[np.lexsort((tie, -count))] = np.arange(len(count), dtype=np.int32)
    by_word, by_piece = np.argsort(hashed), np.argsort(pieces)
    return Tokens(hashed[by_word], rank[:len(hashed)][by_word], pieces[by_piece],
                  rank[len(hashed):][by_piece])


def classes_of(size: int) -> np.ndarray:
    """Where each class begins among the tokens, and their number: widths grow as ranks do."""
    steps = np.arange(CLASSES + 1, dtype=float) / CLASSES
    return np.maximum(np.floor(size * steps ** 2).astype(np.int64), np.arange(CLASSES + 1))


#: A class for each token.
ONE_EACH = np.arange(CLASSES + 1)


def shapes(cuts: np.ndarray) -> tuple[tuple[int, ...], ...]:
    return ((int(cuts[-1]) + 1, HIDDEN), (len(PLACES), HIDDEN, HIDDEN), (HIDDEN,),
            (HIDDEN, CLASSES), (CLASSES,), (int(cuts[-1]), HIDDEN), (int(cuts[-1]),))


def start(cuts: np.ndarray = ONE_EACH, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, 0.25, int(np.prod(s))) if len(s) > 1
                           else np.zeros(s[0]) for s in shapes(cuts)]).astype(np.float32)


def layers(flat: np.ndarray, cuts: np.ndarray = ONE_EACH, tables: bool = True
           ) -> list[np.ndarray]:
    """Views of the weights, the beginnings of the classes, a table for each place (only for
    other readers of a network), which softmax (of each class, and last of the classes) needs
    its scores shifted, and the weights of the classes and of the tokens, each with its biases."""
    sizes = shapes(cuts)
    ends = np.cumsum([int(np.prod(s)) for s in sizes])
    parts = [p.reshape(s) for p, s in zip(np.split(flat, ends[:-1]), sizes)]
    most = np.append(np.maximum.reduceat(_sums(np.abs(parts[5])), cuts[:-1])
                     + np.maximum.reduceat(np.abs(parts[6]), cuts[:-1]),
                     np.abs(parts[3]).sum(axis=0).max() + np.abs(parts[4]).max())
    return [*parts, cuts, np.matmul(parts[0], parts[1]) if tables else None,
            most > SAFE,  # hidden units reach 1
            flat[ends[2]:ends[4]].reshape(-1, CLASSES), np.column_stack(parts[5:7])]


def neighbours(classes: np.ndarray, text: np.ndarray, beyond: int = CLASSES) -> np.ndarray:
    """Tokens at every place around each token; ``beyond`` outside the text."""
    out = np.full((len(classes), len(PLACES)), beyond, dtype=np.int32)
    for k, d in enumerate(PLACES):
        a, b = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d), slice(d, None))
        same = text[a] == text[b]
        out[a, k][same] = classes[b][same]
    return out


def _hidden(net: list[np.ndarray], around: np.ndarray) -> np.ndarray:
    """Hidden units of tokens, and a column of ones for the biases.

    Tokens next to each other share neighbours, so these are read from a near cache."""
    held = np.ones((len(around), HIDDEN + 1), dtype=net[0].dtype)
    matrix = net[1].reshape(-1, HIDDEN)
    for a in range(0, len(around), BLOCK):
        some = slice(a, a + BLOCK)
        z = net[0].take(around[some], axis=0).reshape(-1, len(matrix)) @ matrix
        z += net[2]
        np.tanh(z, out=held[some, :HIDDEN])
    return held


def _powers(h: np.ndarray, weights: np.ndarray, shift: bool) -> np.ndarray:
    """Scores of classes or of tokens, shifted if their exponentials might overflow."""
    z = h @ weights
    if shift:
        z -= z.max(axis=1)[:, None]
    return z


def _sums(z: np.ndarray) -> np.ndarray:
    """Sum of each row; a product is faster than a reduction."""
    return z @ ONES[:z.shape[1]] if z.shape[1] <= len(ONES) else z.sum(axis=1)


def _at(z: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scores as one row, and where the right one of each row stands in it."""
    return z.reshape(-1), np.arange(0, z.size, z.shape[1]) + right


def _by_class(net: list[np.ndarray], wanted: np.ndarray):
    """Places in order of tokens, the class of each in that order and its number in the class,
    and where the classes begin.

    Members of a class then lie side by side, so that its rows are views."""
    cuts = net[7]
    order = np.argsort(wanted.astype(np.uint16 if cuts[-1] <= 1 << 16 else np.int32), kind="stable")
    wanted = wanted.take(order)
    ends = np.searchsorted(wanted, cuts)
    of = np.repeat(np.arange(CLASSES), np.diff(ends))
    return order, of, wanted - cuts.take(of), ends.tolist()


def _blocks(net: list[np.ndarray], ends: list[int], block: int = BLOCK
            ) -> Iterator[tuple[int, int, int, int, int]]:
    """Class, its tokens, and some of its rows, for each class with several tokens."""
    cuts = net[7].tolist()
    for c, (low, high, a, b) in enumerate(zip(cuts, cuts[1:], ends, ends[1:])):
        if high - low > 1:
            for at in range(a, b, block):
                yield c, low, high, at, min(at + block, b)


def log_likelihood(net: list[np.ndarray], around: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Log-probability of each token given its neighbours."""
    order, of, member, ends = _by_class(net, classes)
    h, own = _hidden(net, around).take(order, axis=0), np.empty(len(classes), dtype=np.float32)
    total, block = np.empty_like(own), 2 * BLOCK
    for a in range(0, len(classes), block):
        some = slice(a, a + block)
        z = _powers(h[some], net[10], net[9][-1])
        flat, at = _at(z, of[some])
        own[some] = flat.take(at)
        total[some] = _sums(np.exp(z, out=z))
    own -= np.log(total)
    total.fill(1)
    for c, low, high, a, b in _blocks(net, ends, block):
        z = _powers(h[a:b], net[11][low:high].T, net[9][c])
        flat, at = _at(z, member[a:b])
        own[a:b] += flat.take(at)
        total[a:b] = _sums(np.exp(z, out=z))
    own -= np.log(total)
    out = np.empty_like(own)
    out[order] = own
    return out


def _errors(z: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Turns scores into errors: probabilities less one at the right place, over ``n``, but for
    a factor of each row, which is returned."""
    np.exp(z, out=z)
    total = _sums(z)
    flat, at = _at(z, right)
    flat[at] -= total
    return np.divide(1 / n, total, dtype=z.dtype)


def gradient(net: list[np.ndarray], around: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Mean gradient of the negative log-probability, laid out like the weights."""
    n = len(classes)
    order, of, member, ends = _by_class(net, classes)
    h = _hidden(net, around).take(order, axis=0)
    choice, members = np.zeros_like(net[10].T), np.zeros_like(net[11])
    own, part = np.empty_like(h[:, :HIDDEN]), np.zeros_like(h[:, :HIDDEN])
    share = np.zeros((n, 1), dtype=h.dtype)
    for a in range(0, n, BLOCK):
        some = slice(a, a + BLOCK)
        mine = h[some]
        z = _powers(mine, net[10], net[9][-1])
        share[some, 0] = _errors(z, of[some], n)
        np.matmul(z, net[3].T, out=own[some])
        choice += z.T @ (mine * share[some])
    own *= share
    for c, low, high, a, b in _blocks(net, ends):
        mine = h[a:b]
        z = _powers(mine, net[11][low:high].T, net[9][c])
        share[a:b, 0] = _errors(z, member[a:b], n)
        np.matmul(z, net[5][low:high], out=part[a:b])
        members[low:high] += z.T @ (mine * share[a:b])
    for a in range(0, n, BLOCK):
        some = slice(a, a + BLOCK)
        own[some] += part[some] * share[some]
        own[some] *= 1 - h[some, :HIDDEN] ** 2
    del h, mine, part
    place = np.empty_like(order)
    place[order] = np.arange(n)
    back = own.take(place, axis=0)
    del own
    table, places = _context(net, around, classes, back)
    return np.concatenate([table.ravel(), places.ravel(), back.sum(axis=0),
                           choice.T.ravel(), members[:, :HIDDEN].ravel(), members[:, HIDDEN]])


def _context(net: list[np.ndarray], around: np.ndarray, classes: np.ndarray, back: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the table of tokens and of the matrices, from those of the hidden units.

    What a token gets as a neighbour is first added up at its own place, if that is among the
    given ones; what others get, and the bounds of texts, stands behind."""
    n, matrix = len(classes), net[1].reshape(-1, HIDDEN)
    apart = np.ones((len(PLACES), n), dtype=bool)
    for k, d in enumerate(PLACES):
        low, high = max(0, -d), max(0, -d, min(n, n - d))
        apart[k, low:high] = around[low:high, k] != classes[low + d:high + d]
    token = np.concatenate([classes, around.T[apart]]).astype(np.int64)
    total, places = np.zeros((HIDDEN, len(token)), dtype=back.dtype), np.zeros_like(matrix)
    ends = n + np.append(0, np.cumsum(apart.sum(axis=1)))
    for a in range(0, n, 4 * BLOCK):
        mine = back[a:a + 4 * BLOCK]
        b = a + len(mine)
        places += net[0].take(around[a:b], axis=0).reshape(len(mine), -1).T @ mine
        parts = (matrix @ mine.T).reshape(len(PLACES), HIDDEN, -1)
        for k, d in enumerate(PLACES):
            out = np.flatnonzero(apart[k, a:b])
            total[:, ends[k]:ends[k] + len(out)] = parts[k][:, out]
            ends[k] += len(out)
            parts[k][:, out] = 0
            low, high = max(a, -d), max(a, -d, min(b, n - d))
            total[:, low + d:high + d] += parts[k][:, low - a:high - a]
    table = np.empty(net[0].shape[::-1], dtype=net[0].dtype)
    for j in range(HIDDEN):
        table[j] = np.bincount(token, weights=total[j], minlength=table.shape[1])
    return table.T, places


class Trainer:
    """Adagrad steps from given weights and sums of squares; steps grow from small ones."""

    def __init__(self, flat: np.ndarray, squares: np.ndarray, cuts: np.ndarray, seen: int = 0):
        self.flat, self.squares, self.cuts = flat.copy(), squares.copy(), cuts
        self.before, self.seen = seen, 0

    def learn(self, found: np.ndarray, text: np.ndarray) -> None:
        around = neighbours(found, text, int(self.cuts[-1]))
        a = 0
        while a < len(found):
            size = min(BATCHES[1], BATCHES[0] + (self.before + self.seen) // 4)
            some = slice(a, a + size)
            g = gradient(layers(self.flat, self.cuts, tables=False), around[some], found[some])
            self.squares += g * g
            g *= np.float32(RATE)
            g /= np.sqrt(self.squares) + np.float32(1e-8)
            self.flat -= g
            self.seen += len(found[some])
            a += size


@dataclass(frozen=True)
class Model:
    tokens: Tokens
    cuts: np.ndarray
    weights: np.ndarray


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Count all words, then train on every text once."""
    source = pick(docs, text_col)
    context = docs.sparkSession.sparkContext
    found = vocabulary(source, text_col)
    cuts = classes_of(len(found))
    known = Shipped(docs.sparkSession, (found, cuts))
    flat, seen = start(cuts), 0
    size = len(flat)
    squares = np.zeros_like(flat)
    share = F.pmod(F.xxhash64(text_col), F.lit(16))
    for low, high in ROUNDS:
        begin = context.broadcast((flat, squares, seen))

        def train(batches, begin=begin):
            held, ends = known.value
            trainer = Trainer(*begin.value[:2], ends, begin.value[2])
            for chunk in chunks(batches, text_col):
                ids, text = tokens(chunk, held)
                if len(ids):
                    trainer.learn(ids, text)
            n = trainer.seen
            if not n:
                return np.zeros(2 * size + 2, dtype=np.float32)
            return np.concatenate([trainer.flat * n, trainer.squares * n, [n, 1]]).astype("<f4")

        total = summed(source.where((share >= low) & (share < high)), train, 2 * size + 2, 16,
                       "<f4")
        if total[-2] > 0:
            flat, squares = np.split((total[:-2] / total[-2]).astype(np.float32), 2)
            seen += int(total[-2] / total[-1])
    return Model(found, cuts, flat)


def score(chunk: Chunk, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed log-probability of each text."""
    found, text = tokens(chunk, model.tokens)
    each = log_likelihood(layers(model.weights, model.cuts, tables=False),
                          neighbours(found, text, int(model.cuts[-1])), found).astype(float)
    n_words = chunk.per_text(chunk.words[2]).astype(np.int64)
    return n_words, chunk.per_text(text, each).astype(float)


def apply(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Returns ``id_col, n_words long, log_likelihood double, mean_log_likelihood double``."""
    source = pick(docs, id_col, text_col)
    shared = Shipped(docs.sparkSession, model)

    def run(batches):
        for chunk in chunks(batches, text_col):
            n, total = score(chunk, shared.value)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_pydict({
                id_col: chunk.rows.column(0), "n_words": pa.array(n),
                "log_likelihood": pa.array(total), "mean_log_likelihood": mean})

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_words long, log_likelihood double, "
                                  "mean_log_likelihood double")
