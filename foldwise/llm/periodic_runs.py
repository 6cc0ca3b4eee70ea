"""Maximal periodic runs of words, found with string synchronising sets.

A run is a stretch of neighbouring words with smallest period ``q``, at least ``times``
periods and ``least`` words long, that no neighbouring word extends. All runs of a text are
found, whatever their period:

* **Names.** Every stretch of ``2**k`` words gets a number that equal stretches of a text
  share (pairs of numbers one scale below, renumbered). A stretch that occurs once in its
  text cannot lie in a run, so only repeated ones go on to the next scale; where no stretch
  of neighbouring repeated ones is long enough any more, the search ends.
* **Synchronising positions.** At scale ``t = 2**k`` each position has a hash of the name of
  its ``t`` words. A position is chosen if the smallest hash within the next ``t`` positions
  is at either end of them: the choice depends on the next ``2 * t`` words alone, so equal
  surroundings choose alike, and every ``t`` neighbours hold a chosen one, except where the
  words have a period of at most ``t / 3``. Such highly periodic positions are left out.
* **Proposals.** A run with period ``1.5 * t <= q < 3 * t`` holds chosen positions ``q``
  apart whose next ``2 * t`` words are equal. Pairs of chosen positions with equal names at
  such distances propose periods; they are widened word by word, so what is found is exact.
* **Highly periodic regions.** Periods up to ``DIRECT`` words are found by comparing each
  word with the one that far ahead. Together with the runs of lower scales they are the
  regions that a scale leaves out.

Everything is compared within one text. Nulls: a null text has no words and no runs; a null
id is kept. Empty texts and texts without words have no runs and collapse to nothing.
Repeated rows each give a row. An empty table gives an empty result. The arrays of one text
take about 20 bytes per byte of text; a text must fit into one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textbytes import Chunk, chunks, mix, pick

#: Periods up to this many words are found by direct comparison; three of them make the
#: shortest run of the default settings.
DIRECT = 8
#: Words whose bytes are put together at once when a text is written anew.
SLICE_WORDS = 1 << 16
_NEVER = np.uint64(2**64 - 1)
_NONE = np.zeros(0, dtype=np.int64)


def word_names(chunk: Chunk) -> np.ndarray:
    """A number per word of a chunk; equal numbers are equal words of the same text."""
    text = chunk.words[2]
    codes = chunk.coded_words.indices.to_numpy().astype(np.int64)
    return codes * len(chunk) + text


def _stretches(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and one past the last of each row of neighbouring positions."""
    if not len(positions):
        return _NONE, _NONE
    cut = np.flatnonzero(np.diff(positions) != 1) + 1
    return np.append(0, cut), np.append(cut, len(positions))


def _long_enough(positions: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a row of at least ``least`` neighbours."""
    first, last = _stretches(positions)
    return np.repeat(last - first >= least, last - first)


def _renumbered(keys: np.ndarray, times: int) -> np.ndarray:
    """Dense numbers of the keys that occur at least ``times`` times, -1 for the others."""
    if not len(keys):
        return _NONE
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    count = np.diff(np.append(start, len(keys)))
    kept = count >= times
    number = np.where(kept, np.cumsum(kept) - 1, -1)
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.repeat(number, count)
    return out


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours; the result is ``width - 1`` shorter."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[:len(values) - (width - span)], values[width - span:])
    return values


def _same_ahead(names: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many positions from ``at`` on, in direction ``step``, equal the one ``period`` ahead."""
    out = np.zeros(len(at), dtype=np.int64)
    open_, width, limit = np.arange(len(at)), 16, len(names)
    while len(open_):
        width = max(1, min(width, (1 << 20) // len(open_)))
        place = (at[open_] + step * out[open_])[:, None] + step * np.arange(width)
        ahead = place + period[open_][:, None]
        inside = (place >= 0) & (ahead < limit)
        equal = inside & (names[np.where(inside, place, 0)] == names[np.where(inside, ahead, 0)])
        all_ = equal.all(axis=1)
        out[open_] += np.where(all_, width, equal.argmin(axis=1))
        open_, width = open_[all_], 4 * width
    return out


def _widened(names: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Stretches of equality over a period, joined, widened to the full and turned into runs."""
    order = np.lexsort((begin, period))
    begin, end, period = begin[order], end[order], period[order]
    # Equal stretches of one period that touch are one; ends grow with begins at one scale.
    new = np.append(True, (period[1:] != period[:-1]) | (begin[1:] > end[:-1]))
    first = np.flatnonzero(new)
    begin, period, end = begin[first], period[first], np.maximum.reduceat(end, first)
    end = end + _same_ahead(names, end, period, 1)
    begin = begin - _same_ahead(names, begin - 1, period, -1)
    found = np.unique(np.stack([begin, end + period, period]), axis=1)
    return found[0], found[1], found[2]


def _direct(names: np.ndarray, period: int):
    """All stretches of one short period, at least three periods and four words long."""
    if len(names) <= period:
        return _NONE, _NONE, _NONE
    first, last = _stretches(at := np.flatnonzero(names[:-period] == names[period:]))
    if not len(first):
        return _NONE, _NONE, _NONE
    begin, end = at[first], at[last - 1] + 1 + period
    good = end - begin >= max(4, 3 * period)
    return begin[good], end[good], np.full(int(good.sum()), period)


def _covered(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which positions some stretch covers."""
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, np.maximum(end, begin), -1)
    return np.cumsum(change[:-1]) > 0


def synchronising(positions: np.ndarray, number: np.ndarray, t: int,
                  periodic: np.ndarray) -> np.ndarray:
    """Indexes into ``positions`` that are chosen at scale ``t``.

    ``positions`` ascend; ``number`` names the ``t`` words from each on; ``periodic`` marks
    those whose ``t`` words have a period of at most ``t / 3``.
    """
    if len(positions) <= t:
        return _NONE
    hashed = mix(number.astype(np.uint64) + np.uint64(1))
    hashed[periodic] = _NEVER
    least = _window_least(hashed, t + 1)
    n = len(least)
    chosen = (least != _NEVER) & ((least == hashed[:n]) | (least == hashed[t:t + n]))
    return np.flatnonzero(chosen & (positions[t:t + n] - positions[:n] == t))


def runs(names: np.ndarray, least: int = 24, times: int = 3):
    """Begin, end and period of every run of an array of names.

    ``least`` must be at least ``3 * DIRECT`` and ``times`` at least 3.
    """
    if least < 3 * DIRECT or times < 3:
        raise ValueError(f"least must be {3 * DIRECT} or more and times 3 or more")
    n = len(names)
    found = [_direct(names, q) for q in range(1, DIRECT + 1)]
    number, t = np.full(n, -1, dtype=np.int64), 1
    number[:] = _renumbered(names, 3)
    positions = np.flatnonzero(number >= 0)
    while len(positions):
        # A run whose period this scale or a later one proposes keeps so many neighbours.
        positions = positions[_long_enough(positions, max(7 * t // 2 + 1, least - t + 1))]
        mine = number[positions]
        if 3 * t > DIRECT and len(positions):
            small = [(b, e) for b, e, q in found if len(q) for b, e in
                     [(b[(3 * q <= t) & (e - b >= t)], e[(3 * q <= t) & (e - b >= t)])]]
            begin = np.concatenate([_NONE, *(b for b, _ in small)])
            end = np.concatenate([_NONE, *(e for _, e in small)])
            periodic = _covered(n, begin, end - t + 1)[positions]
            at = synchronising(positions, mine, t, periodic)
            here = positions[at]
            wide = int(mine.max()) + 1
            key = mine[at] * wide + mine[at + t]
            order = np.argsort(key, kind="stable")
            here, key = here[order], key[order]
            pairs, lag, low = [], 1, max(DIRECT + 1, -(-3 * t // 2))
            while lag < len(here):
                near = (key[lag:] == key[:-lag]) & (here[lag:] - here[:-lag] < 3 * t)
                if not near.any():
                    break
                good = np.flatnonzero(near & (here[lag:] - here[:-lag] >= low))
                pairs.append((here[good], here[good + lag] - here[good]))
                lag += 1
            if pairs:
                begin, period = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
                if len(begin):
                    found.append(_widened(names, begin, begin + 2 * t, period))
        if not len(positions):
            break
        # Names of the next scale, of positions whose both halves are repeated.
        both = positions[positions + t < n]
        kept = np.full(n, -1, dtype=np.int64)
        kept[positions] = mine
        right = kept[both + t]
        both, right = both[right >= 0], right[right >= 0]
        if not len(both):
            break
        number = np.full(n, -1, dtype=np.int64)
        number[both] = _renumbered(kept[both] * (int(mine.max()) + 1) + right, 2)
        positions, t = both[number[both] >= 0], 2 * t
    begin, end, period = (np.concatenate([f[i] for f in found]) for i in range(3))
    good = end - begin >= np.maximum(least, times * period)
    begin, end, period = begin[good], end[good], period[good]
    # The same stretch found with a multiple of its smallest period is the same run.
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    if len(begin):
        new = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))
        begin, end, period = begin[new], end[new], period[new]
    return begin, end, period


def _best(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> int:
    """The run of the greatest exponent; of equal ones the first, then the shorter period."""
    share = (end - begin) / period
    near = np.flatnonzero(share >= share.max() * (1 - 1e-9))
    return min(near.tolist(), key=lambda i: (-Fraction(int(end[i] - begin[i]), int(period[i])),
                                             int(begin[i]), int(period[i])))


def joined(chunk: Chunk, begin: np.ndarray, end: np.ndarray) -> str:
    """SHA-256 of the named words joined by one space, put together slice by slice."""
    digest = hashlib.sha256()
    for a in range(0, len(begin), SLICE_WORDS):
        digest.update(spelled(chunk, begin[a:a + SLICE_WORDS], end[a:a + SLICE_WORDS],
                              a + SLICE_WORDS >= len(begin)))
    return digest.hexdigest()


def spelled(chunk: Chunk, begin: np.ndarray, end: np.ndarray, last: bool = True) -> bytes:
    """The named words, a space after each but the last of a text."""
    if not len(begin):
        return b""
    size = end - begin + 1
    upto = np.cumsum(size)
    at = np.repeat(begin - (upto - size), size) + np.arange(int(upto[-1]))
    at[upto - 1] = 0
    out = chunk.data[at]
    out[upto - 1] = 32
    return out[:-1].tobytes() if last else out.tobytes()


def _source(text: np.ndarray, first: np.ndarray, count: np.ndarray, spans) -> np.ndarray:
    """Which word stands at each place once parts of some texts are made periodic."""
    at = np.arange(len(text))
    if spans is None:
        return at
    start, period = spans
    own = at - first[text]
    a, p = start[text], np.maximum(period[text], 1)
    moved = (period[text] > 0) & (own >= a)
    return np.where(moved, first[text] + a + (own - a) % p, at)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24,
           times: int = 3, digest: bool = False, planted: tuple[Column, Column] | None = None
           ) -> DataFrame:
    """All runs of every text, and the text with each run cut down to one period.

    Returns ``id_col, n_words long, n_runs long, start, length, period, exponent_milli long``
    (of the run of the greatest exponent; null without runs) and either
    ``runs array<struct<start, length, period>>, collapsed string`` or, with ``digest``,
    ``runs_sha256, collapsed_sha256 string``. Places count words from 0.

    ``planted``, two columns ``g`` (whole number) and ``on`` (boolean), checks the detector on
    real texts: where ``on`` is true, the ``n`` words of a text are made periodic before the
    search. From ``a = g % n`` on they repeat the ``1 + (n - a) // (3 + g % 8)`` words at ``a``.
    """
    g, on = planted or (F.lit(0), F.lit(False))
    plain = pick(docs, id_col, text_col)
    source = plain.select(F.col(id_col), F.col(text_col),
                          F.coalesce(g.cast("long"), F.lit(0)).alias("_g"),
                          F.coalesce(on, F.lit(False)).alias("_on"))
    kind = source.schema[id_col].dataType.simpleString()
    rest = ("runs_sha256 string, collapsed_sha256 string" if digest else
            "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")

    def search(batches):
        for chunk in chunks(batches, text_col):
            yield _searched(chunk, id_col, least, times, digest)

    return source.mapInArrow(search, (
        f"`{id_col}` {kind}, n_words long, n_runs long, start long, length long, period long, "
        f"exponent_milli long, {rest}"))


def _searched(chunk: Chunk, id_col: str, least: int, times: int, digest: bool) -> pa.RecordBatch:
    begin, end, text = chunk.words
    count = chunk.per_text(text)
    first = np.cumsum(count) - count
    g, on = (np.asarray(chunk.rows.column(i).to_numpy(zero_copy_only=False)) for i in (2, 3))
    a = np.where(on & (count > 0), g % np.maximum(count, 1), 0)
    spans = (a, np.where(on & (count > 0), 1 + (count - a) // (3 + g % 8), 0)) if on.any() else None
    source = _source(text, first, count, spans)
    names = word_names(chunk)[source]
    at, to, period = runs(names, least, times)
    gone = _covered(len(names), at + period, to)
    mine = text[at] if len(at) else _NONE
    cuts = np.searchsorted(mine, np.arange(len(chunk) + 1))
    best: list[list[int | None]] = [[], [], [], []]
    listed, texts = [], []
    for i in range(len(chunk)):
        b, e, q = (x[cuts[i]:cuts[i + 1]] for x in (at, to, period))
        if len(b):
            k = _best(b, e, q)
            top = [int(b[k] - first[i]), int(e[k] - b[k]), int(q[k])]
            top.append(1000 * top[1] // top[2])
        else:
            top = [None] * 4
        for column, value in zip(best, top):
            column.append(value)
        order = np.lexsort((q, b))
        own = list(zip((b[order] - first[i]).tolist(), (e - b)[order].tolist(), q[order].tolist()))
        words = source[first[i]:first[i] + count[i]]
        if len(b):
            words = words[~gone[first[i]:first[i] + count[i]]]
        if digest:
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in own)
            listed.append(hashlib.sha256(lines.encode()).hexdigest())
            texts.append(joined(chunk, begin[words], end[words]))
        else:
            listed.append([{"start": s, "length": n, "period": p} for s, n, p in own])
            texts.append(b"".join(spelled(chunk, begin[w], end[w], k + SLICE_WORDS >= len(words))
                                  for k in range(0, len(words), SLICE_WORDS)
                                  for w in [words[k:k + SLICE_WORDS]]).decode())
    names_ = ("start", "length", "period", "exponent_milli")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    tail = ({"runs_sha256": pa.array(listed, pa.string()),
             "collapsed_sha256": pa.array(texts, pa.string())} if digest else
            {"runs": pa.array(listed, pa.list_(run)), "collapsed": pa.array(texts, pa.string())})
    return pa.RecordBatch.from_pydict({
        id_col: chunk.rows.column(0), "n_words": pa.array(count, pa.int64()),
        "n_runs": pa.array(np.diff(cuts), pa.int64()),
        **{n: pa.array(c, pa.int64()) for n, c in zip(names_, best)}, **tail})
