"""Removal of repeated passages with a logarithmic family of suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts in a text with a
smaller id is removed. Such strings are found without comparing texts pairwise:

1. Each position's string is led by its anchor, the ``gram`` bytes within it of smallest
   hash. Neighbouring positions share an anchor, and equal strings have equal ones, so
   pieces of text around anchors are dealt into parts by their anchor and each part can be
   judged alone. Equal pieces within a task are merged first; all but those of the smallest
   id are settled there, so a passage that a third of all texts hold leaves a task once.
2. Within a part, pieces whose anchor occurs in one text only are set aside. The others come
   in batches by ascending id. A batch's suffixes are sorted (its suffix array; they are
   ordered by a 64-bit hash of their first ``length`` bytes, so that equal ones meet),
   scanned for equal neighbours, and merge-scanned against the levels of the family, which
   hold the suffixes seen before. Its new suffixes become a level, and levels of like size
   merge, so there are only logarithmically many.
3. Removed stretches meet the texts, grouped by a hash of the id.

Nulls: a null text counts as empty. Rows with a null id are kept whole and remove nothing.
Rows that repeat an id never remove from each other; they are told apart by a mark of their
text. Texts shorter than ``length`` keep everything. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textbytes import CHUNK_BYTES, Chunk, RangeHash, chunks, mix, pick

#: Bytes of an anchor.
GRAM = 10
#: Bytes of text a task gathers before it sends pieces, bytes of pieces in a part, and bytes
#: of text in a group of texts. They bound memory, not results.
FLUSH_BYTES, PART_BYTES, GROUP_BYTES = 6 << 20, 8 << 20, 4 << 20
#: Suffixes in a batch of the family, as far as ids allow.
BATCH_SUFFIXES = 1 << 17


class SuffixFamily:
    """Sorted arrays of the suffixes seen so far, each more than twice the next in size."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, suffixes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Take in a batch; true where a suffix was seen before or has a smaller owner.

        All owners must be larger than those of earlier batches.
        """
        order = np.argsort(suffixes, kind="stable")
        array, owner = suffixes[order], owner[order]
        first = np.append(True, array[1:] != array[:-1]) if len(array) else np.zeros(0, bool)
        at = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        least = np.minimum.reduceat(owner, at) if len(at) else owner
        new = array[at]
        seen = np.zeros(len(new), dtype=bool)
        for level in self.levels:
            place = np.searchsorted(level, new)
            inside = place < len(level)
            seen[inside] |= level[place[inside]] == new[inside]
        out = np.empty(len(array), dtype=bool)
        out[order] = seen[group] | (owner > least[group])
        if not seen.all():
            self.levels.append(new[~seen])
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            last = self.levels.pop()
            self.levels[-1] = np.sort(np.concatenate([self.levels[-1], last]), kind="stable")
        return out


def pieces(chunk: Chunk, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, begin, end and anchor of each piece, and the anchor's hash."""
    data, wide = chunk.data, length - gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    hashed = RangeHash(data).grams(gram)
    # Whole hashes are compared and equal ones ranked by place, so equal strings have equal
    # anchors whatever chunk they lie in.
    low, anchor, span = hashed, np.arange(len(hashed)), 1
    while span < wide:
        step = min(span, wide - span)
        later = low[step:] < low[:-step]
        low = np.where(later, low[step:], low[:-step])
        anchor = np.where(later, anchor[step:], anchor[:-step])
        span += step
    owner = chunk.text_of(np.arange(len(data)))
    inside = owner[:len(low)] == owner[length - 1:]
    change = np.ones(len(low), dtype=bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    # A run inside one text never goes on into the next: strings across the border part them.
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(low)) + length - 1
    good = inside[begin]
    begin, end = begin[good], end[good]
    anchor = anchor[begin]
    return owner[begin], begin, end, anchor, hashed[anchor]


def gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The named stretches of an array, end to end."""
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
    at += np.repeat((begin - (ends - size)).astype(np.int32), size)
    return data[at]


def piece_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each stretch, worked through in slices of about one chunk."""
    out = np.empty(len(begin), dtype=np.uint64)
    total, a = np.cumsum(size), 0
    while a < len(begin):
        b = max(int(np.searchsorted(total, total[a] - size[a] + CHUNK_BYTES)), a + 1)
        place = np.append(0, np.cumsum(size[a:b]))
        out[a:b] = RangeHash(gather(data, begin[a:b], size[a:b])).of(place[:-1], place[1:])
        a = b
    return out


def gram_keys(data: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit key of the ``gram`` bytes at each place."""
    held = np.zeros((len(at), -(-gram // 8) * 8), dtype=np.uint8)
    held[:, :gram] = np.lib.stride_tricks.sliding_window_view(data, gram)[at]
    words = held.view("<u8")
    out = mix(words[:, 0] + np.uint64(gram))
    for k in range(1, words.shape[1]):
        out = mix(out ^ mix(words[:, k] + np.uint64(k)))
    return out


def _squeeze(*columns: np.ndarray) -> bytes:
    """Numbers by column and byte place, compressed."""
    rows = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes()
            for c in columns]
    return zstandard.compress(b"".join(rows), 3)


def _open(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    rows, out, at = len(raw) // sum(widths), [], 0
    for kind, width in zip(kinds, widths):
        part = raw[at:at + rows * width].reshape(width, rows)
        out.append(np.ascontiguousarray(part.T).view(kind).reshape(rows))
        at += rows * width
    return out


def _firsts(key: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where the owner is the smallest one that has the key."""
    order = np.lexsort((owner, key))
    key, mine = key[order], owner[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    least = np.repeat(mine[start], np.diff(np.append(start, len(key))))
    out = np.empty(len(key), dtype=bool)
    out[order] = mine == least
    return out


def _merge_spans(ids, marks, begin, end) -> tuple[np.ndarray, ...]:
    """Join stretches of one row that touch; the rest stay as they are."""
    order = np.lexsort((begin, marks, ids))
    ids, marks, begin, end = ids[order], marks[order], begin[order], end[order]
    if not len(ids):
        return ids, marks, begin, end
    same = (ids[1:] == ids[:-1]) & (marks[1:] == marks[:-1]) & (begin[1:] <= end[:-1])
    start = np.flatnonzero(np.append(True, ~same))
    return ids[start], marks[start], begin[start], np.maximum.reduceat(end, start)


def _span_rows(ids, marks, begin, end, groups: int) -> Iterator[tuple[int, bytes]]:
    """Removed stretches by group of texts."""
    ids, marks, begin, end = _merge_spans(ids, marks, begin, end)
    group = (mix(ids.view(np.uint64) + np.uint64(5)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(group[order]))) if len(order) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(order))):
        own = order[a:b]
        yield int(group[own[0]]), _squeeze(ids[own], marks[own], begin[own].astype("<u4"),
                                           end[own].astype("<u4"))


_SCHEMA = pa.schema([("part", pa.int64()), ("meta", pa.binary()), ("bytes", pa.binary())])


def _rows(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    part, meta, held = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int64()), pa.array(meta, pa.binary()), pa.array(held, pa.binary())],
        schema=_SCHEMA)


def _marks(chunk: Chunk) -> np.ndarray:
    """Sixteen bits that tell texts of one id apart."""
    return (RangeHash(chunk.data).of(chunk.starts, chunk.ends) >> np.uint64(48)).astype("<u2")


def cut(batches, length: int, gram: int, parts: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Pieces by part; stretches settled within the task, by group, as parts below zero."""
    held: list[tuple[np.ndarray, ...]] = []
    text_bytes = 0

    def flush() -> Iterator[pa.RecordBatch]:
        ids, marks, begin, size, off, anchor, whole = (
            np.concatenate([h[i] for h in held]) for i in range(7))
        data = np.concatenate([h[7] for h in held])
        at = np.append(0, np.cumsum(size))[:-1].astype(np.int64)
        keep = _firsts(whole, ids)
        done = ~keep
        rows = [(-1 - g, blob, b"") for g, blob in _span_rows(
            ids[done], marks[done], begin[done], begin[done] + size[done], groups)]
        part = (anchor % np.uint64(parts)).astype(np.int64)
        own = np.flatnonzero(keep)
        own = own[np.lexsort((begin[own], ids[own], part[own]))]
        cuts = np.flatnonzero(np.append(True, np.diff(part[own]))) if len(own) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(own))):
            some = own[a:b]
            meta = _squeeze(ids[some], marks[some], begin[some].astype("<u4"),
                            size[some].astype("<u2"), off[some].astype("<u2"))
            text = gather(data, at[some], size[some].astype(np.int64)).tobytes()
            rows.append((int(part[some[0]]), meta, zstandard.compress(text, 3)))
            if len(rows) >= 64:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    for chunk in chunks(batches):
        text, begin, end, anchor, hashed = pieces(chunk, length, gram)
        if not len(text):
            continue
        ids, marks = chunk.rows.column(0).to_numpy(), _marks(chunk)
        size = end - begin
        held.append((ids[text], marks[text], begin - chunk.starts[text], size.astype(np.int32),
                     (anchor - begin).astype(np.int32), hashed,
                     RangeHash(chunk.data).of(begin, end), gather(chunk.data, begin, size)))
        text_bytes += len(chunk.data)
        if text_bytes >= FLUSH_BYTES:
            yield from flush()
            held, text_bytes = [], 0
    if held:
        yield from flush()


def judge(table: pa.Table, length: int, gram: int, groups: int) -> pa.Table:
    """Removed stretches of one part, by group of texts."""
    part = table["part"][0].as_py()
    if part < 0:
        return pa.table({"group": pa.array([-1 - part] * len(table), pa.int64()),
                         "meta": table["meta"], "bytes": pa.nulls(len(table), pa.binary())})
    opened = [_open(m, "<i8", "<u2", "<u4", "<u2", "<u2") for m in table["meta"].to_pylist()]
    ids, marks, begin, size, off = (np.concatenate([o[i] for o in opened]) for i in range(5))
    data = np.frombuffer(b"".join(map(zstandard.decompress, table["bytes"].to_pylist())), np.uint8)
    size, off = size.astype(np.int64), off.astype(np.int64)
    at = np.append(0, np.cumsum(size))[:-1]

    # Pieces whose anchor one text alone has cannot be repeated.
    key = gram_keys(data, at + off, gram)
    order = np.argsort(key, kind="stable")
    start = np.flatnonzero(np.append(True, np.diff(key[order])))
    low = np.minimum.reduceat(ids[order], start)
    high = np.maximum.reduceat(ids[order], start)
    shared = np.empty(len(ids), dtype=bool)
    shared[order] = np.repeat(low != high, np.diff(np.append(start, len(ids))))
    own = np.flatnonzero(shared)
    spans: list[tuple[np.ndarray, ...]] = []
    if len(own):
        # Equal pieces: the smallest id's stay, all others are covered whole.
        keep = _firsts(piece_hashes(data, at[own], size[own]), ids[own])
        done = own[~keep]
        spans.append((ids[done], marks[done], begin[done].astype(np.int64),
                      begin[done] + size[done]))
        own = own[keep]
        own = own[np.argsort(ids[own], kind="stable")]
        family = SuffixFamily()
        count = size[own] - length + 1
        total = np.cumsum(count)
        a = 0
        while a < len(own):
            before = total[a] - count[a]
            b = max(int(np.searchsorted(total, before + BATCH_SUFFIXES)), a + 1)
            b = int(np.searchsorted(ids[own], ids[own[b - 1]], side="right"))  # whole texts only
            some, n = own[a:b], count[a:b]
            piece = np.repeat(np.arange(len(some)), n)
            step = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
            text = RangeHash(gather(data, at[some], size[some]))
            start = (np.cumsum(size[some]) - size[some])[piece] + step
            suffixes = text.of(start, start + length)
            hit = family.add(suffixes, ids[some][piece])
            edge = np.flatnonzero(hit & np.append(
                True, ~hit[:-1] | (piece[1:] != piece[:-1])))
            last = np.flatnonzero(hit & np.append(
                ~hit[1:] | (piece[1:] != piece[:-1]), True))
            mine = some[piece[edge]]
            spans.append((ids[mine], marks[mine], begin[mine] + step[edge],
                          begin[mine] + step[last] + length))
            a = b
    out = list(_span_rows(*(np.concatenate([s[i] for s in spans]) for i in range(4)), groups)) \
        if spans else []
    return pa.table({"group": pa.array([g for g, _ in out], pa.int64()),
                     "meta": pa.array([m for _, m in out], pa.binary()),
                     "bytes": pa.nulls(len(out), pa.binary())})


def pack(batches, groups: int) -> Iterator[pa.RecordBatch]:
    """Whole texts by group."""
    held: dict[int, list[tuple]] = {}
    text_bytes = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for g, own in held.items():
            ids, marks, size = (np.array([o[i] for o in own]) for i in range(3))
            meta = _squeeze(ids.astype("<i8"), marks.astype("<u2"), size.astype("<u4"))
            blob = zstandard.compress(b"".join(o[3] for o in own), 3)
            yield pa.RecordBatch.from_pydict({"group": pa.array([g], pa.int64()),
                                              "meta": pa.array([meta], pa.binary()),
                                              "bytes": pa.array([blob], pa.binary())})

    for chunk in chunks(batches):
        ids, marks, raw = chunk.rows.column(0).to_numpy(), _marks(chunk), chunk.data.tobytes()
        group = mix(ids.view(np.uint64) + np.uint64(5)) % np.uint64(groups)
        for i, g in enumerate(group.tolist()):
            a, b = int(chunk.starts[i]), int(chunk.ends[i])
            held.setdefault(g, []).append((ids[i], marks[i], b - a, raw[a:b]))
        text_bytes += len(raw)
        if text_bytes >= FLUSH_BYTES:
            yield from flush()
            held, text_bytes = {}, 0
    yield from flush()


def _strip(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Texts of one group and which of their bytes are removed."""
    texts = [(m, b) for m, b in zip(rows["meta"].to_pylist(), rows["bytes"].to_pylist())
             if b is not None]
    spans = [_open(m, "<i8", "<u2", "<u4", "<u4")
             for m, b in zip(rows["meta"].to_pylist(), rows["bytes"].to_pylist()) if b is None]
    opened = [_open(m, "<i8", "<u2", "<u4") for m, _ in texts]
    if not opened:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ids, marks, size = (np.concatenate([o[i] for o in opened]) for i in range(3))
    data = np.frombuffer(b"".join(zstandard.decompress(b) for _, b in texts), np.uint8)
    end = np.cumsum(size.astype(np.int64))
    start = end - size
    change = np.zeros(len(data) + 1, dtype=np.int64)
    if spans:
        theirs, tags, a, b = (np.concatenate([s[i] for s in spans]) for i in range(4))
        names = np.unique(ids)
        key = np.searchsorted(names, ids) << 16 | marks
        order = np.argsort(key, kind="stable")
        wanted = np.searchsorted(names, theirs) << 16 | tags
        left = np.searchsorted(key[order], wanted)
        times = np.searchsorted(key[order], wanted, side="right") - left  # equal rows share all
        row = order[np.repeat(left, times) + np.arange(times.sum())
                    - np.repeat(np.cumsum(times) - times, times)]
        np.add.at(change, start[row] + np.repeat(a, times), 1)
        np.add.at(change, start[row] + np.repeat(b, times), -1)
    return ids, start, end, data, change


def _outcome(rows: pa.Table) -> pa.Table:
    ids, start, end, data, change = _strip(rows)
    gone = np.cumsum(change[:-1]) > 0
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    opens[start[end > start]] = gone[start[end > start]]
    sums = [np.append(0, np.cumsum(x)) for x in (gone, opens)]
    raw = data[~gone].tobytes()
    kept = np.append(0, np.cumsum(~gone))
    texts = [raw[kept[a]:kept[b]] for a, b in zip(start.tolist(), end.tolist())]
    return pa.table({
        "id": pa.array(ids, pa.int64()), "n_bytes": pa.array(end - start, pa.int64()),
        "n_removed": pa.array(sums[0][end] - sums[0][start], pa.int64()),
        "n_spans": pa.array(sums[1][end] - sums[1][start], pa.int64()),
        "kept": pa.array(texts, pa.binary())})


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
          digest: bool = False, gram: int = GRAM) -> DataFrame:
    """Remove repeated passages of ``length`` bytes or more from every text.

    Returns ``id_col, n_bytes long, n_removed long, n_spans long`` and ``kept binary`` (the
    remaining bytes) or, with ``digest``, ``kept_sha256 string``. Ids must be whole numbers.
    """
    source = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"),
                                                 F.col(text_col).alias("text"))
    named = source.where("id is not null")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, round(total * 3.6 / PART_BYTES))
    groups = max(1, round(total / GROUP_BYTES))

    spans = named.mapInArrow(lambda b: cut(b, length, gram, parts, groups),
                             "part long, meta binary, bytes binary").groupBy("part").applyInArrow(
        lambda t: judge(t, length, gram, groups), "group long, meta binary, bytes binary")
    texts = named.mapInArrow(lambda b: pack(b, groups), "group long, meta binary, bytes binary")

    def finish(rows: pa.Table) -> pa.Table:
        out = _outcome(rows)
        if digest:
            sums = [hashlib.sha256(x).hexdigest() for x in out["kept"].to_pylist()]
            out = out.drop_columns("kept").append_column("kept_sha256",
                                                         pa.array(sums, pa.string()))
        return out

    last = "kept_sha256 string" if digest else "kept binary"
    found = spans.unionByName(texts).groupBy("group").applyInArrow(
        finish, f"id long, n_bytes long, n_removed long, n_spans long, {last}")
    held = F.coalesce(F.encode("text", "utf-8"), F.lit(b""))
    unnamed = source.where("id is null").select(
        "id", F.octet_length(held).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(held, 256).alias("kept_sha256") if digest else held.alias("kept"))
    return found.union(unnamed).withColumnRenamed("id", id_col)
