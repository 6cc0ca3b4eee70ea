"""Token ids in files of independently compressed frames, read frame by frame.

A file holds the ids of neighbouring documents, little-endian unsigned 32-bit integers end
to end, cut into frames of equal size:

* each frame is a zstandard frame of its own, so it is read without those before it;
* a skippable frame follows with the index of documents: ids, which of them are null, and
  token counts, compressed, their number and a checksum before them;
* a skippable frame with the seek table ends the file: compressed size, plain size and a
  checksum (the low half of XXH64 of the plain bytes) of every frame, then their number, a
  descriptor and a magic number. This is the published seekable form of zstandard, so other
  readers of that form can open the files.

A reader takes the last bytes of a file, from them the seek table, then the frames it needs;
each is compared with its checksum. A table of files beside them (``Dataset.files``) names
what belongs to the dataset. It is written by Spark's commit, so what a lost or repeated task
left behind is never read.

Files are written by tasks through ``pyarrow.fs``; the folder must be a store it knows (local
or mounted paths, HDFS, S3, GCS, Azure) and that all executors share.

Nulls: a null text counts as empty and holds the end id alone, if there is one. Null document
ids are kept and come first. Documents of one id are ordered by a hash of their texts. An
empty table gives no file and no rows. Any other column is ignored.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress, repeat
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.shared import shared_folder
from foldwise.llm.textbytes import Chunk, chunks, pick
from foldwise.operators.ordering import running_totals

#: Plain bytes of a frame; a longer document goes on in the next.
FRAME_BYTES = 1 << 18
#: Bytes of text that one file should take; balances tasks only.
FILE_BYTES = 128 << 20
#: Pieces of text, and words, a task remembers the ids of. Beyond that it forgets the pieces
#: it met once, or all but those at hand, and all words.
REMEMBERED = 500_000
#: Bytes of text encoded at once; one longer text is taken whole.
CHUNK_BYTES = 4 << 20
#: Words encoded in one call.
TOGETHER = 512
#: Fixed values of the seekable form: magic numbers of skippable frames and of the table's end,
#: and the descriptor bit that says the table holds checksums.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, TABLE_END, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

FILE_SCHEMA = ("shard int, path string, n_docs long, n_tokens long, n_frames long, n_bytes long")


class DamagedFile(ValueError):
    """A file whose bytes do not match its seek table."""


# --- one file ------------------------------------------------------------------------------

class FrameWriter:
    """Writes one file; holds a frame and the index of its documents in memory."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.frame_bytes = out, frame_bytes
        self.press = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held, self.table = bytearray(), []
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(tokens) // 4)
        view = memoryview(tokens)
        while len(view):
            room = self.frame_bytes - len(self.held)
            self.held += view[:room]
            view = view[room:]
            if len(self.held) == self.frame_bytes:
                self._frame()

    def _frame(self) -> None:
        plain = bytes(self.held)
        packed = self.press.compress(plain)
        self.out.write(packed)
        self.table.append((len(packed), len(plain), int.from_bytes(_checksum(plain), "little")))
        self.held.clear()

    def close(self) -> int:
        """Write index and seek table; returns the bytes of the file."""
        if self.held:
            self._frame()
        plain = b"".join([np.array([i or 0 for i in self.ids], "<i8").tobytes(),
                          np.array([i is None for i in self.ids], "u1").tobytes(),
                          np.array(self.counts, "<u8").tobytes()])
        index = len(self.ids).to_bytes(8, "little") + _checksum(plain) + self.press.compress(plain)
        self.out.write(_words(SKIPPABLE_INDEX, len(index)) + index)
        self.table.append((len(index) + 8, 0, 0))
        rows = np.array(self.table, "<u4").tobytes()
        end = _words(len(self.table)) + bytes([HAS_CHECKSUMS]) + _words(TABLE_END)
        self.out.write(_words(SKIPPABLE_TABLE, len(rows) + len(end)) + rows + end)
        return sum(p for p, _, _ in self.table) + 8 + len(rows) + len(end)


def _words(*values: int) -> bytes:
    return np.array(values, "<u4").tobytes()


def _checksum(plain: bytes) -> bytes:
    return _words(xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)


class FrameReader:
    """Reads one file; decompresses only the frames asked for and counts them."""

    def __init__(self, file, size: int):
        self.file, self.opened = file, 0
        self.unpress = zstandard.ZstdDecompressor()
        tail = self._bytes(size - 9, 9) if size >= 17 else b""
        if len(tail) < 9 or tail[5:] != _words(TABLE_END) or tail[4] != HAS_CHECKSUMS:
            raise DamagedFile("no seek table at the end")
        n = int.from_bytes(tail[:4], "little")
        begin = size - 9 - 12 * n - 8
        head = self._bytes(begin, 8) if begin >= 0 else b""
        if head != _words(SKIPPABLE_TABLE, 12 * n + 9):
            raise DamagedFile("seek table of another size than it says")
        table = np.frombuffer(self._bytes(begin + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        if not n or table[:, 0].sum() != begin or table[-1, 1:].any():
            raise DamagedFile("frames do not fill the file")
        self.packed, self.plain, self.sums = table[:-1].T
        self.at = np.cumsum(table[:, 0]) - table[:, 0]
        self.starts = np.append(0, np.cumsum(self.plain))
        index = self._bytes(int(self.at[-1]) + 8, int(table[-1, 0]) - 8)
        docs = int.from_bytes(index[:8], "little")
        raw = self._plain(index[12:], 17 * docs, index[8:12], "index")
        self.ids = np.frombuffer(raw, "<i8", docs)
        self.null = np.frombuffer(raw, "u1", docs, 8 * docs).astype(bool)
        self.counts = np.frombuffer(raw[9 * docs:], "<u8").astype(np.int64)
        self.ends = 4 * np.cumsum(self.counts)
        if (self.ends[-1] if docs else 0) != self.starts[-1]:
            raise DamagedFile("documents do not fill the frames")

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _plain(self, packed: bytes, size: int, checksum: bytes, name: str) -> bytes:
        try:
            plain = self.unpress.decompress(packed, max_output_size=max(size, 1))
        except zstandard.ZstdError as e:
            raise DamagedFile(f"{name}: {e}") from e
        if len(plain) != size or _checksum(plain) != checksum:
            raise DamagedFile(f"{name} does not match its checksum")
        return plain

    def frame(self, k: int) -> bytes:
        plain = self._plain(self._bytes(int(self.at[k]), int(self.packed[k])), int(self.plain[k]),
                            _words(int(self.sums[k])), f"frame {k}")
        self.opened += 1
        return plain

    def documents(self, wanted: np.ndarray) -> Iterator[tuple[int, Iterator[bytes]]]:
        """The ids of each wanted document (ascending places), stretch by stretch."""
        k, plain = -1, b""

        def stretches(a: int, b: int) -> Iterator[bytes]:
            nonlocal k, plain
            while a < b:
                need = int(np.searchsorted(self.starts, a, side="right")) - 1
                if need != k:
                    k, plain = need, self.frame(need)
                base = int(self.starts[k])
                yield plain[a - base:b - base]
                a = min(b, base + len(plain))

        for place in wanted.tolist():
            b = int(self.ends[place])
            yield place, stretches(b - 4 * int(self.counts[place]), b)


def opened(path: str) -> FrameReader:
    store, place = fs.FileSystem.from_uri(path)
    file = store.open_input_file(place)
    return FrameReader(file, file.size())


# --- encoding ------------------------------------------------------------------------------

class PieceEncoder:
    """Encodes texts with the tokenizers library, each piece between white space once.

    Right for vocabularies that drop white space, fold case and cut words by a pattern, so
    that no token, composition or case depends on what stands beyond a blank. Pieces of
    printable ASCII are cut further by the vocabulary's own pattern, so that ``Word,`` and
    ``word`` share their word; all others go to the library whole.
    """

    def __init__(self, vocabulary: str, end: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        from tokenizers import Tokenizer

        file = json.loads(vocabulary)
        marks = {t["content"]: t["id"] for t in file["added_tokens"]
                 if not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"])}
        self.mark, self.mark_id = next(iter(marks.items()), ("", -1))
        self.marks = [t["content"].encode() for t in file["added_tokens"]]
        self.cut = regex.compile(file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.letters_stay = self.cut("ab") == ["ab"]
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Where every word ends in a token of its own kind, ids are cut there.
        suffix = file["model"].get("end_of_word_suffix")
        last = [i for t, i in file["model"]["vocab"].items() if suffix and t.endswith(suffix)]
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.last[last] = True
        self.end = b"" if end is None else np.array([end], "<u4").tobytes()
        # Pieces are numbered as they stand here; their ids lie end to end in ``flat``.
        self.pieces: dict[bytes, int] = {}
        self.flat = np.zeros(0, "<u4")
        self.sizes, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words: dict[str, bytes] = {}

    def encode(self, chunk: Chunk) -> Iterator[bytes]:
        """Ids of each text and the end id as little-endian unsigned 32-bit integers."""
        coded, text = chunk.coded_words, chunk.words[2]
        met = coded.dictionary.to_pylist()
        number = np.fromiter(map(self.pieces.get, met, repeat(-1)), np.int64, len(met))
        new = np.flatnonzero(number < 0)
        if len(self.pieces) + len(new) > REMEMBERED:
            number = self._forget(number, len(new))
        marked = any(m in chunk.data.tobytes() for m in self.marks)
        for a in range(0, len(new), REMEMBERED // 4):
            some = new[a:a + REMEMBERED // 4]
            number[some] = np.arange(len(some)) + len(self.pieces)
            own = self._learn(coded.dictionary.take(pa.array(some)), marked)
            self.pieces.update(zip([met[i] for i in some.tolist()], number[some].tolist()))
            self.flat = np.append(self.flat, np.frombuffer(b"".join(own), "<u4"))
            self.sizes = np.append(self.sizes, np.fromiter(map(len, own), np.int64, len(own)) // 4)
            self.met = np.append(self.met, np.zeros(len(own), np.int64))
        self.met[number] += 1
        size, flat = self.sizes[number], self.flat
        start = (np.cumsum(self.sizes) - self.sizes)[number]
        codes = coded.indices.to_numpy()
        upto = np.append(0, np.cumsum(size[codes]))
        at = np.repeat(start[codes] - upto[:-1], size[codes])
        at += np.arange(len(at))
        ids = flat[at]
        cuts = upto[np.searchsorted(text, np.arange(len(chunk) + 1))].tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield ids[a:b].tobytes() + self.end

    def _forget(self, number: np.ndarray, new: int) -> np.ndarray:
        """Keep pieces that are wanted now or were met again; returns the numbers they have then."""
        known = number >= 0
        kept = self.met > 1
        kept[number[known]] = True
        if kept.sum() + new > REMEMBERED:
            kept[:] = False
            kept[number[known]] = True
        self.pieces = {p: i for i, p in enumerate(compress(self.pieces, kept.tolist()))}
        self.flat = self.flat[np.repeat(kept, self.sizes)]
        self.sizes, self.met = self.sizes[kept], self.met[kept] // 2
        return np.where(known, (np.cumsum(kept) - 1)[number], -1) if len(kept) else number

    def _learn(self, pieces: pa.LargeBinaryArray, marked: bool) -> np.ndarray:
        """The ids of each piece, as bytes."""
        text = pieces.cast(pa.large_string())
        plain = pc.and_(pc.string_is_ascii(text), pc.ascii_is_printable(text)).to_numpy(False)
        plain &= not marked and self.last.any()
        letters = plain & pc.ascii_is_alpha(text).to_numpy(False) & self.letters_stay
        whole = pc.ascii_lower(text.filter(pa.array(letters))).to_pylist()
        mixed = list(map(self.cut, pc.ascii_lower(text.filter(pa.array(plain & ~letters))).to_pylist()))
        self._remember({*whole, *chain.from_iterable(mixed)})
        known = self.words.__getitem__
        out = np.empty(len(pieces), dtype=object)
        out[letters] = list(map(known, whole))
        out[plain & ~letters] = [b"".join(map(known, own)) for own in mixed]
        odd = text.filter(pa.array(~plain)).to_pylist()
        if marked or not self.mark:
            alone = [not self.mark or self.mark in t for t in odd]
            together = iter(self._ask([t for t, one in zip(odd, alone) if not one], self.mark))
            out[~plain] = [self._ids(t).tobytes() if one else next(together)
                           for t, one in zip(odd, alone)]
        else:
            out[~plain] = self._ask(odd, self.mark)
        return out

    def _remember(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > REMEMBERED:
            self.words.clear()
            new = list(words)
        self.words.update(zip(new, self._ask(new, " ")))

    def _ask(self, words: list[str], between: str) -> list[bytes]:
        """Encode many words in one call, cut where a word ends or at the mark between them."""
        out: list[bytes] = []
        for a in range(0, len(words), TOGETHER):
            some = words[a:a + TOGETHER]
            ids = self._ids(between.join(some))
            raw = ids.tobytes()
            if between == self.mark:
                at = np.flatnonzero(ids == self.mark_id)
                begins, ends = np.append(0, at + 1), np.append(at, len(ids))
            else:
                ends = np.flatnonzero(self.last[np.minimum(ids, len(self.last) - 1)]) + 1
                begins = np.append(0, ends[:-1])
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not cut these words as its pattern does")
            out += [raw[b:e] for b, e in zip((4 * begins).tolist(), (4 * ends).tolist())]
        return out

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4")


# --- a dataset -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Dataset:
    """Files of token ids; ``files`` has a row per file in the order of documents."""

    files: DataFrame
    folder: str

    @property
    def spark(self) -> SparkSession:
        return self.files.sparkSession


def write(docs: DataFrame, vocabulary_path: str, folder: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", end: int | None = None,
          frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> Dataset:
    """Encode every text, append ``end`` and write all ids in ascending order of ``id_col``.

    ``folder`` must not hold a dataset yet; by default a new one is made in the folder that
    the cluster shares. ``frame_bytes`` must be a multiple of four.
    """
    if frame_bytes < 4 or frame_bytes % 4:
        raise ValueError("frame_bytes must be a positive multiple of four")
    spark = docs.sparkSession
    folder = (folder or f"{shared_folder(spark)}/foldwise-token-files-{uuid.uuid4().hex}").rstrip("/")
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # one vocabulary
    source = pick(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tie"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = (source.repartitionByRange(max(1, ceil(total / file_bytes)), "id", "tie")
               .sortWithinPartitions("id", "tie"))

    def save(batches):
        path = file = writer = None
        try:
            encoder = PieceEncoder(shared.value, end)
            for chunk in chunks(batches, limit=CHUNK_BYTES):
                if writer is None:
                    shard = TaskContext.get().partitionId()
                    path = f"{folder}/{shard:06d}-{uuid.uuid4().hex}.ids.zst"
                    store, place = fs.FileSystem.from_uri(path)
                    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    file = store.open_output_stream(place, compression=None)
                    writer = FrameWriter(file, frame_bytes)
                for i, ids in zip(chunk.rows.column(0).to_pylist(), encoder.encode(chunk)):
                    writer.add(i, ids)
            if writer is not None:
                size = writer.close()
                file.close()
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "path": [path],
                    "n_docs": pa.array([len(writer.ids)], pa.int64()),
                    "n_tokens": pa.array([sum(writer.counts)], pa.int64()),
                    "n_frames": pa.array([len(writer.table) - 1], pa.int64()),
                    "n_bytes": pa.array([size], pa.int64())})
        except BaseException:
            if file is not None and not file.closed:  # an attempt that ended half way
                file.close()
                store.delete_file(place)
            raise

    ordered.mapInArrow(save, FILE_SCHEMA).write.parquet(f"{folder}/files")
    return load(spark, folder)


def load(spark: SparkSession, folder: str) -> Dataset:
    """A dataset written before; ``files`` gains ``start``, the ids in all files before."""
    folder = folder.rstrip("/")
    files = spark.read.schema(FILE_SCHEMA).parquet(f"{folder}/files")
    number = files.count()
    files = running_totals(files, "shard", "n_tokens", "upto", number)
    files = files.withColumn("start", F.col("upto") - F.col("n_tokens")).drop("upto")
    return Dataset(files.repartition(max(1, number), "shard"), folder)


def documents(dataset: Dataset) -> DataFrame:
    """Every document as the files give it, without holding its ids.

    Returns ``doc_id long, start long`` (ids of all documents before it), ``n_tokens long`` and
    ``ids_crc32 long`` (of the ids as little-endian unsigned 32-bit integers).
    """
    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = opened(path)
                before = start + np.cumsum(reader.counts) - reader.counts
                sums = np.zeros(len(reader.ids), dtype=np.int64)
                for place, stretches in reader.documents(np.arange(len(reader.ids))):
                    crc = 0
                    for part in stretches:
                        crc = zlib.crc32(part, crc)
                    sums[place] = crc
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(reader.ids, pa.int64(), mask=reader.null),
                    "start": pa.array(before), "n_tokens": pa.array(reader.counts),
                    "ids_crc32": pa.array(sums)})

    return dataset.files.select("path", "start").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(dataset: Dataset, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The ids of the wanted documents, decompressing only frames that hold some of them.

    Returns ``doc_id long, ids array<long>`` for every document whose id is in ``wanted``, and
    ``frames_read long``, the frames its file had to open. Ids that no document has give
    no row; ids asked for twice count once; null ids are not looked up.
    """
    def index(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = opened(path)
                at = np.flatnonzero(~reader.null)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(reader.ids[at]), "place": pa.array(at),
                    "path": pa.array([path] * len(at), pa.string())})

    def take(table: pa.Table) -> pa.Table:
        reader = opened(table["path"][0].as_py())
        found = [(place, np.frombuffer(b"".join(parts), "<u4")) for place, parts in
                 reader.documents(np.sort(table["place"].to_numpy()))]
        return pa.table({
            "doc_id": pa.array([int(reader.ids[p]) for p, _ in found], pa.int64()),
            "ids": pa.array([v.astype(np.int64) for _, v in found], pa.list_(pa.int64())),
            "frames_read": pa.array([reader.opened] * len(found), pa.int64())})

    places = dataset.files.select("path").mapInArrow(index, "id long, place long, path string")
    ids = pick(wanted, id_col).select(F.col(id_col).cast("long").alias("id"))
    return (places.join(ids, "id", "left_semi").groupBy("path")
            .applyInArrow(take, "doc_id long, ids array<long>, frames_read long"))
