"""Language identification by rank-order profiles of letter n-grams.

A profile is the list of a language's most frequent n-grams of one to three letters, a
word's edge counting as a letter of its own. A text's own list is held against each
profile: the distance adds up how far each n-gram is out of place, or the list's length
where the profile lacks it. Profiles are counted over every training text.

Nulls: a null text, an empty one and one without a letter give ``und`` and score 0. Texts
with a null language teach nothing. Without any training text every answer is ``und``.
Repeated rows each count and each give a row; ties go to the language first in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.shared import Shipped
from foldwise.llm.textbytes import Chunk, chunks, pick

#: N-grams kept per profile and per text.
PROFILE = 400
UNKNOWN = "und"
_POINT_BITS = 21
_EDGE = ord("_")


@dataclass(frozen=True)
class Profiles:
    """``rank[i, j]`` is the place of ``grams[i]`` in the list of ``languages[j]``."""

    languages: list[str]
    grams: np.ndarray
    rank: np.ndarray


class Letters:
    """Maps code points to lower-case letters, everything else to zero."""

    def __init__(self) -> None:
        self.low = np.array([self._one(c) for c in range(0x3000)], dtype=np.int32)

    @staticmethod
    def _one(code: int) -> int:
        char = chr(code)
        return ord(char.lower()[0]) if char.isalpha() else 0

    def of(self, points: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(points, len(self.low) - 1)]
        high = np.flatnonzero(points >= len(self.low))
        if len(high):
            kinds, back = np.unique(points[high], return_inverse=True)
            out[high] = np.array([self._one(int(c)) for c in kinds], dtype=np.int32)[back]
        return out


def counted(chunk: Chunk, letters: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, n-gram and count of every n-gram of each text, in that order."""
    points = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    found = letters.of(points)
    starts = chunk.chars_before[chunk.starts]
    full = chunk.ends > chunk.starts
    # Texts and words are set apart by one edge mark each.
    found = np.insert(found, starts[full], 0)
    text = np.repeat(np.flatnonzero(full),
                     np.diff(np.append(starts[full], len(points))) + 1)
    edge = found == 0
    keep = ~edge
    keep[1:] |= edge[1:] & ~edge[:-1]
    keep[:-1] |= edge[:-1] & ~edge[1:]
    doubled = edge[1:] & edge[:-1] & keep[1:] & keep[:-1] & (text[1:] == text[:-1])
    keep[1:] &= ~doubled
    found, text = found[keep], text[keep]
    alphabet = np.unique(found)
    wide = int(alphabet.max(initial=0)) + 1
    table = np.zeros(wide, dtype=np.uint64)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    code = table[found]
    bits = np.uint64(max(int(len(alphabet)).bit_length(), 1))
    inner = found == 0
    tag = text.astype(np.uint64) << (bits * np.uint64(3))
    parts = []
    if len(code):
        parts.append((tag | code)[~inner])
    if len(code) > 1:
        two = (text[1:] == text[:-1]) & ~(inner[1:] & inner[:-1])
        parts.append((tag[1:] | code[:-1] << bits | code[1:])[two])
    if len(code) > 2:
        three = (text[2:] == text[:-2]) & ~inner[1:-1]
        parts.append((tag[2:] | code[:-2] << (bits * np.uint64(2)) | code[1:-1] << bits
                      | code[2:])[three])
    keys = np.sort(np.concatenate([*parts, np.zeros(0, np.uint64)]))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys.astype(int)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    real = np.append(0, np.where(alphabet == 0, _EDGE, alphabet)).astype(np.uint64)
    low = np.uint64((1 << int(bits)) - 1)
    gram = np.zeros(len(keys), dtype=np.int64)
    for place in range(3):
        gram |= (real[keys >> (bits * np.uint64(place)) & low]
                 << np.uint64(_POINT_BITS * place)).astype(np.int64)
    return (keys >> (bits * np.uint64(3))).astype(np.int64), gram, counts


def ranked(text: np.ndarray, gram: np.ndarray, counts: np.ndarray,
           top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``top`` most frequent n-grams of each text with their places, from zero."""
    most = int(counts.max(initial=1))
    order = np.lexsort((gram, most - counts, text))
    text, gram = text[order], gram[order]
    first = np.flatnonzero(np.diff(text, prepend=-1))
    place = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    use = place < top
    return text[use], gram[use], place[use]


def fit(docs: DataFrame, train: Column | None = None, lang_col: str = "lang",
        text_col: str = "text", profile: int = PROFILE) -> Profiles:
    """Count n-grams per language over all rows where ``train`` holds, keep the top of each."""
    rows = docs if train is None else docs.where(train)
    source = pick(rows, lang_col, text_col).where(F.col(lang_col).isNotNull())

    def run(batches):
        letters, total = Letters(), {}
        for chunk in chunks(batches, text_col):
            names, which = np.unique(np.array(chunk.rows.column(0).to_pylist(), dtype=object),
                                     return_inverse=True)
            text, gram, counts = counted(chunk, letters)
            for i, name in enumerate(names.tolist()):
                mine = which[text] == i
                grams, back = np.unique(gram[mine], return_inverse=True)
                sums = np.bincount(back, weights=counts[mine], minlength=len(grams))
                if name in total:
                    old_grams, old = total[name]
                    grams, back = np.unique(np.append(old_grams, grams), return_inverse=True)
                    sums = np.bincount(back, weights=np.append(old, sums), minlength=len(grams))
                total[name] = grams, sums
        for name, (grams, sums) in total.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(grams), pa.string()), "gram": pa.array(grams),
                "n": pa.array(sums.astype(np.int64))})

    counts = (source.mapInArrow(run, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = (counts.withColumn("place", F.row_number().over(best) - 1)
            .where(F.col("place") < profile).drop("n").toArrow())
    return assemble(kept.column("lang").to_pylist(), kept.column("gram").to_numpy(),
                    kept.column("place").to_numpy(), profile)


def assemble(langs: list[str], grams: np.ndarray, places: np.ndarray, profile: int) -> Profiles:
    languages = sorted(set(langs))
    at = {name: j for j, name in enumerate(languages)}
    known = np.unique(grams).astype(np.int64)
    rank = np.full((len(known) + 1, len(languages)), -1, dtype=np.int32)
    rank[np.searchsorted(known, grams), [at[x] for x in langs]] = places
    return Profiles(languages, known, rank)


def identify(chunk: Chunk, profiles: Profiles, letters: Letters,
             profile: int = PROFILE) -> tuple[list[str], np.ndarray]:
    """The nearest profile's language and one minus its share of the largest distance."""
    text, gram, place = ranked(*counted(chunk, letters), profile)
    n = len(chunk)
    if not profiles.languages or not len(text):
        return [UNKNOWN] * n, np.zeros(n)
    at = np.searchsorted(profiles.grams, gram)
    at = np.where(profiles.grams[np.minimum(at, len(profiles.grams) - 1)] == gram, at,
                  len(profiles.grams))
    held = np.bincount(text, minlength=n)
    distance = np.empty((n, len(profiles.languages)))
    for j in range(len(profiles.languages)):
        theirs = profiles.rank[at, j]
        off = np.where(theirs < 0, profile, np.minimum(np.abs(theirs - place), profile))
        distance[:, j] = np.bincount(text, weights=off, minlength=n)
    best = distance.argmin(axis=1)
    score = 1 - distance[np.arange(n), best] / np.maximum(held * profile, 1)
    names = [profiles.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), held)]
    return names, np.where(held > 0, np.clip(score, 0, 1), 0.0)


def apply(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text",
          profile: int = PROFILE) -> DataFrame:
    """Returns ``id_col, lang_pred string, score double`` per row."""
    source = pick(docs, id_col, text_col)
    shared = Shipped(docs.sparkSession, profiles)  # languages times ``profile``

    def run(batches):
        letters = Letters()
        for chunk in chunks(batches, text_col):
            names, score = identify(chunk, shared.value, letters, profile)
            yield pa.RecordBatch.from_pydict({
                id_col: chunk.rows.column(0), "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(score)})

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
