"""Secret scan with corpus-wide ownership of every candidate.

Plain patterns give the base spans. A wider pattern collects long mixed tokens as further
candidates. Each candidate's hash is counted over the whole corpus by distinct
repositories and owners: what many owners, or many repositories of few owners, hold is a
copied example; what a few repositories of a few owners hold looks live. Live-looking wide candidates become spans of their own (kind ``live``),
and base spans are told apart the same way.

Nulls: a null text counts as empty. A null repository or owner counts as one unnamed one.
Rows without a candidate give zero counts and empty lists. Repeated rows each give a row;
they count as one repository if their repository value is the same. Null ids are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.shared import write_table
from foldwise.llm.textbytes import Chunk, RangeHash, chunks, laid, pick

#: The base patterns.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    rb"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "live")

#: Bytes of a wide candidate, and the digits, letters and distinct bytes it must hold.
WIDE_LEAST, WIDE_DIGITS, WIDE_LETTERS, WIDE_DISTINCT = 20, 3, 3, 10
#: Owners and repositories up to which, both together, a candidate looks live.
LIVE_OWNERS, LIVE_REPOS = 4, 8

_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True


def _texts_with(chunk: Chunk, held: bytes, needle: bytes) -> set[int]:
    """Numbers of the texts in which the needle begins; it may run past their end."""
    found, at = [], held.find(needle)
    while at >= 0:
        found.append(at)
        at = held.find(needle, at + 1)
    at = np.array(found, dtype=np.int64)
    return set(chunk.text_of(at).tolist())


def spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, kind, begin and end byte of base spans and wide candidates.

    Each kind is matched leftmost and without overlap within its text; wide candidates
    that lie within a base span are left out.
    """
    raw, low = chunk.data.tobytes(), chunk.lowered.tobytes()
    rows: list[tuple[int, int, int, int]] = []
    for t in set().union(*(_texts_with(chunk, low, k) for k in KEYWORDS)):
        rows += [(t, 0, m.start(), m.end())
                 for m in ASSIGN.finditer(raw, int(chunk.starts[t]), int(chunk.ends[t]))
                 if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    for t in _texts_with(chunk, raw, b"AKIA"):
        rows += [(t, 1, m.start(), m.end())
                 for m in ACCESS.finditer(raw, int(chunk.starts[t]), int(chunk.ends[t]))
                 if m.end() - m.start() >= ACCESS_LEAST]
    begin, end, text = chunk.runs(_HEX[chunk.data])
    long = end - begin >= HEX_LEAST
    rows += list(zip(text[long].tolist(), [2] * int(long.sum()), begin[long].tolist(),
                     end[long].tolist()))
    base: dict[int, list[tuple[int, int]]] = {}
    for t, _, b, e in rows:
        base.setdefault(t, []).append((b, e))
    begin, end, text = chunk.runs(_TOKEN[chunk.data])
    for i in np.flatnonzero(end - begin >= WIDE_LEAST).tolist():
        b, e, t = int(begin[i]), int(end[i]), int(text[i])
        token = raw[b:e]
        digits = sum(48 <= c <= 57 for c in token)
        letters = sum(65 <= (c & 0xDF) <= 90 for c in token)
        if (digits >= WIDE_DIGITS and letters >= WIDE_LETTERS
                and len(set(token)) >= WIDE_DISTINCT
                and not any(x <= b and e <= y for x, y in base.get(t, ()))):
            rows.append((t, 3, b, e))
    table = np.array(sorted(rows, key=lambda r: (r[0], r[2], r[1])), dtype=np.int64)
    return tuple(table.reshape(-1, 4).T)


def _value_begin(raw: bytes, kind: int, begin: int, end: int) -> int:
    """Where the secret itself begins: behind the key word of an assignment."""
    return ASSIGN.match(raw, begin, end).start(1) if kind == 0 else begin


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str,
               owner_col: str) -> DataFrame:
    """One row per text with its spans as an array, offsets in code points."""
    source = pick(docs, *dict.fromkeys((id_col, text_col, repo_col, owner_col)))
    names = source.columns

    def run(batches):
        kinds = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()),
                                    ("end", pa.int64()), ("hash", pa.int64())]))
        for chunk in chunks(batches, text_col):
            text, kind, begin, end = spans(chunk)
            raw, before = chunk.data.tobytes(), chunk.chars_before
            value = np.array([_value_begin(raw, k, b, e) for k, b, e in
                              zip(kind.tolist(), begin.tolist(), end.tolist())], dtype=np.int64)
            hashed = RangeHash(chunk.data).of(value, end).view(np.int64) if len(text) else text
            zero = before[chunk.starts[text]]
            listed: list[list] = [[] for _ in range(len(chunk))]
            for t, k, b, e, h in zip(text.tolist(), kind.tolist(), (before[begin] - zero).tolist(),
                                     (before[end] - zero).tolist(), hashed.tolist()):
                listed[t].append({"kind": k, "start": b, "end": e, "hash": h})
            columns = [chunk.rows.column(names.index(c)) for c in (id_col, repo_col, owner_col)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(listed, kinds)],
                                             names=["id", "repo", "owner", "found"])

    kind = {c: source.schema[c].dataType.simpleString() for c in names}
    return source.mapInArrow(
        run, f"id {kind[id_col]}, repo {kind[repo_col]}, owner {kind[owner_col]}, found "
             "array<struct<kind: int, start: bigint, end: bigint, hash: bigint>>")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each candidate hash.

    Pairs are made distinct before they are counted, so a candidate that a third of all
    rows hold is merged within each task and spread over tasks by its pairs.
    """
    flat = found.select("repo", "owner", F.explode("found").alias("s")).select(
        F.col("s.hash").alias("hash"), "repo", "owner").distinct()
    repos = flat.select("hash", "repo").distinct().groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_repos"))
    owners = flat.select("hash", "owner").distinct().groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"))
    return repos.join(owners, "hash")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         repo_col: str = "doc_id", owner_col: str = "source",
         live_owners: int = LIVE_OWNERS, live_repos: int = LIVE_REPOS) -> DataFrame:
    """Spans of every row with the ownership of what they hold.

    Returns ``id_col, found array<struct<kind, start, end, n_repos, n_owners, live>>``
    sorted by start and kind; wide candidates are listed only if they look live.
    """
    found = write_table(
        candidates(docs, id_col, text_col, repo_col, owner_col)
        .withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    owned = ownership(found)
    flat = found.select("row", F.explode("found").alias("s")).select(
        "row", "s.kind", "s.start", "s.end", F.col("s.hash").alias("hash"))
    spread = 32  # a hash that a third of all rows hold is met by as many tasks
    salted = flat.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(spread)).cast("int"))
    copies = owned.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(spread)])))
    told = salted.join(copies, ["hash", "salt"]).withColumn(
        "live", (F.col("n_owners") <= live_owners) & (F.col("n_repos") <= live_repos))
    listed = (told.where((F.col("kind") < KINDS.index("live")) | F.col("live"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                  "start", "kind", "end", "n_repos", "n_owners", "live"))).alias("found")))
    empty = F.array().cast("array<struct<start: bigint, kind: int, end: bigint, "
                           "n_repos: bigint, n_owners: bigint, live: boolean>>")
    return found.select("row", F.col("id").alias(id_col)).join(listed, "row", "left").select(
        id_col, F.coalesce("found", empty).alias("found"))




def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           repo_col: str = "doc_id", owner_col: str = "source",
           live_owners: int = LIVE_OWNERS, live_repos: int = LIVE_REPOS) -> DataFrame:
    """The given rows, all columns kept, with live-looking spans masked by asterisks.

    Widely copied examples and texts without a candidate stay as they are.
    """
    plain, at = laid(docs, id_col, text_col, repo_col, owner_col)
    id_col, text_col = at[id_col], at[text_col]
    keyed = plain.withColumn("__secret_row", F.xxhash64(id_col, text_col))
    spans = (scan(keyed, "__secret_row", text_col, at[repo_col], at[owner_col], live_owners,
                  live_repos)
             .withColumn("__spans", F.filter("found", lambda s: s.live))
             .where(F.size("__spans") > 0)
             .groupBy("__secret_row").agg(F.first("__spans").alias("__spans")))

    def mask(text, span):
        size = (span.end - span.start).cast("int")
        return F.overlay(text, F.repeat(F.lit("*"), size), (span.start + 1).cast("int"), size)

    joined = keyed.join(spans, "__secret_row", "left")
    masked = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(
        F.aggregate("__spans", F.col(text_col), mask))
    return joined.withColumn(text_col, masked).select(*plain.columns).toDF(*docs.columns)
