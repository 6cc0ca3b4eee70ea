"""Small tables with every awkward row, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORDS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, stock: str = "alpha beta gamma delta epsilon zeta eta") -> str:
    parts = stock.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(seed: int = 3) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, blanks, odd bytes and a long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    rows = []
    for i in range(120):
        text = rng.choice(base)
        if rng.random() < 0.6:
            words = text.split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            text = " ".join(words)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), 1))
    rows += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, " \n\t ", "en", "a", 4),
             (203, "One two THREE", "en", "b", 3), (204, "one two three", None, "b", 3),
             (205, "é\0ü 中国 " * 40, "de", "c", 1), (206, "é\0ü 中国 " * 40, "de", "c", 1),
             (207, prose(rng, 30_000), "en", "a", 1), (3, base[0], "en", "a", 1),
             (3, base[0], "en", "a", 1), (None, base[1], "en", "a", 1)]
    return rows


def awkward(spark, rows):
    """The rows with more columns whose names clash but for their case."""
    wide = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, Doc_Id int"
    return spark.createDataFrame([(*r, "x", 1) for r in rows], wide)


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingle_set(text: str | None, n: int = 5) -> frozenset:
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if not found:
        return frozenset()
    if len(found) < n:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i:i + n]) for i in range(len(found) - n + 1))


def linked(rows: list[tuple]) -> dict:
    """Smallest id within reach of every id."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if common and 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def stripped(rows: list[tuple], length: int = 50) -> list[tuple]:
    """Bytes that remain of each text, by the definition."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, raw in texts:
        if i is not None:
            for p in range(len(raw) - length + 1):
                s = raw[p:p + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, raw in texts:
        gone = bytearray(len(raw))
        if i is not None:
            for p in range(len(raw) - length + 1):
                if first[raw[p:p + length]] < i:
                    gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, sha(kept)))
    return out


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    found = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(found[k:k + 3]) for k in range(len(found) - 2))
    covered = {k + d for k in range(len(found) - 2) if grams[tuple(found[k:k + 3])] > 1
               for d in range(3)}
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))
