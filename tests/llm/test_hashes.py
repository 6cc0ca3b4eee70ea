"""Equality of bytes where results hang on it, and anchors that do not depend on the chunk."""

import random

import numpy as np
import pyarrow as pa

from foldwise.llm import jaccard_join, quality, suffix_family
from foldwise.llm.textbytes import PLAIN_BYTES, RangeHash, chunks
from tests.llm.helpers import linked, stripped


def thue_morse(first: str, second: str, length: int) -> str:
    return "".join(second if bin(i).count("1") % 2 else first for i in range(length))


def test_range_hashes_tell_long_ranges_apart():
    for n in (64, PLAIN_BYTES, PLAIN_BYTES + 1, 1024, 1 << 14):
        texts = [thue_morse(*x, n) for x in ("ab", "ba")] + [thue_morse("xyzw", "wxyz", n // 4)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        end = np.cumsum([len(t) for t in texts])
        got = RangeHash(data).of(end - [len(t) for t in texts], end)
        assert len(set(got.tolist())) == 3
        again = RangeHash(np.append(data[:7], data)).of(end - [len(t) for t in texts] + 7, end + 7)
        assert (again == got).all()


def test_texts_of_one_word_each_are_not_linked(spark):
    rows = [(i, thue_morse(*x, 1024)) for i, x in enumerate(["ab", "ba", "ab"])]
    got = {r.doc_id: r.component_id for r in jaccard_join.link(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == linked(rows) == {0: 0, 1: 1, 2: 0}


def test_different_lines_are_not_counted_as_copies():
    lines = [thue_morse(*x, 1024) for x in ("ab", "ba", "ab")]
    chunk = next(chunks([pa.RecordBatch.from_pydict({"text": ["\n".join(lines[:2]), "\n".join(lines)]})]))
    assert quality.base_counts(chunk)["n_dup_lines"].tolist() == [0, 1]


def test_anchors_do_not_depend_on_the_chunk():
    """Among many strings some hold two grams that agree in all but a few bits of their hashes."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdef") for _ in range(50)) for _ in range(300)]
    words += [("ab" * 25), ("abc" * 17)[:50], "x" * 50]
    filler = "".join(rng.choice("ghijklmnop") for _ in range(600_000))
    for pieces in (words, [w + filler[:1000 + 13 * i] for i, w in enumerate(words[:30])], [words[0] + filler]):
        chunk = next(chunks([pa.RecordBatch.from_pydict({"text": pieces})], limit=1 << 24))
        text, begin, _, anchor, hashed = suffix_family.pieces(chunk, 50, 10)
        for i, w in enumerate(pieces):
            alone = suffix_family.pieces(next(chunks([pa.RecordBatch.from_pydict({"text": [w[:50]]})])), 50, 10)
            k = int(np.searchsorted(text, i))
            assert anchor[k] - begin[k] == alone[3][0] and hashed[k] == alone[4][0]


def test_a_passage_inside_a_long_text_is_found(spark):
    """The copy lies in a chunk of its own, above the size at which texts are handled together."""
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(40)]
    long_text = "".join("".join(rng.choice("ijklmnop ") for _ in range(15_000)) + p for p in passages)
    rows = [*((i, p) for i, p in enumerate(passages)), (100, long_text)]
    got = suffix_family.dedup(spark.createDataFrame(rows, "doc_id long, text string"), digest=True).collect()
    assert sorted(map(tuple, got)) == sorted(stripped(rows))
    assert {r.n_removed for r in got if r.doc_id == 100} == {60 * 40}
