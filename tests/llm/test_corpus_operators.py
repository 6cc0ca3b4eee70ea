"""Operators that compare texts or vectors with each other, against brute force."""

import random

import numpy as np
import pytest

from foldwise.llm import jaccard_join, mixing, suffix_family, topk
from foldwise.llm.graph import components
from tests.llm.helpers import SCHEMA, awkward, documents, linked, prose, shingle_set, stripped


def test_jaccard_components(spark):
    rows = documents()
    want = linked([(i, t) for i, t, *_ in rows])
    got = jaccard_join.link(awkward(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {(i, len(shingle_set(t))) for i, t, *_ in rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes
    assert all(r.component_id == want.get(r.doc_id) for r in got)


def test_jaccard_blocks(spark, monkeypatch):
    """Buckets cut into many blocks link the same."""
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "SEEN", 0)
    rng = random.Random(9)
    base = prose(rng, 60).split()
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(60)] = prose(rng, 1)
        rows.append((i, " ".join(words), None, None, 1))
    want = linked([(i, t) for i, t, *_ in rows])
    got = jaccard_join.link(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) > 2


def test_parity_never_exceeds_difference():
    rng = np.random.default_rng(3)
    for n in (1, 40, 300, 9000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.append(a[: max(1, int(n * 0.9))], rng.integers(0, 2**63, n // 8 + 1, dtype=np.uint64)))
        one, two = (np.unpackbits(np.frombuffer(jaccard_join.parity(x), np.uint8), bitorder="little") for x in (a, b))
        if len(one) == len(two):
            assert (one != two).sum() <= len(np.setxor1d(a, b))


def test_prefixes_meet():
    rng = np.random.default_rng(4)
    rare = rng.integers(0, 60, 1 << jaccard_join.CELL_BITS).astype(np.uint8)
    for _ in range(200):
        n = int(rng.integers(1, 80))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.append(a[: n - n // 10], rng.integers(0, 2**63, n // 12, dtype=np.uint64))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            for order in range(3):
                assert np.intersect1d(jaccard_join.prefix(a, rare, order, 80),
                                      jaccard_join.prefix(b, rare, order, 80)).size


def test_marks_meet_where_tokens_do(monkeypatch):
    rng = np.random.default_rng(5)
    for few in (0, 8, 256):
        monkeypatch.setattr(jaccard_join, "FEW_MARKS", few)
        for n, m in ((1, 1), (5, 40), (300, 12), (300, 400)):
            a, b, shared = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (n, m, 1))
            one, two = (jaccard_join.marks(np.append(x, shared)) for x in (a, b))
            assert jaccard_join.meet_marks(one, two) and jaccard_join.meet_marks(two, one)
    apart = [jaccard_join.marks(np.arange(k, k + 9, dtype=np.uint64) << np.uint64(40)) for k in (0, 2**20)]
    assert not jaccard_join.meet_marks(*apart)
    empty = jaccard_join.marks(np.zeros(0, np.uint64))
    assert not jaccard_join.meet_marks(empty, apart[0]) and not jaccard_join.meet_marks(empty, empty)


def test_orders_are_intersected(spark):
    """A pair stays only if both other orders find it; ids that repeat keep a pair once."""
    mark = lambda *x: jaccard_join.marks(np.array(x, np.uint64) << np.uint64(48))
    rows = [(1, mark(1, 2), mark(7)), (2, mark(2, 3), mark(7, 8)), (3, mark(2), mark(9)),
            (4, mark(5), mark(7)), (2, mark(2, 3), mark(7, 8)), (None, mark(1), mark(7))]
    nodes = spark.createDataFrame(rows, "id long, second binary, third binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 4)], "a long, b long")
    got = [tuple(r) for r in jaccard_join.intersected(nodes, pairs).collect()]
    assert got == [(1, 2)]


def test_survivors(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    want = linked([(i, t) for i, t, *_ in rows])
    got = jaccard_join.survivors(df)
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted({(i, t) for i, t, *_ in rows if want.get(i) == i}, key=str)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 95), (7, None)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_suffixes(spark, monkeypatch):
    rows = [r for r in documents() if r[0] != 207]
    rng = random.Random(11)
    passage = prose(rng, 20)
    rows += [(500 + i, prose(rng, 20) + passage[i % 3:] + prose(rng, 5), None, None, 1) for i in range(30)]
    rows += [(600, "ab" * 200, None, None, 1), (601, "xx" + "ab" * 100, None, None, 1)]
    want = sorted(stripped([(i, t) for i, t, *_ in rows]), key=str)
    got = suffix_family.dedup(awkward(spark, rows), digest=True).collect()
    assert sorted(map(tuple, got), key=str) == want
    # The same with hardly any memory: many flushes, parts, groups and batches.
    for name, size in (("FLUSH_BYTES", 3000), ("PART_BYTES", 4000), ("GROUP_BYTES", 5000), ("BATCH_SUFFIXES", 50)):
        monkeypatch.setattr(suffix_family, name, size)
    again = suffix_family.dedup(spark.createDataFrame(rows, SCHEMA), digest=True).collect()
    assert sorted(map(tuple, again), key=str) == want


def test_suffix_family_levels():
    rng = np.random.default_rng(5)
    family, seen = suffix_family.SuffixFamily(), {}
    for batch in range(40):
        keys = rng.integers(0, 3000, 100).astype(np.uint64)
        owner = np.sort(rng.integers(0, 5, 100)) + batch * 5
        hit = family.add(keys, owner)
        least = {}
        for k, o in zip(keys.tolist(), owner.tolist()):
            least[k] = min(least.get(k, o), o)
        assert hit.tolist() == [k in seen or o > least[k] for k, o in zip(keys.tolist(), owner.tolist())]
        seen.update(least)
        assert all(len(a) > 2 * len(b) for a, b in zip(family.levels, family.levels[1:]))


def mixed_ok(rows, weights, block_rows, period):
    slots = {}
    for r in rows:
        slots.setdefault(r.slot, set()).add((r.source, r.block))
        assert r.release <= r.slot < r.deadline
    assert all(len(x) == 1 for x in slots.values())
    last = {s: max(r.slot for r in rows if r.source == s) for s in {r.source for r in rows}}
    horizon, count = min(last.values()), dict.fromkeys(last, 0)
    for t in range(horizon + 1):
        (name, _), = slots[t]
        count[name] += 1
        assert all(abs(count[s] - (t + 1) * weights[s] / period) < 1 for s in count)
    return last


def test_mixing(spark):
    rows = [(i, None, None, s, 1) for i in range(900) for s in ["a" if i % 2 else "b" if i % 3 else None]]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), {"a": 0.5, "b": 0.2, None: 0.3}, block_rows=4,
                     period=10, rank_rows=50).collect()
    assert sorted(r.doc_id for r in got) == list(range(900))
    for s in ("a", "b", None):
        assert sorted(r.place for r in got if r.source == s) == list(range(sum(x[3] == s for x in rows)))
        assert all(r.block == r.place // 4 for r in got)
    mixed_ok(got, {"a": 5, "b": 2, None: 3}, 4, 10)


def test_schedule_deviation():
    rng = np.random.default_rng(6)
    for _ in range(30):
        slots = tuple(int(x) for x in mixing.slots_of(rng.random(int(rng.integers(1, 9))), 60))
        total, count = sum(slots), np.zeros(len(slots))
        plan = mixing.schedule(slots)
        for t, (i, _) in enumerate(plan):
            count[i] += 1
            assert np.all(np.abs(count - (t + 1) * np.array(slots) / total) < 1)
        assert count.tolist() == list(slots)


def test_mixing_meets_the_weights_of_many_sources(spark):
    """One source is due a third, three thousand small ones share the rest."""
    small = [f"s{i}" for i in range(3000)]
    rows = [(i, None, None, s, 1) for i, s in enumerate(small + ["hot"] * 1500)]
    weights = {s: 2 / 9000 for s in small} | {"hot": 1 / 3}
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights, block_rows=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    assert all(r.release <= r.slot < r.deadline for r in got)
    order = [r.source for r in sorted(got, key=lambda r: r.slot)]
    hot = np.cumsum([s == "hot" for s in order])
    assert np.all(np.abs(hot - np.arange(1, len(order) + 1) / 3) < 1)


def test_slots_fit_uneven_weights():
    rng = np.random.default_rng(14)
    for n in (1, 40, 5000):
        shares = np.append(rng.random(n) ** 3, n / 8)
        slots = mixing.fitting_slots(shares, np.full(n + 1, 10_000), 1000)
        wanted = shares / shares.sum()
        assert np.all(np.abs(slots / slots.sum() / wanted - 1) < 0.011)
    # Sources without a weight take nothing that counts from the others.
    slots = mixing.fitting_slots(np.array([3.0, 1.0] + [0.0] * 4000), np.full(4002, 1000), 1000)
    assert slots[0] / slots.sum() == pytest.approx(0.75, rel=0.011) and slots.min() == 1


def test_mixing_edges(spark):
    df = awkward(spark, documents())
    got = mixing.mix(df).collect()
    assert len(got) == df.count() and len({r.slot for r in got}) == len({(r.source, r.block) for r in got})
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    plain = spark.createDataFrame(documents(), SCHEMA)
    kept = mixing.arranged(plain, files=3)
    assert kept.columns == plain.columns and kept.count() == plain.count()


def exact(rows, k):
    vectors = {i: np.floor(256 * np.array(v, dtype=float)) for i, v in rows
               if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    width = max(map(len, vectors.values()))
    vectors = {i: np.pad(v, (0, width - len(v))) for i, v in vectors.items()}
    out = []
    for q in (i for i in vectors if i % 50 == 0):
        best = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("slice_rows", [7, 4096])
def test_topk(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(topk, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, rng.choice([0.1, 1, 3]), 9)]) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 9), (2050, [float("inf")] * 9),
             (None, [1.0] * 9), (2100, [1.0, 2.0]), (2150, []), (2200, [0.0] * 9)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, label int, VEC_ID string")
    import pyspark.sql.functions as F
    got = topk.search(df, F.col("id") % 50 == 0, 5).collect()
    assert sorted(map(tuple, got)) == exact(rows, 5)


def test_topk_few(spark):
    import pyspark.sql.functions as F
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], schema)
    assert [tuple(r) for r in topk.search(few, F.col("id") % 50 == 0, 5).collect()] == [(0, 1, 1, 768 * 128)]
    assert topk.search(few.where("false"), F.col("id") % 50 == 0, 5).count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.link(df).count() == 0
    assert jaccard_join.survivors(df).count() == 0
    assert suffix_family.dedup(df).count() == 0
