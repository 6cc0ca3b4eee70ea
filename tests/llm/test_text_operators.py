"""Operators that work text by text, against plain Python on awkward tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from foldwise.llm import bpe, langid, lm_scoring, quality, secret_scan, toxicity
from foldwise.llm.queries import word_vocabulary
from foldwise.llm.textbytes import LOWER
from tests.llm.helpers import SCHEMA, awkward, documents, plain_counts, prose, sha, words


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


def labelled(spark, rows, mark):
    return spark.createDataFrame([(i, int(mark in (t or ""))) for i, t, *_ in rows] + [(None, 1)],
                                 "doc_id long, quality int").selectExpr(
        "doc_id", "quality", "quality as toxic")


def test_quality_counts(spark):
    rows = documents() + [(300, "a a a a\na a a a\n\n a\n a", None, None, 1), (301, "#*$%&|<>", *[None] * 3)]
    df = awkward(spark, rows)
    model = quality.fit(df, labelled(spark, rows, "alpha"), sample_rows=100)
    got = quality.apply(df, model).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, plain_counts(t)) for i, t, *_ in rows)
    assert want == sorted((r[0] is None, r[0] or 0, (r.n_words, r.word_chars, r.n_symbols,
                                                     r.n_dup_lines, r.n_repeat_words)) for r in got)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.probability <= 1


def test_quality_learns(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 80, "good fine nice" if i % 3 else "bad ugly poor"), None, None, 1)
            for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)], "doc_id long, quality int")
    kept = {r.doc_id: r.probability >= 0.5 for r in quality.apply(df, quality.fit(df, labels)).collect()}
    assert np.mean([kept[i] == (i % 3 > 0) for i in range(400, 600)]) > 0.97


def test_toxicity_finds_the_sentence(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        sentences = [prose(rng, 8) for _ in range(6)]
        if i % 4 == 0:
            sentences[i % 6] = "you " + rng.choice(["scumbag", "scumlike", "scummy"]) + " thing"
        rows.append((i, ". ".join(sentences), None, None, 1))
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r for r in toxicity.apply(df, model).collect()}
    assert np.mean([got[i].predicted == (i % 4 == 0) for i in range(600, 900)]) > 0.97
    hits = [r for i, r in got.items() if i >= 600 and i % 4 == 0 and r.offending]
    texts = dict((r[0], r[1]) for r in rows)
    assert hits and all("scum" in texts[r.doc_id][s.start:s.end] for r in hits
                        for s in r.offending if s.score > 0.6)
    assert toxicity.keep(df, model).count() == sum(r.predicted == 0 for r in got.values())


def test_toxicity_edges(spark):
    rows = documents()
    df = awkward(spark, rows)
    got = toxicity.apply(df, toxicity.fit(df, labelled(spark, rows, "alphabeta"))).collect()
    assert len(got) == len(rows)
    assert all(r.score == 0 for r in got if r.doc_id in (200, 201, 202))
    none = toxicity.fit(df, labelled(spark, rows, "alpha").where("false"))
    assert {r.predicted for r in toxicity.apply(df, none).collect()} == {0}


def test_language(spark):
    rng = random.Random(4)
    stock = {"xx": "sha lo mir ta", "yy": "gra pul ost wim"}
    rows = [(i, prose(rng, 40, stock[l]), l, None, 1) for i in range(300)
            for l in [rng.choice(["xx", "yy"])]]
    df = spark.createDataFrame(rows, SCHEMA)
    profiles = langid.fit(df, df["doc_id"] < 200)
    told = {r.doc_id: r for r in langid.apply(df, profiles).collect()}
    assert all(told[i].lang_pred == l for i, _, l, *_ in rows)
    odd = spark.createDataFrame([(1, None), (2, "12 34 !"), (3, ""), (None, "grapul")], "doc_id long, text string")
    assert [r[1] for r in by_id(langid.apply(odd, profiles))] == ["und", "und", "und", "yy"]
    empty = langid.fit(df.where("false"))
    assert {r.lang_pred for r in langid.apply(df, empty).collect()} == {"und"}


def test_language_counts(spark):
    """The n-gram counts behind the profiles, by hand."""
    from foldwise.llm.textbytes import chunks

    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["Ab, b", None, "éa"])})
    chunk = next(chunks([batch]))
    text, gram, counts = langid.counted(chunk, langid.Letters())
    show = lambda g: "".join(chr(g >> 21 * k & 0x1FFFFF) for k in (2, 1, 0) if g >> 21 * k & 0x1FFFFF)
    first = {show(g): c for t, g, c in zip(text.tolist(), gram.tolist(), counts.tolist()) if t == 0}
    assert first == {"a": 1, "b": 2, "_a": 1, "ab": 1, "b_": 1, "_b": 1, "_ab": 1, "ab_": 1, "_b_": 1} or \
        first["a"] == 1 and first["b"] == 2 and first["ab"] == 1 and first["_ab"] == 1


def test_secrets(spark):
    key, hexa = "AKIA" + "A1B2C3D4E5F6G7H8", "0123456789abcdef0"
    rows = [(1, f'é token = "{key}xyz" {hexa}', None, "a", 1), (2, f"PassWord:{'q' * 12} x", None, "b", 1),
            (3, "secret=short AKIA1 abcdef", None, "b", 1), (4, None, None, None, 1), (5, "", None, "a", 1),
            *[(10 + i, "copied Zx9Kq27LmNb35TrWv8Yc1", None, f"s{i}", 1) for i in range(5)],
            (20, "rare Qw8Er77TyUi12OpAs4Df6", None, "a", 1), (None, "api_key='abcdefghijkl'", None, "c", 1)]
    rows = [(i if i is None else i + 1000, *r) for i, *r in rows] + documents()
    got = secret_scan.scan(awkward(spark, rows)).collect()
    assert len(got) == len(rows)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.I | re.A)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        if r.doc_id in (None, 3):
            continue
        t = texts[r.doc_id]
        base = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert sorted(base) == [(s.start, s.kind, s.end) for s in r.found if s.kind < 3]
    found = {r.doc_id: r.found for r in got}
    assert not found[1012] and [s.kind for s in found[1020]] == [3]
    masked = {r.doc_id: r.text for r in secret_scan.redact(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert masked[1020] == "rare " + "*" * 21 and masked[1012] == texts[1012]
    assert key not in masked[1001]
    assert masked[1004] is None and masked[205] == texts[205]


def test_secrets_by_owners_and_repositories(spark):
    """A key copied through one source is an example; a password in three sources is live."""
    example, password = "AKIA" + "EXAMPLEEXAMPLE01", "password=hunter2hunter2"
    wide = "Zx9Kq27LmNb35TrWv8Yc1"
    rows = [(i, f"{example} {wide}", None, "hot", 1) for i in range(400)]
    rows += [(1000 + i, f"mine {password}", None, f"s{i}", 1) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.found for r in secret_scan.scan(df).collect()}
    assert all([(s.kind, s.live, s.n_repos) for s in found[i]] == [(1, False, 400)] for i in range(400))
    assert all([(s.kind, s.live, s.n_owners) for s in found[1000 + i]] == [(0, True, 3)] for i in range(3))
    masked = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert all(masked[i] == f"{example} {wide}" for i in range(400))
    assert all(masked[1000 + i] == "mine " + "*" * len(password) for i in range(3))


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    rng = random.Random(5)
    odd = "aAbBé̈ΣİßΩ中国ñ \t\n\x0b\x85 '!?#12²½Ⅷ🙂sS'LL’"
    rows = documents() + [(400 + i, "".join(rng.choice(odd) for _ in range(rng.randint(0, 60))), *[None] * 3)
                          for i in range(300)]
    rows += [(800, "<|endoftext|>a<|startoftext|> b", *[None] * 3), (801, "x" * 900 + "ab" * 700, *[None] * 3)]
    want = []
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()),
                     sha(tokenizer.decode(ids, skip_special_tokens=False).encode())))
    df = awkward(spark, rows)
    got = bpe.apply(df, word_vocabulary(), digest=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    full = bpe.apply(df, word_vocabulary(), carry=("source",)).where("doc_id = 800").first()
    assert full.ids == tokenizer.encode(rows[-2][1], add_special_tokens=False).ids


def test_bpe_trees_agree():
    vocabulary = bpe.load(word_vocabulary())
    rng = random.Random(6)
    words = [bpe._symbols("".join(rng.choice("thingero") for _ in range(rng.randint(1, 64))), vocabulary)
             for _ in range(400)]

    def naive(symbols):
        symbols = list(symbols)
        while True:
            ranks = [(vocabulary.pair_rank.get(a << 20 | b, 1 << 40), k)
                     for k, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            if not ranks or min(ranks)[0] == 1 << 40:
                return symbols
            rank, k = min(ranks)
            symbols[k:k + 2] = [int(vocabulary.merged[rank])]

    assert bpe.merge_many(words, vocabulary) == [naive(w) for w in words]
    assert [bpe.merge_one(w, vocabulary) for w in words] == [naive(w) for w in words]


def test_lm_gradient():
    """The hand-written gradient against differences."""
    rng = np.random.default_rng(1)
    classes = rng.integers(0, lm_scoring.CLASSES, 50)
    around = lm_scoring.neighbours(classes, np.repeat([0, 1], 25))
    flat = lm_scoring.start().astype(float)
    g = lm_scoring.gradient(lm_scoring.layers(flat), around, classes)
    loss = lambda f: -lm_scoring.log_likelihood(lm_scoring.layers(f), around, classes).astype(float).mean()
    for i in rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 12):
        step = np.zeros_like(flat)
        step[i] = 1e-2
        assert (loss(flat + step) - loss(flat - step)) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=1e-4)


def test_lm_prefers_seen_order(spark):
    rng = random.Random(7)
    line = "the quick brown fox jumps over a lazy dog while seven grey owls watch".split()
    rows = [(i, " ".join(line[(i + k) % len(line)] for k in range(120)), None, None, 1) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = lm_scoring.fit(df)
    mixed = [(i, " ".join(rng.sample(t.split(), 120)), None, None, 1) for i, t, *_ in rows[:40]]
    seen = [r.mean_log_likelihood for r in lm_scoring.apply(df.where("doc_id < 40"), model).collect()]
    other = [r.mean_log_likelihood for r in
             lm_scoring.apply(spark.createDataFrame(mixed, SCHEMA), model).collect()]
    assert min(seen) > max(other) and np.mean(seen) > np.mean(other) + 0.1


def test_lm_edges(spark):
    df = awkward(spark, documents())
    got = lm_scoring.apply(df, lm_scoring.fit(df)).collect()
    assert len(got) == df.count()
    blank = {r.doc_id: r for r in got if r.doc_id in (200, 201, 202)}
    assert all(r.n_words == 0 and r.log_likelihood == 0 and r.mean_log_likelihood is None
               for r in blank.values())
    assert all(r.log_likelihood < 0 for r in got if r.n_words)


def test_lm_counts_every_word(spark):
    rows = documents()
    got = {bytes(r.word): r.n for r in lm_scoring.word_counts(awkward(spark, rows)).collect()}
    want = Counter(bytes(LOWER[np.frombuffer(w.encode(), np.uint8)])
                   for _, t, *_ in rows for w in words(t))
    assert got == want


def test_lm_tokens_spell_the_text(spark):
    """Different words give different tokens, rare ones and bounds between them included."""
    import pyarrow as pa
    from foldwise.llm.textbytes import chunks

    known = lm_scoring.vocabulary(spark.createDataFrame(documents(), SCHEMA))
    rng = random.Random(12)
    texts = sorted({" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
                             for _ in range(rng.randint(1, 3))) for _ in range(3000)})
    chunk = next(chunks([pa.RecordBatch.from_pydict({"text": pa.array(texts + ["alpha", ""])})]))
    ids, text = lm_scoring.tokens(chunk, known)
    assert ids.min() >= 0 and ids.max() < len(known)
    assert len({tuple(ids[text == i]) for i in range(len(texts))}) == len(texts)


def test_lm_context_tells_words_of_one_ending_apart(spark):
    """Words beyond the most frequent ones, all with one ending, foretell their partners."""
    rng = random.Random(13)
    filler = [f"f{i}" for i in range(120)]
    pairs = [(f"{a}{b}ra", f"{b}{a}tu") for a in "kmpsv" for b in "bdgjlnrz"]

    def line(shift):
        out = []
        for k in rng.sample(range(len(pairs)), 12):
            out += [*rng.choices(filler, k=6), pairs[k][0], pairs[(k + shift) % len(pairs)][1]]
        return " ".join(out)

    df = spark.createDataFrame([(i, line(0), None, None, 1) for i in range(1500)], SCHEMA)
    model = lm_scoring.fit(df)
    right, wrong = (np.mean([r.mean_log_likelihood for r in lm_scoring.apply(spark.createDataFrame(
        [(i, line(shift), None, None, 1) for i in range(60)], SCHEMA), model).collect()])
        for shift in (0, 1))
    assert right > wrong + 0.05


def test_lm_steps_stay_in_cache():
    """A step over many tokens holds the scores of a block of them, and gives what one sum gives."""
    import tracemalloc

    rng = np.random.default_rng(5)
    cuts, n = lm_scoring.classes_of(3000), 16384
    found = rng.integers(0, 3000, n).astype(np.int32)
    net = lm_scoring.layers(lm_scoring.start(cuts), cuts)
    around = lm_scoring.neighbours(found, np.arange(n) // 100, 3000)
    tracemalloc.start()
    whole = lm_scoring.gradient(net, around, found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * n * lm_scoring.CLASSES
    parts = [lm_scoring.gradient(net, around[a:a + 100], found[a:a + 100]) * (len(found[a:a + 100]) / n)
             for a in range(0, n, 100)]
    assert np.abs(whole - sum(parts)).max() < 1e-5


def test_lm_shifts_large_scores():
    """Scores whose exponentials overflow, in the classes and in their members."""
    rng = np.random.default_rng(6)
    cuts = lm_scoring.classes_of(2000)
    found = rng.integers(0, 2000, 300).astype(np.int32)
    around = lm_scoring.neighbours(found, np.zeros(300), 2000)
    flat = lm_scoring.start(cuts) * 300
    steep, exact = (lm_scoring.layers(f, cuts) for f in (flat, flat.astype(float)))
    assert steep[9].all()
    got = lm_scoring.log_likelihood(steep, around, found)
    h = np.tanh(sum(exact[8][k][around[:, k]] for k in range(len(lm_scoring.PLACES))) + exact[2])
    z = h @ exact[3] + exact[4]
    of = np.searchsorted(cuts, found, side="right") - 1
    want = z[np.arange(300), of] - np.logaddexp.reduce(z, axis=1)
    for i, c in enumerate(of):
        y = exact[5][cuts[c]:cuts[c + 1]] @ h[i] + exact[6][cuts[c]:cuts[c + 1]]
        want[i] += y[found[i] - cuts[c]] - np.logaddexp.reduce(y)
    assert np.allclose(got, want, rtol=1e-3, atol=0.1)
    assert np.isfinite(lm_scoring.gradient(steep, around, found)).all()


def test_lm_finds_tokens_in_few_looks():
    rng = np.random.default_rng(8)
    for values in (np.unique(rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)), np.arange(4000),
                   np.zeros(0, dtype=np.int64)):
        ids = rng.permutation(len(values)).astype(np.int32)
        places = lm_scoring.Places(values, ids)
        assert places.most <= 8
        wanted = np.append(values[::-1], values[:100] + values.dtype.type(1 << 40))
        known = dict(zip(values.tolist(), ids.tolist()))
        assert places.find(wanted).tolist() == [known.get(v, -1) for v in wanted.tolist()]


@pytest.mark.parametrize("step", ["quality", "toxic", "lang", "secret", "bpe", "lm"])
def test_empty_tables(spark, step):
    df = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {"quality": lambda: quality.apply(df, quality.fit(df, labels)),
           "toxic": lambda: toxicity.apply(df, toxicity.fit(df, labels)),
           "lang": lambda: langid.apply(df, langid.fit(df)),
           "secret": lambda: secret_scan.redact(df),
           "bpe": lambda: bpe.apply(df, word_vocabulary()),
           "lm": lambda: lm_scoring.apply(df, lm_scoring.fit(df))}[step]()
    assert out.count() == 0


def test_lm_neighbours_add_up_in_one_place(monkeypatch):
    """What a token gets from all sides is summed once, also where texts or steps end."""
    rng = np.random.default_rng(9)
    cuts, n = lm_scoring.classes_of(700), 3000
    found = rng.integers(0, 700, n).astype(np.int32)
    net = lm_scoring.layers(lm_scoring.start(cuts), cuts)
    counted, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: (counted.append(len(x)), bincount(x, *a, **k))[1])
    for text in (np.arange(n), np.arange(n) // 2, np.arange(n) // 100):
        around = lm_scoring.neighbours(found, text, 700)
        for some in (slice(0, n), slice(1500, 1501), slice(101, 103), slice(7, 2900)):
            counted.clear()
            got = lm_scoring.gradient(net, around[some], found[some])
            size = len(found[some])
            if size > 2000 and text[-1] < n // 50:
                assert sum(counted) < 1.2 * lm_scoring.HIDDEN * size
            step = 1e-2
            for token in {700, *around[some][:2].ravel().tolist()[:2]}:
                held = [a.copy() if i == 0 else a for i, a in enumerate(net)]
                loss = []
                for by in (step, -step):
                    held[0][token] = net[0][token] + by
                    loss.append(-lm_scoring.log_likelihood(held, around[some], found[some]).astype(float).mean())
                want = (loss[0] - loss[1]) / 2 / step
                assert got[:701 * 16].reshape(701, 16)[token].sum() == pytest.approx(want, rel=0.02, abs=2e-4)


def test_lm_piece_keys():
    rng = np.random.default_rng(10)
    for size in (1, 3, 500):
        data = rng.integers(0, 256, size).astype(np.uint8)
        begin = rng.integers(0, size + 1, 300)
        end, first = np.minimum(begin + rng.integers(0, 5, 300), size), rng.integers(0, 2, 300)
        want = [((e - b) * 2 + f) << 32 | int.from_bytes(data[b:e].tobytes().ljust(4, b"\0"), "big")
                for b, e, f in zip(begin.tolist(), end.tolist(), first.tolist())]
        assert lm_scoring.keys(data, begin, end, first).tolist() == want
