"""Token files, periodic runs and the filter audit, against plain Python."""

import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from foldwise.llm import filter_audit, periodic_runs, token_files
from foldwise.llm.queries import word_vocabulary
from tests.llm.helpers import SCHEMA, awkward, documents, prose, sha, words


# --- periodic runs -------------------------------------------------------------------------

def plain_runs(x, least=24, times=3):
    """Every run by its definition."""
    found = {}
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + (j == i)
    return sorted((b, e, q) for (b, e), q in found.items())


def periodic_words(rng: random.Random) -> list[int]:
    letters = rng.choice([1, 2, 3, 10, 100])
    x = [rng.randrange(letters) for _ in range(rng.randint(0, 300))]
    for _ in range(rng.randint(0, 4)):
        if len(x) > 30:
            a = rng.randrange(len(x))
            p = rng.randint(1, max(1, (len(x) - a) // 3))
            for i in range(a, rng.randint(a, len(x))):
                if rng.random() > 0.002:
                    x[i] = x[a + (i - a) % p]
    return x


def test_runs_of_made_up_texts():
    rng = random.Random(11)
    for _ in range(400):
        x = periodic_words(rng)
        got = sorted(zip(*(v.tolist() for v in periodic_runs.runs(np.array(x, dtype=np.int64)))))
        assert got == plain_runs(x)


def test_runs_of_nested_periods():
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    inner = [0, 1] * 20 + [2]
    for x in [fibonacci[-1], ([0] * 30 + [1]) * 7, inner * 5 + [3] + inner * 4, [5] * 1000,
              ([0] * 47 + [1]) * 3, ([0, 1] * 31 + [1]) * 3 + [0]]:
        got = sorted(zip(*(v.tolist() for v in periodic_runs.runs(np.array(x)))))
        assert got == plain_runs(x) and got


def test_choice_of_positions_depends_on_the_words_alone():
    rng = np.random.default_rng(2)
    for t in (4, 8, 16):
        x = rng.integers(0, 30, 600)
        x[300:500] = x[50:250]
        grams = {}
        number = np.array([grams.setdefault(tuple(x[i:i + t]), len(grams)) for i in range(len(x) - t + 1)])
        at = periodic_runs.synchronising(np.arange(len(number)), number, t, np.zeros(len(number), bool))
        chosen = set(at.tolist())
        assert all((i in chosen) == (i + 250 in chosen) for i in range(50, 250 - 2 * t + 1))
        assert np.diff(at).max() <= t


def run_table(rows):
    out = []
    for i, t, *_ in rows:
        w = words(t)
        found = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
        gone = {k for b, e, q in found for k in range(b + q, e)}
        best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
        top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        out.append((i, len(w), len(found), *top, "".join(f"{b},{e - b},{q}\n" for b, e, q in found),
                    " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def run_rows():
    rng = random.Random(12)
    rows = [r for r in documents() if r[0] != 207]
    for i in range(60):
        x = periodic_words(rng)
        rows.append((500 + i, "\n ".join(f"w{v}é" for v in x) + rng.choice(["", " ", "\t."]), None, None, 1))
    rows += [(600, "a " * 100, None, None, 1), (601, "a b " * 12, None, None, 1), (602, "a " * 23, None, None, 1)]
    return rows


def test_runs_of_texts(spark):
    rows = run_rows()
    df = awkward(spark, rows)
    want = run_table(rows)
    got = [(*r[:7], "".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs), r.collapsed)
           for r in periodic_runs.detect(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    digest = periodic_runs.detect(df, digest=True).collect()
    assert sorted(map(tuple, digest), key=str) == sorted(
        ((*r[:7], sha(r[7].encode()), sha(r[8].encode())) for r in want), key=str)


def test_runs_planted(spark):
    """As the registered query does it: texts made periodic before the search."""
    rng = random.Random(13)
    rows = [(i, prose(rng, rng.randint(0, 200)) if i % 9 else None, None, None, 1) for i in range(300)]
    h = F.crc32(F.col("doc_id").cast("string"))
    got = periodic_runs.detect(spark.createDataFrame(rows, SCHEMA), planted=(F.floor(h / 10), h % 10 == 0))
    changed = []
    for i, t, *_ in rows:
        w, c = words(t), zlib.crc32(str(i).encode())
        if c % 10 == 0 and w:
            g, n = c // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        changed.append((i, " ".join(w)))
    found = [(*r[:7], "".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs), r.collapsed)
             for r in got.collect()]
    assert sorted(found, key=str) == sorted(run_table(changed), key=str)
    assert sum(r[2] for r in found) >= 5


def test_runs_of_a_long_text(spark):
    """Many chunks of text in one row, with a period in the hundreds of thousands."""
    rng = np.random.default_rng(3)
    block = [f"{v:x}" for v in rng.integers(0, 1 << 40, 100_000)]
    x = block[-77:] + block * 3 + ["end"] * 30
    df = spark.createDataFrame([(1, " ".join(x))], "doc_id long, text string")
    r = periodic_runs.detect(df).first()
    assert [tuple(v) for v in r.runs] == [(0, 300_077, 100_000), (300_077, 30, 1)]
    assert (r.start, r.length, r.period) == (300_077, 30, 1)
    assert r.collapsed == " ".join(x[:100_000] + ["end"])


# --- token files ---------------------------------------------------------------------------

def encoded(rows, end=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for i, t, *_ in rows}


def token_rows():
    rng = random.Random(14)
    odd = "aAbBé̈ΣİßΩ中国ñ \t\n\x0b\x85\x1c \xa0 '!?#12²½🙂sS'LL’́"
    rows = [r for r in documents() if r[0] not in (None, 3)]
    rows += [(400 + i, "".join(rng.choice(odd) for _ in range(rng.randint(0, 60))), None, None, 1)
             for i in range(300)]
    rows += [(800, "<|endoftext|>a<|startoftext|> b", None, None, 1),
             (801, prose(rng, 200_000), None, None, 1), (-5, "before all", None, None, 1)]
    rng.shuffle(rows)
    return rows


def test_token_files_round_trip(spark, tmp_path):
    rows = token_rows()
    data = token_files.write(awkward(spark, rows), word_vocabulary(), str(tmp_path / "ids"), end=2,
                             frame_bytes=4096, file_bytes=1 << 18)
    assert data.files.count() > 3
    start, want = 0, []
    for i, ids in sorted(encoded(rows).items()):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.documents(data).collect())) == want
    again = token_files.load(spark, str(tmp_path / "ids"))
    assert again.files.agg(F.sum("n_tokens")).first()[0] == start


def test_token_files_keep_pieces_met_again(monkeypatch):
    """Frequent pieces are asked for a few times only, however many rare ones pass by."""
    import pyarrow as pa
    from foldwise.llm.textbytes import chunks

    monkeypatch.setattr(token_files, "REMEMBERED", 400)
    rng = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyzäß"
    common = sorted({"".join(rng.choices(letters, k=7)) for _ in range(150)})
    texts = [" ".join(rng.sample(common, len(common)) + ["".join(rng.choices(letters, k=9)) for _ in range(100)]
                      + ["Ab,Cd", "x<|endoftext|>y" if i % 10 == 9 else "z"]) for i in range(30)]
    with open(word_vocabulary(), encoding="utf-8") as f:
        encoder = token_files.PieceEncoder(f.read(), 2)
    asked, ask = Counter(), encoder._ask
    monkeypatch.setattr(encoder, "_ask", lambda words, between: asked.update(words) or ask(words, between))
    rows = pa.RecordBatch.from_pydict({"text": pa.array([*texts, "", " \n"])})
    got = [ids for chunk in chunks([rows], limit=2000) for ids in encoder.encode(chunk)]
    want = encoded(list(enumerate([*texts, "", " \n"])))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == list(want.values())
    assert len(encoder.pieces) == len(encoder.sizes) <= 400 and len(encoder.flat) == encoder.sizes.sum()
    assert sum(asked[w] for w in common) <= 3 * len(common)


def test_token_files_open_only_frames_they_need(spark, tmp_path):
    rows = token_rows()
    data = token_files.write(spark.createDataFrame(rows, SCHEMA), word_vocabulary(), str(tmp_path / "ids"),
                             end=2, frame_bytes=4096)
    assert data.files.count() == 1 and data.files.first().n_frames > 50
    ids = encoded(rows)
    wanted = spark.createDataFrame([(7,), (450,), (450,), (205,), (99999,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in token_files.fetch(data, wanted).collect()}
    assert set(got) == {7, 450, 205}
    assert all(r.ids == ids[i] and r.frames_read <= 6 for i, r in got.items())
    long_text = token_files.fetch(data, spark.createDataFrame([(801,)], "doc_id long")).first()
    assert long_text.ids == ids[801] and long_text.frames_read >= len(ids[801]) // 1024


def test_token_files_are_the_published_form(spark, tmp_path):
    """Any zstandard reader skips index and table and reads the ids through."""
    import zstandard

    rows = token_rows()
    data = token_files.write(spark.createDataFrame(rows, SCHEMA), word_vocabulary(), str(tmp_path / "ids"), end=2)
    with open(data.files.first().path, "rb") as f:
        raw = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    want = [v for _, ids in sorted(encoded(rows).items()) for v in ids]
    assert np.frombuffer(raw, "<u4").tolist() == want


@pytest.mark.parametrize("where", ["frame", "checksum", "index", "end", "cut"])
def test_token_files_notice_damage(spark, tmp_path, where):
    data = token_files.write(spark.createDataFrame(documents()[:80], SCHEMA), word_vocabulary(),
                             str(tmp_path / "ids"), end=2, frame_bytes=1024)
    path = data.files.first().path
    with open(path, "rb") as f:
        raw = bytearray(f.read())
    if where == "cut":
        raw = raw[:-20]
    else:
        n = int.from_bytes(raw[-9:-5], "little")
        raw[{"frame": 40, "checksum": -22, "index": -9 - 12 * n - 20, "end": -1}[where]] ^= 0x55
    with open(path, "wb") as f:
        f.write(raw)
    with pytest.raises(PythonException, match="DamagedFile"):
        token_files.documents(data).collect()


def test_token_files_edges(spark, tmp_path):
    empty = token_files.write(spark.createDataFrame([], SCHEMA), word_vocabulary(), str(tmp_path / "a"), end=2)
    assert token_files.documents(empty).count() == 0
    assert token_files.fetch(empty, spark.createDataFrame([(1,)], "doc_id long")).count() == 0
    rows = [(None, "one two"), (7, None), (7, "x"), (7, "x"), (9, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for end, extra in ((2, 1), (None, 0)):
        data = token_files.write(df, word_vocabulary(), str(tmp_path / f"b{end}"), end=end)
        got = token_files.documents(data).orderBy("start").collect()
        assert [r.doc_id for r in got][:2] == [None, None] and len(got) == 6
        assert sorted(r.n_tokens for r in got) == sorted([2 + extra, extra, 1 + extra, 1 + extra, extra, extra])
        assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist() or end is None
        assert token_files.fetch(data, spark.createDataFrame([(7,)], "doc_id long")).count() == 3


# --- filter audit --------------------------------------------------------------------------

def plain_failures(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, _, source, *_ in rows:
        t, w = t or "", words(t)
        out.append((i, source or "", {f for f, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and first[t] < i)) if bad}))
    return out


def plain_audit(rows, good, toxic):
    failed = plain_failures(rows)
    parts = sorted({p for _, p, _ in failed})
    removed, out = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for p in parts:
            alive = [(i, f) for i, q, f in failed if q == p]
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in alive if name in f]
                alive = [(i, f) for i, f in alive if name not in f]
                bad = sum(name in f for _, q, f in failed if q == p)
                out[p, order, step] = (
                    len(alive), len(gone), bad - len(gone), sum(f == {name} for _, q, f in failed if q == p),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                removed[p, name] = removed.get((p, name), 0) + len(gone)
    return {(*k, *v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows():
    rng = random.Random(15)
    rows = documents()
    for i in range(300):
        text = prose(rng, rng.choice([10, 49, 50, 80]), rng.choice(["a b", "alpha beta gamma delta"]))
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice("#$%&*|")
        rows += [(1000 + 3 * i + k, text, None, rng.choice(["a", "b", "", None]), 1)
                 for k in range(rng.choice([1, 1, 3]))]
    return rows


def test_audit(spark):
    rows = audit_rows()
    rng = random.Random(16)
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows[::2] if r[0] is not None]
    labels = list({l[0]: l for l in labels}.values()) + [(10**6, 1, 1), (None, 1, 1)]
    good, toxic = ({l[0] for l in labels if l[k] == 1} - {None} for k in (1, 2))
    told = spark.createDataFrame([(*l, 5) for l in labels], "doc_id long, quality int, toxic int, Toxic int")
    got = filter_audit.audit_texts(awkward(spark, rows), told).collect()
    assert len(got) == len(set(map(tuple, got))) == 600 * len({r[3] or "" for r in rows})
    assert {tuple(r) for r in got} == plain_audit(rows, good, toxic)


def test_audit_shares_are_shapley_values(spark):
    """Weights of edges against all orders one by one, for other numbers of filters."""
    for k in (1, 2, 4):
        names = [chr(65 + i) for i in range(k)]
        assert sum(w for *_, w in filter_audit.edges(k)) == k * len(list(permutations(names)))
        walked = Counter((s, f) for _, _, s, f in filter_audit.steps(names))
        assert walked == {(s, f): w for s, f, w in filter_audit.edges(k)}
        df = spark.range(200).select((F.col("id") % 3).alias("p"), *[
            F.when(F.col("id") % 11 > 0, F.xxhash64("id", F.lit(n)) % 3 == 0).alias(n) for n in names])
        got = filter_audit.audit(df, "p", {n: F.col(n) for n in names}, {}).collect()
        assert len(got) == 3 * k * len(list(permutations(names)))
        per = {(r.part, r.filter_order[r.step - 1]): r.shapley for r in got}
        for (p, n), v in per.items():
            assert v == sum(r.removed for r in got if r.part == p and r.filter_order[r.step - 1] == n)
    with pytest.raises(ValueError):
        filter_audit.audit(df, "p", {}, {})


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_texts(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_empty_and_blank_texts_have_no_runs(spark):
    assert periodic_runs.detect(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (None, "a " * 40)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.detect(df).collect()}
    assert [(got[i].n_runs, got[i].start, got[i].collapsed) for i in (1, 2, 3)] == [(0, None, "")] * 3
    assert (got[None].n_runs, got[None].collapsed, got[None].exponent_milli) == (1, "a", 40_000)
