"""Stages that keep all columns, on tables whose names clash; executors without the package."""

import subprocess
import sys
from pathlib import Path

import pytest

from foldwise.llm import jaccard_join, langid, mixing, secret_scan, toxicity
from tests.llm.helpers import SCHEMA, documents

WIDE = (SCHEMA + ", Doc_Id int, TEXT string, Source string, `__copy` int, `__spans` int, `__at` int, "
        "`__secret_row` int, `a.b` string, `_metadata` int, c0 string")
EXTRA = (7, "x", "S", 1, 2, 3, 4, "dot", 5, "c")


def clashing(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], WIDE)


@pytest.fixture(scope="module")
def model(spark):
    labels = spark.createDataFrame([(i, int("alpha" in (t or ""))) for i, t, *_ in documents()],
                                   "doc_id long, toxic int")
    return toxicity.fit(spark.createDataFrame(documents(), SCHEMA), labels)


@pytest.mark.parametrize("stage", ["keep", "survivors", "redact", "arranged"])
@pytest.mark.parametrize("rows", [documents(), []], ids=["rows", "empty"])
def test_clashing_columns(spark, model, stage, rows):
    """The same rows stay as without the extra columns, which keep names and values."""
    work = {"keep": lambda d: toxicity.keep(d, model), "survivors": jaccard_join.survivors,
            "redact": secret_scan.redact, "arranged": mixing.arranged}[stage]
    df = clashing(spark, rows)
    out = work(df)
    assert out.columns == df.columns
    got = out.collect()
    assert all(tuple(r)[5:] == EXTRA for r in got)
    want = work(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(map(tuple, want), key=str)


ALONE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from foldwise.llm import (bpe, filter_audit, jaccard_join, langid, lm_scoring, mixing, periodic_runs,
                          quality, secret_scan, suffix_family, token_files, topk, toxicity)
from foldwise.llm.queries import word_vocabulary
from pyspark.sql import functions as F

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {folder!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())

def absent(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("foldwise") is not None]}})

assert not spark.range(1).mapInArrow(absent, "found boolean").first()[0], "workers see the package"
texts = ["alpha beta gamma " * 20, "one two three. password=abcdefgh1234", None, "", "alpha beta delta " * 20] * 4
df = spark.createDataFrame([(i, t, "en" if i % 2 else "de", "s", 1) for i, t in enumerate(texts)], {schema!r})
labels = spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(16)], "doc_id long, quality int, toxic int")
vectors = spark.createDataFrame([(i, [float(i), 1.0, -i / 2]) for i in range(60)], "vec_id long, embedding array<float>")
vocabulary = word_vocabulary()
for name, out in {{
    "lm": lambda: lm_scoring.apply(df, lm_scoring.fit(df)), "mix": lambda: mixing.arranged(df),
    "suffix": lambda: suffix_family.dedup(df), "bpe": lambda: bpe.apply(df, vocabulary),
    "jaccard": lambda: jaccard_join.survivors(df), "secret": lambda: secret_scan.redact(df),
    "toxicity": lambda: toxicity.keep(df, toxicity.fit(df, labels)),
    "toxic scores": lambda: toxicity.apply(df, toxicity.fit(df, labels)),
    "language": lambda: langid.apply(df, langid.fit(df)),
    "topk": lambda: topk.search(vectors, F.col("id") % 50 == 0, 5),
    "quality": lambda: quality.apply(df, quality.fit(df, labels)), "runs": lambda: periodic_runs.detect(df),
    "files": lambda: token_files.documents(token_files.write(df, vocabulary, end=2)),
    "audit": lambda: filter_audit.audit_texts(df, labels),
}}.items():
    assert out().collect(), name
    print("done", name, flush=True)
"""


def test_executors_without_the_package(tmp_path):
    """Workers are started where the package cannot be imported."""
    import os

    repo = str(Path(__file__).resolve().parents[2])
    script = tmp_path / "alone.py"
    script.write_text(ALONE.format(repo=repo, folder=str(tmp_path / "shared"), schema=SCHEMA))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT",
                                                            "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=600)
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-4000:]
    assert done.stdout.count("done") == 14
