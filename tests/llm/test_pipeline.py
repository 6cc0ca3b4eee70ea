"""The pipeline stage by stage, and its registered query."""

import corpus_pipeline
import pytest

from foldwise.llm import jaccard_join, secret_scan, toxicity
from foldwise.llm.queries import held_out, queries, read
from tests.llm.helpers import SCHEMA, linked

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [], read(spark, FOLDER, "documents")
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_columns(stages):
    assert [s.columns for s in stages[:-1]] == [COLUMNS] * 4


def test_toxic_rows_go(spark, stages):
    docs = read(spark, FOLDER, "documents")
    model = toxicity.fit(docs, read(spark, FOLDER, "labels").where(~held_out()))
    told = {r.doc_id for r in toxicity.apply(docs, model).where("predicted = 0").collect()}
    assert {r.doc_id for r in stages[0].collect()} == told and len(told) > 850


def test_one_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[0].collect()]
    want = {i for i, c in linked(before).items() if i == c}
    assert {r.doc_id for r in stages[1].collect()} == want


def test_secrets_go_and_rows_stay(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[1:3])
    assert before.keys() == after.keys()
    assert all(len(before[i]) == len(after[i]) for i in before)
    live = secret_scan.scan(stages[1]).collect()
    for r in live:
        for s in r.found:
            hidden = set(after[r.doc_id][s.start:s.end]) == {"*"}
            assert hidden or not s.live


def test_mix_and_ids(spark, stages):
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(r.doc_id for r in stages[4].collect())
    order = [r.doc_id for r in stages[4].orderBy("shard", "row").collect()]
    from foldwise.llm import mixing
    want = [r.doc_id for r in mixing.mix(stages[2]).orderBy("slot", "place").collect()]
    assert order == want


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == stages[4].columns
    assert {(r.doc_id, r.n_tokens) for r in got.collect()} == {(r.doc_id, r.n_tokens) for r in stages[4].collect()}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 11)]
