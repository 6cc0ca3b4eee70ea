import pytest

from foldwise.config import parse_features_config
from foldwise.errors import DataError
from foldwise.operators import prepare

ROWS = [
    (0, 1.0, 2.0, "a", "x", "note"), (1, None, 2.0, "a", "x", "note"),
    (2, 1.0, None, "a", "x", "note"), (3, 1.0, float("nan"), "a", "x", "note"),
    (4, 1.0, 2.0, None, "x", "note"), (5, 1.0, 2.0, "", "x", "note"),
    (6, 1.0, 2.0, " ", "x", None), (7, 1.0, 2.0, "b", "x", ""), (8, 1.0, 2.0, "b", None, "note"),
]
CONFIG = parse_features_config({"target_column": "y0", "features": [
    {"column": "num", "kind": "numeric"}, {"column": "cat", "kind": "categorical"}]})


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        ROWS, "id bigint, y0 double, num double, cat string, fold string, unused string")


def test_required_columns_each_once():
    assert prepare.required_columns(CONFIG, "fold") == ["y0", "fold", "num", "cat"]
    assert prepare.required_columns(CONFIG, "cat") == ["y0", "cat", "num"]


def test_complete_cases(dirty):
    required = prepare.required_columns(CONFIG, "fold")
    kept = prepare.complete_cases(dirty, required).orderBy("id").collect()
    assert [r["id"] for r in kept] == [0, 6, 7]
    assert [r["unused"] for r in kept] == ["note", None, None]
    row = prepare.funnel(dirty, required).first()
    assert (row["rows_before"], row["rows_after"]) == (9, 3)
    assert row["remaining_pct"] == pytest.approx(100 / 3)
    assert prepare.unused_column_count(dirty, required) == 2


def test_filter_reaches_the_scan(spark, folder):
    df = spark.read.parquet(f"{folder}/orders.parquet")
    plan = prepare.complete_cases(df.select("o_totalprice", "o_orderpriority"),
                                  ["o_totalprice", "o_orderpriority"])
    text = plan._jdf.queryExecution().toString()
    assert "IsNotNull(o_orderpriority)" in text and "IsNotNull(o_totalprice)" in text


def test_guards(dirty, spark):
    with pytest.raises(DataError, match="nope"):
        prepare.check_columns(dirty, ["id", "nope"])
    with pytest.raises(DataError, match="empty"):
        prepare.check_not_empty(dirty.limit(0))
    with pytest.raises(DataError, match="ordered|expects"):
        prepare.check_model_schema(["b", "a"], ["a", "b"])
    wrong = spark.createDataFrame([(1.0, 2.0, 3)], "y0 double, num double, cat int")
    with pytest.raises(DataError, match="strings"):
        prepare.check_column_types(wrong, CONFIG)


def test_missing_by_column(dirty):
    got = {r["column"]: r["missing"] for r in
           prepare.missing_by_column(dirty, ["y0", "num", "cat", "fold"]).collect()}
    assert got == {"y0": 1, "num": 2, "cat": 2, "fold": 1}
