import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from foldwise.operators import summaries
from foldwise import ConfigError, DataError, StoreError, score, train_and_evaluate
from foldwise.operators.table import Preparation
from foldwise.sources import store
from foldwise.sources.outputs import write
from foldwise.sources.tables import read_csv

FEATURES = {"target_column": "yield t/d", "features": [
    {"column": "depth", "kind": "numeric"}, {"column": "soil  code", "kind": "categorical"},
    {"column": "עומק", "kind": "numeric"}]}


def params(builder, **more):
    return dict(model_builder=builder, epochs_count=3, random_seed=1,
                evaluation_folds_split=dict(by_key_column="year"), **more)


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(4)
    n = 240
    pdf = pd.DataFrame({
        "yield t/d": rng.normal(10, 2, n), "depth": rng.normal(50, 9, n),
        "soil  code": rng.choice(["1", "2", "3"], n), "עומק": rng.normal(0, 1, n),
        "unused": "x", "year": rng.choice(["2003", "2004", "2005"], n)})
    pdf["yield t/d"] += pdf["depth"] * 0.3
    pdf.loc[:11, "soil  code"] = ""
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def finished(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("runs") / "linear")
    return path, train_and_evaluate(raw, FEATURES, params(lambda n: LinearRegression()), path)


def test_report_tables(finished):
    _, run = finished
    page = {r["key"]: r["value"] for r in run.tables["preprocessing_page"].collect()}
    assert page["imputation funnel"] == (
        "95.00% rows remained after the imputation funnel (before: 240 | after: 228)")
    assert page["unused dropped columns count"] == "1"
    assert page["preprocessed dataset size"] == "228 rows, 8 columns"
    assert run.tables["fold_table"].count() == 3
    assert run.tables["oof"].count() == 228
    assert run.tables["importance"].first()["feature"] == "depth"
    assert {"profile_input_overview", "profile_prepared_correlations"} <= set(run.tables)


def test_outputs_read_back(spark, finished):
    path, run = finished
    oof = read_csv(spark, f"{run.path}/oof_predictions", {
        "sample_id": str, "fold_key": str, "y_true": float, "fold_model_y_pred": float})
    assert oof.columns == ["sample_id", "fold_key", "y_true", "fold_model_y_pred"]
    assert oof.select("sample_id").distinct().count() == 228
    assert store.read_report(path, "fold_table").count() == 3


def test_score(raw, finished):
    path, run = finished
    rows = raw.where("`soil  code` <> ''").drop("yield t/d")
    scored = score(rows, path)
    assert scored.columns == [*rows.columns, "model_prediction"]
    pdf = scored.toPandas()
    assert len(pdf) == 228 and pdf["model_prediction"].notna().all()
    intercept, weights = run.model.intercept, run.model.weights
    names = run.preparation.output_columns
    by_hand = intercept + pdf["depth"] * weights[names.index("depth")] \
        + pdf["עומק"] * weights[names.index("עומק")] \
        + pdf["soil  code"].map(lambda c: weights[names.index(f"soil  code_OHE__{c}")])
    np.testing.assert_allclose(pdf["model_prediction"], by_hand)
    single = score(rows, path, check="inline")
    np.testing.assert_allclose(single.toPandas()["model_prediction"], pdf["model_prediction"])
    with pytest.raises(Exception, match="must not contain empty"):
        score(raw, path, check="inline").collect()
    with pytest.raises(Exception, match="did not have when fitted: 9"):
        score(rows.limit(1).withColumn("soil  code", F.lit("9")), path, check="inline").collect()
    with pytest.raises(DataError, match="soil  code"):
        score(raw, path)
    with pytest.raises(DataError, match="depth"):
        score(rows.drop("depth"), path)
    with pytest.raises(ConfigError):
        score(rows.withColumnRenamed("unused", "model_prediction"), path)


def test_failed_run_keeps_the_old_model(raw, finished):
    path, run = finished
    with pytest.raises(ConfigError):
        train_and_evaluate(raw, FEATURES, params(lambda n: None), path)
    assert store.current_run(path) == run.path


def test_new_run_replaces_the_old_one(raw, tmp_path):
    path = str(tmp_path / "trees")
    builder = lambda n: GBTRegressor(maxDepth=2)
    more = dict(create_dataset_eda_reports=False, loss_function="mae",
                early_stopping=dict(validation_set_fraction_size=0.3, tolerance_epochs_count=1))
    split = dict(evaluation_folds_split=dict(by_folds_number=3))
    train_and_evaluate(raw, FEATURES, params(lambda n: LinearRegression()) | dict(
        create_dataset_eda_reports=False), path)
    second = train_and_evaluate(raw, FEATURES, params(builder, **more) | split, path)
    assert store.current_run(path) == second.path
    assert not any(t.startswith("profile") for t in second.tables)
    groups = {r["group"] for r in second.tables["training_curves"].collect()}
    assert groups == {"train", "validation", "guess (train mean)"}
    assert score(raw.where("`soil  code` <> ''"), path).count() == 228


def test_store_guards(tmp_path, finished):
    with pytest.raises(StoreError):
        store.load_fitted(str(tmp_path / "nothing"))
    preparation: Preparation = finished[1].preparation
    with pytest.raises(StoreError, match="fitted"):
        store.save_fitted(str(tmp_path / "x"), None, preparation)


def test_input_guards(raw, tmp_path):
    with pytest.raises(DataError, match="empty"):
        train_and_evaluate(raw.limit(0), FEATURES, params(lambda n: LinearRegression()),
                           str(tmp_path))
    with pytest.raises(DataError, match="year"):
        train_and_evaluate(raw.drop("year"), FEATURES, params(lambda n: LinearRegression()),
                           str(tmp_path))


def test_csv_types(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, "007"), (None, None, "x")], "`k.1` string, v double, c string")
    write(df, str(tmp_path / "t"), "csv")
    got = read_csv(spark, str(tmp_path / "t"), {"v": float, "c": str})
    assert sorted(got.collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(ValueError, match="nope"):
        read_csv(spark, str(tmp_path / "t"), {"nope": str})
    with pytest.raises(ValueError, match="format"):
        write(df, str(tmp_path / "u"), "xml")


def test_a_run_can_keep_sketches(raw, tmp_path):
    run = train_and_evaluate(raw, FEATURES, params(lambda n: LinearRegression()) | dict(
        profile_values="sketched"), str(tmp_path / "sketched"))
    kept = run.tables["profile_input_distinct_sketches"]
    both = summaries.variables(summaries.merged_sketches([kept, kept]))
    one = {r["column"]: r for r in run.tables["profile_input_variables"].collect()}
    assert all(r["distinct"] == one[r["column"]]["distinct"]
               and r["count"] == 2 * one[r["column"]]["count"] for r in both.collect())
    assert run.tables["profile_input_top_values"].count() > 0
