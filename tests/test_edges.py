"""Tables and settings at the edge: early stopping, empty tables, one fold, leftovers."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from foldwise import DataError, score, train_and_evaluate
from foldwise.config import FOLD_COLUMN, TARGET_COLUMN, EarlyStopping, Optimizer
from foldwise.operators import cv
from foldwise.operators.table import ModelTable
from foldwise.plans import bindings as b
from foldwise.sources import settle

NUMBERS = {"target_column": "y", "features": [{"column": "x", "kind": "numeric"}]}


def params(**more):
    return dict(model_builder=lambda n: LinearRegression(solver="normal"), epochs_count=2, random_seed=1,
                evaluation_folds_split=dict(by_key_column="k"), **more)


def rows(spark, n=60, keys=("a", "b", "c"), empty=False):
    return spark.createDataFrame(
        [(i, None if empty else float(i), 2.0 * i + i % 3, keys[i % len(keys)]) for i in range(n)],
        "id long, x double, y double, k string")


def leftovers(spark):
    folder = Path(settle.shared_folder(spark).removeprefix("file:"))
    return {p.name for p in folder.glob("foldwise-*")}


@pytest.mark.parametrize("builder", [lambda n: LinearRegression(solver="normal"),
                                     lambda n: RandomForestRegressor(numTrees=2, seed=1)])
def test_early_stopping_leaves_held_out_rows_alone(spark, builder):
    """Held-out rows with another slope must not show in the model."""
    run = b.BALANCE.params(builder, seed=3, early_stopping=EarlyStopping(0.5, 2))
    plain = spark.range(400).select(F.col("id").alias("row_id"), F.lit("k").alias(FOLD_COLUMN),
                                    (F.col("id") % 37).cast("double").alias("x"),
                                    F.lit(0.0).alias(TARGET_COLUMN))
    table = ModelTable(plain, ("x",), ("row_id",))
    held = cv.training_vectors(table, run)
    bent = held.withColumn(TARGET_COLUMN, F.when(F.col(cv.VALIDATION_COLUMN), F.lit(1e6))
                           .otherwise(F.col("row_id") % 37 * 3.0))
    model = cv.fit_model(run, bent, 1)
    guess = model.transform(bent).agg(F.max("prediction")).first()[0]
    assert guess < 120


def test_no_complete_row(spark, tmp_path):
    with pytest.raises(DataError, match="no row has a value"):
        train_and_evaluate(rows(spark, empty=True), NUMBERS, params(), str(tmp_path / "m"))


@pytest.mark.parametrize("builder", [lambda n: LinearRegression(), lambda n: RandomForestRegressor(numTrees=2)])
def test_one_fold(spark, tmp_path, builder):
    before = leftovers(spark)
    with pytest.raises(DataError, match="at least 2 folds"):
        train_and_evaluate(rows(spark, keys=("a",)), NUMBERS, params() | {"model_builder": builder},
                           str(tmp_path / "m"))
    assert leftovers(spark) == before
    assert not list((tmp_path / "m").rglob("report"))


def test_run_leaves_nothing_and_scores_empty_alike(spark, tmp_path):
    before = leftovers(spark)
    path = str(tmp_path / "m")
    run = train_and_evaluate(rows(spark), NUMBERS, params(), path, ["id"], explained_rows=7)
    assert leftovers(spark) == before
    assert run.tables["attribution"].count() == 7
    x = np.arange(60.0)
    want = abs(run.model.weights[0]) * np.abs(x - x.mean()).mean()
    assert run.tables["importance"].first()["importance"] == pytest.approx(want)
    empty = rows(spark).limit(0)
    for check in ("first", "inline"):
        with pytest.raises(DataError, match="empty"):
            score(empty, path, check=check)


def test_forest_run_leaves_nothing(spark, tmp_path):
    before = leftovers(spark)
    train_and_evaluate(rows(spark), NUMBERS, params(create_dataset_eda_reports=False) | {
        "model_builder": lambda n: RandomForestRegressor(numTrees=2, seed=1)}, str(tmp_path / "m"), ["id"])
    assert leftovers(spark) == before


def test_checkpoint_dir_by_call(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: f"file:{tmp_path}/called")
    assert settle.shared_folder(spark) == f"file:{tmp_path}/called"
    written = settle.write_table(spark.range(3), "x")
    assert written.count() == 3 and list(tmp_path.glob("called/foldwise-x-*"))


def test_inline_check_knows_many_rare_categories(spark, tmp_path):
    names = [f"c{i:04d}" for i in range(1500)]
    df = spark.createDataFrame(
        [(i, float(i), names[i] if i < 1500 else "often" if i % 2 else "more", "ab"[i % 2])
         for i in range(6000)], "id long, y double, c string, k string")
    config = {"target_column": "y", "features": [{"column": "c", "kind": "categorical"}]}
    path = str(tmp_path / "m")
    train_and_evaluate(df, config, params(create_dataset_eda_reports=False), path, ["id"])
    assert score(df, path, check="inline").count() == score(df, path).count() == 6000
    strange = df.withColumn("c", F.when(F.col("id") < 30, F.concat(F.lit("z"), "c")).otherwise(F.col("c")))
    with pytest.raises(DataError, match="30 categories"):
        score(strange, path)
    with pytest.raises(Exception, match="did not have when fitted"):
        score(strange, path, check="inline").collect()


def test_network_records_the_metric_and_ignores_row_order(spark):
    from foldwise import DenseRegressor
    run = b.BALANCE.params(lambda n: DenseRegressor(hidden=[8], dropout=0.0), seed=3,
                           epochs=15, early_stopping=EarlyStopping(0.25, 15), loss="mse", metric="mae",
                           optimizer_builder=lambda: Optimizer("adam", 0.02))
    plain = spark.range(600, numPartitions=1).select(
        F.col("id").alias("row_id"), F.lit("k").alias(FOLD_COLUMN),
        (F.col("id") / 300 - 1).alias("x"), (F.col("id") / 100).alias(TARGET_COLUMN))
    table = ModelTable(plain, ("x",), ("row_id",))
    model = cv.fit_model(run, cv.training_vectors(table, run), 1)
    kinds = {(m, g) for _, m, g, _ in model.history}
    assert kinds == {(m, g) for m in ("mse", "mae") for g in ("train", "validation")}
    last = {(m, g): v for _, m, g, v in model.history}
    assert last["mae", "validation"] < 0.5
    empty = cv.training_vectors(table, run).where("false")
    with pytest.raises(DataError, match="no row to train on"):
        cv.fit_model(run, empty, 1)
