import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from foldwise.config import FOLD_COLUMN, FoldSplit, TrainParams
from foldwise.operators import cv, linear
from foldwise.operators.linear import fit_by_fold, moments
from foldwise.operators.table import ModelTable

FEATURES = ("x 1", "x.2", "c_a", "c_b")


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 600
    a = rng.integers(0, 2, n)
    pdf = pd.DataFrame({
        "row_id": np.arange(n), FOLD_COLUMN: rng.choice(["u", "v", "w", "hot", "hot"], n),
        "x 1": rng.normal(1e4, 3, n), "x.2": rng.normal(0, 1e-2, n), "c_a": a, "c_b": 1 - a})
    pdf["y"] = 2 * pdf["x 1"] - 40 * pdf["x.2"] + 5 * a + rng.normal(0, 1, n)
    return pdf


@pytest.fixture(scope="module")
def table(spark, frame):
    return ModelTable(spark.createDataFrame(frame), FEATURES, ("row_id",))


def expected(frame, fold):
    design = np.column_stack([np.ones(len(frame)), *[frame[c] for c in FEATURES]])
    train = (frame[FOLD_COLUMN] != fold).to_numpy()
    design[:, 1] -= 1e4  # condition
    coef = np.linalg.lstsq(design[train], frame["y"][train], rcond=None)[0]
    return design @ coef, train


@pytest.mark.parametrize("limit", [20, 0])
def test_moments_agree_with_numpy(spark, frame, table, limit):
    cols = [*FEATURES, "y"]
    shift = frame[cols].mean().to_numpy()
    for r in moments(table.df, cols, shift, max_sql_variables=limit).collect():
        z = frame.loc[frame[FOLD_COLUMN] == r[FOLD_COLUMN], cols].to_numpy() - shift
        n, s, g = linear.unpack(r["n"], r["s"], r["g"])
        assert n == len(z)
        np.testing.assert_allclose(s, z.sum(axis=0), atol=1e-6)
        np.testing.assert_allclose(g, z.T @ z, rtol=1e-9, atol=1e-6)


def test_cross_validation_equals_a_fit_per_fold(frame, table):
    result = cv.cross_validate_ols(table)
    oof = result.oof.toPandas().sort_values("row_id")
    assert list(oof["row_id"]) == list(frame["row_id"])
    for r in result.fold_results.collect():
        pred, train = expected(frame, r["fold"])
        error = pred - frame["y"].to_numpy()
        assert r["train_rows"] == train.sum()
        assert r["train_rmse"] == pytest.approx(np.sqrt(np.mean(error[train] ** 2)), rel=1e-8)
        assert r["train_mae"] == pytest.approx(np.mean(np.abs(error[train])), rel=1e-8)
        assert r["evaluation_rmse"] == pytest.approx(np.sqrt(np.mean(error[~train] ** 2)), rel=1e-8)
        assert r["evaluation_mae"] == pytest.approx(np.mean(np.abs(error[~train])), rel=1e-8)
        np.testing.assert_allclose(oof["fold_model_y_pred"][~train], pred[~train], rtol=1e-9)


def test_many_folds_take_several_passes(table, monkeypatch):
    whole = cv.cross_validate_ols(table).fold_results.orderBy("fold").toPandas()
    monkeypatch.setattr(cv, "_MODELS_PER_PASS", 2)
    monkeypatch.setattr(linear, "_LOCAL_MOMENTS", 1)
    split = cv.cross_validate_ols(table).fold_results.orderBy("fold").toPandas()
    pd.testing.assert_frame_equal(whole, split, check_exact=False, rtol=1e-9)


def test_fold_models_beyond_the_driver(table, monkeypatch):
    local = fit_by_fold(table.df, FEATURES)
    monkeypatch.setattr(linear, "_LOCAL_MOMENTS", 1)
    spread = fit_by_fold(table.df, FEATURES)
    assert local.local and not spread.local
    a, b = (t.df.orderBy("fold").toPandas() for t in (local, spread))
    np.testing.assert_allclose(np.stack(a["weights"]), np.stack(b["weights"]), rtol=1e-6)


def test_same_as_library_estimator(table):
    params = TrainParams(lambda n: LinearRegression(solver="normal"), 50,
                         FoldSplit(key_column="k"))
    wide = ModelTable(table.df, FEATURES[:3], table.row_id)
    closed = cv.cross_validate(wide, params).fold_results.orderBy("fold").toPandas()
    # Weighted fits do not take the closed form.
    weighted = TrainParams(lambda n: LinearRegression(solver="normal", weightCol="one"), 50,
                           FoldSplit(key_column="k"))
    vectors = cv.training_vectors(wide, weighted).withColumn("one", F.lit(1.0))
    model = cv.fit_model(weighted, vectors.where(F.col(FOLD_COLUMN) != "u"), 3)
    rmse = model.transform(vectors.where(F.col(FOLD_COLUMN) == "u")).agg(
        F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    assert closed.set_index("fold")["evaluation_rmse"]["u"] == pytest.approx(rmse, rel=1e-6)


def test_constant_feature_gets_no_weight(spark, frame):
    df = spark.createDataFrame(frame.assign(flat=1.0))
    _, weights, _ = linear.fit_all(df, ["x.2", "flat"])
    assert weights[1] == 0 and np.isfinite(weights).all()


def test_many_partial_sums_merge(spark):
    from foldwise.operators.linear import PARTIAL_SCHEMA, merge_partials
    rows = [("k" if i % 2 else None, 1, [float(i), 1.0], [1.0, float(i), 2.0]) for i in range(2000)]
    got = {r["by"]: r for r in merge_partials(spark.createDataFrame(rows, PARTIAL_SCHEMA)
                                              .repartition(40)).collect()}
    for key, odd in (("k", 1), (None, 0)):
        total = float(sum(range(odd, 2000, 2)))
        assert got[key]["n"] == 1000 and list(got[key]["s"]) == [total, 1000.0]
        assert list(got[key]["g"]) == [1000.0, total, 2000.0]
