import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (GBTRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import functions as F

from foldwise import DenseRegressor
from foldwise.config import FOLD_COLUMN, EarlyStopping, FoldSplit, Optimizer, TrainParams
from foldwise.errors import ConfigError
from foldwise.operators import baseline, cv, explain
from foldwise.operators.linear import LeastSquaresModel
from foldwise.operators.mlp import DenseRegressorModel, dropout_mask, initial_weights
from foldwise.operators.table import ModelTable

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame(rng.normal(size=(n, 3)), columns=list(FEATURES)).assign(
        row_id=np.arange(n), **{FOLD_COLUMN: rng.choice(["p", "q", "q"], n)})
    pdf["y"] = 3 * pdf["a"] - 2 * pdf["b"] + 1 + rng.normal(0, 0.1, n)
    return ModelTable(spark.createDataFrame(pdf).coalesce(1), FEATURES, ("row_id",))


def params(builder, **more):
    return TrainParams(builder, more.pop("epochs", 4), FoldSplit(key_column="k"), seed=1, **more)


def test_builder_guards(table):
    fitted = LinearRegression.__new__(LinearRegressionModel)
    for builder in (lambda n: None, lambda n: "model", lambda n: fitted):
        with pytest.raises(ConfigError):
            cv.build_estimator(params(builder), 3)
    with pytest.raises(ConfigError, match="cannot be trained"):
        cv.build_estimator(params(lambda n: RandomForestRegressor(), loss="mae"), 3)
    with pytest.raises(ConfigError, match="Optimizer"):
        cv.build_estimator(params(lambda n: GBTRegressor(), optimizer_builder=lambda: 1), 3)


def test_params_reach_the_estimator():
    tree = cv.build_estimator(params(lambda n: GBTRegressor(), loss="mae", epochs=7), 3)
    assert (tree.getMaxIter(), tree.getLossType(), tree.getSeed()) == (7, "absolute", 1)
    net = cv.build_estimator(params(lambda n: DenseRegressor(), loss="huber_loss",
                                    optimizer_builder=lambda: Optimizer("sgd", 0.5)), 3)
    assert (net._get("optimizer"), net.getStepSize(), net._get("loss")) == (
        "sgd", 0.5, "huber_loss")


def test_tree_cross_validation(table):
    result = cv.cross_validate(table, params(lambda n: GBTRegressor(maxDepth=2)), 2)
    rows = {r["fold"]: r for r in result.fold_results.collect()}
    assert set(rows) == {"p", "q"} and set(result.fold_results.columns) == set(cv.RESULT_COLUMNS)
    oof = result.oof.toPandas()
    assert sorted(oof["row_id"]) == list(range(400))
    for fold, part in oof.groupby("fold_key"):
        error = part["fold_model_y_pred"] - part["y_true"]
        assert rows[fold]["evaluation_mse"] == pytest.approx((error ** 2).mean())
    curves = cv.training_curves(result.history, result.guesses).toPandas()
    assert set(curves["group"]) == {"train", "guess (train mean)"}
    assert set(curves["epoch"]) == {1, 2, 3, 4}


def test_baseline_uses_the_other_folds(table):
    pdf = table.df.toPandas()
    for r in baseline.baseline_by_fold(table.df).collect():
        train = pdf[pdf[FOLD_COLUMN] != r[FOLD_COLUMN]]["y"]
        held = pdf[pdf[FOLD_COLUMN] == r[FOLD_COLUMN]]["y"]
        assert r["train_mean"] == pytest.approx(train.mean())
        assert r["baseline_mae"] == pytest.approx((held - train.mean()).abs().mean())


def net(n=3, **more):
    return DenseRegressor(hidden=[16], dropout=0.0, stepSize=0.01, **more)


def test_network_learns_and_stores(table, tmp_path):
    run = params(lambda n: net(), epochs=40, early_stopping=EarlyStopping(0.25, 3),
                 optimizer_builder=lambda: Optimizer("adam", 0.02))
    vectors = cv.training_vectors(table, run)
    model = cv.fit_model(run, vectors, 3)
    scored = model.transform(vectors)
    rmse = scored.agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    assert rmse < 1.0
    groups = {h[2] for h in model.history}
    assert groups == {"train", "validation"} and cv.epochs_of(model) <= 40
    model.save(str(tmp_path / "net"))
    again = DenseRegressorModel.load(str(tmp_path / "net"))
    a, b = (m.transform(vectors).orderBy("row_id").toPandas()["prediction"]
            for m in (model, again))
    np.testing.assert_allclose(a, b)


def test_network_averages_partitions(table):
    run = params(lambda n: net(), epochs=15, optimizer_builder=lambda: Optimizer("adam", 0.02))
    vectors = cv.training_vectors(table.over(lambda t: t.repartition(4, "row_id")), run)
    model = cv.fit_model(run, vectors, 3)
    values = [h[3] for h in model.history]
    assert values[-1] < values[0]


def shared_steps(**more):
    return DenseRegressor(synchronous=True, seed=5, **more)


def made_up(spark, partitions: int, n: int = 600):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3))
    rows = [(Vectors.dense(a), float(a @ [3.0, -2.0, 0.5] + 1 + a[0] * a[1])) for a in x]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(partitions)


def test_shared_steps_do_not_depend_on_partitions(spark):
    """Several steps an epoch, with dropout: same weights and losses for 1 and 7 partitions."""
    one, seven = (shared_steps(hidden=[12, 8], dropout=0.3, batchSize=100, maxIter=3)
                  .fit(made_up(spark, k)) for k in (1, 7))
    np.testing.assert_allclose(one.flat, seven.flat, atol=1e-6)
    np.testing.assert_allclose([h[3] for h in one.history], [h[3] for h in seven.history],
                               rtol=1e-6)


def test_shared_full_steps_are_gradient_descent(spark):
    data = made_up(spark, 3)
    model = shared_steps(hidden=[6], dropout=0.0, batchSize=10_000, maxIter=4, optimizer="sgd",
                         stepSize=0.05).fit(data)
    pdf = data.toPandas()
    x, y = np.stack([v.toArray() for v in pdf["features"]]), pdf["label"].to_numpy()
    flat = initial_weights([3, 6, 1], 5).astype(float)
    for epoch in range(4):
        w, b, v, c = flat[:18].reshape(3, 6), flat[18:24], flat[24:30], flat[30]
        h = np.maximum(x @ w + b, 0)
        away = h @ v + c - y
        assert model.history[epoch][3] == pytest.approx(np.mean(away ** 2))
        back = 2 * away[:, None] / len(y) * v * (h > 0)
        flat = flat - 0.05 * np.concatenate([(x.T @ back).ravel(), back.sum(0),
                                             2 * h.T @ away / len(y), [2 * away.mean()]])
    np.testing.assert_allclose(model.flat, flat, atol=1e-6)


def test_default_layers_take_shared_steps(spark):
    model = shared_steps(batchSize=400, maxIter=2).fit(made_up(spark, 2, 800))
    assert model.sizes == [3, 512, 1024, 1024, 1] and np.isfinite(model.flat).all()
    assert model.history[1][3] < model.history[0][3]


def test_dropout_mask_follows_from_the_key():
    keys = np.arange(-2000, 2000)
    mask = dropout_mask(keys, 50, 0.4, 9)
    assert set(np.unique(mask)) == {0.0, 1 / 0.6} and abs((mask == 0).mean() - 0.4) < 0.01
    np.testing.assert_array_equal(mask[7:9], dropout_mask(keys[7:9], 50, 0.4, 9))
    assert (mask != dropout_mask(keys, 50, 0.4, 10)).mean() > 0.4


def test_permutation_shapley_of_a_linear_model(table):
    """Exact for a linear model whatever the permutations: w * (x - background mean)."""
    weights = [3.0, -2.0, 0.5]
    model = LeastSquaresModel(1.0, weights)._set(featuresCol="_features")
    got = explain.permutation_shapley(model, table, seed=2, permutations=2, size=20).toPandas()
    pdf = table.df.toPandas().set_index("row_id")
    back = explain.sample_rows(table.df, ["row_id"], 20, 3).toPandas()
    assert got["row_id"].nunique() == 20 and len(got) == 60
    for r in got.itertuples():
        i = FEATURES.index(r.feature)
        want = weights[i] * (pdf.loc[r.row_id, r.feature] - back[r.feature].mean())
        assert r.phi == pytest.approx(want, abs=1e-9)


def test_sample_does_not_depend_on_the_shortcut(spark):
    df = spark.range(300_000)
    fast = explain.sample_rows(df, ["id"], 50, 9, rows=300_000)
    slow = explain.sample_rows(df, ["id"], 50, 9, rows=10)
    assert {r[0] for r in fast.collect()} == {r[0] for r in slow.collect()}
