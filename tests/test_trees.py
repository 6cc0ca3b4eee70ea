"""Boosting with shared scans and patience, and exact attribution of trees."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from foldwise import BoostedTreesRegressor
from foldwise.config import FOLD_COLUMN, EarlyStopping, FoldSplit, TrainParams
from foldwise.errors import DataError
from foldwise.operators import boosting, cv, explain, tree_paths
from foldwise.operators.boosting import BoostedTreesRegressorModel
from foldwise.operators.table import VECTOR_COLUMN, ModelTable, with_vector

FEATURES = ("a", "b b", "c", "d")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    n = 600
    pdf = pd.DataFrame(rng.integers(0, 12, (n, 4)).astype(float), columns=list(FEATURES)).assign(
        row_id=np.arange(n), **{FOLD_COLUMN: rng.choice(["p", "q", "r"], n)})
    pdf["y"] = pdf["a"] * (pdf["b b"] > 5) - 2 * pdf["c"] + rng.normal(0, 0.5, n)
    return ModelTable(spark.createDataFrame(pdf).repartition(3), FEATURES, ("row_id",))


def vectors(table):
    return with_vector(table.df, FEATURES).withColumn("held", F.col("row_id") % 5 == 0)


def fitted(estimator, table):
    names = dict(featuresCol=VECTOR_COLUMN, labelCol="y")
    return estimator._set(**names).fit(vectors(table))


def brute_force(weights, trees, x):
    """Shapley values by their definition."""
    d = len(x)

    def value(tree, known, node=0):
        f = int(tree.feature[node])
        if f < 0:
            return float(tree.value[node])
        left, right = int(tree.left[node]), int(tree.right[node])
        if f in known:
            return value(tree, known, left if x[f] <= tree.threshold[node] else right)
        return sum(tree.cover[c] / tree.cover[node] * value(tree, known, c) for c in (left, right))

    def worth(known):
        return sum(w * value(t, known) for w, t in zip(weights, trees))

    phi = np.zeros(d)
    for j in range(d):
        others = [k for k in range(d) if k != j]
        for size in range(d):
            for known in combinations(others, size):
                share = factorial(size) * factorial(d - size - 1) / factorial(d)
                phi[j] += share * (worth({*known, j}) - worth(set(known)))
    return phi


@pytest.mark.parametrize("estimator", [
    lambda: GBTRegressor(maxDepth=3, maxIter=4),
    lambda: RandomForestRegressor(maxDepth=4, numTrees=3, seed=1),
    lambda: DecisionTreeRegressor(maxDepth=5), lambda: BoostedTreesRegressor(maxDepth=4, maxIter=3)],
    ids=["boosted", "forest", "tree", "own"])
def test_attribution_is_shapley(table, estimator):
    model = fitted(estimator(), table)
    base, weights, trees = tree_paths.weighted_trees(model)
    phi = tree_paths.tree_attribution(model, table).toPandas().pivot(
        index="row_id", columns="feature", values="phi")[list(FEATURES)]
    assert len(phi) == 600
    rows = table.df.toPandas().set_index("row_id").loc[phi.index]
    for i in (0, 17, 400, 599):
        want = brute_force(weights, trees, rows.loc[i, list(FEATURES)].to_numpy())
        assert phi.loc[i].to_numpy() == pytest.approx(want, abs=1e-9)
    predicted = model.transform(vectors(table)).select("row_id", "prediction").toPandas().set_index("row_id")
    total = phi.sum(axis=1) + tree_paths.expectation(model)
    assert total.to_numpy() == pytest.approx(predicted.loc[phi.index, "prediction"].to_numpy(), abs=1e-9)
    ranked = {r["feature"]: r["importance"] for r in tree_paths.tree_importance(model, table).collect()}
    assert ranked == pytest.approx(phi.abs().mean().to_dict())
    assert ranked == pytest.approx({r["feature"]: r["importance"] for r in explain.importance(
        tree_paths.tree_attribution(model, table)).collect()})


def test_long_paths_without_a_table(monkeypatch):
    """The same shares whether patterns are worked out beforehand or as rows meet them."""
    rng = np.random.default_rng(3)
    d = 11
    path = lambda: tree_paths.Path(2.0, np.arange(d), np.zeros(d), rng.uniform(0.3, 1, d),
                                   np.linspace(0.1, 0.9, d))
    x = rng.uniform(0, 1, (200, d))
    one, two = path().prepared(), None
    monkeypatch.setattr(tree_paths, "_TABLE_FEATURES", 12)
    two = tree_paths.Path(one.value, one.features, one.low, one.high, one.share).prepared()
    phi = [np.zeros((200, d)) for _ in "ab"]
    one.add(x, phi[0])
    two.add(x, phi[1])
    assert one.table is None and two.table is not None
    np.testing.assert_allclose(*phi, atol=1e-12)
    met = ((x > one.low) & (x <= one.high)).astype(float)
    gap = 2.0 * np.where(met > 0, 1.0, 0.0).prod(axis=1) - 2.0 * one.share.prod()
    np.testing.assert_allclose(phi[0].sum(axis=1), gap, atol=1e-12)


def test_other_models_are_refused(table):
    with pytest.raises(DataError, match="not made of trees"):
        tree_paths.weighted_trees(object())


def plain_boost(x, y, held, rounds, depth, rate, bins, patience=None):
    """The same trees grown in memory, one at a time."""
    cuts = [np.unique(np.quantile(c, [i / bins for i in range(1, bins)], method="inverted_cdf")) for c in x.T]
    out, best, stale = np.full(len(y), y[~held].mean()), np.inf, 0
    errors = []
    for _ in range(rounds):
        r, todo, step = y - out, [(np.ones(len(y), bool), 0)], np.zeros(len(y))
        while todo:
            mine, level = todo.pop()
            train = mine & ~held
            gains = [(-1.0, 0, 0.0)]
            for f in range(x.shape[1]) if level < depth else ():
                for c in cuts[f]:
                    a, b = train & (x[:, f] <= c), train & (x[:, f] > c)
                    if a.any() and b.any():
                        gains.append((r[a].sum() ** 2 / a.sum() + r[b].sum() ** 2 / b.sum()
                                      - r[train].sum() ** 2 / train.sum(), -f, -c))
            gain, f, c = max(gains)
            if gain <= 1e-12 * max(1.0, r[train].sum() ** 2):
                step[mine] = r[train].mean()
            else:
                left = x[:, -f] <= -c
                todo += [(mine & left, level + 1), (mine & ~left, level + 1)]
        out = out + rate * step
        errors.append(((y - out)[held] ** 2).mean() if held.any() else np.nan)
        best, stale = (errors[-1], 0) if errors[-1] < best else (best, stale + 1)
        if patience and stale >= patience:
            break
    return out, errors


def test_boosting_equals_plain_boosting(table):
    model = fitted(BoostedTreesRegressor(maxDepth=3, maxIter=10, stepSize=0.3), table)
    got = model.transform(vectors(table)).toPandas().sort_values("row_id")
    x, y = got[list(FEATURES)].to_numpy(), got["y"].to_numpy()
    want, _ = plain_boost(x, y, np.zeros(len(y), bool), 10, 3, 0.3, 64)
    np.testing.assert_allclose(got["prediction"], want, atol=1e-8)
    assert len(model.trees) == 10 and model.trees[0].cover[0] == 600


def test_patience_stops_exactly(table):
    estimator = BoostedTreesRegressor(maxDepth=3, maxIter=60, stepSize=0.9, patience=3)
    model = fitted(estimator._set(validationIndicatorCol="held"), table)
    got = model.transform(vectors(table)).toPandas().sort_values("row_id")
    x, y, held = got[list(FEATURES)].to_numpy(), got["y"].to_numpy(), got["held"].to_numpy()
    want, errors = plain_boost(x, y, held, 60, 3, 0.9, 64, patience=3)
    shown = [v for _, _, group, v in model.history if group == "validation"]
    np.testing.assert_allclose(shown, errors, rtol=1e-9)
    assert len(model.trees) == len(errors) == int(np.argmin(errors)) + 1 + 3 < 60
    np.testing.assert_allclose(got["prediction"], want, atol=1e-8)


def test_folds_share_scans(spark, table, monkeypatch):
    """Models of a run equal those fitted apart, in the scans of one model."""
    scans = []
    merged = boosting.merge_partials
    monkeypatch.setattr(boosting, "merge_partials", lambda parts: scans.append(1) or merged(parts))
    estimator = BoostedTreesRegressor(maxDepth=2, maxIter=3)._set(featuresCol=VECTOR_COLUMN, labelCol="y")
    rows = vectors(table)
    together = boosting.grow(rows, estimator, ["p", "q", "r", None], FOLD_COLUMN)
    assert len(scans) <= 3 * 2 + 1
    for fold, model in zip(["p", "q", "r", None], together):
        own = rows.where(F.col(FOLD_COLUMN) != fold) if fold else rows
        x = np.stack(own.toPandas()[VECTOR_COLUMN].map(lambda v: v.toArray()))
        cuts = boosting.bin_cuts(rows.select(F.array(*[F.col(f"`{c}`") for c in FEATURES]).alias("x")), 4, 64)
        monkeypatch.setattr(boosting, "bin_cuts", lambda *a: cuts)
        alone = estimator.fit(own)
        assert [t.feature.tolist() for t in model.trees] == [t.feature.tolist() for t in alone.trees]
        for a, b in zip(model.trees, alone.trees):
            np.testing.assert_allclose(a.predict(x), b.predict(x), atol=1e-9)


@pytest.mark.parametrize("loss", ["rmse", "mae", "huber_loss"])
def test_cross_validation(table, loss):
    params = TrainParams(
        lambda n: BoostedTreesRegressor(maxDepth=2), 9, FoldSplit(key_column="k"), seed=1, loss=loss,
        early_stopping=EarlyStopping(0.2, 2))
    result = cv.cross_validate(table, params)
    rows = result.fold_results.collect()
    assert {r["fold"] for r in rows} == {"p", "q", "r"}
    assert all(r["evaluation_mse"] < r["baseline_mse"] for r in rows)
    assert result.oof.count() == 600
    history = result.history.toPandas()
    assert set(history["group"]) == {"train", "validation"}
    train = history[(history.group == "train") & (history.measure == loss) & (history.fold == "p")]
    assert train.sort_values("epoch")["value"].is_monotonic_decreasing


def test_store_and_edges(spark, table, tmp_path):
    model = fitted(BoostedTreesRegressor(maxDepth=2, maxIter=2), table)
    model.save(str(tmp_path / "m"))
    again = BoostedTreesRegressorModel.load(str(tmp_path / "m"))
    rows = vectors(table)
    assert again.transform(rows).exceptAll(model.transform(rows)).count() == 0
    flat = ModelTable(table.df.withColumn("y", F.lit(2.0)), FEATURES, ("row_id",))
    model = fitted(BoostedTreesRegressor(maxIter=2), flat)
    assert {r["prediction"] for r in model.transform(vectors(flat)).collect()} == {2.0}
    assert tree_paths.tree_attribution(model, flat).where("phi <> 0").count() == 0
    with pytest.raises(DataError, match="no row"):
        fitted(BoostedTreesRegressor(), ModelTable(table.df.where("false"), FEATURES, ("row_id",)))
    with pytest.raises(DataError, match="maxBins"):
        BoostedTreesRegressor(maxBins=300)


def test_lookup_equals_walk():
    """Leaves are read from tables by cell; deep trees, unused features and stumps included."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (500, 5)).astype(float)
    trees = [boosting.Tree(*(np.array(v) for v in ([-1], [0.0], [-1], [-1], [2.5], [500])))]
    for size in (3, 41, 160):
        nodes = [[-1, 0.0, -1, -1, rng.normal(), 1]]
        while len(nodes) < size:
            at = rng.choice([i for i, n in enumerate(nodes) if n[0] < 0])
            nodes[at][:4] = [int(rng.integers(0, 4)), float(rng.integers(0, 9)), len(nodes), len(nodes) + 1]
            nodes += [[-1, 0.0, -1, -1, rng.normal(), 1] for _ in range(2)]
        trees.append(boosting.Tree(*(np.array(c) for c in zip(*nodes))))
    binned, cells = boosting._binned_trees(trees, 5)
    weights = [0.5, 1.0, -2.0, 0.1]
    got = boosting.Lookup(binned, boosting._values(trees, weights), cells).add(np.zeros(500), cells.of(x))
    want = sum(w * t.predict(x) for w, t in zip(weights, trees))
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_rows_of_one_file_are_spread(spark, tmp_path, monkeypatch):
    """Packed rows are dealt to more than the one task that reads the file."""
    rows = spark.range(400000).selectExpr("id", "'p' AS fold", "array(pmod(id * 7, 50) * 1.0D) AS x",
                                         "rand(5) AS y").coalesce(1)
    rows.write.parquet(f"{tmp_path}/one")
    data = spark.read.parquet(f"{tmp_path}/one").select(array_to_vector("x").alias("features"), "y", "fold")
    files, write = [], boosting.Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(boosting.Scratch, "write", counted)
    estimator = BoostedTreesRegressor(maxDepth=1, maxIter=1)._set(labelCol="y")
    assert len(boosting.grow(data, estimator, [None])[0].trees) == 1
    assert files[0] > 1


def test_equal_cuts_take_the_first(table):
    """A copy of a feature never wins by the rounding of its sums."""
    twice = ModelTable(table.df.select("row_id", "y", "a", F.col("a").alias("a2")), ("a", "a2"), ("row_id",))
    data = with_vector(twice.df, twice.features)
    model = BoostedTreesRegressor(maxDepth=3, maxIter=4)._set(
        featuresCol=VECTOR_COLUMN, labelCol="y").fit(data)
    assert {int(f) for t in model.trees for f in t.feature} == {-1, 0}


def test_tables_of_trees_equal_paths(table):
    model = fitted(BoostedTreesRegressor(maxDepth=4, maxIter=3), table)
    _, weights, trees = tree_paths.weighted_trees(model)
    x = np.asfortranarray(table.df.toPandas()[list(FEATURES)].to_numpy())
    want, got = np.zeros(x.shape), np.zeros(x.shape)
    for path in tree_paths.paths(weights, trees)[1]:
        path.add(x, want)
    parts = tree_paths.explainers(weights, trees, 4)
    assert all(isinstance(p, tree_paths.TreeTable) for p in parts) and len(parts) == len(trees)
    for part in parts:
        part.add(x, got)
    np.testing.assert_allclose(got, want, atol=1e-12)


@pytest.mark.parametrize("stopping", [None, EarlyStopping(0.3, 2)], ids=["all", "held"])
def test_shared_judging_equals_one_by_one(table, stopping):
    """Errors, rounds and guesses of all fold models from shared scans."""
    params = TrainParams(estimator_builder=lambda n: GBTRegressor(maxDepth=2), epochs=3, seed=1,
                         fold_split=FoldSplit(key_column="f"), early_stopping=stopping)
    rows = cv.training_vectors(table, params)
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        models = [(f, cv.fit_model(params, rows.where(F.col(FOLD_COLUMN) != f), 4)) for f in "pq"]
        judged = cv._rounds_judged(rows, params, models)
    finally:
        rows.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    guesses = cv.guess_on_train_folds(rows, params, ["p", "q"])
    for fold, model in models:
        train, pdf = rows.where(F.col(FOLD_COLUMN) != fold), model.transform(rows).toPandas()
        (name, n_train, n_eval, _, *measures), history = judged[fold]
        away, inside = pdf["prediction"] - pdf["y"], pdf[FOLD_COLUMN] == fold
        assert (name, n_train, n_eval) == (fold, (~inside).sum(), inside.sum())
        assert measures[0] == pytest.approx((away[~inside] ** 2).mean())
        assert measures[4] == pytest.approx((away[inside] ** 2).mean())
        assert measures[6] == pytest.approx(away[inside].abs().mean())
        want = cv.fit_history(model, train, params)
        assert [h[:3] for h in history] == [h[:3] for h in want]
        assert [h[3] for h in history] == pytest.approx([h[3] for h in want])
        one = dict(cv.guess_on_train_rows(train, params))
        assert {m: v for f, m, v in guesses if f == fold} == pytest.approx(one)
