"""Cross-validation by fold key: fold results and out-of-fold rows."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.regression import GBTRegressionModel, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.config import FOLD_COLUMN, TARGET_COLUMN, Optimizer, TrainParams
from foldwise.errors import ConfigError, DataError
from foldwise.functions.metrics import METRICS, huber_sql
from foldwise.functions.names import q, qs, text_literal
from foldwise.functions.text import capped
from foldwise.operators import linear
from foldwise.operators.baseline import baseline_by_fold, train_means
from foldwise.operators.boosting import (BoostedTreesRegressor, BoostedTreesRegressorModel,
                                         fold_errors, grow)
from foldwise.operators.folds import fold_sizes, holdout
from foldwise.operators.table import VECTOR_COLUMN, ModelTable, with_vector
from foldwise.operators.tree_paths import weighted_trees
from foldwise.sources.settle import Settled, in_this_context, spread, write_table

PREDICTION = "prediction"
VALIDATION_COLUMN = "_validation"
_MODELS_PER_PASS = 32

# Loss keyword -> name the estimators of the library use for it.
_LINEAR_LOSSES = {"mse": "squaredError", "rmse": "squaredError", "huber_loss": "huber"}
_TREE_LOSSES = {"mse": "squared", "rmse": "squared", "mae": "absolute"}
_PLAIN_LOSSES = ("mse", "rmse")
_CURVE_LIMIT = 1.5
# Models whose rounds are judged from their trees.
_ROUNDS = (GBTRegressionModel, BoostedTreesRegressorModel)

HISTORY_SCHEMA = "fold string, epoch int, measure string, group string, value double"
GUESS_SCHEMA = "fold string, measure string, guess double"


@dataclass(frozen=True)
class CrossValidation:
    """Per-fold results, out-of-fold rows and the per-epoch history of the fits."""

    fold_results: DataFrame
    oof: DataFrame
    history: DataFrame | None = None
    guesses: DataFrame | None = None


# ---------------------------------------------------------------- estimators

def build_estimator(params: TrainParams, n_features: int) -> Estimator:
    """A fresh, untrained estimator set up for this run."""
    estimator = params.estimator_builder(n_features)
    if estimator is None:
        raise ConfigError("model_builder returned nothing")
    if isinstance(estimator, (Model, Transformer)):
        raise ConfigError("model_builder must return an estimator that is not fitted yet")
    if not isinstance(estimator, Estimator):
        raise ConfigError(f"model_builder must return an Estimator, got {type(estimator)}")
    optimizer = params.optimizer_builder()
    if not hasattr(optimizer, "learning_rate"):
        raise ConfigError("optimizer_builder must return an Optimizer")
    values = {"featuresCol": VECTOR_COLUMN, "labelCol": TARGET_COLUMN,
              "predictionCol": PREDICTION, "maxIter": params.epochs, "seed": params.seed}
    if estimator.hasParam("metric"):
        values["metric"] = params.metric
    if not estimator.hasParam("optimizer") and estimator.hasParam("stepSize"):
        # Trees have a default of their own; only an optimizer that was asked for changes it.
        if params.optimizer_builder is not Optimizer:
            values["stepSize"] = float(optimizer.learning_rate)
    elif estimator.hasParam("optimizer"):
        values |= {"optimizer": optimizer.name, "stepSize": float(optimizer.learning_rate)}
    if params.early_stopping is not None and estimator.hasParam("validationIndicatorCol"):
        values["validationIndicatorCol"] = VALIDATION_COLUMN
        values["patience"] = params.early_stopping.patience
    for name, value in values.items():
        if value is not None and estimator.hasParam(name):
            estimator.set(estimator.getParam(name), value)
    _set_loss(estimator, params.loss)
    return estimator


def _set_loss(estimator: Estimator, loss: str) -> None:
    if estimator.hasParam("lossType"):
        name, value = "lossType", _TREE_LOSSES.get(loss)
    elif isinstance(estimator, LinearRegression):
        name, value = "loss", _LINEAR_LOSSES.get(loss)
    elif estimator.hasParam("loss"):
        name, value = "loss", loss
    else:
        name, value = None, loss if loss in _PLAIN_LOSSES else None
    if value is None:
        raise ConfigError(f"{type(estimator).__name__} cannot be trained with loss '{loss}'")
    if name:
        estimator.set(estimator.getParam(name), value)


def fit_model(params: TrainParams, vectors: DataFrame, n_features: int) -> Model:
    """Fit on ``vectors``; rows held out for early stopping are never fitted on.

    An estimator that cannot watch held-out rows is fitted without them.
    """
    estimator = build_estimator(params, n_features)
    if VALIDATION_COLUMN in vectors.columns and not estimator.hasParam("validationIndicatorCol"):
        vectors = vectors.where(~F.col(VALIDATION_COLUMN))
    return estimator.fit(vectors)


def fit_final(table: ModelTable, params: TrainParams, vectors: DataFrame | None = None) -> Model:
    """The model of all rows; plain least squares in closed form, like its folds."""
    if takes_closed_form(table, params):
        intercept, weights, _ = linear.fit_all(table.df, table.features)
        return linear.LeastSquaresModel(intercept, weights)._set(
            featuresCol=VECTOR_COLUMN, predictionCol=PREDICTION)
    return fit_model(params, training_vectors(table, params) if vectors is None else vectors,
                     len(table.features))


def takes_closed_form(table: ModelTable, params: TrainParams) -> bool:
    return params.early_stopping is None and is_plain_least_squares(
        build_estimator(params, len(table.features)))


def is_plain_least_squares(estimator: Estimator) -> bool:
    """Whether the estimator's optimum is the closed form of the moment matrices."""
    return (isinstance(estimator, LinearRegression) and estimator.getRegParam() == 0
            and estimator.getLoss() == "squaredError" and estimator.getFitIntercept()
            and not estimator.isDefined(estimator.weightCol))


def epochs_of(model: Model) -> int:
    """Training rounds the fit took, as far as the model tells."""
    if hasattr(model, "history"):
        return len({h[0] for h in model.history})
    if getattr(model, "hasSummary", False):
        return max(1, int(model.summary.totalIterations))
    if isinstance(model, GBTRegressionModel):
        return int(model.getNumTrees)
    return 1


def fit_history(model: Model, vectors: DataFrame, params: TrainParams) -> list[tuple]:
    """``(epoch, measure, group, value)`` per round, where the model records rounds."""
    if hasattr(model, "history"):
        return list(model.history)
    if isinstance(model, GBTRegressionModel):
        sides = {"train": vectors}
        if VALIDATION_COLUMN in vectors.columns:
            sides = {"train": vectors.where(~F.col(VALIDATION_COLUMN)),
                     "validation": vectors.where(VALIDATION_COLUMN)}
        out = []
        for group, rows in sides.items():
            for measure in dict.fromkeys((params.loss, params.metric)):
                if measure not in _TREE_LOSSES:
                    continue
                curve = model.evaluateEachIteration(rows, _TREE_LOSSES[measure])
                out += [(i + 1, measure, group, v ** 0.5 if measure == "rmse" else v)
                        for i, v in enumerate(curve)]
        return out
    if getattr(model, "hasSummary", False):
        # The library reports the (scaled) training objective per iteration.
        return [(i + 1, "objective", "train", float(v))
                for i, v in enumerate(model.summary.objectiveHistory)]
    return []


def training_curves(history: DataFrame, guesses: DataFrame) -> DataFrame:
    """History with a guess line per fold and measure, and values kept for drawing.

    ``guesses`` is ``(fold, measure, guess)``; curves are cut at 1.5 times it.
    """
    epochs = history.select("fold", "epoch", "measure").distinct()
    guess_line = (epochs.join(F.broadcast(guesses), ["fold", "measure"]).select(
        "fold", "epoch", "measure", F.lit("guess (train mean)").alias("group"),
        F.col("guess").alias("value")))
    return (history.unionByName(guess_line)
            .join(F.broadcast(guesses), ["fold", "measure"], "left")
            .withColumn("capped_value", capped(
                F.col("value"), F.lit(0.0),
                F.coalesce(F.col("guess") * _CURVE_LIMIT, F.col("value"))))
            .select("fold", "epoch", "measure", "group", "value", "capped_value"))


# ---------------------------------------------------------------- fold results

SIDES = ("train", "evaluation", "baseline")
RESULT_COLUMNS = ("fold", "train_rows", "evaluation_rows", "train_epochs",
                  *(f"{side}_{m}" for side in SIDES for m in METRICS))


def check_folds(folds: int) -> None:
    """Every fold needs another one to be trained on."""
    if folds < 2:
        raise DataError(f"cross-validation needs at least 2 folds, the table has {folds}")


def oof_rows(scored: DataFrame, row_id: Sequence[str]) -> DataFrame:
    return scored.select(
        *qs(row_id), q(FOLD_COLUMN).alias("fold_key"), q(TARGET_COLUMN).alias("y_true"),
        q(PREDICTION).alias("fold_model_y_pred"))


def with_deviation(oof: DataFrame) -> DataFrame:
    return oof.withColumn("deviation", F.col("fold_model_y_pred") - F.col("y_true"))


def cross_validate_ols(table: ModelTable) -> CrossValidation:
    """Least squares: all folds from one fitting pass, no fit per fold.

    Four passes in all, whatever the number of folds up to 32: sums, moments, model
    errors, baseline errors.
    """
    columns = [*table.features, TARGET_COLUMN]
    sums = linear.fold_sums(table.df, columns)
    check_folds(sums.df.limit(2).count())
    models = linear.fit_by_fold(table.df, table.features, sums)
    means = train_means(sums.over(lambda t: t.select(
        FOLD_COLUMN, "n", F.col("sums")[len(columns) - 1].alias("y_sum"))))
    sizes = models.df.select("fold", "train_rows", "evaluation_rows",
                             F.lit(1).alias("train_epochs"))
    results = (sizes.join(ols_errors(table, models), "fold")
               .join(_baseline(table, means), "fold").select(*RESULT_COLUMNS))
    scored = linear.fold_predictions(table.df, table.features, models,
                                     [*table.row_id, FOLD_COLUMN, TARGET_COLUMN])
    return CrossValidation(results, oof_rows(scored, table.row_id))


def _baseline(table: ModelTable, means: Settled | None = None) -> DataFrame:
    return (baseline_by_fold(table.df, means).withColumnRenamed(FOLD_COLUMN, "fold")
            .drop("train_rows", "evaluation_rows", "train_mean"))


def ols_errors(table: ModelTable, models: Settled) -> DataFrame:
    """Errors of each fold model on its train rows and on its evaluation rows.

    A pass applies up to 32 models to every row and sums the errors per fold of the
    row, so rows are never multiplied and both sides come from the same sums.
    """
    parts, chunk = [], []

    def flush() -> None:
        # As SQL text, since the expressions are many.
        away = table.df.selectExpr(f"{FOLD_COLUMN} AS row_fold", *[
            f"{linear.prediction_sql(m['intercept'], m['weights'], table.features)}"
            f" - {TARGET_COLUMN} AS e{i}" for i, m in enumerate(chunk)])
        sums = [F.expr(sql) for i in range(len(chunk)) for sql in (
            f"sum(e{i} * e{i}) AS sq{i}", f"sum(abs(e{i})) AS ab{i}",
            f"sum({huber_sql(f'e{i}')}) AS hu{i}")]
        models_of_pass = ", ".join(
            f"named_struct('fold', {text_literal(m['fold'])}, 'sq', sq{i}, 'ab', ab{i}, "
            f"'hu', hu{i})" for i, m in enumerate(chunk))
        parts.append(away.groupBy("row_fold").agg(F.count("*").alias("n"), *sums)
                     .selectExpr("row_fold", "n", f"inline(array({models_of_pass}))"))
        chunk.clear()

    for model in models.df.toLocalIterator():
        chunk.append(model)
        if len(chunk) == _MODELS_PER_PASS:
            flush()
    if chunk:
        flush()
    inside = F.col("row_fold") == F.col("fold")

    def side(name: str, rows: Column) -> list[Column]:
        total = lambda e: F.sum(F.when(rows, F.col(e)))
        n = total("n")
        return [F.try_divide(total("sq"), n).alias(f"{name}_mse"),
                F.sqrt(F.try_divide(total("sq"), n)).alias(f"{name}_rmse"),
                F.try_divide(total("ab"), n).alias(f"{name}_mae"),
                F.try_divide(total("hu"), n).alias(f"{name}_huber_loss")]

    return reduce(DataFrame.unionByName, parts).groupBy("fold").agg(
        *side("train", ~inside), *side("evaluation", inside))


def cross_validate(table: ModelTable, params: TrainParams, parallel_fits: int = 4
                   ) -> CrossValidation:
    """One fresh model per fold, trained on all other folds.

    Plain least squares takes the one-pass route. The models of ``BoostedTreesRegressor`` grow
    together, a scan serving all folds. Any other estimator is fitted per fold; fits run side
    by side. Boosted trees, ours and Spark's, are judged together in one scan, round by round
    where the fit kept no history; any other model's errors on both sides come from one pass
    over its predictions. The guess lines of all folds take two scans.
    """
    if takes_closed_form(table, params):
        return cross_validate_ols(table)
    spark = table.df.sparkSession
    estimator, together = build_estimator(params, len(table.features)), {}
    # Written once: k fits of many rounds then read it, and nothing before it. Spark's own trees
    # draw their cuts from a sample by task, so only rows for ours are dealt anew.
    vectors = training_vectors(table, params)
    vectors = write_table(spread(vectors) if isinstance(estimator, BoostedTreesRegressor)
                          else vectors, "vectors")
    sizes = fold_sizes(vectors)
    check_folds(sizes.df.limit(2).count())
    folds = [r[0] for r in sizes.df.select(FOLD_COLUMN).orderBy(FOLD_COLUMN).toLocalIterator()]
    if isinstance(estimator, BoostedTreesRegressor):
        together = dict(zip(folds, grow(vectors, estimator, folds, FOLD_COLUMN)))

    def run(fold: str) -> tuple:
        train = vectors.where(q(FOLD_COLUMN) != fold)
        model = together.get(fold) or fit_model(params, train, len(table.features))
        inside = q(FOLD_COLUMN) == fold
        oof = oof_rows(model.transform(vectors.where(inside)), table.row_id)
        if isinstance(model, _ROUNDS):
            return fold, model, oof, None, None
        errors = {r["inside"]: r for r in model.transform(vectors).groupBy(inside.alias("inside"))
                  .agg(F.count("*").alias("n"), *[b(q(TARGET_COLUMN), q(PREDICTION)).alias(m)
                                                  for m, b in METRICS.items()]).collect()}
        result = (fold, errors[False]["n"], errors[True]["n"], epochs_of(model),
                  *[errors[False][m] for m in METRICS], *[errors[True][m] for m in METRICS])
        return fold, model, oof, result, fit_history(model, train, params)

    with ThreadPoolExecutor(max_workers=parallel_fits) as pool:
        done = list(pool.map(in_this_context(inheritable_thread_target(spark)(run)), folds))
    judged = {fold: found for at in range(0, len(done), _MODELS_PER_PASS)
              for fold, found in _rounds_judged(vectors, params, [
                  d[:2] for d in done[at:at + _MODELS_PER_PASS] if d[3] is None]).items()}
    found = [judged.get(d[0]) or d[3:] for d in done]
    schema = ("fold string, train_rows bigint, evaluation_rows bigint, train_epochs int, "
              + ", ".join(f"{side}_{m} double" for side in ("train", "evaluation")
                          for m in METRICS))
    results = spark.createDataFrame([r for r, _ in found], schema)
    history = spark.createDataFrame(
        [(r[0], *h) for r, rounds in found for h in rounds], HISTORY_SCHEMA)
    guesses = spark.createDataFrame(
        guess_on_train_folds(vectors, params, [r[0] for r, rounds in found if rounds]), GUESS_SCHEMA)
    return CrossValidation(results.join(_baseline(table), "fold"),
                           reduce(DataFrame.unionByName, [d[2] for d in done]), history, guesses)


def _means(sums: Sequence[float]) -> list[float]:
    """Measures in the order of ``METRICS`` from rows and error sums."""
    n, sq, ab, hu = (float(v) for v in sums)
    if not n:
        return [float("nan")] * len(METRICS)
    return [sq / n, (sq / n) ** 0.5, ab / n, hu / n]


def _rounds_judged(vectors: DataFrame, params: TrainParams, models: Sequence[tuple]
                   ) -> dict[str, tuple]:
    """``(result, history)`` per fold of ``(fold, model)``, models of boosted trees, in one scan."""
    if not models:
        return {}
    forests = [weighted_trees(m) for _, m in models]
    held = VALIDATION_COLUMN in vectors.columns
    sums = fold_errors(vectors, forests, [f for f, _ in models], FOLD_COLUMN, VECTOR_COLUMN,
                       TARGET_COLUMN, VALIDATION_COLUMN if held else None,
                       every_round=any(not hasattr(m, "history") for _, m in models))
    out, names = {}, list(METRICS)
    for (fold, model), (_, _, trees) in zip(models, forests):
        last = sums[fold, len(trees)]
        train, evaluation = last[0] + last[1], last[2]
        result = (fold, int(train[0]), int(evaluation[0]), epochs_of(model),
                  *_means(train), *_means(evaluation))
        if hasattr(model, "history"):
            out[fold] = result, list(model.history)
            continue
        # As the library's own evaluation of each iteration: measures of its tree losses only.
        out[fold] = result, [
            (i, measure, group, _means(sums[fold, i][side])[names.index(measure)])
            for side, group in enumerate(("train", "validation")[:1 + held])
            for measure in dict.fromkeys((params.loss, params.metric)) if measure in _TREE_LOSSES
            for i in range(1, len(trees) + 1)]
    return out


def _validation(params: TrainParams, row_id: Sequence[str]) -> list[Column]:
    if params.early_stopping is None:
        return []
    # Another seed than the fold hash, so that hold-out and folds are independent.
    return [holdout(params.hash_seed + 1, params.early_stopping.validation_fraction, row_id)
            .alias(VALIDATION_COLUMN)]


def training_vectors(table: ModelTable, params: TrainParams) -> DataFrame:
    """All rows as vectors, with the hold-out flag when early stopping is on."""
    return with_vector(table.df, table.features).select(
        *qs(table.row_id), TARGET_COLUMN, FOLD_COLUMN, VECTOR_COLUMN,
        *_validation(params, table.row_id))


def guess_on_train_rows(rows: DataFrame, params: TrainParams) -> list[tuple[str, float]]:
    """``(measure, error)`` of guessing the mean, on the rows a model was fitted on.

    With early stopping the mean comes from the train part and the error from the
    held-out part, otherwise both come from all rows.
    """
    held = VALIDATION_COLUMN in rows.columns
    seen = rows.where(~F.col(VALIDATION_COLUMN)) if held else rows
    judged = rows.where(VALIDATION_COLUMN) if held else rows
    mean = F.lit(seen.agg(F.avg(TARGET_COLUMN)).first()[0]).cast("double")
    measures = list(dict.fromkeys((params.loss, params.metric)))
    errors = judged.agg(*[METRICS[m](q(TARGET_COLUMN), mean).alias(m) for m in measures]).first()
    return [(m, errors[m]) for m in measures]


def guess_on_train_folds(rows: DataFrame, params: TrainParams, folds: Sequence[str]
                         ) -> list[tuple[str, str, float]]:
    """``(fold, measure, error)`` as :func:`guess_on_train_rows` gives it on the rows outside of
    each fold; a mean and an error scan serve up to 32 folds."""
    held = q(VALIDATION_COLUMN) if VALIDATION_COLUMN in rows.columns else None
    measures, out = list(dict.fromkeys((params.loss, params.metric))), []
    for at in range(0, len(folds), _MODELS_PER_PASS):
        part = folds[at:at + _MODELS_PER_PASS]
        train = [q(FOLD_COLUMN) != f for f in part]
        seen = [t if held is None else t & ~held for t in train]
        judged = [F.when(t if held is None else t & held, q(TARGET_COLUMN)) for t in train]
        means = rows.agg(*[F.avg(F.when(s, q(TARGET_COLUMN))).alias(f"m{i}")
                           for i, s in enumerate(seen)]).first()
        errors = rows.agg(*[METRICS[m](y, F.lit(means[i]).cast("double")).alias(f"{m}{i}")
                            for i, y in enumerate(judged) for m in measures]).first()
        out += [(f, m, errors[f"{m}{i}"]) for i, f in enumerate(part) for m in measures]
    return out


def summarise_folds(fold_results: DataFrame) -> DataFrame:
    """Mean and population deviation over folds, each fold weighing the same."""
    measures = [f"{side}_{m}" for side in ("evaluation", "train", "baseline") for m in METRICS]
    measures = [m for m in measures if m in fold_results.columns]
    wide = fold_results.agg(*[x for i, m in enumerate(measures) for x in (
        F.avg(m).alias(f"m{i}"), F.stddev_pop(m).alias(f"s{i}"))])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"m{i}").alias("mean"),
                 F.col(f"s{i}").alias("std")) for i, m in enumerate(measures)])).alias("r")
    ).select("r.*")

