"""Least squares for every fold from one pass over the data.

Each fold contributes its moment matrix; the train side of a fold is the total
minus that fold, so k fits cost one scan. Rows never leave the executors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.config import FOLD_COLUMN, TARGET_COLUMN
from foldwise.functions.names import number, q, qs, quoted, total_sql
from foldwise.sources.settle import LOCAL_ROWS, Settled, settle, write_table

#: Up to this many variables the moments are SQL sums, beyond it NumPy products.
MAX_SQL_VARIABLES = 12
#: Moment entries the driver may hold to solve all folds itself.
_LOCAL_MOMENTS = 4_000_000
#: Keys whose sums a task holds before it passes them on.
_KEPT_KEYS = 64
_MERGE_GROUPS = 256
_RANK_TOLERANCE = 1e-9
PARTIAL_SCHEMA = "by string, n bigint, s array<double>, g array<double>"


def fold_sums(df: DataFrame, columns: Sequence[str]) -> Settled:
    """Rows and sums of the columns per fold, from one pass.

    Global means for :func:`moments` and train means for the baseline both follow.
    """
    sums = [F.sum(q(c).cast("double")) for c in columns]
    return settle(df.groupBy(q(FOLD_COLUMN)).agg(
        F.count("*").alias("n"), F.array(*sums).alias("sums")), "fold-sums")


def centre(sums: Settled, width: int) -> np.ndarray:
    """Global means, by which all moments are shifted against cancellation."""
    row = sums.df.agg(F.sum("n").alias("n"), *[
        F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]).first()
    return np.array([(row[f"s{i}"] or 0.0) / max(row["n"] or 0, 1) for i in range(width)])


def moments(df: DataFrame, columns: Sequence[str], shift: Sequence[float],
            by: str = FOLD_COLUMN, max_sql_variables: int = MAX_SQL_VARIABLES) -> DataFrame:
    """``(by, n, s, g)`` per group: rows, shifted sums and upper-triangle products."""
    if len(columns) <= max_sql_variables:
        return _moments_sql(df, columns, shift, by)
    return _moments_numpy(df, columns, shift, by)


def _moments_sql(df: DataFrame, columns: Sequence[str], shift: Sequence[float], by: str
                 ) -> DataFrame:
    # Generated as SQL text: hundreds of sums would be as many calls into the JVM.
    m = len(columns)
    upper = [(i, j) for i in range(m) for j in range(i, m)]
    z = df.selectExpr(f"{quoted(by)} AS by", *[
        f"CAST({quoted(c)} AS DOUBLE) - {number(shift[i])} AS z{i}"
        for i, c in enumerate(columns)])
    sums = z.groupBy("by").agg(
        F.count("*").alias("n"), *[F.expr(f"sum(z{i}) AS s{i}") for i in range(m)],
        *[F.expr(f"sum(z{i} * z{j}) AS g{i}_{j}") for i, j in upper])
    return sums.selectExpr(
        f"by AS {quoted(by)}", "n", f"array({', '.join(f's{i}' for i in range(m))}) AS s",
        f"array({', '.join(f'g{i}_{j}' for i, j in upper)}) AS g")


def _partial_moments(batches: Iterator[pd.DataFrame], shift: np.ndarray
                     ) -> Iterator[pd.DataFrame]:
    upper = np.triu_indices(len(shift))
    kept: dict[object, list] = {}

    def flush() -> pd.DataFrame:
        out = pd.DataFrame({
            "by": list(kept), "n": [v[0] for v in kept.values()],
            "s": [v[1] for v in kept.values()], "g": [v[2] for v in kept.values()]})
        kept.clear()
        return out

    for batch in batches:
        keys = batch["by"]
        values = batch.drop(columns="by").to_numpy(np.float64) - shift
        for key, at in keys.groupby(keys, dropna=False).indices.items():
            z = values[at]
            have = kept.setdefault(key, [0, np.zeros(len(shift)), np.zeros(len(upper[0]))])
            have[0] += len(z)
            have[1] += z.sum(axis=0)
            have[2] += (z.T @ z)[upper]
            if len(kept) >= _KEPT_KEYS:
                yield flush()
    if kept:
        yield flush()


def _merge_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add neighbouring rows of equal key; one sum is held at a time."""
    key, have = None, None
    for batch in batches:
        for by, n, s, g in zip(batch["by"], batch["n"], batch["s"], batch["g"]):
            if have is not None and by != key:
                yield pd.DataFrame({"by": [key], "n": [have[0]], "s": [have[1]], "g": [have[2]]})
                have = None
            if have is None:
                key, have = by, [0, np.zeros(len(s)), np.zeros(len(g))]
            have[0] += n
            have[1] += s
            have[2] += g
    if have is not None:
        yield pd.DataFrame({"by": [key], "n": [have[0]], "s": [have[1]], "g": [have[2]]})


def _moments_numpy(df: DataFrame, columns: Sequence[str], shift: Sequence[float], by: str
                   ) -> DataFrame:
    rows = df.select(q(by).cast("string").alias("by"), *[
        q(c).cast("double").alias(f"z{i}") for i, c in enumerate(columns)])
    parts = rows.mapInPandas(partial(_partial_moments, shift=np.asarray(shift)), PARTIAL_SCHEMA)
    return merge_partials(parts).withColumnRenamed("by", by)


def merge_partials(parts: DataFrame) -> DataFrame:
    """Add up partial sums of equal key from many tasks.

    Two steps, each adding sorted rows as they come: no task holds more than one sum and a
    batch, and a key's rows are first added in ``_MERGE_GROUPS`` tasks.
    """
    spread = F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS))
    for keys in (["by", "part"], ["by"]):
        parts = (parts.withColumn("part", spread).repartition(*keys)
                 .sortWithinPartitions("by").select("by", "n", "s", "g")
                 .mapInPandas(_merge_moments, PARTIAL_SCHEMA))
    return parts


def unpack(n: int, s: Sequence[float], g: Sequence[float]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row of :func:`moments` as count, sum vector and full symmetric matrix."""
    s = np.asarray(s, dtype=np.float64)
    full = np.zeros((len(s), len(s)))
    full[np.triu_indices(len(s))] = np.asarray(g, dtype=np.float64)
    return int(n), s, full + np.triu(full, 1).T


def solve(n: int, s: np.ndarray, g: np.ndarray, shift: np.ndarray
          ) -> tuple[float, np.ndarray, float]:
    """Least squares of the last variable on the others.

    A full one-hot block plus intercept is singular by design, so directions
    without variance get weight zero. Returns intercept, weights and the mean
    squared error on the rows the moments came from.
    """
    d = len(s) - 1
    if n == 0:
        return float("nan"), np.full(d, np.nan), float("nan")
    cov = g - np.outer(s, s) / n
    scale = np.sqrt(np.maximum(np.diag(cov)[:d], 0.0))
    live = scale > np.sqrt(_RANK_TOLERANCE * np.maximum(np.diag(g)[:d], 1e-300))
    safe = np.where(live, scale, 1.0)
    corr = np.where(np.outer(live, live), cov[:d, :d] / np.outer(safe, safe), 0.0)
    values, vectors = np.linalg.eigh(corr)
    keep = values > _RANK_TOLERANCE * max(values.max(initial=0.0), 1e-300)
    projected = vectors[:, keep].T @ np.where(live, cov[:d, d] / safe, 0.0)
    beta = np.where(live, (vectors[:, keep] @ (projected / values[keep])) / safe, 0.0)
    w = np.append(-beta, 1.0)
    sse = max(float(w @ cov @ w), 0.0)
    intercept = shift[d] + s[d] / n - beta @ (shift[:d] + s[:d] / n)
    return float(intercept), beta, sse / n


_COEF_SCHEMA = ("fold string, train_rows bigint, evaluation_rows bigint, intercept double, "
                "weights array<double>, train_mse double")


def _solve_rows(rows: pd.DataFrame, whole: tuple, shift: np.ndarray) -> pd.DataFrame:
    out = []
    for r in rows.itertuples(index=False):
        n, s, g = unpack(r.n, r.s, r.g)
        intercept, beta, mse = solve(whole[0] - n, whole[1] - s, whole[2] - g, shift)
        out.append((r.fold, whole[0] - n, n, intercept, beta.tolist(), mse))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _COEF_SCHEMA.split(", ")])


def fit_by_fold(df: DataFrame, features: Sequence[str], sums: Settled | None = None,
                max_sql_variables: int = MAX_SQL_VARIABLES) -> Settled:
    """One model per fold, fitted on all other folds.

    Columns: fold, train_rows, evaluation_rows, intercept, weights, train_mse.
    """
    columns = [*features, TARGET_COLUMN]
    shift = centre(sums or fold_sums(df, columns), len(columns))
    per_fold = moments(df, columns, shift, FOLD_COLUMN, max_sql_variables)
    kept = settle(per_fold.withColumnRenamed(FOLD_COLUMN, "fold"), "moments",
                  max(1, min(LOCAL_ROWS, _LOCAL_MOMENTS // len(columns) ** 2)))
    spark = df.sparkSession
    if kept.local:
        rows = kept.df.toPandas()
        whole = _whole(rows)
        solved = spark.createDataFrame(_solve_rows(rows, whole, shift), _COEF_SCHEMA)
        return Settled(solved.coalesce(1), True)
    whole = _whole(whole_moments(df, columns, shift, max_sql_variables))
    solver = partial(_solve_batches, whole=whole, shift=shift)
    return Settled(write_table(kept.df.mapInPandas(solver, _COEF_SCHEMA), "fold-models"), False)


def whole_moments(df: DataFrame, columns: Sequence[str], shift: Sequence[float],
                  max_sql_variables: int = MAX_SQL_VARIABLES) -> pd.DataFrame:
    """Moments of all rows, one row."""
    return moments(df.select(F.lit(1).alias("_all"), *qs(columns)), columns, shift, "_all",
                   max_sql_variables).toPandas()


def _whole(rows: pd.DataFrame) -> tuple:
    parts = [unpack(r.n, r.s, r.g) for r in rows.itertuples(index=False)]
    return tuple(sum(p[i] for p in parts) for i in range(3))


def _solve_batches(batches: Iterator[pd.DataFrame], whole: tuple, shift: np.ndarray
                   ) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _solve_rows(batch, whole, shift)


def fit_all(df: DataFrame, features: Sequence[str]) -> tuple[float, np.ndarray, list[float]]:
    """Model on all rows: intercept, weights and feature means."""
    columns = [*features, TARGET_COLUMN]
    shift = centre(fold_sums(df, columns), len(columns))
    intercept, beta, _ = solve(*_whole(whole_moments(df, columns, shift)), shift)
    return intercept, beta, list(shift[:-1])


def prediction_sql(intercept: float, weights: Sequence[float], features: Sequence[str]) -> str:
    """A fitted linear model as SQL text over the feature columns."""
    return total_sql([number(intercept), *[
        f"{quoted(c)} * {number(w)}" for c, w in zip(features, weights)]])


def linear_prediction(intercept: float, weights: Sequence[float], features: Sequence[str]
                      ) -> Column:
    """Prediction as one codegen expression over the feature columns."""
    return F.expr(prediction_sql(intercept, weights, features))


class LeastSquaresModel(Model, HasFeaturesCol, HasPredictionCol):
    """Closed-form least squares; predicts by one expression."""

    def __init__(self, intercept: float, weights: Sequence[float]):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self.intercept, self.weights = float(intercept), [float(w) for w in weights]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = [f"_x[{i}]" for i in range(len(self.weights))]
        terms = [f"{n} * {number(w)}" for n, w in zip(names, self.weights)]
        return (dataset.withColumn("_x", vector_to_array(q(self.getFeaturesCol())))
                .withColumn(self.getPredictionCol(),
                            F.expr(total_sql([number(self.intercept), *terms]))).drop("_x"))

    def save(self, path: str) -> None:
        text = json.dumps({"intercept": self.intercept, "weights": self.weights,
                           "columns": [self.getFeaturesCol(), self.getPredictionCol()]})
        (SparkSession.active().createDataFrame([(text,)], "value string")
         .coalesce(1).write.text(path))

    @classmethod
    def load(cls, path: str) -> LeastSquaresModel:
        kept = json.loads(SparkSession.active().read.text(path).first()[0])
        features, prediction = kept["columns"]
        return cls(kept["intercept"], kept["weights"])._set(
            featuresCol=features, predictionCol=prediction)


def fold_predictions(df: DataFrame, features: Sequence[str], models: Settled,
                     keep: Sequence[str]) -> DataFrame:
    """Every row predicted by the model that did not see its fold."""
    held = models.over(lambda t: t.select(
        F.col("fold").alias("_fold"), F.col("intercept").alias("_intercept"),
        F.col("weights").alias("_weights")))
    joined = df.join(held.joinable, q(FOLD_COLUMN) == F.col("_fold"))
    prediction = total_sql(["_intercept", *[
        f"{quoted(c)} * _weights[{i}]" for i, c in enumerate(features)]])
    return joined.select(*qs(keep), F.expr(prediction).alias("prediction"))
