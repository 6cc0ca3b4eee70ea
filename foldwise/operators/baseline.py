"""Predict-the-train-mean baseline per fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.config import FOLD_COLUMN, TARGET_COLUMN
from foldwise.functions.metrics import METRICS
from foldwise.functions.names import q
from foldwise.sources.settle import Settled, settle


def fold_target_sums(df: DataFrame) -> Settled:
    """Rows and target sum per fold: all that train means need."""
    return settle(df.groupBy(FOLD_COLUMN).agg(
        F.count("*").alias("n"), F.sum(TARGET_COLUMN).alias("y_sum")), "fold-sums")


def train_means(sums: Settled) -> Settled:
    """Mean target of all other folds, by subtraction instead of a join per fold."""
    n, y = sums.df.agg(F.sum("n"), F.sum("y_sum")).first()
    other_rows, other_y = F.lit(n) - F.col("n"), F.lit(y) - F.col("y_sum")
    return sums.over(lambda t: t.select(
        FOLD_COLUMN, F.col("n").alias("evaluation_rows"), other_rows.alias("train_rows"),
        F.try_divide(other_y, other_rows).alias("train_mean")))


def baseline_rows(df: DataFrame, means: Settled) -> DataFrame:
    """Evaluation rows with the mean of their fold's train side."""
    return df.join(means.joinable, FOLD_COLUMN)


def baseline_by_fold(df: DataFrame, means: Settled | None = None) -> DataFrame:
    """One row per fold: sizes, train mean and the baseline's error measures."""
    means = means or train_means(fold_target_sums(df))
    rows = baseline_rows(df.select(FOLD_COLUMN, TARGET_COLUMN), means)
    y, guess = q(TARGET_COLUMN), F.col("train_mean")
    # Partial aggregation comes before the shuffle, so a fold of any size is fine.
    return rows.groupBy(FOLD_COLUMN, "train_rows", "evaluation_rows", "train_mean").agg(
        *[build(y, guess).alias(f"baseline_{name}") for name, build in METRICS.items()])
