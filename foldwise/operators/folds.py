"""Evaluation folds: assignment, sizes and balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.config import FOLD_COLUMN, FoldSplit
from foldwise.functions.hashing import hash_below, hash_bucket
from foldwise.functions.names import q, qs
from foldwise.operators.ordering import running_totals
from foldwise.sources.settle import Settled, settle

#: Folds a single task may order when running totals are formed.
_ORDERED_IN_ONE_TASK = 1_000_000


def fold_key(split: FoldSplit, seed: int, row_id: Sequence[str]) -> Column:
    """The fold of a row as text: the key column, or a hash of the row id."""
    if split.key_column is not None:
        return q(split.key_column).cast("string").alias(FOLD_COLUMN)
    return hash_bucket(seed, split.folds, *qs(row_id)).cast("string").alias(FOLD_COLUMN)


def assign_folds(df: DataFrame, split: FoldSplit, seed: int, row_id: Sequence[str]) -> DataFrame:
    return df.withColumn(FOLD_COLUMN, fold_key(split, seed, row_id))


def holdout(seed: int, fraction: float, row_id: Sequence[str]) -> Column:
    """True for the rows held out for validation."""
    return hash_below(seed, fraction, *qs(row_id))


def fold_sizes(df: DataFrame) -> Settled:
    """Rows per fold. Partial aggregation leaves a row per fold and task to shuffle."""
    return settle(df.groupBy(FOLD_COLUMN).agg(F.count("*").alias("evaluation_rows")), "fold-sizes")


def fold_table(sizes: DataFrame) -> DataFrame:
    """Evaluation and train size of each fold; the train side is the complement."""
    n = sizes.agg(F.sum("evaluation_rows")).first()[0]
    return sizes.select(FOLD_COLUMN, (F.lit(n) - F.col("evaluation_rows")).alias("train_rows"),
                        "evaluation_rows")


def balance_label(gini: Column) -> Column:
    # Limits and names of the balance classes.
    return (F.when(gini.isNull() | F.isnan(gini), "unknown")
            .when(gini < 0, "unknown")
            .when(gini < 0.5, "relatively_balanced")
            .when(gini < 0.75, "moderately_imbalanced")
            .when(gini < 1.0, "highly_imbalanced")
            .otherwise("unknown"))


def fold_stats(sizes: DataFrame) -> DataFrame:
    """One row: number of folds, rows, Gini over fold ranks, its label, Gini over sizes.

    The rank Gini is half the mean absolute difference of the 0-based fold ranks
    over their mean. With C_t the rows of the first t folds and n rows in all it is
    sum C_t (n - C_t) / (n * sum (n - C_t)), so a running total over folds suffices.
    """
    n_folds, n = sizes.agg(F.count("*"), F.sum("evaluation_rows")).first()
    size, rows, k = F.col("evaluation_rows").cast("double"), F.lit(n), F.lit(float(n_folds))
    ordered = running_totals(sizes.withColumn("size", size), FOLD_COLUMN, "size", "upto",
                             n_folds, _ORDERED_IN_ONE_TASK)
    left = rows - F.col("upto")
    rank_gini = F.try_divide(F.sum(F.col("upto") * left), rows * F.sum(left))
    stats = ordered.agg(F.count("*").alias("folds"), F.sum("evaluation_rows").alias("rows"),
                        rank_gini.alias("gini"), F.lit(1).alias("_one"))
    # Folds of equal size are one group: sum of (2 i - k - 1) x_i over sorted items,
    # added up per group, is mass * (2 m_upto - m - k).
    by_size = (sizes.groupBy(size.alias("size")).agg(F.count("*").cast("double").alias("m"))
               .withColumn("mass", F.col("size") * F.col("m")))
    upto = running_totals(by_size, "size", "m", "m_upto", n_folds, _ORDERED_IN_ONE_TASK)
    spread = F.sum(F.col("mass") * (2 * F.col("m_upto") - F.col("m") - k))
    size_gini = upto.agg(F.try_divide(spread, k * F.sum("mass")).alias("fold_size_gini"),
                         F.lit(1).alias("_one"))
    return (stats.join(F.broadcast(size_gini), "_one")
            .select("folds", "rows", "gini", balance_label(F.col("gini")).alias("balance"),
                    "fold_size_gini"))
