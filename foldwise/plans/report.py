"""The tables behind each page of the run report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.config import FoldSplit
from foldwise.functions.metrics import DISPLAY_NAMES
from foldwise.functions.text import (context_text, count_text, fold_setup_text, funnel_text,
                                     mean_std_text, module_text, pct_text, shape_text)
from foldwise.operators.cv import summarise_folds

DISPLAY_PLACES = 3
GINI_FORMAT = "%.4f"


def entry(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))


def _page(df: DataFrame, entries: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.key", "e.value")


def _join(pages: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, pages)


def metric_entries(fold_results: DataFrame, metric: str) -> DataFrame:
    """Mean and deviation over folds of the main metric, as texts."""
    shown = DISPLAY_NAMES[metric]
    # Labels of the page, here and below.
    labels = {
        f"evaluation_{metric}": f"K fold model evaluation sets {shown}",
        f"train_{metric}": f"K fold model train sets {shown}",
        f"baseline_{metric}": f"guess (train set target mean) evaluation sets {shown}",
    }
    label = F.element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]),
                         F.col("measure"))
    return (summarise_folds(fold_results).where(F.col("measure").isin(*labels))
            .select(label.alias("key"), mean_std_text(F.col("mean"), F.col("std")).alias("value")))


def evaluation_page(fold_results: DataFrame, fold_stats: DataFrame, loss: str, metric: str,
                    split: FoldSplit) -> DataFrame:
    return _join([metric_entries(fold_results, metric), _page(fold_stats, [
        entry("loss function name", F.lit(DISPLAY_NAMES[loss])),
        entry("evaluation folds split setup", F.lit(fold_setup_text(split.key_column))),
        entry("evaluation folds count", F.col("folds")),
        entry("folds distribution GINI coefficient",
              F.coalesce(F.format_string(GINI_FORMAT, F.col("gini")), F.lit("nan"))),
    ])])


def summary_page(fold_results: DataFrame, fold_stats: DataFrame, metric: str, columns: int,
                 duration: str, warnings: str, seed: int | None) -> DataFrame:
    return _join([metric_entries(fold_results, metric), _page(fold_stats, [
        entry("preprocessed dataset size", shape_text(F.col("rows"), F.lit(columns))),
        entry("evaluation folds count", F.col("folds")),
        entry("pipeline execution duration", F.lit(duration)),
        entry("warnings raised", F.lit(warnings)),
        entry("global random seed", F.lit("not set" if seed is None else str(seed))),
    ])])


def preprocessing_page(funnel: DataFrame, columns: int, unused_columns: int) -> DataFrame:
    return _page(funnel, [
        entry("preprocessed dataset size", shape_text(F.col("rows_after"), F.lit(columns))),
        entry("unused dropped columns count", F.lit(unused_columns)),
        entry("imputation funnel", funnel_text(
            F.col("rows_before"), F.col("rows_after"), F.col("remaining_pct"))),
    ])


def category_page(final_distribution: DataFrame) -> DataFrame:
    """Frequency and percent text per final category, most frequent first."""
    return (final_distribution
            .select("feature", "category", F.col("count"), F.col("pct"),
                    pct_text(F.col("pct")).alias("frequency"))
            .orderBy("feature", F.desc("pct"), "category"))


def other_breakdown(distribution: DataFrame) -> DataFrame:
    """Categories folded into the shared bucket, with their share of it."""
    rare = distribution.where("is_rare")
    whole = rare.groupBy("feature").agg(F.sum("pct").alias("_other"))
    return (rare.join(F.broadcast(whole), "feature")
            .select("feature", "category", "count", "pct",
                    (F.try_divide(F.col("pct"), F.col("_other")) * 100)
                    .alias("share_of_other_pct")))


def fold_table(fold_results: DataFrame, loss: str, metric: str, key_column: str | None
               ) -> DataFrame:
    """One row per fold, in key order, numbers rounded for display."""
    loss_name, metric_name = DISPLAY_NAMES[loss], DISPLAY_NAMES[metric]
    # The labels of the table.
    key = "fold id (random split)" if key_column is None else f"fold key ({key_column})"
    sides = {"train": "train set model", "evaluation": "evaluation set model",
             "baseline": "guess evaluation set"}
    numbers = [F.round(F.col(f"{side}_{m}"), DISPLAY_PLACES).alias(label)
               for side, words in sides.items()
               for m, label in ((loss, f"{words} loss ({loss_name})"),
                                (metric, f"{words} {metric_name}"))]
    return fold_results.orderBy("fold").select(
        F.col("fold").alias(key), count_text(F.col("train_rows")).alias("train set size"),
        count_text(F.col("evaluation_rows")).alias("evaluation set size"),
        F.col("train_epochs").alias("train epochs count"), *numbers)


def warnings_page(warnings: DataFrame) -> DataFrame:
    return warnings.select(
        "rule", module_text(F.col("module")).alias("pipeline_module"), "description",
        context_text(F.col("context")).alias("context"))
