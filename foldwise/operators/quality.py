"""Data-quality warnings: predicates over aggregates that exist already."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.config import FeatureSpec
from foldwise.functions.text import pct_text, short_number

# Limits of the rules.
MIN_REMAINING_PCT = 95
MAX_OTHER_PCT = 10
MIN_OWN_CATEGORIES = 2
MIN_FOLDS = 3
MAX_FOLDS = 30
BALANCED = "relatively_balanced"
PREPROCESSING = "dataset_preprocessing"
TRAINING = "model_training"


def _rule(df: DataFrame, rule: str, module: str, fires: Column, description: Column,
          **context: Column) -> DataFrame:
    # Context names carry a dot where the configuration has a nested setting.
    entries = [x for name, value in context.items()
               for x in (F.lit(name.replace("__", ".")), value.cast("string"))]
    pairs = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return df.where(fires).select(
        F.lit(rule).alias("rule"), F.lit(module).alias("module"),
        description.alias("description"), pairs.alias("context"))


def _setting(specs: Sequence[FeatureSpec], value) -> Column:
    return F.element_at(
        F.create_map(*[F.lit(x) for s in specs for x in (s.column, value(s))]), F.col("feature"))


def funnel_warnings(funnel: DataFrame) -> DataFrame:
    pct = F.col("remaining_pct")
    # Texts of the rules, here and below.
    return _rule(funnel, "W1", PREPROCESSING, pct < MIN_REMAINING_PCT, F.concat(
        F.lit("only "), pct_text(pct),
        F.lit(" of the train dataset rows remained after the imputation funnel")))


def encoding_warnings(summary: DataFrame, specs: Sequence[FeatureSpec]) -> DataFrame:
    feature = F.col("feature")
    limit = _setting(specs, lambda s: s.max_categories)
    near = _setting(specs, lambda s: ceil(s.max_categories * 2 / 3))
    threshold = _setting(specs, lambda s: s.rare_below_pct)
    return reduce(DataFrame.unionByName, [
        _rule(summary, "W2", PREPROCESSING, F.col("final_categories") >= near, F.concat(
            F.lit("the number of categories in this feature is "),
            F.col("final_categories").cast("string"),
            F.lit(", which is relatively high and approaches the limit defined for this feature")),
            feature_column=feature, feature__max_allowed_categories_count=limit),
        _rule(summary, "W3", PREPROCESSING, F.col("other_pct") > MAX_OTHER_PCT, F.concat(
            F.lit("the percentage of the 'others' category in this feature is "),
            pct_text(F.col("other_pct")), F.lit(", which is relatively high")),
            feature_column=feature),
        _rule(summary, "W4", PREPROCESSING, F.col("own_categories") < MIN_OWN_CATEGORIES, F.lit(
            "there is no diversity in the categories of this features, when counting out the "
            "'others' category. consider changing the value of "
            "min_significant_category_percentage_threshold defined for this feature."),
            feature_column=feature,
            feature__min_significant_category_percentage_threshold=short_number(threshold, 6)),
    ])


def fold_warnings(stats: DataFrame) -> DataFrame:
    folds = F.col("folds")
    return reduce(DataFrame.unionByName, [
        _rule(stats, "W5", TRAINING, folds < MIN_FOLDS,
              F.lit("the number of evaluation folds is low"), evaluation_folds_count=folds),
        _rule(stats, "W6", TRAINING, folds > MAX_FOLDS,
              F.lit("the number of evaluation folds is high"), evaluation_folds_count=folds),
        _rule(stats, "W7", TRAINING, F.col("balance") != BALANCED, F.lit(
            "the distribution of the evaluation folds is considered imbalanced "
            "according to the gini coefficient test"),
            folds_distribution_gini_coefficient=F.coalesce(
                F.format_string("%.4f", F.col("gini")), F.lit("nan")),
            distribution_balance=F.col("balance")),
    ])


def warnings_table(*tables: DataFrame | None) -> DataFrame:
    return reduce(DataFrame.unionByName, [t for t in tables if t is not None])
