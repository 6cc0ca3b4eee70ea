"""Tabular regression runs on Spark: prepare, evaluate, explain, profile and score."""

import sys

from pyspark import cloudpickle

from foldwise.config import (EarlyStopping, FeaturesConfig, FeatureSpec, FoldSplit,
                             OneHotSettings, Optimizer, TrainParams, parse_features_config,
                             parse_train_params)
from foldwise.errors import ConfigError, DataError, StoreError
from foldwise.operators.boosting import BoostedTreesRegressor
from foldwise.operators.mlp import DenseRegressor, default_regressor
from foldwise.plans.pipeline import Run, score, train_and_evaluate

# Functions that run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "BoostedTreesRegressor", "ConfigError", "DataError", "DenseRegressor", "EarlyStopping", "FeatureSpec",
    "FeaturesConfig", "FoldSplit", "OneHotSettings", "Optimizer", "Run", "StoreError",
    "TrainParams", "default_regressor", "parse_features_config", "parse_train_params", "score",
    "train_and_evaluate",
]
