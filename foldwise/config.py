"""Declarative configuration: features of a table and parameters of a run.

The two ``parse_*`` functions take plain dicts; everything else in the package
takes the frozen records defined here.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import MISSING, dataclass, fields
from typing import Any

from foldwise.errors import ConfigError

# Defaults, reserved names and accepted keywords.
DEFAULT_RARE_BELOW_PCT = 3.0
DEFAULT_MAX_CATEGORIES = 15
DEFAULT_ALLOW_UNKNOWN = False
DEFAULT_LOSS = "mse"
DEFAULT_METRIC = "rmse"
OTHER_CATEGORY = "__other__"
TARGET_COLUMN = "y"
FOLD_COLUMN = "evaluation_folds_key"
METRIC_NAMES = ("mse", "rmse", "mae", "huber_loss")
NUMERIC = "numeric"
CATEGORICAL = "categorical"


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _is_int(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


@dataclass(frozen=True)
class OneHotSettings:
    """How one categorical feature is encoded; ``None`` means the default."""

    rare_below_pct: float | None = None
    max_categories: int | None = None
    allow_unknown: bool | None = None

    def __post_init__(self) -> None:
        pct, cap = self.rare_below_pct, self.max_categories
        _require(pct is None or (_is_number(pct) and 0 < pct < 100),
                 f"the rare-category threshold must lie between 0 and 100, got {pct!r}")
        _require(cap is None or (_is_int(cap) and cap > 0),
                 f"the category limit must be a positive integer, got {cap!r}")
        _require(self.allow_unknown is None or isinstance(self.allow_unknown, bool),
                 f"the unknown-category flag must be a boolean, got {self.allow_unknown!r}")


@dataclass(frozen=True)
class FeatureSpec:
    column: str
    kind: str
    one_hot: OneHotSettings | None = None

    def __post_init__(self) -> None:
        _require(isinstance(self.column, str) and self.column != "",
                 "a feature needs a non-empty column name")
        _require(self.kind in (NUMERIC, CATEGORICAL),
                 f"feature '{self.column}' has an unknown kind {self.kind!r}")
        _require(self.one_hot is None or self.kind == CATEGORICAL,
                 f"feature '{self.column}' is not categorical but has one-hot settings")

    def _setting(self, name: str, default: Any) -> Any:
        value = getattr(self.one_hot, name) if self.one_hot else None
        return default if value is None else value

    @property
    def rare_below_pct(self) -> float:
        return float(self._setting("rare_below_pct", DEFAULT_RARE_BELOW_PCT))

    @property
    def max_categories(self) -> int:
        return self._setting("max_categories", DEFAULT_MAX_CATEGORIES)

    @property
    def allow_unknown(self) -> bool:
        return self._setting("allow_unknown", DEFAULT_ALLOW_UNKNOWN)


@dataclass(frozen=True)
class FeaturesConfig:
    target: str
    features: tuple[FeatureSpec, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "features", tuple(self.features))
        _require(isinstance(self.target, str) and self.target != "",
                 "the target column needs a non-empty name")
        _require(len(self.features) > 0, "at least one feature is needed")
        repeated = [c for c, n in Counter(self.columns).items() if n > 1]
        _require(not repeated, f"features are defined more than once: {repeated}")
        _require(self.target not in self.columns,
                 f"the target '{self.target}' is also listed as a feature")
        reserved = {TARGET_COLUMN, FOLD_COLUMN} & set(self.columns)
        _require(not reserved, f"feature names clash with reserved columns: {sorted(reserved)}")

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.column for f in self.features)

    @property
    def numeric(self) -> tuple[FeatureSpec, ...]:
        return tuple(f for f in self.features if f.kind == NUMERIC)

    @property
    def categorical(self) -> tuple[FeatureSpec, ...]:
        return tuple(f for f in self.features if f.kind == CATEGORICAL)

    def to_dict(self) -> dict[str, Any]:
        """The dict form that :func:`parse_features_config` reads."""
        return {
            "target_column": self.target,
            "features": [
                {"column": f.column, "kind": f.kind}
                | ({} if f.one_hot is None else {"one_hot_encoding_settings": {
                    key: getattr(f.one_hot, field)
                    for key, field in _ONE_HOT_KEYS.items()
                    if getattr(f.one_hot, field) is not None
                }})
                for f in self.features
            ],
        }


@dataclass(frozen=True)
class EarlyStopping:
    validation_fraction: float
    patience: int

    def __post_init__(self) -> None:
        _require(_is_number(self.validation_fraction) and 0 < self.validation_fraction < 1,
                 "the validation fraction must lie strictly between 0 and 1")
        _require(_is_int(self.patience) and self.patience > 0,
                 "the early-stopping patience must be a positive integer")


@dataclass(frozen=True)
class FoldSplit:
    """Either a key column of the input or a number of hashed folds."""

    key_column: str | None = None
    folds: int | None = None

    def __post_init__(self) -> None:
        _require((self.key_column is None) != (self.folds is None),
                 "set exactly one of by_key_column and by_folds_number")
        _require(self.key_column is None
                 or (isinstance(self.key_column, str) and self.key_column != ""),
                 "the fold key needs a non-empty column name")
        _require(self.folds is None or (_is_int(self.folds) and self.folds >= 2),
                 "by_folds_number must be an integer of at least 2")


@dataclass(frozen=True)
class Optimizer:
    """Step rule of iterative learners; estimators take what they support."""

    name: str = "adam"
    learning_rate: float = 0.001

    def __post_init__(self) -> None:
        _require(self.name in ("adam", "sgd"), f"unknown optimizer {self.name!r}")
        _require(_is_number(self.learning_rate) and self.learning_rate > 0,
                 "the learning rate must be positive")


#: How a run's profile tells values apart: all are counted, or mergeable summaries are kept.
PROFILE_VALUES = ("counted", "sketched")


@dataclass(frozen=True)
class TrainParams:
    estimator_builder: Callable[[int], Any]
    epochs: int
    fold_split: FoldSplit
    optimizer_builder: Callable[[], Optimizer] = Optimizer
    loss: str = DEFAULT_LOSS
    metric: str = DEFAULT_METRIC
    early_stopping: EarlyStopping | None = None
    seed: int | None = None
    silent: bool = True
    profile: bool = True
    profile_values: str = "counted"

    def __post_init__(self) -> None:
        _require(callable(self.estimator_builder), "model_builder must be callable")
        _require(callable(self.optimizer_builder), "optimizer_builder must be callable")
        _require(_is_int(self.epochs) and self.epochs > 0,
                 "epochs_count must be a positive integer")
        _require(isinstance(self.fold_split, FoldSplit), "evaluation_folds_split is missing")
        for role, name in (("loss_function", self.loss), ("evaluation_metric", self.metric)):
            _require(name in METRIC_NAMES, f"{role} must be one of {METRIC_NAMES}, got {name!r}")
        _require(self.seed is None or _is_int(self.seed), "random_seed must be an integer")
        _require(self.profile_values in PROFILE_VALUES,
                 f"profile_values must be one of {PROFILE_VALUES}, got {self.profile_values!r}")

    @property
    def hash_seed(self) -> int:
        return 0 if self.seed is None else self.seed


# Keys of the dict form.
_ONE_HOT_KEYS = {
    "min_significant_category_percentage_threshold": "rare_below_pct",
    "max_allowed_categories_count": "max_categories",
    "allow_unknown_categories_during_inference": "allow_unknown",
}
_FEATURE_KEYS = {"column": "column", "kind": "kind", "one_hot_encoding_settings": "one_hot"}
_FEATURES_KEYS = {"target_column": "target", "features": "features"}
_EARLY_KEYS = {
    "validation_set_fraction_size": "validation_fraction",
    "tolerance_epochs_count": "patience",
}
_SPLIT_KEYS = {"by_key_column": "key_column", "by_folds_number": "folds"}
_PARAM_KEYS = {
    "model_builder": "estimator_builder",
    "optimizer_builder": "optimizer_builder",
    "loss_function": "loss",
    "evaluation_metric": "metric",
    "epochs_count": "epochs",
    "evaluation_folds_split": "fold_split",
    "early_stopping": "early_stopping",
    "random_seed": "seed",
    "silent_models_fitting": "silent",
    "create_dataset_eda_reports": "profile",
    "profile_values": "profile_values",
}


def _record(cls: type, keys: Mapping[str, str], raw: Any,
            nested: Mapping[str, Callable[[Any], Any]] | None = None) -> Any:
    """Build ``cls`` from a dict, refusing keys it does not know."""
    if isinstance(raw, cls):
        return raw
    _require(isinstance(raw, Mapping), f"{cls.__name__} must be given as a dict")
    unknown = set(raw) - set(keys)
    _require(not unknown, f"unknown keys for {cls.__name__}: {sorted(map(str, unknown))}")
    values = {keys[k]: v for k, v in raw.items()}
    for name, build in (nested or {}).items():
        if values.get(name) is not None:
            values[name] = build(values[name])
    missing = [
        key for key, name in keys.items()
        if name not in values and next(
            f for f in fields(cls) if f.name == name).default is MISSING
    ]
    _require(not missing, f"missing keys for {cls.__name__}: {missing}")
    return cls(**values)


def _feature(raw: Any) -> FeatureSpec:
    return _record(FeatureSpec, _FEATURE_KEYS, raw,
                   {"one_hot": lambda v: _record(OneHotSettings, _ONE_HOT_KEYS, v)})


def _features(raw: Any) -> tuple[FeatureSpec, ...]:
    _require(isinstance(raw, (list, tuple)), "features must be a list")
    return tuple(_feature(item) for item in raw)


def parse_features_config(raw: Mapping[str, Any] | FeaturesConfig) -> FeaturesConfig:
    try:
        return _record(FeaturesConfig, _FEATURES_KEYS, raw, {"features": _features})
    except (ConfigError, TypeError) as ex:
        raise ConfigError(f"the features config is invalid: {ex}") from ex


def parse_train_params(raw: Mapping[str, Any] | TrainParams) -> TrainParams:
    try:
        return _record(TrainParams, _PARAM_KEYS, raw, {
            "fold_split": lambda v: _record(FoldSplit, _SPLIT_KEYS, v),
            "early_stopping": lambda v: _record(EarlyStopping, _EARLY_KEYS, v),
        })
    except (ConfigError, TypeError) as ex:
        raise ConfigError(f"the train params are invalid: {ex}") from ex
