import pytest

from foldwise.config import (EarlyStopping, FoldSplit, OneHotSettings, parse_features_config,
                             parse_train_params)
from foldwise.errors import ConfigError

FEATURES = {
    "target_column": "t",
    "features": [
        {"column": "a", "kind": "numeric"},
        {"column": "b", "kind": "categorical"},
        {"column": "c", "kind": "categorical", "one_hot_encoding_settings": {
            "min_significant_category_percentage_threshold": 1.5,
            "max_allowed_categories_count": 20,
            "allow_unknown_categories_during_inference": True}},
    ],
}
PARAMS = dict(model_builder=lambda n: None, epochs_count=25,
              evaluation_folds_split=dict(by_key_column="year"),
              early_stopping=dict(validation_set_fraction_size=0.2, tolerance_epochs_count=9),
              random_seed=42, silent_models_fitting=True, create_dataset_eda_reports=True)


def test_full_features_config():
    config = parse_features_config(FEATURES)
    assert config.columns == ("a", "b", "c")
    b, c = config.categorical
    assert (b.rare_below_pct, b.max_categories, b.allow_unknown) == (3.0, 15, False)
    assert (c.rare_below_pct, c.max_categories, c.allow_unknown) == (1.5, 20, True)
    assert parse_features_config(config.to_dict()) == config


def test_train_params_defaults():
    params = parse_train_params(PARAMS)
    assert (params.loss, params.metric) == ("mse", "rmse")
    assert params.fold_split == FoldSplit(key_column="year")
    assert params.early_stopping == EarlyStopping(0.2, 9)


def _feature(**more):
    return FEATURES | {"features": [{"column": "a", "kind": "numeric"} | more]}


@pytest.mark.parametrize("bad", [
    FEATURES | {"extra": 1},
    FEATURES | {"target_column": ""},
    FEATURES | {"target_column": "a"},
    FEATURES | {"features": []},
    FEATURES | {"features": FEATURES["features"][:1] * 2},
    {"target_column": "t"},
    _feature(column=""),
    _feature(column="y"),
    _feature(kind="date"),
    _feature(other=1),
    _feature(one_hot_encoding_settings={}),
    _feature(kind="categorical", one_hot_encoding_settings={
        "min_significant_category_percentage_threshold": 0}),
    _feature(kind="categorical", one_hot_encoding_settings={
        "min_significant_category_percentage_threshold": 100}),
    _feature(kind="categorical", one_hot_encoding_settings={"max_allowed_categories_count": 0}),
    _feature(kind="categorical", one_hot_encoding_settings={"unknown": 0}),
    "text",
])
def test_bad_features(bad):
    with pytest.raises(ConfigError, match="invalid") as error:
        parse_features_config(bad)
    assert error.value.__cause__ is not None


@pytest.mark.parametrize("change", [
    dict(evaluation_folds_split={}),
    dict(evaluation_folds_split=dict(by_key_column="k", by_folds_number=3)),
    dict(evaluation_folds_split=dict(by_folds_number=1)),
    dict(early_stopping=dict(validation_set_fraction_size=0.0, tolerance_epochs_count=1)),
    dict(early_stopping=dict(validation_set_fraction_size=1.0, tolerance_epochs_count=1)),
    dict(early_stopping=dict(validation_set_fraction_size=0.2, tolerance_epochs_count=0)),
    dict(loss_function="hinge"),
    dict(evaluation_metric="r2"),
    dict(model_builder=3),
    dict(epochs_count="many"),
    dict(random_seed="x"),
    dict(surprise=1),
])
def test_bad_params(change):
    with pytest.raises(ConfigError, match="invalid"):
        parse_train_params(PARAMS | change)


def test_explicit_zero_is_not_a_default():
    with pytest.raises(ConfigError):
        OneHotSettings(max_categories=0)
