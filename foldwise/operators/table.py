"""The prepared model table: one row per sample, features as plain columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.config import (FOLD_COLUMN, TARGET_COLUMN, FeaturesConfig, FoldSplit, TrainParams)
from foldwise.errors import DataError
from foldwise.functions.names import q, qs
from foldwise.operators.encode import Encoder, FeatureEncoding, fit_encoder
from foldwise.operators.folds import fold_key
from foldwise.operators.prepare import (check_column_types, check_columns, check_model_schema,
                                        complete_cases, is_missing, numeric_features,
                                        required_columns)

VECTOR_COLUMN = "_features"
ROW_ID_COLUMN = "row_id"
#: Offending categories an error names; it states how many there are.
NAMED = 20


@dataclass(frozen=True)
class ModelTable:
    """``df`` holds the row id, ``y``, the fold key and the features, in that order."""

    df: DataFrame
    features: tuple[str, ...]
    row_id: tuple[str, ...]

    def over(self, step) -> ModelTable:
        return ModelTable(step(self.df), self.features, self.row_id)

    @property
    def full_dataset(self) -> DataFrame:
        """``y``, fold key and features, without the row id."""
        return self.df.select(TARGET_COLUMN, FOLD_COLUMN, *qs(self.features))


def with_vector(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the features as one vector column, whatever characters their names hold."""
    return df.withColumn(
        VECTOR_COLUMN, array_to_vector(F.array(*[q(c).cast("double") for c in features])))


@dataclass(frozen=True)
class Preparation:
    """Fitted preparation; training and scoring share its expressions."""

    config: FeaturesConfig
    encoder: Encoder

    @property
    def output_columns(self) -> list[str]:
        """Numeric features, then the indicators of each category, in config order."""
        return [s.column for s in self.config.numeric] + self.encoder.output_columns

    def feature_columns(self):
        return [*numeric_features(self.config), *self.encoder.columns()]

    def train_table(self, clean: DataFrame, split: FoldSplit, seed: int,
                    row_id: Sequence[str]) -> ModelTable:
        """Project complete cases to the model table; one select, no shuffle."""
        ids = [q(c).alias(f"{ROW_ID_COLUMN}{i or ''}") for i, c in enumerate(row_id)]
        names = tuple(f"{ROW_ID_COLUMN}{i or ''}" for i in range(len(row_id)))
        df = clean.select(
            *ids, q(self.config.target).cast("double").alias(TARGET_COLUMN),
            fold_key(split, seed, row_id), *self.feature_columns())
        return ModelTable(df, tuple(self.output_columns), names)

    def check_scoring_table(self, df: DataFrame) -> None:
        """Refuse a table that is empty, incomplete or holds disallowed categories.

        One pass counts everything; names of unknown categories are looked up only
        when a value without an own column was seen.
        """
        check_columns(df, self.config.columns)
        check_column_types(df, self.config)
        strict = [e for e in self.encoder.encodings if not e.allow_unknown]
        columns = list(self.config.columns)
        counts = df.agg(
            F.count("*").alias("rows"),
            *[F.count(F.when(is_missing(df, c), True)).alias(f"m{i}")
              for i, c in enumerate(columns)],
            *[F.count(F.when(~e.is_own & q(e.feature).isNotNull(), True)).alias(f"s{i}")
              for i, e in enumerate(strict)]).first()
        if not counts["rows"]:
            raise DataError("the table is empty")
        empty = [c for i, c in enumerate(columns) if counts[f"m{i}"]]
        if empty:
            raise DataError(f"these feature columns must not contain empty values: {empty}")
        strange = [e for i, e in enumerate(strict) if counts[f"s{i}"]]
        if strange:
            self._refuse_unknown(df, strange)

    def _refuse_unknown(self, df: DataFrame, strict: Sequence[FeatureEncoding]) -> None:
        unknown = self.encoder.unknown_categories(df, strict)
        found = unknown.count()
        if found:
            first = unknown.orderBy("feature", "category").limit(NAMED).collect()
            raise DataError(
                f"{found} categories that the fitted table did not have; "
                f"encoder.unknown_categories(df) gives all, the first are: "
                f"{[(r['feature'], r['category']) for r in first]}")

    def inline_checked(self, df: DataFrame) -> DataFrame:
        """``df`` with guards that fail the job at the first bad row.

        It spares the counting pass. Rare categories are looked up in their table,
        however many there are.
        """
        check_columns(df, self.config.columns)
        check_column_types(df, self.config)
        guard = F.when(F.lit(False), F.lit(True))
        for c in self.config.columns:
            guard = guard.when(is_missing(df, c), F.raise_error(F.lit(
                f"the feature column '{c}' must not contain empty values")).cast("boolean"))
        wide = df
        for i, e in enumerate(e for e in self.encoder.encodings if not e.allow_unknown):
            known = e.is_own
            if e.rare_count:
                rare = self.encoder.categories.over(lambda t, e=e: t.where(
                    F.col("is_rare") & (F.col("feature") == e.feature)).select(
                    F.col("category").alias(f"_rare{i}")))
                wide = wide.join(rare.joinable, q(e.feature) == F.col(f"_rare{i}"), "left")
                known = known | F.col(f"_rare{i}").isNotNull()
            guard = guard.when(~known, F.raise_error(F.concat(
                F.lit(f"a category that '{e.feature}' did not have when fitted: "),
                q(e.feature))).cast("boolean"))
        return wide.where(guard.otherwise(F.lit(True))).select(*qs(df.columns))

    def scoring_table(self, df: DataFrame, keep: Sequence[str] = (), check: bool = True
                      ) -> DataFrame:
        """``keep`` columns followed by the features the model takes."""
        if check:
            self.check_scoring_table(df)
        out = df.select(*qs(keep), *self.feature_columns())
        check_model_schema(out.columns[len(keep):], self.output_columns)
        return out


def fit_preparation(df: DataFrame, config: FeaturesConfig, fold_key_column: str | None = None
                    ) -> tuple[Preparation, DataFrame]:
    """Fit the encoder on complete cases; returns it with those rows."""
    required = required_columns(config, fold_key_column)
    check_columns(df, required)
    check_column_types(df, config)
    clean = complete_cases(df, required)
    return Preparation(config, fit_encoder(clean, config.categorical)), clean


def prepare_training(df: DataFrame, config: FeaturesConfig, params: TrainParams,
                     row_id: Sequence[str]) -> tuple[Preparation, ModelTable]:
    preparation, clean = fit_preparation(df, config, params.fold_split.key_column)
    return preparation, preparation.train_table(
        clean, params.fold_split, params.hash_seed, row_id)
