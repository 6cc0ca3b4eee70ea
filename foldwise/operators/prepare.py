"""Guards, complete cases and the model table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.config import FeaturesConfig
from foldwise.errors import DataError
from foldwise.functions.names import q, qs
from foldwise.operators.ordering import dense_position


def required_columns(config: FeaturesConfig, fold_key: str | None = None) -> list[str]:
    """Target, fold key and features, in that order, each once."""
    names = [config.target, *([fold_key] if fold_key else []), *config.columns]
    return list(dict.fromkeys(names))


def unused_column_count(df: DataFrame, required: Sequence[str]) -> int:
    return len(df.columns) - len(set(required))


def check_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataError(f"the table lacks the required columns {missing}")


def check_not_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise DataError("the table is empty")


def check_column_types(df: DataFrame, config: FeaturesConfig) -> None:
    """Categorical features hold text; the target and numeric features hold numbers."""
    for spec in config.categorical:
        if not isinstance(df.schema[spec.column].dataType, T.StringType):
            raise DataError(f"'{spec.column}' is declared categorical but does not hold strings")
    numeric = [s.column for s in config.numeric] + [config.target] * (config.target in df.columns)
    for name in numeric:
        if not isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType)):
            raise DataError(f"the column '{name}' must be numeric")


def check_model_schema(actual: Sequence[str], fitted: Sequence[str]) -> None:
    """The model takes exactly the fitted columns, in the fitted order."""
    if list(actual) != list(fitted):
        raise DataError(f"the model expects the columns {list(fitted)}, got {list(actual)}")


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, NaN or the empty string, by the type of the column."""
    kind, c = df.schema[name].dataType, q(name)
    if isinstance(kind, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_present(df: DataFrame, name: str) -> Column:
    """Negation of :func:`is_missing`, in the form that reaches the file scan."""
    kind, c = df.schema[name].dataType, q(name)
    if isinstance(kind, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def _every(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def blank_to_null(df: DataFrame) -> DataFrame:
    """Replace the empty string by null in every text column."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        F.nullif(q(c), F.lit("")).alias(c) if c in text else q(c) for c in df.columns])


def complete_cases(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a value in every required column; other columns may stay empty."""
    check_columns(df, required)
    return blank_to_null(df.where(_every(is_present(df, c) for c in required)))


def funnel(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: rows before and after the complete-case filter, remaining percent."""
    check_columns(df, required)
    kept = _every(is_present(df, c) for c in required)
    counts = df.agg(F.count("*").alias("rows_before"),
                    F.count(F.when(kept, True)).alias("rows_after"))
    return counts.withColumn(
        "remaining_pct", F.try_divide(F.col("rows_after"), F.col("rows_before")) * 100)


def number_rows(df: DataFrame, row_id: Sequence[str], name: str = "row_number",
                rows: int | None = None) -> DataFrame:
    """Add a dense 0-based row number in row-id order."""
    return dense_position(df, row_id, name, df.count() if rows is None else rows)


def missing_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, missing)`` counts of all columns from one pass."""
    wide = df.agg(*[F.count(F.when(is_missing(df, c), True)).alias(f"m{i}")
                    for i, c in enumerate(columns)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
        for i, c in enumerate(columns)])).alias("r")).select("r.*")


def numeric_features(config: FeaturesConfig) -> list[Column]:
    return [q(s.column).cast("double").alias(s.column) for s in config.numeric]


def profiled_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The raw table restricted to the training columns."""
    return df.select(*qs(required))
