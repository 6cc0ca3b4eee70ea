"""Data profile as tables, one function per section.

Sections over all columns run as one wide aggregate, or as one grouped pass over
``(column, value)`` cells where values have to be told apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.names import number, qs, quoted, text_literal
from foldwise.operators.linear import PARTIAL_SCHEMA, merge_partials
from foldwise.operators.ordering import ROWS_PER_RANGE, exact_quantiles
from foldwise.operators.prepare import missing_by_column
from foldwise.sources.settle import write_table

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
_SQL_PAIRS = 10

# Limits of the profile alerts.
ZEROS_ALERT_PCT = 10.0
MISSING_ALERT_PCT = 0.0


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]


def _values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns as ``c0, c1, ...``: numbers as double, all else as text.

    NaN becomes null and -0.0 becomes 0.0. Sections build on this as SQL text, since
    one expression per column and measure is many.
    """
    numeric = set(numeric_columns(df))

    def value(name: str) -> str:
        if name not in numeric:
            return f"CAST({quoted(name)} AS STRING)"
        number = f"CAST({quoted(name)} AS DOUBLE)"
        return f"CASE WHEN NOT isnan({number}) THEN {number} + 0D END"

    return df.selectExpr(*[f"{value(c)} AS c{i}" for i, c in enumerate(names)])


def _rows(entries: Sequence[str]) -> str:
    return f"inline(array({', '.join(f'named_struct({e})' for e in entries)}))"


def _cells(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value)`` per cell, made inside the scan stage."""
    named = _values(df, names).toDF(*names)
    return named.unpivot([], qs(names), "column", "value")


def _by_column(df: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Every field over every column, as a row per column.

    Cells are grouped by column name: partial aggregates keep a row per column and
    task, and generated code stays small however many columns there are. Numbers and
    texts are read apart, each with its own columns only.
    """
    numeric = set(numeric_columns(df))
    parts = [[c for c in names if c in numeric], [c for c in names if c not in numeric]]
    return reduce(DataFrame.unionByName, [
        _cells(df, part).groupBy("column").agg(*[F.expr(sql).alias(f) for f, sql in fields.items()])
        for part in parts if part])


def _frequencies(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` of the present cells."""
    return (_cells(df, names).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count("*").alias("count")))


@dataclass(frozen=True)
class ValueCounts:
    """``(column, value, count)`` of present cells: numbers as double, texts as text.

    Telling values apart shuffles them, the costliest step of a profile; sections
    that need it can share one.
    """

    numeric: DataFrame | None
    text: DataFrame | None

    def written(self) -> ValueCounts:
        """The same counts as tables, computed once."""
        return ValueCounts(*[None if t is None else write_table(t, "value-counts")
                             for t in (self.numeric, self.text)])

    @property
    def as_text(self) -> DataFrame:
        parts = [t.withColumn("value", F.col("value").cast("string"))
                 for t in (self.numeric, self.text) if t is not None]
        return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame) -> ValueCounts:
    return ValueCounts(*[_frequencies(df, names) if names else None
                         for names in (numeric_columns(df), text_columns(df))])


def overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells and duplicate rows with percents.

    Rows are told apart by a 128-bit fingerprint, so what is shuffled does not grow with their
    width. Whole rows are compared only where a fingerprint repeats.
    """
    names = list(df.columns)
    columns = [f"c{i}" for i in range(len(names))]
    empty = " || ".join(f"CAST({c} IS NULL AS TINYINT)" for c in columns)
    rows = _values(df, names).selectExpr(
        "*", f"{empty} AS gaps").selectExpr("*", *[
            f"xxhash64({seed}, gaps, {', '.join(columns)}) AS h{seed}" for seed in (1, 2)])
    totals = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(
        F.length(F.translate("gaps", "0", ""))), F.lit(0)).alias("missing_cells"))
    again = rows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = (rows.join(again, ["h1", "h2"], "left_semi").groupBy(*columns)
                .agg(F.count("*").alias("n"))
                .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")))
    cells = F.col("rows") * len(names)
    return (totals.join(F.broadcast(repeated))  # a row each
            .select("rows", F.lit(len(names)).alias("columns"), "missing_cells",
                    (F.try_divide(F.col("missing_cells"), cells) * 100).alias("missing_pct"),
                    "duplicate_rows",
                    (F.try_divide(F.col("duplicate_rows"), F.col("rows")) * 100)
                    .alias("duplicate_pct")))


def variables(df: DataFrame, exact: bool = True, counts: ValueCounts | None = None) -> DataFrame:
    """Per column: present and missing cells, distinct values, values seen once.

    The exact form groups all values. With ``exact=False`` distinct values are
    estimated in one pass without a shuffle of values, and ``unique`` is null.
    """
    counted = _by_column(df, list(df.columns), {
        "count": "count(value)", "missing": "count(*) - count(value)",
    } | ({} if exact else {"distinct": "approx_count_distinct(value, 0.01D)"}))
    if not exact:
        return counted.withColumn("unique", F.lit(None).cast("bigint"))
    distinct = (counts or value_counts(df)).as_text.groupBy("column").agg(
        F.count("*").alias("distinct"), F.count(F.when(F.col("count") == 1, True)).alias("unique"))
    return (counted.join(F.broadcast(distinct), "column", "left")
            .select("column", "count", "missing", F.coalesce("distinct", F.lit(0)).alias("distinct"),
                    F.coalesce("unique", F.lit(0)).alias("unique")))


def numeric_stats(df: DataFrame) -> DataFrame:
    stats = _by_column(df, numeric_columns(df), {
        "mean": "avg(value)", "std": "stddev_samp(value)", "variance": "var_samp(value)",
        "min": "min(value)", "max": "max(value)", "sum": "sum(value)",
        "zeros": "count_if(value = 0)", "negatives": "count_if(value < 0)"})
    return stats.withColumn("cv", F.try_divide(F.col("std"), F.col("mean")))


def quantiles(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """5, 25, 50, 75 and 95 percent quantiles with interquartile range and range."""
    names = numeric_columns(df)
    at = exact_quantiles(df, names, (0.0, *QUANTILES, 1.0), rows_per_range)
    pick = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    return (at.groupBy("column").agg(
        *[pick(p).alias(f"q{round(p * 100):02d}") for p in QUANTILES],
        (pick(0.75) - pick(0.25)).alias("iqr"), (pick(1.0) - pick(0.0)).alias("range")))


def shape(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Skewness and excess kurtosis (population form) and median absolute deviation."""
    names = numeric_columns(df)
    moments = _by_column(df, names, {"skewness": "skewness(value)", "kurtosis": "kurtosis(value)"})
    medians = {r["column"]: r["value"] for r in exact_quantiles(df, names, [0.5], rows_per_range).collect()}
    away = df.selectExpr(*[
        f"abs(CAST({quoted(c)} AS DOUBLE) - {number(_or_nan(medians[c]))}) AS {quoted(c)}"
        for c in names])
    mad = exact_quantiles(away, names, [0.5], rows_per_range).select("column", F.col("value").alias("mad"))
    return moments.join(F.broadcast(mad), "column")


def _or_nan(value: float | None) -> float:
    return float("nan") if value is None else value


def histogram(df: DataFrame, bins: int = 10) -> DataFrame:
    """Counts in ``bins`` equal steps between minimum and maximum of each column."""
    limits = {r["column"]: (r["min"], r["max"]) for r in _by_column(
        df, numeric_columns(df), {"min": "min(value)", "max": "max(value)"}).collect()}
    names = [c for c in numeric_columns(df) if limits[c][0] is not None]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, bin_start double, count bigint")

    def place(i: int, name: str) -> str:
        low, high = limits[name]
        if low == high:
            return f"CASE WHEN c{i} IS NOT NULL THEN 0 END"
        # ``least`` skips nulls, so empty cells are kept out by name.
        return (f"CASE WHEN c{i} IS NOT NULL THEN CAST(least(floor((c{i} - {number(low)}) / "
                f"{number(high - low)} * {bins}), {bins - 1}) AS INT) END")

    cells = _values(df, names).selectExpr(_rows([
        f"'column', {text_literal(c)}, 'bin', {place(i, c)}, 'low', {number(limits[c][0])}, "
        f"'width', {number((limits[c][1] - limits[c][0]) / bins)}"
        for i, c in enumerate(names)]))
    return (cells.where(F.col("bin").isNotNull()).groupBy("column", "bin", "low", "width")
            .agg(F.count("*").alias("count"))
            .select("column", "bin", (F.col("low") + F.col("width") * F.col("bin"))
                    .alias("bin_start"), "count"))


def top_values(df: DataFrame, k: int = 5, counts: ValueCounts | None = None) -> DataFrame:
    """Most frequent values per column; ties go to the smaller text."""
    rank = F.row_number().over(
        W.partitionBy("column").orderBy(F.desc("count"), F.asc("value")))
    return ((counts or value_counts(df)).as_text.withColumn("rank", rank)
            .where(F.col("rank") <= k))


def extreme_values(df: DataFrame, k: int = 5, counts: ValueCounts | None = None) -> DataFrame:
    """Smallest and largest distinct values per numeric column, with counts."""
    cells = (counts or value_counts(df)).numeric

    def side(name: str, order: Column) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("column").orderBy(order))
        return (cells.withColumn("rank", rank).where(F.col("rank") <= k)
                .select("column", F.lit(name).alias("side"), "rank", "value", "count"))

    return side("smallest", F.asc("value")).unionByName(side("largest", F.desc("value")))


def text_lengths(df: DataFrame) -> DataFrame:
    return _by_column(df, text_columns(df), {
        "min_length": "min(length(value))", "mean_length": "avg(length(value))",
        "max_length": "max(length(value))"})


def correlations(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, over rows that have both.

    Null where a side is constant. Few columns are summed in SQL; for more, each
    task multiplies its batches as matrices and a two-step merge adds them up.
    """
    names = numeric_columns(df)
    pairs = list(combinations(range(len(names)), 2))
    schema = "left string, right string, correlation double"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    if len(pairs) <= _SQL_PAIRS:
        sums = _values(df, names).selectExpr(*[sql for i, j in pairs for sql in (
            f"covar_pop(c{i}, c{j}) AS v{i}_{j}",
            f"stddev_pop(c{i}) FILTER (WHERE c{j} IS NOT NULL) AS a{i}_{j}",
            f"stddev_pop(c{j}) FILTER (WHERE c{i} IS NOT NULL) AS b{i}_{j}")])
        return sums.selectExpr(_rows([
            f"'left', {text_literal(names[i])}, 'right', {text_literal(names[j])}, "
            f"'correlation', try_divide(v{i}_{j}, a{i}_{j} * b{i}_{j})" for i, j in pairs]))
    means = {r["column"]: r["mean"] or 0.0
             for r in _by_column(df, names, {"mean": "avg(value)"}).collect()}
    shift = np.array([means[c] for c in names])
    parts = _values(df, names).mapInPandas(partial(_pair_sums, shift=shift), PARTIAL_SCHEMA)
    merged = merge_partials(parts).first()
    n, x, xx, xy = np.asarray(merged["g"]).reshape(4, len(names), len(names))
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = xx / n - (x / n) ** 2
        r = (xy / n - (x / n) * (x.T / n)) / np.sqrt(spread * spread.T)
    # Rounding leaves a speck of variance in a constant column.
    live = spread > 1e-14 * np.maximum(np.abs(xx / n), 1e-300)
    return df.sparkSession.createDataFrame([
        (names[i], names[j], float(r[i, j]) if live[i, j] and live[j, i] else None)
        for i, j in pairs], schema)


def _pair_sums(batches: Iterator[pd.DataFrame], shift: np.ndarray) -> Iterator[pd.DataFrame]:
    """Counts and sums over rows that have both columns, for every ordered pair."""
    d = len(shift)
    total, rows = np.zeros((4, d, d)), 0
    for batch in batches:
        z = batch.to_numpy(np.float64) - shift
        there = (~np.isnan(z)).astype(np.float64)
        z = np.nan_to_num(z)
        total += np.stack([there.T @ there, z.T @ there, (z * z).T @ there, z.T @ z])
        rows += len(z)
    if rows:
        yield pd.DataFrame({"by": ["all"], "n": [rows], "s": [[]], "g": [total.ravel()]})


def missing(df: DataFrame) -> DataFrame:
    """Missing cells per column with percent; empty text counts as a value here."""
    counted = _by_column(df, list(df.columns), {
        "missing": "count(*) - count(value)", "rows": "count(*)"})
    return counted.withColumn(
        "missing_pct", F.try_divide(F.col("missing"), F.col("rows")) * 100)


def missing_patterns(df: DataFrame) -> DataFrame:
    """``(pattern, columns_missing, count, pct)`` per set of cells missing together.

    ``pattern`` has a 1 for every missing column, in column order. Rows are grouped by it where
    they lie, so a task passes on a row per pattern it met.
    """
    columns = [f"c{i}" for i in range(len(df.columns))]
    marks = " || ".join(f"CAST({c} IS NULL AS TINYINT)" for c in columns)
    counted = (_values(df, list(df.columns)).selectExpr(f"{marks} AS pattern")
               .groupBy("pattern").agg(F.count("*").alias("count")))
    rows = df.agg(F.count("*").alias("rows"))
    return counted.join(F.broadcast(rows)).select(  # one row
        "pattern", F.length(F.translate("pattern", "0", "")).alias("columns_missing"), "count",
        (F.col("count") / F.col("rows") * 100).alias("pct"))


def missing_together(df: DataFrame) -> DataFrame:
    """``(left, right, both, either)``: rows in which two columns are missing, from the patterns."""
    names = list(df.columns)
    pairs = list(combinations(range(len(names)), 2))
    schema = "left string, right string, both bigint, either bigint"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    bit = lambda i: f"substring(pattern, {i + 1}, 1) = '1'"
    cells = missing_patterns(df).selectExpr("count", _rows([
        f"'left', {text_literal(names[i])}, 'right', {text_literal(names[j])}, "
        f"'b', {bit(i)} AND {bit(j)}, 'e', {bit(i)} OR {bit(j)}" for i, j in pairs]))
    return cells.groupBy("left", "right").agg(
        F.sum(F.when(F.col("b"), F.col("count")).otherwise(0)).alias("both"),
        F.sum(F.when(F.col("e"), F.col("count")).otherwise(0)).alias("either"))


def blank_cells(df: DataFrame) -> DataFrame:
    """Missing cells per column, where empty text counts as missing."""
    return missing_by_column(df, df.columns)


def alerts(df: DataFrame, counts: ValueCounts | None = None, facts: DataFrame | None = None
           ) -> DataFrame:
    """``(column, alert)``: constant, unique, missing or many zeros.

    ``facts`` are rows like those of :func:`variables`, where these are at hand.
    """
    facts = variables(df, counts=counts) if facts is None else facts
    if numeric_columns(df):
        zeros = _by_column(df, numeric_columns(df), {"zeros": "count_if(value = 0)"})
        facts = facts.join(F.broadcast(zeros), "column", "left")
    else:
        facts = facts.withColumn("zeros", F.lit(0))
    rows = F.col("count") + F.col("missing")
    rules = {
        "constant": F.col("distinct") <= 1,
        "unique": (F.col("distinct") == F.col("count")) & (F.col("distinct") > 1),
        "missing": F.try_divide(F.col("missing"), rows) * 100 > MISSING_ALERT_PCT,
        "zeros": F.coalesce(F.try_divide(F.col("zeros"), rows) * 100 > ZEROS_ALERT_PCT,
                            F.lit(False)),
    }
    fired = F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]),
                     lambda a: a.isNotNull())
    return facts.select("column", F.explode(fired).alias("alert"))


SECTIONS = {
    "overview": overview, "variables": variables, "missing": missing, "top_values": top_values,
    "alerts": alerts, "numeric_stats": numeric_stats, "quantiles": quantiles, "shape": shape,
    "histogram": histogram, "extreme_values": extreme_values, "correlations": correlations,
    "text_lengths": text_lengths, "missing_patterns": missing_patterns,
    "missing_together": missing_together,
}
_NUMERIC_ONLY = {"numeric_stats", "quantiles", "shape", "histogram", "extreme_values",
                 "correlations"}


def section_names(df: DataFrame) -> list[str]:
    """The sections that apply to the column types of ``df``."""
    skipped = (set() if numeric_columns(df) else _NUMERIC_ONLY) | (
        set() if text_columns(df) else {"text_lengths"})
    return [name for name in SECTIONS if name not in skipped]


_COUNTED = {"variables", "top_values", "extreme_values", "alerts"}


def section(name: str, df: DataFrame, counts: ValueCounts | None = None) -> DataFrame:
    """One section by name; those that tell values apart use the given counts."""
    return SECTIONS[name](df, counts=counts) if name in _COUNTED else SECTIONS[name](df)


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """All sections by name, with the value counts computed once."""
    counts = value_counts(df).written()
    return {name: section(name, df, counts) for name in section_names(df)}
