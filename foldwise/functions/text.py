"""Display texts of the report, as column expressions.

Numbers stay numbers in every result table; these are for the edge only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldwise.functions.metrics import DISPLAY_NAMES


def pct_text(pct: Column) -> Column:
    return F.format_string("%.2f%%", pct.cast("double"))


def count_text(n: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(n.cast("bigint"), 0)


def short_number(x: Column, places: int = 3) -> Column:
    """Rounded number without trailing zeros, one decimal at least."""
    fixed = F.format_string(f"%.{places}f", F.round(x.cast("double"), places))
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


# The texts of the next four functions.
def mean_std_text(mean: Column, std: Column) -> Column:
    return F.concat(F.lit("mean: "), short_number(mean),
                    F.lit(" (std: "), short_number(std), F.lit(")"))


def shape_text(rows: Column, columns: Column) -> Column:
    return F.concat(count_text(rows), F.lit(" rows, "), count_text(columns), F.lit(" columns"))


def funnel_text(before: Column, after: Column, remaining_pct: Column) -> Column:
    return F.concat(
        pct_text(remaining_pct), F.lit(" rows remained after the imputation funnel (before: "),
        count_text(before), F.lit(" | after: "), count_text(after), F.lit(")"))


def warning_count_text(n: Column) -> Column:
    return F.when(n == 0, F.lit("No")).otherwise(
        F.concat(F.lit("Yes ("), n.cast("string"), F.lit(" in total)")))


def module_text(module: Column) -> Column:
    # Module keyword -> display name.
    return (F.when(module == "dataset_preprocessing", "Dataset Preprocessing")
            .when(module == "model_training", "Model training"))


def context_text(context: Column) -> Column:
    """``key: value`` pairs of a map in key order, two spaces apart."""
    pairs = F.array_sort(F.map_entries(context))
    return F.array_join(
        F.transform(pairs, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "  ")


def metric_text(metric: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for keyword, display in DISPLAY_NAMES.items():
        chain = chain.when(metric == keyword, display)
    return chain


def fold_setup_text(key_column: str | None) -> str:
    return "random split" if key_column is None else f"by the key column '{key_column}'"


def duration_text(start: Column, end: Column) -> Column:
    """Elapsed hours, minutes and seconds with the two stamps behind."""
    seconds = F.timestamp_diff("SECOND", start, end)
    stamp = "HH:mm:ss dd/MM/yyyy"
    spent = F.format_string("%d:%02d:%02d", F.floor(seconds / 3600).cast("bigint"),
                            F.floor(seconds % 3600 / 60).cast("bigint"), seconds % 60)
    known = F.concat(spent, F.lit(" (start: "), F.date_format(start, stamp),
                     F.lit(" | end: "), F.date_format(end, stamp), F.lit(")"))
    return F.coalesce(known, F.lit("unknown"))


def capped(value: Column, low: Column, high: Column) -> Column:
    """Curve value kept between both limits."""
    return F.least(F.greatest(value, low), high)
