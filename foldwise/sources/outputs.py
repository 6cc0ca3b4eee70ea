"""Table writers. Every output is a folder of part files, written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame

FORMATS = ("csv", "parquet")


def write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown output format {fmt!r}, choose from {FORMATS}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_predictions(oof: DataFrame, path: str, fmt: str = "csv") -> None:
    """Out-of-fold rows: sample id, fold key, true value, prediction."""
    write(oof.select("sample_id", "fold_key", "y_true", "fold_model_y_pred"), path, fmt)


def write_fold_table(fold_report: DataFrame, path: str, fmt: str = "csv") -> None:
    write(fold_report, path, fmt)


def write_scored(scored: DataFrame, path: str, fmt: str = "csv") -> None:
    """Input columns followed by ``model_prediction``."""
    write(scored, path, fmt)
