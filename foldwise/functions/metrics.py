"""Regression measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HUBER_DELTA = 1.0


def squared_error(y: Column, pred: Column) -> Column:
    return (pred - y) * (pred - y)


def absolute_error(y: Column, pred: Column) -> Column:
    return F.abs(pred - y)


def huber_sql(error: str) -> str:
    """Huber loss of an error with limit 1, as SQL text."""
    return (f"CASE WHEN abs({error}) <= {HUBER_DELTA}D THEN 0.5D * {error} * {error} "
            f"ELSE {HUBER_DELTA}D * (abs({error}) - {0.5 * HUBER_DELTA}D) END")


def huber_error(y: Column, pred: Column) -> Column:
    e = F.abs(pred - y)
    return F.when(e <= HUBER_DELTA, e * e * 0.5).otherwise(HUBER_DELTA * (e - 0.5 * HUBER_DELTA))


def mse(y: Column, pred: Column) -> Column:
    return F.avg(squared_error(y, pred))


def rmse(y: Column, pred: Column) -> Column:
    return F.sqrt(mse(y, pred))


def mae(y: Column, pred: Column) -> Column:
    return F.avg(absolute_error(y, pred))


def huber(y: Column, pred: Column) -> Column:
    return F.avg(huber_error(y, pred))


# Configuration keyword -> aggregate, display name.
METRICS = {"mse": mse, "rmse": rmse, "mae": mae, "huber_loss": huber}
DISPLAY_NAMES = {"mse": "MSE", "rmse": "RMSE", "mae": "MAE", "huber_loss": "Huber"}


def all_metrics(y: Column, pred: Column, prefix: str = "") -> list[Column]:
    return [build(y, pred).alias(prefix + name) for name, build in METRICS.items()]
