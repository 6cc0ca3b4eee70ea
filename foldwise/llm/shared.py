"""Intermediate tables in the folder that driver and executors share, and values for tasks."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession

from foldwise.sources.settle import Scratch, settle, shared_folder, write_table

__all__ = ["Scratch", "Shipped", "settle", "shared_folder", "write_table"]


class Shipped:
    """A value broadcast with the classes it is made of, so that tasks need no installed package."""

    def __init__(self, spark: SparkSession, value: Any):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._held: list[Any] = []

    def __getstate__(self) -> dict:
        return {"_sent": self._sent, "_held": []}

    @property
    def value(self) -> Any:
        """The value, opened once a task."""
        if not self._held:
            self._held.append(pickle.loads(self._sent.value))
        return self._held[0]
