from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import array_sums
from foldwise.llm.array_sums import summed


def ids_counted(size: int):
    def make(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            total += np.bincount(ids % size, weights=ids, minlength=size).astype(np.int64)
        return total

    return make


@pytest.mark.parametrize("tasks, fan_in", [(1, 32), (7, 2), (33, 32), (40, 3)])
def test_sums(spark, tasks, fan_in):
    got = summed(spark.range(5000, numPartitions=tasks), ids_counted(11), 11, 3, "<i8", fan_in)
    ids = np.arange(5000)
    assert got.tolist() == np.bincount(ids % 11, weights=ids).astype(int).tolist()


def test_sums_of_nothing(spark):
    assert summed(spark.range(0), ids_counted(5), 5, 2, "<i8").tolist() == [0] * 5


def test_small_numbers_in_transit_add_up_beyond_their_type(spark):
    full = lambda _: np.full(3, 2 ** 32 - 1, dtype=np.int64)
    got = summed(spark.range(9, numPartitions=9), full, 3, 2, "<u4", 2)
    assert got.tolist() == [9 * (2 ** 32 - 1)] * 3


def test_no_task_meets_more_arrays_than_the_fan_in(spark):
    """2,000 tasks that send 4 parts each."""
    blob = F.lit(np.ones(5, "<i8").tobytes())
    sent = spark.range(8000, numPartitions=2000).select(
        (F.col("id") % 4).cast("int").alias("part"),
        (F.floor(F.col("id") / 4 / array_sums.FAN_IN)).cast("int").alias("place"), blob.alias("n"))
    *levels, sums = array_sums.added(sent, 2000, 4, "<i8", "<i8")
    assert len(levels) == 3
    for level in levels:
        most = (level.groupBy(F.spark_partition_id().alias("task")).count()
                .agg(F.max("count")).first()[0])
        assert most <= array_sums.FAN_IN
    assert [np.frombuffer(r["n"], "<i8").tolist() for r in sums.collect()] == [[2000] * 5] * 4
