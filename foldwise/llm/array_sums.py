"""Sums of long arrays over all tasks, without one place that meets them whole.

A task cuts its array into parts and sends each part on its own. Parts of one number are added
in a tree: a summing task takes one part from at most ``FAN_IN`` tasks and passes on one, so
what it reads does not grow with the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks whose arrays meet in one summing task.
FAN_IN = 32

_SCHEMA = "part int, place int, n binary"


def summed(source: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
           size: int, parts: int, kind: str, fan_in: int = FAN_IN, tasks: int | None = None
           ) -> np.ndarray:
    """Add the arrays that ``make`` returns for the batches of each task.

    ``kind`` is the little-endian element type the tasks send; sums are 64-bit. A table without
    rows or tasks gives zeros. ``tasks`` tells how many there are; unless given, ``source`` is
    planned once more to know. It only balances the tree: a task beyond it is still added.
    """
    step = -(-size // parts)
    wide = "<f8" if np.dtype(kind).kind == "f" else "<i8"

    def send(batches):
        total = make(batches)
        place = TaskContext.get().partitionId() // fan_in
        for i in range(parts):
            held = total[i * step:(i + 1) * step]
            if held.any():
                yield _row(i, place, held.astype(kind))

    tasks = source.rdd.getNumPartitions() if tasks is None else tasks
    sums = added(source.mapInArrow(send, _SCHEMA), tasks, parts, kind, wide, fan_in)[-1]
    out = np.zeros(size, dtype=wide)
    for r in sums.toArrow().to_pylist():
        values = np.frombuffer(r["n"], wide)
        out[r["part"] * step:r["part"] * step + len(values)] += values
    return out


def added(sums: DataFrame, tasks: int, parts: int, kind: str, wide: str, fan_in: int = FAN_IN
          ) -> list[DataFrame]:
    """The levels of the tree: what arrives at the summing tasks, and last the sums."""
    levels, groups = [], max(1, -(-tasks // fan_in))
    while True:
        levels.append(sums.repartitionById(
            groups * parts, F.pmod(F.col("place"), F.lit(groups)) * parts + F.col("part")))
        sums, kind = levels[-1].mapInArrow(_adder(kind, wide, fan_in), _SCHEMA), wide
        if groups == 1:
            return [*levels, sums]
        groups = -(-groups // fan_in)


def _adder(kind: str, wide: str, fan_in: int) -> Callable:
    def add(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for *key, blob in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                values, at = np.frombuffer(blob, kind), tuple(key)
                total[at] = total[at] + values if at in total else values.astype(wide)
        for (part, place), values in total.items():
            yield _row(part, place // fan_in, values)

    return add


def _row(part: int, place: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int32()),
        "n": pa.array([values.tobytes()], pa.binary())})
