"""Mixing sources to target weights by Pfair scheduling of blocks.

The rows of a source are dealt into blocks. With ``a`` of every ``A`` slots due to a source,
its block ``j`` (from zero) may run from slot ``floor(j * A / a)`` on and must have run by
slot ``ceil((j + 1) * A / a)``. Taking in every slot the released block with the earliest
deadline meets all of them, so at any moment a source is less than one block away from its
share. Windows repeat after ``A`` slots, so one period is scheduled and then reused: the
slot of a block follows from its number alone, whatever the size of the table. ``A`` grows
with the number and the unevenness of the sources until whole slots meet the target weights:
over all its blocks, rounding moves no source by more than one block or ``DRIFT`` of them,
and all sources together by no more than ``DRIFT`` of the mix.

A source that has no more blocks leaves; from the next period on the others share its slots
by their weights. Every row is kept and gets a place. Slots that a source's last, unfinished
period leaves idle are numbers nobody holds.

Nulls: a null source is a source of its own; a null id sorts first. Repeated rows each get
a place, apart by chance only if all their columns are equal. An empty table gives an empty
result. Sources without a weight in ``weights`` get one slot a period; the period is long
enough for the others' weights to hold all the same.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import count as count_up

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.shared import write_table
from foldwise.llm.textbytes import laid, pick

#: Rows per block, least slots per period, and rows ranked by one task.
BLOCK_ROWS = 32
PERIOD = 1000
RANK_ROWS = 2000
#: Share of a source's blocks, and of the mix, that rounding to whole slots may move.
DRIFT = 0.01
#: Exponent of the default weights: shares of rows, flattened.
TEMPER = 0.7


@dataclass(frozen=True)
class Phase:
    """Periods ``first`` to ``last`` (exclusive), in which the same sources are active."""

    number: int
    first: int
    last: int
    start: int
    sources: tuple[int, ...]
    slots: tuple[int, ...]


def slots_of(shares: np.ndarray, period: int) -> np.ndarray:
    """Whole slots per period, at least one each, by largest remainder."""
    shares = np.maximum(np.asarray(shares, dtype=float), 0)
    shares = shares / shares.sum() if shares.sum() > 0 else np.full(len(shares), 1 / len(shares))
    exact = shares * period
    out = np.maximum(np.floor(exact).astype(int), 1)
    spare = period - int(out.sum())
    if spare > 0:
        out[np.argsort(out - exact, kind="stable")[:spare]] += 1
    return out


def fitting_slots(shares: np.ndarray, blocks: np.ndarray, least: int) -> np.ndarray:
    """Slots of the shortest period tried, of at least ``least``, that meets the shares.

    A source's slots over their sum are its share in effect. Besides ``least`` the slots that
    give the smallest share just one are tried, and both are doubled until one fits.
    """
    shares = np.maximum(np.asarray(shares, dtype=float), 0)
    if not shares.sum() > 0:
        return slots_of(shares, max(least, len(shares)))
    wanted = shares / shares.sum()
    due = wanted > 0
    unit = round(1 / wanted[due].min())
    for period in heapq.merge(*((n << k for k in count_up()) for n in (least, max(unit, 1)))):
        if period < least:
            continue
        out = slots_of(wanted, period)
        real = out / out.sum()
        moved = blocks * np.abs(1 - wanted / real)
        if (np.abs(real - wanted).sum() <= 2 * DRIFT
                and np.all(moved[due] <= np.maximum(1, DRIFT * blocks[due]))):
            return out


def phases(blocks: np.ndarray, slots: np.ndarray) -> list[Phase]:
    """Cut time where a source runs out of blocks."""
    periods = -(-blocks // slots)
    out, first, start = [], 0, 0
    for last in sorted(set(periods[periods > 0].tolist())):
        active = tuple(np.flatnonzero(periods >= last).tolist())
        out.append(Phase(len(out), first, last, start, active,
                         tuple(int(slots[i]) for i in active)))
        start += (last - first) * sum(out[-1].slots)
        first = last
    return out


def schedule(slots: tuple[int, ...]) -> list[tuple[int, int]]:
    """One period: which source, and which of its blocks, runs in each slot.

    Released blocks wait in a heap by deadline; a source's next block is released at its
    own time, kept in a second heap.
    """
    total = sum(slots)
    coming = [(0, i, 0) for i in range(len(slots))]
    heapq.heapify(coming)
    ready: list[tuple[int, int, int]] = []
    out = []
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            _, i, j = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(j + 1) * total // slots[i]), i, j))
        _, i, j = heapq.heappop(ready)
        out.append((i, j))
        if j + 1 < slots[i]:
            heapq.heappush(coming, ((j + 1) * total // slots[i], i, j + 1))
    return out


def mix(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id",
        source_col: str = "source", block_rows: int = BLOCK_ROWS, period: int = PERIOD,
        rank_rows: int = RANK_ROWS, temper: float = TEMPER) -> DataFrame:
    """Places of all rows in the mixed order.

    ``weights`` maps sources to target weights; without it a source weighs its share of
    rows to the power ``temper``. ``period`` is the least number of slots in a period. Returns ``id_col, source_col, place, block, slot, release,
    deadline`` (all long); ordered by ``slot`` and ``place`` the rows are the mix.

    A row's place within its source comes from a hash of the id. A source is cut into
    buckets by that hash, so no task ranks more than about ``rank_rows`` rows; places before
    a bucket are sums of counts. The sources have to fit the driver, as their weights do.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_col, source_col).toDF("id", "source").withColumn("h", F.xxhash64("id"))
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows")).orderBy("source").collect()
    names = [r["source"] for r in sizes]
    count = np.array([r["rows"] for r in sizes], dtype=np.int64)
    if weights is None:
        share = (count / max(count.sum(), 1)) ** temper
    else:
        share = np.array([float(weights.get(n, 0.0)) for n in names])
    blocks = -(-count // block_rows)
    slots = fitting_slots(share, blocks, period) if names else np.zeros(0, int)
    plan = phases(blocks, slots)

    # One row per source, phase and block of a period: where in the period that block runs.
    def patterns(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                phase = plan[number]
                turns = schedule(phase.slots)
                yield pa.RecordBatch.from_pydict({
                    "phase": pa.array([number] * len(turns), pa.int64()),
                    "number": pa.array([phase.sources[i] for i, _ in turns], pa.int64()),
                    "turn": pa.array([j for _, j in turns], pa.int64()),
                    "offset": pa.array(range(len(turns)), pa.int64())})

    pattern = spark.range(0, len(plan), 1, max(1, min(len(plan), 200))).mapInArrow(
        patterns, "phase long, number long, turn long, offset long")
    source_rows = [(n, i, int(a), int(max(1, -(-c // rank_rows))))
                   for i, (n, a, c) in enumerate(zip(names, slots.tolist(), count.tolist()))]
    kind = dict(docs.dtypes)[source_col]
    sources = spark.createDataFrame(
        source_rows, f"source {kind}, number long, slots long, buckets long")
    period_rows = [(p.number, p.first, p.last, p.start, sum(p.slots)) for p in plan]
    cycles = spark.createDataFrame(
        period_rows, "phase long, first long, last long, start long, total long").select(
        "phase", "start", "total", "first",
        F.explode(F.sequence("first", F.col("last") - 1)).alias("cycle")).select(
        "phase", "cycle", "total",
        (F.col("start") + (F.col("cycle") - F.col("first")) * F.col("total")).alias("begin"))

    # Sources were counted above; a hot one is met by as many tasks as Spark likes, since
    # their table is broadcast.
    known = rows.join(F.broadcast(sources), rows["source"].eqNullSafe(sources["source"])).select(
        "id", rows["source"].alias("source"), "h", "number", "slots",
        F.pmod(F.shiftrightunsigned("h", 8), F.col("buckets")).alias("bucket"))
    counts = write_table(known.groupBy("number", "bucket").agg(F.count(F.lit(1)).alias("n")),
                         "mix-buckets")
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("number", "bucket").orderBy("h", "id")
    placed = (known.withColumn("at", F.row_number().over(inside) - 1)
              .join(starts, ["number", "bucket"])
              .withColumn("place", F.col("before") + F.col("at"))
              .withColumn("block", F.expr(f"place div {int(block_rows)}"))
              .withColumn("cycle", F.expr("block div slots"))
              .withColumn("turn", F.col("block") % F.col("slots")))
    timed = (placed.join(cycles, "cycle").join(pattern, ["phase", "number", "turn"])
             .withColumn("slot", F.col("begin") + F.col("offset"))
             .withColumn("release", F.col("begin") + F.expr("turn * total div slots"))
             .withColumn("deadline",
                         F.col("begin") + F.expr("((turn + 1) * total + slots - 1) div slots")))
    return timed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "place",
                        "block", "slot", "release", "deadline")


def arranged(docs: DataFrame, id_col: str = "doc_id", files: int | None = None,
             source_col: str = "source", **options) -> DataFrame:
    """The given rows, all columns kept, in mixed order: partition by partition, row by row.

    Written to files, the order of file numbers and of rows within them is the mix. Rows
    that repeat an id stand together; rows with a null id come first.
    """
    plain, at = laid(docs, id_col, source_col)
    id_col = at[id_col]
    places = (mix(plain, id_col=id_col, source_col=at[source_col], **options).where(F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.min(F.struct("slot", "place")).alias("__at")))
    placed = plain.join(places, id_col, "left")
    order = [F.col("__at.slot"), F.col("__at.place"), F.col(id_col)]
    spread = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).select(*plain.columns).toDF(*docs.columns)
