"""Profile sections from mergeable summaries, for tables whose distinct values are too many.

No section here shuffles all distinct values. Distinct counts are estimates from sketches that
can be stored and merged over runs. Frequent and extreme values, and alerts, are exact: a
summary names candidates, and what it cannot decide is counted as in ``profile``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.functions.names import qs
from foldwise.operators import profile
from foldwise.sources.settle import settle, write_table

#: Base-2 logarithm of the registers of a sketch: a standard error of 0.8 %.
SKETCH_BITS = 14
#: Values a task counts per column; a summary misses at most 1 in this many rows.
COUNTERS = 4096
#: Share of distinct values from which on a column may be unique and is counted exactly.
_NEARLY_UNIQUE = 0.95


def distinct_sketches(df: DataFrame) -> DataFrame:
    """``(column, rows, count, sketch)``: one pass, a sketch per column and task shuffled."""
    return profile._by_column(df, list(df.columns), {
        "rows": "count(*)", "count": "count(value)",
        "sketch": f"hll_sketch_agg(CAST(value AS STRING), {SKETCH_BITS})"})


def merged_sketches(tables: Sequence[DataFrame]) -> DataFrame:
    """Sketches of the union of the tables they come from, e.g. of several runs."""
    return reduce(DataFrame.unionByName, tables).groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"),
        F.hll_union_agg("sketch").alias("sketch"))


def variables(sketches: DataFrame) -> DataFrame:
    """Like ``profile.variables``; ``distinct`` is an estimate and ``unique`` unknown."""
    return sketches.select(
        "column", "count", (F.col("rows") - F.col("count")).alias("missing"),
        F.least(F.hll_sketch_estimate("sketch"), "count").alias("distinct"),
        F.lit(None).cast("bigint").alias("unique"))


def alerts(df: DataFrame, sketches: DataFrame) -> DataFrame:
    """Like ``profile.alerts``: only columns that may be unique are counted exactly."""
    facts = variables(sketches)
    near = [r["column"] for r in facts.where(
        F.col("distinct") >= F.col("count") * _NEARLY_UNIQUE).select("column").collect()]
    if near:
        facts = (facts.where(~F.col("column").isin(near))
                 .unionByName(profile.variables(df.select(*qs(near)))))
    return profile.alerts(df, facts=facts)


def _texts(df: DataFrame) -> DataFrame:
    return profile._values(df, df.columns).selectExpr(
        *[f"CAST(c{i} AS STRING) AS c{i}" for i in range(len(df.columns))])


def _frequent(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """At most ``counters`` values per column with counts that are too low by at most the count
    in the row without value.

    Beyond that many values the count of the next one is taken from all (Misra and Gries), so
    each unit lost stands for ``counters + 1`` rows.
    """
    held: dict[int, list[pa.Table]] = {}
    waiting: dict[int, int] = {}
    lost: dict[int, int] = {}

    def shrink(i: int) -> None:
        table = (pa.concat_tables(held[i]).group_by("value").aggregate([("n", "sum")])
                 .rename_columns(["value", "n"]))
        n = table["n"].to_numpy()
        if len(n) > counters:
            cut = int(np.partition(n, len(n) - counters - 1)[len(n) - counters - 1])
            table = table.set_column(1, "n", pa.array(n - cut)).filter(pa.array(n > cut))
            lost[i] = lost.get(i, 0) + cut
        held[i], waiting[i] = [table], 0

    for batch in batches:
        for i, column in enumerate(batch.columns):
            found = column.drop_null().value_counts()
            if len(found):
                held.setdefault(i, []).append(pa.table({
                    "value": found.field("values"), "n": found.field("counts")}))
                waiting[i] = waiting.get(i, 0) + len(found)
                if waiting[i] > 8 * counters:
                    shrink(i)
    for i in held:
        shrink(i)
        values, n = (held[i][0][name].to_pylist() for name in ("value", "n"))
        if i in lost:
            values, n = [*values, None], [*n, lost[i]]
        yield pa.RecordBatch.from_pydict({
            "column": pa.array([i] * len(n), pa.int32()), "value": pa.array(values, pa.string()),
            "n": pa.array(n, pa.int64())})


def heavy_values(df: DataFrame, k: int = 5, counters: int = COUNTERS) -> DataFrame:
    """Like ``profile.top_values``, and as exact, without shuffling all distinct values.

    Summaries of the tasks are added up; a value they lack occurs at most as often as they
    lost in all. Where ``k`` values beat that, all that may still rank among the first ``k``
    are counted in a second pass. Other columns, whose values are all rare, are counted whole.
    """
    names, texts = list(df.columns), _texts(df)
    found = write_table(
        texts.mapInArrow(partial(_frequent, counters=counters), "column int, value string, n long")
        .groupBy("column", "value").agg(F.sum("n").alias("n")), "value-summaries")
    lost = {r["column"]: r["n"] for r in found.where("value IS NULL").collect()}
    seen = found.where("value IS NOT NULL")
    place = F.row_number().over(W.partitionBy("column").orderBy(F.desc("n")))
    least = {r["column"]: r["n"] for r in
             seen.withColumn("place", place).where(F.col("place") == k).collect()}
    sure = [i for i in range(len(names)) if i not in lost or least.get(i, 0) > lost[i]]
    rest = [c for i, c in enumerate(names) if i not in sure]
    parts = [profile.top_values(df.select(*qs(rest)), k)] if rest else []
    if sure:
        may = reduce(lambda a, b: a | b, [
            (F.col("column") == i) & (F.col("n") >= least.get(i, 0) - lost.get(i, 0))
            for i in sure])
        candidates = settle(seen.where(may), "value-candidates")
        counts = candidates.over(lambda t: t.select(
            "column", "value", F.col("n").alias("count")))
        again = [i for i in sure if i in lost]
        counted = counts.df.where(~F.col("column").isin(again))
        if again:
            cells = (texts.select(*[F.col(f"c{i}").alias(str(i)) for i in again])
                     .unpivot([], [str(i) for i in again], "column", "value")
                     .withColumn("column", F.col("column").cast("int")))
            counted = counted.unionByName(
                cells.join(counts.over(lambda t: t.drop("count")).joinable, ["column", "value"])
                .groupBy("column", "value").agg(F.count("*").alias("count")))
        rank = F.row_number().over(
            W.partitionBy("column").orderBy(F.desc("count"), F.asc("value")))
        named = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("column") + 1)
        parts.append(counted.withColumn("rank", rank).where(F.col("rank") <= k)
                     .withColumn("column", named))
    return reduce(DataFrame.unionByName, parts)


def _outermost(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """The ``k`` smallest and largest distinct values per column of a task, with counts."""
    held: dict[tuple[int, str], pd.Series] = {}
    for batch in batches:
        for i in range(batch.shape[1]):
            counts = batch.iloc[:, i].dropna().value_counts()
            for side in ("smallest", "largest"):
                both = pd.concat([held[i, side], counts]) if (i, side) in held else counts
                both = both.groupby(level=0).sum()  # sorted by value
                held[i, side] = both.head(k) if side == "smallest" else both.tail(k)
    for (i, side), counts in held.items():
        yield pd.DataFrame({"column": i, "side": side, "value": counts.index.to_numpy(float),
                            "n": counts.to_numpy(np.int64)})


def extreme_values(df: DataFrame, k: int = 5) -> DataFrame:
    """Like ``profile.extreme_values``: a task passes on ``k`` values per column and side.

    A value among the ``k`` smallest of all is among those of every task that has it.
    """
    names = profile.numeric_columns(df)
    found = (profile._values(df, names)
             .mapInPandas(partial(_outermost, k=k), "column int, side string, value double, n long")
             .groupBy("column", "side", "value").agg(F.sum("n").alias("count")))
    order = F.when(F.col("side") == "smallest", F.col("value")).otherwise(-F.col("value"))
    rank = F.row_number().over(W.partitionBy("column", "side").orderBy(order))
    named = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("column") + 1)
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select(named.alias("column"), "side", "rank", "value", "count"))


def section(name: str, df: DataFrame, sketches: DataFrame) -> DataFrame:
    """One section of the profile; those that tell values apart come from summaries."""
    if name == "variables":
        return variables(sketches)
    if name == "alerts":
        return alerts(df, sketches)
    if name == "top_values":
        return heavy_values(df)
    return extreme_values(df) if name == "extreme_values" else profile.section(name, df)
