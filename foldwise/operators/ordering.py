"""Global positions, running sums and exact quantiles without a global window.

``row_number().over(orderBy(...))`` moves the whole table into one task. Here the
order is cut into ranges first; only the range sizes meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.functions.names import number, q, qs, quoted
from foldwise.functions.ranges import range_bucket
from foldwise.sources.settle import Scratch, settle

#: Rows one sorted range should hold.
ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 16_384
_SAMPLE_PER_RANGE = 8
#: Share of the rows by which a rank sketch may be off.
RANK_ERROR = 1e-4


def _key(columns: Sequence[str]) -> Column:
    return q(columns[0]) if len(columns) == 1 else F.struct(*qs(columns))


def splitters(df: DataFrame, columns: Sequence[str], ranges: int, rows: int) -> list[Column]:
    """About ``ranges - 1`` sorted key literals that cut ``df`` into even ranges.

    Keys are sampled by their hash, so the sample is the same on every run. The
    choice only balances the ranges; results never depend on it.
    """
    if ranges <= 1:
        return []
    wanted = ranges * _SAMPLE_PER_RANGE
    every = max(1, rows // wanted)
    keys = qs(columns)
    sample = (df.select(*keys).where(F.pmod(F.xxhash64(*keys), F.lit(every)) == 0)
              .distinct().limit(4 * wanted).orderBy(*keys).collect())
    picked = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    distinct = [r for i, r in enumerate(picked) if i == 0 or r != picked[i - 1]]
    types = [df.schema[c].dataType for c in columns]

    def literal(row) -> Column:
        parts = [F.lit(v).cast(t).alias(c) for v, t, c in zip(row, types, columns)]
        return parts[0] if len(parts) == 1 else F.struct(*parts)

    return [literal(r) for r in distinct]


def dense_position(df: DataFrame, order_by: Sequence[str], name: str, rows: int,
                   within: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE
                   ) -> DataFrame:
    """Add the 0-based position of each row in the order ``within + order_by``.

    ``order_by`` must identify a row. ``within`` holds low-cardinality columns that
    sort first; a value of them may cover any share of the rows, since ranges are
    cut on ``order_by``.
    """
    ranges = min(MAX_RANGES, max(1, ceil(rows / rows_per_range)))
    if ranges == 1:
        order = W.orderBy(*qs(within), *qs(order_by))
        return df.withColumn(name, (F.row_number().over(order) - 1).cast("bigint"))
    cuts = splitters(df, order_by, ranges, rows)
    ranged = df.withColumn("_range", range_bucket(_key(order_by), cuts))
    keys = [*within, "_range"]
    before = W.orderBy(*qs(keys)).rowsBetween(W.unboundedPreceding, -1)
    offsets = settle(ranged.groupBy(*qs(keys)).agg(F.count("*").alias("_n")), "range-sizes")
    offsets = offsets.over(lambda t: t.select(
        *[q(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    numbered = ranged.withColumn(
        "_rank", F.row_number().over(W.partitionBy(*qs(keys)).orderBy(*qs(order_by))))
    on = [q(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return (numbered.join(offsets.joinable, on, "inner")
            .withColumn(name, F.col("_offset") + F.col("_rank") - 1)
            .drop("_range", "_rank", "_offset", *[f"_key{i}" for i in range(len(keys))]))


def running_totals(groups: DataFrame, key: str, size: str, name: str, rows: int,
                   max_in_one_task: int = 1_000_000) -> DataFrame:
    """Add the running sum of ``size`` in ``key`` order to a table of groups."""
    if rows <= max_in_one_task:
        upto = W.orderBy(q(key)).rowsBetween(W.unboundedPreceding, W.currentRow)
        return groups.withColumn(name, F.sum(size).over(upto))
    cuts = splitters(groups, [key], min(MAX_RANGES, ceil(rows / max_in_one_task) * 8), rows)
    ranged = groups.withColumn("_range", range_bucket(q(key), cuts))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_range").agg(F.sum(size).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .drop("_n"))
    upto = (W.partitionBy("_range").orderBy(q(key))
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (ranged.withColumn("_upto", F.sum(size).over(upto))
            .join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_offset") + F.col("_upto"))
            .drop("_range", "_upto", "_offset"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Linear-interpolation quantiles as ``(column, prob, value)`` rows.

    Null and NaN are left out. Up to ``rows_per_range`` rows the ``percentile``
    aggregate holds the distinct values of a column. Beyond that one pass makes a rank sketch
    of every column, whose bounds bracket each wanted rank; a second pass counts the values
    in the brackets one by one and all others by the gap they fall in. The number of
    jobs does not depend on the number of columns.
    """
    spark, names = df.sparkSession, list(columns)
    schema = "column string, prob double, value double"
    if not names:
        return spark.createDataFrame([], schema)
    values = df.selectExpr(*[
        f"CASE WHEN NOT isnan(CAST({quoted(c)} AS DOUBLE)) THEN CAST({quoted(c)} AS DOUBLE) END"
        f" AS c{i}" for i, c in enumerate(names)])
    counts = values.selectExpr(*[f"count(c{i})" for i in range(len(names))]).first()
    if max(counts) <= rows_per_range:
        at = ", ".join(number(p) for p in probs)
        found = (values.unpivot([], list(values.columns), "c", "v").groupBy("c")
                 .agg(F.expr(f"percentile(v, array({at})) AS q")).collect())
        by_name = {r["c"]: r["q"] or [None] * len(probs) for r in found}
        return spark.createDataFrame([
            (c, float(p), by_name.get(f"c{i}", [None] * len(probs))[j])
            for i, c in enumerate(names) for j, p in enumerate(probs)], schema).coalesce(1)
    # Ranks count from 1; a quantile lies between two neighbouring ones.
    around = {}
    for i, n in enumerate(counts):
        for p in probs if n else ():
            at = (n - 1) * float(p)
            around[i, p] = (int(at) + 1, min(int(at) + 2, n), at - int(at))
    found = _ranked_values(values, brackets(values, probs, counts), around)
    out = []
    for i, c in enumerate(names):
        for p in probs:
            if (i, p) not in around:
                out.append((c, float(p), None))
                continue
            r1, r2, part = around[i, p]
            out.append((c, float(p), found[i, r1] + (found[i, r2] - found[i, r1]) * part))
    return spark.createDataFrame(out, schema).coalesce(1)


def brackets(values: DataFrame, probs: Sequence[float], counts: Sequence[int]
             ) -> list[list[tuple[float, float]]]:
    """Per column, ascending disjoint value ranges that hold the wanted ranks for certain.

    A sketch is off by at most ``RANK_ERROR`` of the rows, and its bounds are taken twice
    as far away.
    """
    away = 2 * RANK_ERROR + 2 / min(n for n in counts if n)
    asked = sorted({min(1.0, max(0.0, float(p) + d)) for p in probs for d in (-away, away)})
    found = values.approxQuantile(list(values.columns), asked, RANK_ERROR)
    out = []
    for at in found:
        by_prob, merged = dict(zip(asked, at)), []
        for p in sorted(map(float, probs)) if at else ():
            low, high = (by_prob[min(1.0, max(0.0, p + d))] for d in (-away, away))
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        out.append(merged)
    return out


def _ranked_values(values: DataFrame, bounds: list[list[tuple[float, float]]],
                   around: dict) -> dict[tuple[int, int], float]:
    """The values of the wanted ranks, from one pass over the cells."""
    # Odd places are brackets, even ones the gaps before and between them.
    place = " ".join(f"WHEN {i} THEN CASE " + " ".join(
        f"WHEN v < {number(low)} THEN {2 * k} WHEN v <= {number(high)} THEN {2 * k + 1}"
        for k, (low, high) in enumerate(own)) + f" ELSE {2 * len(own)} END"
        for i, own in enumerate(bounds) if own)
    if not place:
        return {}
    cells = (values.unpivot([], list(values.columns), "c", "v").where(F.col("v").isNotNull())
             .withColumn("i", F.substring("c", 2, 10).cast("int"))
             .withColumn("b", F.expr(f"CASE i {place} END")))
    scratch = Scratch(values.sparkSession)
    try:
        merged = scratch.write(cells.groupBy(
            "i", "b", F.when(F.col("b") % 2 == 1, F.col("v")).alias("v"))
            .agg(F.count("*").alias("n")), "rank-counts")
        spans, upto = {}, {}
        for i, b, n in merged.groupBy("i", "b").agg(F.sum("n")).orderBy("i", "b").toLocalIterator():
            low = upto.get(i, 0)
            spans.setdefault(i, []).append((b, low, low + n))
            upto[i] = low + n
        ranks = sorted({(i, r) for (i, _), (r1, r2, _) in around.items() for r in (r1, r2)})
        hit = sorted({(i, b, low) for i, r in ranks for b, low, high in spans[i] if low < r <= high})
        starts = values.sparkSession.createDataFrame(hit, "i int, b int, low bigint").coalesce(1)
        before = W.partitionBy("i", "b").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
        reached = (merged.join(F.broadcast(starts), ["i", "b"])
                   .withColumn("last", F.col("low") + F.sum("n").over(before)))
        # As plain comparisons, so that all but the rows wanted drop out early.
        by_column = {i: [r for j, r in ranks if j == i] for i, _ in ranks}
        holds = " ".join(f"WHEN {i} THEN " + " OR ".join(
            f"({r} <= last AND {r} > last - n)" for r in rs) for i, rs in by_column.items())
        rows = reached.where(f"CASE i {holds} ELSE false END").select("i", "v", "n", "last").collect()
        return {(x["i"], r): x["v"] for x in rows for r in by_column[x["i"]]
                if x["last"] - x["n"] < r <= x["last"]}
    finally:
        scratch.drop()
