"""Feature attribution: exact for linear models, permutation Shapley for any other."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.hashing import HASH_RANGE, hash32, row_digest
from foldwise.functions.names import q, qs
from foldwise.operators.table import VECTOR_COLUMN, ModelTable

#: Rows explained and rows of background, at most.
SAMPLE_ROWS = 100
_FILTER_FROM_ROWS = 100_000
_OVERSAMPLE = 20
#: Rows a task holds before it passes them on.
_COALITION_ROWS = 4096


def sample_rows(df: DataFrame, row_id: Sequence[str], size: int, seed: int,
                rows: int | None = None) -> DataFrame:
    """The ``size`` rows with the smallest seeded digest of their id.

    On a large table the per-task candidates alone would be many, so a threshold on
    the same digest drops nearly all rows first. The result does not depend on it:
    if too few rows pass, all are ranked.
    """
    rows = df.count() if rows is None else rows
    pool = df
    if rows > max(_FILTER_FROM_ROWS, size * _OVERSAMPLE):
        limit = int(HASH_RANGE * min(1.0, size * _OVERSAMPLE / rows))
        near = df.where(hash32(seed, *qs(row_id)) < F.lit(limit))
        if near.limit(size).count() == size:
            pool = near
    return pool.orderBy(row_digest(seed, *qs(row_id)), *qs(row_id)).limit(size)


def linear_attribution(df: DataFrame, row_id: Sequence[str], features: Sequence[str],
                       weights: Sequence[float], means: Sequence[float]) -> DataFrame:
    """``(row id, feature, phi)`` with ``phi = w_j * (x_j - mean of x_j)``."""
    parts = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.lit(float(w)) * (q(f) - F.lit(float(m))))
                 .alias("phi")) for f, w, m in zip(features, weights, means)]))
    return df.select(*qs(row_id), parts.alias("p")).select(*qs(row_id), "p.feature", "p.phi")


def linear_importance(df: DataFrame, features: Sequence[str], weights: Sequence[float],
                      means: Sequence[float]) -> DataFrame:
    """Mean absolute attribution over all rows, without a row per feature."""
    wide = df.agg(*[F.avg(F.abs(F.lit(float(w)) * (q(f) - F.lit(float(m))))).alias(f"f{i}")
                    for i, (f, w, m) in enumerate(zip(features, weights, means))])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"f{i}").alias("importance"))
        for i, f in enumerate(features)])).alias("r")).select("r.*")


def importance(attribution: DataFrame) -> DataFrame:
    """Features ranked by mean absolute attribution."""
    return (attribution.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def _coalitions(batches: Iterator[pd.DataFrame], background: np.ndarray, permutations: int,
                seed: int) -> Iterator[pd.DataFrame]:
    """Rows between background and sample, features switched on in permuted order.

    Every order is used forwards and backwards. ``added`` is the feature switched on
    last, ``next`` the one to come.
    """
    d, rows = background.shape[1], len(background)
    parts: list[pd.DataFrame] = []
    for batch in batches:
        for sample, x in zip(batch["sample"], batch["x"]):
            x = np.asarray(x, dtype=np.float64)
            for p in range(permutations):
                rng = np.random.default_rng([seed, int(sample), p // 2])
                order = rng.permutation(d)
                order = order[::-1] if p % 2 else order
                current = background.copy()
                for step in range(d + 1):
                    if step:
                        current[:, order[step - 1]] = x[order[step - 1]]
                    parts.append(pd.DataFrame({
                        "sample": np.full(rows, sample),
                        "added": np.full(rows, order[step - 1] if step else -1),
                        "next": np.full(rows, order[step] if step < d else -1),
                        "x": list(current.copy())}))
                    if len(parts) * rows >= _COALITION_ROWS:
                        yield pd.concat(parts, ignore_index=True)
                        parts = []
    if parts:
        yield pd.concat(parts, ignore_index=True)


def permutation_shapley(model: Model, table: ModelTable, seed: int = 0,
                        permutations: int = 10, size: int = SAMPLE_ROWS,
                        rows: int | None = None, prediction: str = "prediction") -> DataFrame:
    """``(row id, feature, phi)`` for a sample of rows and any fitted model.

    Sample and background hold at most ``size`` rows each, whatever the table, so
    the scored rows are bounded by ``2 * size**2 * permutations * (d + 1)``. They are
    spread over tasks and scored by one ``transform``.
    """
    if permutations < 2 or permutations % 2:
        raise ValueError("permutations must be an even number of at least 2")
    features, ids = list(table.features), list(table.row_id)
    spark = table.df.sparkSession
    rows = table.df.count() if rows is None else rows
    wanted = table.df.select(*qs(ids), F.array(*[q(c).cast("double") for c in features]).alias("x"))
    background = np.array(
        [r["x"] for r in sample_rows(wanted, ids, size, seed + 1, rows).collect()])
    sample = sample_rows(wanted, ids, size, seed, rows).collect()
    schema = T.StructType([*wanted.schema.fields, T.StructField("sample", T.IntegerType())])
    local = spark.createDataFrame([(*r, i) for i, r in enumerate(sample)], schema)
    expand = partial(_coalitions, background=background, permutations=permutations, seed=seed)
    coalitions = (local.select("sample", "x").repartition(len(sample), "sample")
                  .mapInPandas(expand, "sample int, added int, next int, x array<double>")
                  .withColumn(VECTOR_COLUMN, array_to_vector("x")))
    scored = model.transform(coalitions).select("sample", "added", "next", q(prediction).alias("v"))
    # A value counts for the feature just added and against the one to come.
    share = F.explode(F.array(F.struct(F.col("added").alias("f"), F.col("v").alias("c")),
                              F.struct(F.col("next").alias("f"), (-F.col("v")).alias("c"))))
    phi = (scored.select("sample", share.alias("s")).where("s.f >= 0")
           .groupBy("sample", "s.f").agg((F.sum("s.c") / (permutations * len(background)))
                                         .alias("phi")))
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("f") + 1)
    return (phi.join(F.broadcast(local.select(*qs(ids), "sample")), "sample")
            .select(*qs(ids), names.alias("feature"), "phi"))
