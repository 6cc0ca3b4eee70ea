import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.config import FOLD_COLUMN, FoldSplit
from foldwise.operators import folds
from foldwise.operators.quality import fold_warnings


def sizes(spark, counts):
    return spark.createDataFrame(list(counts.items()),
                                 f"{FOLD_COLUMN} string, evaluation_rows bigint")


def pairwise_gini(x):
    x = np.asarray(x, dtype=float)
    return 0.5 * np.abs(np.subtract.outer(x, x)).mean() / x.mean()


@pytest.mark.parametrize("counts, gini, label", [
    ({"a": 50, "b": 50}, 0.50, "moderately_imbalanced"),
    ({"a": 99, "b": 1}, 0.99, "highly_imbalanced"),
    ({"a": 1, "b": 99}, 0.01, "relatively_balanced"),
    ({str(i): 10 for i in range(5)}, 0.40, "relatively_balanced"),
    ({"a": 7}, None, "unknown"),
])
def test_balance(spark, counts, gini, label):
    row = folds.fold_stats(sizes(spark, counts)).first()
    assert row["balance"] == label and row["folds"] == len(counts)
    assert row["gini"] is None if gini is None else row["gini"] == pytest.approx(gini)


@pytest.mark.parametrize("in_one_task", [1_000_000, 10])
def test_gini_equals_pairwise_form(spark, monkeypatch, in_one_task):
    monkeypatch.setattr(folds, "_ORDERED_IN_ONE_TASK", in_one_task)
    rng = np.random.default_rng(1)
    counts = {f"f{i:03d}": int(n) for i, n in enumerate(rng.integers(1, 12, 60))}
    row = folds.fold_stats(sizes(spark, counts)).first()
    codes = np.repeat(np.arange(60), list(counts.values()))
    assert row["gini"] == pytest.approx(pairwise_gini(codes))
    assert row["fold_size_gini"] == pytest.approx(pairwise_gini(list(counts.values())))


@pytest.mark.parametrize("k, rule", [(2, "W5"), (31, "W6")])
def test_fold_count_warnings(spark, k, rule):
    stats = folds.fold_stats(sizes(spark, {f"{i:02d}": 10 for i in range(k)}))
    assert rule in {r["rule"] for r in fold_warnings(stats).collect()}


def test_key_text(spark):
    df = spark.createDataFrame([(2003.0,), (10.0,)], "k double")
    got = folds.assign_folds(df, FoldSplit(key_column="k"), 0, []).orderBy(FOLD_COLUMN)
    assert [r[FOLD_COLUMN] for r in got.collect()] == ["10.0", "2003.0"]


def test_hash_folds_ignore_partitioning(spark):
    df = spark.range(2000)
    first = folds.assign_folds(df, FoldSplit(folds=7), 3, ["id"])
    second = folds.assign_folds(df.repartition(5), FoldSplit(folds=7), 3, ["id"])
    assert first.exceptAll(second).isEmpty()
    assert first.select(FOLD_COLUMN).distinct().count() == 7


def test_train_and_evaluation_sides_partition_the_rows(spark):
    df = spark.range(500).withColumn(FOLD_COLUMN, (F.col("id") % 3).cast("string"))
    for r in folds.fold_table(folds.fold_sizes(df).df).collect():
        assert r["train_rows"] == df.where(F.col(FOLD_COLUMN) != r[FOLD_COLUMN]).count()
        assert r["train_rows"] + r["evaluation_rows"] == 500
