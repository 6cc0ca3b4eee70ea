import numpy as np
import pandas as pd
import pytest

from foldwise.operators import ordering
from foldwise.operators.ordering import dense_position, exact_quantiles, running_totals

N = 20_000


@pytest.mark.parametrize("rows_per_range", [10**6, 1000])
def test_exact_quantiles(spark, rows_per_range):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({
        "a b": rng.normal(size=N), "nul": np.full(N, np.nan),
        "hot": np.where(rng.random(N) < 0.4, 7.0, rng.integers(0, 50, N)).astype(float)})
    pdf.loc[::7, "a b"] = np.nan
    probs = (0, 0.05, 0.25, 0.5, 0.75, 0.95, 1)
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(
        spark.createDataFrame(pdf), pdf.columns, probs, rows_per_range).collect()}
    for c in ("a b", "hot"):
        for p in probs:
            assert got[c, p] == pytest.approx(np.nanquantile(pdf[c], p), abs=1e-12)
    assert got["nul", 0.5] is None


@pytest.mark.parametrize("order, within", [
    (["id"], []), (["s"], []), (["id"], ["g"]), (["s", "id"], ["g"])])
def test_dense_position(spark, order, within):
    ids = np.random.default_rng(1).permutation(N)
    pdf = pd.DataFrame({"id": ids, "g": np.where(ids % 3 == 0, "hot", (ids % 5).astype(str)),
                        "s": [f"k{i:06d}" for i in ids]})
    want = pdf.sort_values(within + order)["id"].to_numpy()
    got = dense_position(spark.createDataFrame(pdf), order, "pos", N, within, 1000)
    got = got.toPandas().sort_values("pos")
    assert (got["pos"].to_numpy() == np.arange(N)).all() and (got["id"].to_numpy() == want).all()


def test_running_totals_agree(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame(
        {"k": [f"f{i:05d}" for i in range(5000)], "n": rng.integers(1, 9, 5000)}))
    one = running_totals(df, "k", "n", "upto", 5000).orderBy("k").toPandas()["upto"]
    many = running_totals(df, "k", "n", "upto", 5000, 200).orderBy("k").toPandas()["upto"]
    assert (one == many).all()


def test_quantiles_of_many_columns_take_no_more_jobs(spark):
    """Sketch and brackets serve all columns at once, and give exact values."""
    rng = np.random.default_rng(4)
    n = 4000
    pdf = pd.DataFrame({f"c {i}": rng.normal(size=n).round(i % 4) for i in range(9)})
    pdf.loc[::3, "c 4"] = np.nan
    pdf["none"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    probs, jobs = [0.0, 0.05, 0.5, 0.95, 1.0], {}
    for names in (["c 0"], list(pdf.columns)):
        group = f"quantiles-{len(names)}"
        spark.sparkContext.setJobGroup(group, "")
        got = {(r["column"], r["prob"]): r["value"]
               for r in ordering.exact_quantiles(df, names, probs, rows_per_range=500).collect()}
        jobs[len(names)] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        for c in names:
            for p in probs:
                want = pdf[c].quantile(p) if c != "none" else None
                assert got[c, p] == (want if want is None else pytest.approx(want, abs=1e-12))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert abs(jobs[10] - jobs[1]) <= 2 and jobs[1] > 0


def test_brackets_hold_their_ranks(spark, monkeypatch):
    """However coarse the sketch is."""
    monkeypatch.setattr(ordering, "RANK_ERROR", 0.05)
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rng.integers(0, 40, 3000).astype(float), "b": rng.exponential(size=3000)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = ordering.exact_quantiles(df, ["a", "b"], [0.25, 0.3, 0.5, 0.99], rows_per_range=10).collect()
    assert all(r["value"] == pytest.approx(pdf[r["column"]].quantile(r["prob"]), abs=1e-12) for r in got)
