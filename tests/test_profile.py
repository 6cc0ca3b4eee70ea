import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldwise.operators import profile, summaries


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(8)
    n = 500
    out = pd.DataFrame({f"n {i}": rng.normal(i, 1 + i, n) for i in range(7)})
    out["n 1"] = out["n 0"] * 2 + rng.normal(0, 0.1, n)
    out.loc[::5, "n 2"] = np.nan
    out["flat.col"] = 3.0
    out["t"] = rng.choice(["a", "bb", "it's"], n)
    return out


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf)


def test_correlations_wide_and_narrow(spark, pdf, df):
    want = pdf.select_dtypes("number").corr()
    wide = profile.correlations(df).collect()
    narrow = profile.correlations(df.select("`n 0`", "`n 1`", "`n 2`", "`flat.col`")).collect()
    assert len(wide) == 28 and len(narrow) == 6
    for r in [*wide, *narrow]:
        if "flat.col" in (r["left"], r["right"]):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(want.loc[r["left"], r["right"]], abs=1e-9)


def test_numbers(pdf, df):
    stats = profile.numeric_stats(df).toPandas().set_index("column")
    for c in pdf.select_dtypes("number"):
        assert stats["mean"][c] == pytest.approx(pdf[c].mean())
        assert stats["std"][c] == pytest.approx(pdf[c].std(), abs=1e-12)
    shape = profile.shape(df).toPandas().set_index("column")
    x = pdf["n 2"].dropna()
    assert shape["mad"]["n 2"] == pytest.approx((x - x.median()).abs().median())
    histogram = profile.histogram(df, 4).toPandas()
    assert histogram.groupby("column")["count"].sum()["n 2"] == 400
    assert histogram[histogram["column"] == "flat.col"]["bin"].tolist() == [0]


def test_variables(pdf, df):
    exact = profile.variables(df).toPandas().set_index("column")
    assert exact["missing"]["n 2"] == 100 and exact["count"]["n 2"] == 400
    assert exact["distinct"]["t"] == 3 and exact["unique"]["n 0"] == 500
    near = profile.variables(df, exact=False).toPandas().set_index("column")
    assert near["distinct"]["n 0"] == pytest.approx(500, rel=0.05)
    alerts = {(r["column"], r["alert"]) for r in profile.alerts(df).collect()}
    assert {("flat.col", "constant"), ("n 0", "unique"), ("n 2", "missing")} <= alerts


def test_overview_counts_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "a"), (1, "a")],
                               "k int, v string")
    row = profile.overview(df).first()
    assert (row["rows"], row["duplicate_rows"], row["missing_cells"]) == (5, 2, 1)


def test_sections_by_type(spark):
    text = spark.createDataFrame([("a",)], "v string")
    assert "correlations" not in profile.section_names(text)
    assert {n: d.count() for n, d in profile.profile(text).items()}["variables"] == 1


def test_overview_compares_rows_not_fingerprints(spark):
    """Nulls that change places, and texts that join alike, are different rows."""
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), ("ab", "c", 0.0), ("a", "bc", -0.0),
            ("a", "bc", 0.0), (None, None, float("nan")), (None, None, None)]
    got = profile.overview(spark.createDataFrame(rows, "x string, `y.z` string, v double")).first()
    assert (got["rows"], got["columns"], got["missing_cells"], got["duplicate_rows"]) == (8, 3, 9, 3)
    empty = profile.overview(spark.createDataFrame([], "x string, v double")).first()
    assert (empty["rows"], empty["missing_cells"], empty["duplicate_rows"]) == (0, 0, 0)
    assert empty["missing_pct"] is None


def test_missing_patterns(spark):
    rows = [(1.0, None, "x"), (None, None, "x"), (2.0, "b", ""), (float("nan"), None, "x")]
    df = spark.createDataFrame(rows, "a double, `b b` string, c string")
    got = {r["pattern"]: (r["columns_missing"], r["count"], r["pct"]) for r in profile.missing_patterns(df).collect()}
    assert got == {"010": (1, 1, 25.0), "110": (2, 2, 50.0), "000": (0, 1, 25.0)}
    pairs = {(r["left"], r["right"]): (r["both"], r["either"]) for r in profile.missing_together(df).collect()}
    assert pairs == {("a", "b b"): (2, 3), ("a", "c"): (0, 2), ("b b", "c"): (0, 3)}
    assert profile.missing_patterns(df.where("false")).count() == 0
    assert profile.missing_together(df.select("a")).count() == 0


@pytest.mark.parametrize("counters", [3, 7, 4096])
def test_heavy_values_are_exact(spark, counters):
    """Skewed, even, unique and empty columns, whatever a summary can hold."""
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({"skew": rng.zipf(1.6, n).clip(max=200).astype(str),
                        "it's.even": rng.integers(0, 40, n), "id": np.arange(n),
                        "none": pd.Series([None] * n, dtype=object),
                        "gaps": np.where(rng.random(n) < 0.3, None, rng.choice(["a", "b"], n))})
    schema = "skew string, `it's.even` bigint, id bigint, none string, gaps string"
    df = spark.createDataFrame(pdf, schema).repartition(5)
    got = summaries.heavy_values(df, 4, counters)
    assert {tuple(r) for r in got.select("column", "value", "count", "rank").collect()} == {
        tuple(r) for r in profile.top_values(df, 4).select("column", "value", "count", "rank")
        .collect()}
    assert summaries.heavy_values(df.where("false"), 4, counters).count() == 0


def test_summary_keeps_its_bound():
    rng = np.random.default_rng(2)
    values = rng.zipf(1.3, 20_000).clip(max=5000).astype(str)
    batches = [pa.RecordBatch.from_pydict({"c0": pa.array(values[a:a + 500])})
               for a in range(0, len(values), 500)]
    out = pd.concat(b.to_pandas() for b in summaries._frequent(iter(batches), 50))
    lost = int(out["n"][out["value"].isna()].iloc[0])
    held, true = out.dropna().set_index("value")["n"], pd.Series(values).value_counts()
    assert len(held) <= 50 and 0 < lost <= len(values) / 51
    gap = true - held.reindex(true.index).fillna(0)
    assert gap.min() >= 0 and gap.max() <= lost


def test_extremes_and_alerts_from_summaries(df):
    ids = df.withColumn("id", F.monotonically_increasing_id())
    for near, exact in ((summaries.extreme_values(ids, 3), profile.extreme_values(ids, 3)),
                        (summaries.alerts(ids, summaries.distinct_sketches(ids)),
                         profile.alerts(ids))):
        assert {tuple(r) for r in near.collect()} == {tuple(r) for r in
                                                      exact.select(*near.columns).collect()}


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("a"),
                                    F.when(F.col("id") % 2 == 0, "x").alias("b"))
    parts = [summaries.distinct_sketches(df.where(F.pmod(F.hash("a"), F.lit(3)) == i))
             for i in range(3)]
    got = {r["column"]: r for r in summaries.variables(summaries.merged_sketches(parts)).collect()}
    assert abs(got["a"]["distinct"] - 20_000) < 800 and got["b"]["distinct"] == 1
    assert got["b"]["missing"] == 30_000 and got["a"]["count"] == 60_000
