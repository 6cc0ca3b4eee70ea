import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldwise.config import (CATEGORICAL, FeaturesConfig, FeatureSpec, FoldSplit, OneHotSettings)
from foldwise.errors import DataError
from foldwise.operators import encode
from foldwise.operators.quality import encoding_warnings
from foldwise.operators.table import fit_preparation
from foldwise.sources import settle as settling


def table(spark, **counts):
    rows = [(c,) for c, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "`my cat.` string")


def spec(**more):
    return FeatureSpec("my cat.", CATEGORICAL, OneHotSettings(**more))


def fit(df, **more):
    encoding, = encode.fit_encoder(df, [spec(**more)]).encodings
    return encoding


def rules(spark, df, **more):
    s = spec(**more)
    counts = encode.category_counts(df, [s.column])
    summary = encode.encoding_summary(encode.category_distribution(counts, [s]))
    return {r["rule"] for r in encoding_warnings(summary, [s]).collect()}


def test_rare_is_strictly_below(spark):
    encoding = fit(table(spark, a=95, b=3, c=2))
    assert encoding.own == ("a", "b")
    assert encoding.output_columns == (
        "my cat._OHE____other__", "my cat._OHE__a", "my cat._OHE__b")


def test_other_comes_last_and_is_zero_without_rare(spark):
    df = table(spark, a=50, b=50)
    encoding = fit(df)
    assert encoding.output_columns[-1] == "my cat._OHE____other__"
    assert df.select(*encoding.indicators()).agg(
        F.max("`my cat._OHE____other__`")).first()[0] == 0


def test_category_limit(spark):
    counts = {f"k{i:02d}": 6 for i in range(16)}
    with pytest.raises(DataError, match="maximum is 15"):
        fit(table(spark, **counts))
    counts.pop("k15")
    df = table(spark, **counts)
    assert len(fit(df).own) == 15
    assert "W2" in rules(spark, df)


def test_all_rare(spark):
    df = table(spark, **{f"k{i}": 1 for i in range(50)})
    encoding = fit(df)
    assert encoding.own == () and encoding.final_categories == ("__other__",)
    assert rules(spark, df) == {"W3", "W4"}
    assert df.select(*encoding.indicators()).distinct().collect() == [(1,)]


@pytest.mark.parametrize("counts, strict, message", [
    ({"only": 5}, False, "at least 2"),
    ({"Wheat": 5, "wheat": 5}, False, "letter case"),
    ({"Wheat": 5, "WHEAT": 5}, True, "letter case"),
    ({"__other__": 5, "a": 5}, False, "reserved"),
    ({"": 5, "a": 5}, False, "empty"),
])
def test_bad_categories(spark, counts, strict, message):
    with pytest.raises(DataError, match=message):
        encode.fit_encoder(table(spark, **counts), [spec()], strict)


def test_two_upper_forms_pass_by_default(spark):
    assert len(fit(table(spark, Wheat=5, WHEAT=5)).own) == 2


@pytest.mark.parametrize("allow", [False, True])
def test_scoring(spark, allow):
    s = FeatureSpec("c", CATEGORICAL, OneHotSettings(allow_unknown=allow))
    config = FeaturesConfig("t", (s,))
    train = spark.createDataFrame(
        [(1.0, "A")] * 50 + [(2.0, "B")] * 49 + [(3.0, "C")], "t double, c string")
    preparation, _ = fit_preparation(train, config)
    known = spark.createDataFrame([("A", 1), ("C", 2)], "c string, more int")
    rows = preparation.scoring_table(known, keep=["more"]).orderBy("more").collect()
    assert [r["c_OHE____other__"] for r in rows] == [0, 1]
    strange = spark.createDataFrame([("Z",)], "c string")
    if allow:
        assert preparation.scoring_table(strange).first()["c_OHE____other__"] == 1
    else:
        with pytest.raises(DataError, match="Z"):
            preparation.scoring_table(strange)
    for bad, message in (("c string", "empty"), ("d string", "lacks")):
        with pytest.raises(DataError, match=message):
            preparation.scoring_table(spark.createDataFrame([], bad))
    with pytest.raises(DataError, match=r"\['c'\]"):
        preparation.scoring_table(spark.createDataFrame([("A",), ("",)], "c string"))


def test_long_tail_stays_a_table(spark, monkeypatch):
    """More categories than the driver may hold: same result, kept as a table."""
    df = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string"))).alias("my cat."))
    monkeypatch.setattr(settling, "LOCAL_ROWS", 100)
    monkeypatch.setattr(settling.settle, "__defaults__", (100,))
    encoder = encode.fit_encoder(df, [spec()])
    assert not encoder.categories.local
    assert encoder.encodings[0].own == ("hot",)
    assert encoder.encodings[0].rare_count == 3000
    more = df.unionByName(spark.createDataFrame([("new",)], df.schema))
    assert [r["category"] for r in encoder.unknown_categories(more).collect()] == ["new"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "ccc", "x y", "`q`", "it's"]), min_size=5, max_size=60)
       .filter(lambda v: len(set(v)) > 1))
def test_indicators_sum_to_one(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "`my cat.` string")
    encoding = fit(df, rare_below_pct=20.0)
    rows = df.select(*encoding.indicators()).collect()
    assert len(rows) == len(values) and all(sum(r) == 1 for r in rows)
