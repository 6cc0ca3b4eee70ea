"""Regression tasks over the test tables: which columns play which part."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.config import (CATEGORICAL, NUMERIC, FeaturesConfig, FeatureSpec, FoldSplit,
                             OneHotSettings, TrainParams)
from foldwise.sources.tables import read_table


@dataclass(frozen=True)
class Task:
    """A table with its feature configuration, fold key and row id."""

    load: Callable[[SparkSession, str], DataFrame]
    config: FeaturesConfig
    fold_key: str
    row_id: tuple[str, ...]

    def params(self, builder: Callable = lambda n: LinearRegression(solver="normal"),
               **more) -> TrainParams:
        return TrainParams(estimator_builder=builder, epochs=more.pop("epochs", 10),
                           fold_split=FoldSplit(key_column=self.fold_key), **more)


def numeric(column: str) -> FeatureSpec:
    return FeatureSpec(column, NUMERIC)


def categorical(column: str, rare_below_pct: float | None = None,
                max_categories: int | None = None, allow_unknown: bool | None = None
                ) -> FeatureSpec:
    return FeatureSpec(column, CATEGORICAL,
                       OneHotSettings(rare_below_pct, max_categories, allow_unknown))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer, one row per order."""
    placed, customer = (read_table(spark, folder, t) for t in ("orders", "customer"))
    return (placed.join(customer, placed.o_custkey == customer.c_custkey)
            .withColumn("o_year", F.year("o_orderdate")))


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with empty cells: in a required column and in an unused one."""
    key = F.col("o_orderkey")
    priority = (F.when(key % 10 == 0, F.lit(None)).when(key % 10 == 1, F.lit(""))
                .otherwise(F.col("o_orderpriority")))
    return (orders(spark, folder).withColumn("o_orderpriority", priority)
            .withColumn("o_note", F.when(key % 7 == 0, F.lit("")).otherwise(F.col("c_name"))))


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").withColumn("l_year", F.year("l_shipdate"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")


def part(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").withColumn("size_label", F.col("p_size").cast("string"))


ORDERS = Task(orders, FeaturesConfig("o_totalprice", (
    numeric("c_acctbal"), categorical("o_orderpriority"), categorical("o_orderstatus"),
    categorical("c_mktsegment"))), "o_year", ("o_orderkey",))

DIRTY_ORDERS = Task(dirty_orders, ORDERS.config, "o_year", ("o_orderkey",))

#: One number and one category: least squares has a closed form in SQL.
SEGMENTS = Task(orders, FeaturesConfig("o_totalprice", (
    numeric("c_acctbal"), categorical("c_mktsegment"))), "o_year", ("o_orderkey",))

#: Two numbers: likewise.
BALANCES = Task(orders, FeaturesConfig("o_totalprice", (
    numeric("c_acctbal"), numeric("c_nationkey"))), "o_year", ("o_orderkey",))

#: One number.
BALANCE = Task(orders, FeaturesConfig("o_totalprice", (numeric("c_acctbal"),)), "o_year",
               ("o_orderkey",))

#: One state only is frequent enough to keep its column.
STATUSES = Task(orders, FeaturesConfig("o_totalprice", (
    categorical("o_orderstatus", rare_below_pct=33.5),)), "o_year", ("o_orderkey",))

LINEITEM = Task(lineitem, FeaturesConfig("l_extendedprice", (
    numeric("l_quantity"), numeric("l_discount"), numeric("l_tax"), categorical("l_returnflag"),
    categorical("l_linestatus"))), "l_year", ("l_orderkey", "l_linenumber"))

#: One number of fifty values: every cut of a tree on it can be tried in SQL.
QUANTITY = Task(lineitem, FeaturesConfig("l_extendedprice", (numeric("l_quantity"),)), "l_year",
                ("l_orderkey", "l_linenumber"))

DOCUMENTS = Task(documents, FeaturesConfig("n_chars", (
    categorical("lang", rare_below_pct=13.0),)), "source", ("doc_id",))

PART = Task(part, FeaturesConfig("p_retailprice", (
    numeric("p_size"), categorical("p_brand", rare_below_pct=4.0))), "p_type", ("p_partkey",))


#: Epochs and rate of the linear network trained by shared steps.
DESCENT_EPOCHS, DESCENT_RATE = 6, 0.05
