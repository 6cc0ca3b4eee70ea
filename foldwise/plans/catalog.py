"""Registered queries, each over whole tables. SQL counterparts are in ``oracle``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.config import (FOLD_COLUMN, OTHER_CATEGORY, TARGET_COLUMN, EarlyStopping, FoldSplit)
from foldwise.functions import text
from foldwise.functions.hashing import hash_bucket
from foldwise.functions.metrics import all_metrics
from foldwise.functions.names import q, qs
from foldwise.operators import (baseline, boosting, cv, encode, explain, folds, linear, prepare,
                                profile, quality, summaries, tree_paths)
from foldwise.operators.boosting import BoostedTreesRegressor
from foldwise.operators.mlp import DenseRegressor
from foldwise.operators.ordering import dense_position
from foldwise.operators.table import ModelTable, fit_preparation, prepare_training
from foldwise.plans import bindings as b
from foldwise.plans import report
from foldwise.plans.pipeline import FOLD_TABLE, score, train_and_evaluate
from foldwise.sources import outputs, store
from foldwise.sources.settle import shared_folder, spread, write_table
from foldwise.sources.tables import read_csv, read_table

SEED = 42
Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round doubles: the order of a distributed sum is not fixed."""
    return df.withColumns({c: F.round(q(c), n) for c, n in places.items()})


def model_table(spark: SparkSession, folder: str, task: b.Task) -> ModelTable:
    return prepare_training(task.load(spark, folder), task.config, task.params(seed=SEED),
                            task.row_id)[1]


def fold_frame(spark: SparkSession, folder: str, task: b.Task) -> DataFrame:
    """Target and fold key of the complete cases: enough for fold statistics."""
    df = task.load(spark, folder)
    clean = prepare.complete_cases(df, prepare.required_columns(task.config, task.fold_key))
    return clean.select(q(task.config.target).cast("double").alias(TARGET_COLUMN),
                        q(task.fold_key).cast("string").alias(FOLD_COLUMN))


def required_input(spark: SparkSession, folder: str, task: b.Task) -> DataFrame:
    return prepare.profiled_columns(
        task.load(spark, folder), prepare.required_columns(task.config, task.fold_key))


def distribution(spark: SparkSession, folder: str, task: b.Task) -> DataFrame:
    clean = prepare.complete_cases(
        task.load(spark, folder), prepare.required_columns(task.config, task.fold_key))
    specs = task.config.categorical
    return encode.category_distribution(
        encode.category_counts(clean, [s.column for s in specs]), specs)


# ------------------------------------------------------------ filters and projections

@query
def impute_funnel(spark, folder):
    task = b.DIRTY_ORDERS
    out = prepare.funnel(task.load(spark, folder),
                         prepare.required_columns(task.config, task.fold_key))
    return rounded(out.withColumn("warned", F.col("remaining_pct") < quality.MIN_REMAINING_PCT),
                   remaining_pct=6)


@query
def impute_rows(spark, folder):
    task = b.DIRTY_ORDERS
    required = prepare.required_columns(task.config, task.fold_key)
    clean = prepare.complete_cases(task.load(spark, folder), required)
    return prepare.number_rows(
        clean.select("o_orderkey", *qs(required), "o_note"), task.row_id)


@query
def empty_columns(spark, folder):
    task = b.DIRTY_ORDERS
    return (prepare.missing_by_column(task.load(spark, folder), task.config.columns)
            .withColumn("refused", F.col("missing") > 0))


@query
def preprocessed_table(spark, folder):
    return model_table(spark, folder, b.ORDERS).df


@query
def preprocessed_shape(spark, folder):
    full = model_table(spark, folder, b.PART).full_dataset
    return full.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(full.columns)))


# ------------------------------------------------------------ encoding

@query
def category_distribution(spark, folder):
    rank = F.row_number().over(
        W.partitionBy("feature").orderBy(F.desc("count"), F.asc("category")))
    return rounded(distribution(spark, folder, b.ORDERS)
                   .select("feature", "category", "count", "pct", rank.alias("rank")), pct=6)


@query
def rare_categories(spark, folder):
    both = [distribution(spark, folder, t) for t in (b.DOCUMENTS, b.PART)]
    return rounded(reduce(DataFrame.unionByName, both), pct=6)


@query
def encoding_summary(spark, folder):
    both = [encode.encoding_summary(distribution(spark, folder, t))
            for t in (b.DOCUMENTS, b.PART, b.STATUSES)]
    return rounded(reduce(DataFrame.unionByName, both), other_pct=6)


@query
def other_breakdown(spark, folder):
    return rounded(report.other_breakdown(distribution(spark, folder, b.PART)),
                   pct=6, share_of_other_pct=6)


@query
def final_categories(spark, folder):
    final = encode.final_distribution(distribution(spark, folder, b.PART))
    # Few rows per feature: fitting refuses more than the configured number.
    ordinal = F.row_number().over(W.partitionBy("feature").orderBy("category")) - 1
    return rounded(final.withColumn("ordinal", ordinal), pct=6)


@query
def known_categories(spark, folder):
    return (distribution(spark, folder, b.PART)
            .select("feature", F.explode(F.array("category", "final_category")).alias("category"))
            .distinct())


@query
def case_collision(spark, folder):
    df = read_table(spark, folder, "orders")
    mixed = df.withColumn("o_orderpriority", F.when(
        F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority"))
        .otherwise(F.col("o_orderpriority")))
    return encode.case_collisions(
        encode.category_counts(mixed, ["o_orderpriority", "o_orderstatus"]))


@query
def unknown_categories(spark, folder):
    df = b.part(spark, folder)
    spec = b.categorical("size_label", rare_below_pct=0.5, max_categories=60)
    encoder = encode.fit_encoder(df.where("p_size <= 40"), [spec])
    return encoder.unknown_categories(df)


@query
def unknown_to_other(spark, folder):
    df = b.part(spark, folder)
    spec = b.categorical("size_label", rare_below_pct=0.5, max_categories=60, allow_unknown=True)
    encoding, = encode.fit_encoder(df.where("p_size <= 40"), [spec]).encodings
    return df.select("p_partkey", "size_label", encoding.final_category.alias("final_category"))


@query
def one_hot(spark, folder):
    preparation, clean = fit_preparation(
        b.ORDERS.load(spark, folder), b.ORDERS.config, b.ORDERS.fold_key)
    return clean.select("o_orderkey", *preparation.encoder.columns())


@query
def one_hot_other(spark, folder):
    preparation, clean = fit_preparation(
        b.DOCUMENTS.load(spark, folder), b.DOCUMENTS.config, b.DOCUMENTS.fold_key)
    return clean.select("doc_id", *preparation.encoder.columns())


# ------------------------------------------------------------ folds and samples

@query
def hash_folds(spark, folder):
    df = read_table(spark, folder, "orders").select("o_orderkey")
    return folds.assign_folds(df, FoldSplit(folds=5), SEED, ["o_orderkey"])


@query
def hash_fold_sizes(spark, folder):
    return folds.fold_table(folds.fold_sizes(hash_folds(spark, folder)).df)


@query
def fold_sizes(spark, folder):
    return folds.fold_table(folds.fold_sizes(fold_frame(spark, folder, b.ORDERS)).df)


@query
def fold_gini(spark, folder):
    tasks = {"orders": b.ORDERS, "lineitem": b.LINEITEM, "documents": b.DOCUMENTS, "part": b.PART}
    parts = [folds.fold_stats(folds.fold_sizes(fold_frame(spark, folder, t)).df)
             .withColumn("task", F.lit(name)) for name, t in tasks.items()]
    return rounded(reduce(DataFrame.unionByName, parts), gini=9, fold_size_gini=9)


@query
def holdout_split(spark, folder):
    df = read_table(spark, folder, "orders").select("o_orderkey")
    return df.withColumn("is_validation", folds.holdout(SEED, 0.2, ["o_orderkey"]))


@query
def sample_rows(spark, folder):
    df = b.documents(spark, folder).select("doc_id", "n_chars")
    return explain.sample_rows(df, ["doc_id"], explain.SAMPLE_ROWS, SEED)


# ------------------------------------------------------------ measures and baseline

@query
def metrics_all(spark, folder):
    df = read_table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_quantity").alias("y"),
        (F.col("l_extendedprice") / 1500).alias("pred"))
    return rounded(df.groupBy("l_returnflag").agg(*all_metrics(F.col("y"), F.col("pred"))),
                   mse=6, rmse=6, mae=6, huber_loss=6)


@query
def train_means(spark, folder):
    sums = baseline.fold_target_sums(fold_frame(spark, folder, b.ORDERS))
    return rounded(baseline.train_means(sums).df, train_mean=4)


@query
def baseline_by_fold(spark, folder):
    return rounded(baseline.baseline_by_fold(fold_frame(spark, folder, b.ORDERS)),
                   train_mean=4, baseline_mse=0, baseline_rmse=4, baseline_mae=4,
                   baseline_huber_loss=4)


@query
def baseline_summary(spark, folder):
    rows = baseline.baseline_by_fold(fold_frame(spark, folder, b.ORDERS))
    out = cv.summarise_folds(rows)
    return rounded(out.where(F.col("measure") != "baseline_mse"), mean=4, std=4)


# ------------------------------------------------------------ least squares

def _ols(spark, folder, task) -> tuple[ModelTable, cv.CrossValidation]:
    table = model_table(spark, folder, task)
    return table, cv.cross_validate_ols(table)


@query
def ols_cv_folds(spark, folder):
    results = _ols(spark, folder, b.SEGMENTS)[1].fold_results
    return rounded(results.drop("train_epochs"), **{
        f"{side}_{m}": 0 if m == "mse" else 3 for side in ("train", "evaluation", "baseline")
        for m in ("mse", "rmse", "mae", "huber_loss")})


@query
def ols_two_numbers(spark, folder):
    results = _ols(spark, folder, b.BALANCES)[1].fold_results
    return rounded(results.select("fold", "train_rmse", "evaluation_rmse", "evaluation_mae"),
                   train_rmse=3, evaluation_rmse=3, evaluation_mae=3)


@query
def ols_summary(spark, folder):
    results = _ols(spark, folder, b.SEGMENTS)[1].fold_results
    kept = F.col("measure").isin("evaluation_rmse", "train_rmse", "baseline_rmse",
                                 "evaluation_mae", "train_mae", "baseline_mae")
    return rounded(cv.summarise_folds(results).where(kept), mean=3, std=3)


@query
def oof_deviation(spark, folder):
    oof = cv.with_deviation(_ols(spark, folder, b.SEGMENTS)[1].oof)
    placed = dense_position(oof, ["row_id"], "sample_index", oof.count(), within=["fold_key"])
    return rounded(placed, y_true=2, fold_model_y_pred=3, deviation=3)


@query
def fold_report(spark, folder):
    results = _ols(spark, folder, b.SEGMENTS)[1].fold_results
    return report.fold_table(results, "mae", "rmse", "o_year")


@query
def score_ols(spark, folder):
    task = b.SEGMENTS
    table = model_table(spark, folder, task)
    intercept, weights, _ = linear.fit_all(table.df, table.features)
    scored = table.df.select("row_id", linear.linear_prediction(
        intercept, weights, table.features).alias("model_prediction"))
    return rounded(scored, model_prediction=3)


@query
def scored_input(spark, folder):
    """Predictions made elsewhere, attached to their input rows by row id."""
    raw = b.SEGMENTS.load(spark, folder).select("o_orderkey", "c_acctbal", "c_mktsegment")
    predictions = score_ols(spark, folder)
    return raw.join(predictions, raw.o_orderkey == predictions.row_id, "left").drop("row_id")


@query
def linear_attribution(spark, folder):
    table = model_table(spark, folder, b.BALANCES)
    _, weights, means = linear.fit_all(table.df, table.features)
    sample = explain.sample_rows(table.df, table.row_id, explain.SAMPLE_ROWS, SEED)
    return rounded(explain.linear_attribution(
        sample, table.row_id, table.features, weights, means), phi=3)


@query
def linear_importance(spark, folder):
    table = model_table(spark, folder, b.BALANCES)
    _, weights, means = linear.fit_all(table.df, table.features)
    out = explain.linear_importance(table.df, table.features, weights, means)
    # A row per feature, so one ordering window is small.
    rank = F.row_number().over(W.orderBy(F.desc("importance"), "feature"))
    return rounded(out.withColumn("rank", rank), importance=3)


# ------------------------------------------------------------ whole runs, stored and read back

_runs: dict[tuple[str, str], str] = {}


def finished_run(spark: SparkSession, folder: str) -> str:
    """A stored run over all orders: trained once per session and table folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _runs:
        path = f"{shared_folder(spark)}/foldwise-run-{uuid.uuid4().hex}"
        task = b.SEGMENTS
        train_and_evaluate(task.load(spark, folder), task.config,
                           task.params(seed=SEED, profile=False), path, task.row_id)
        _runs[key] = path
    return _runs[key]


def _stored_score(spark, folder, check: str) -> DataFrame:
    path = finished_run(spark, folder)
    rows = b.SEGMENTS.load(spark, folder).select("o_orderkey", "c_acctbal", "c_mktsegment")
    out = f"{path}/scored-{check}"
    outputs.write_scored(score(rows, path, check=check), out, "parquet")
    return rounded(spark.read.parquet(out), model_prediction=3)


@query
def score_stored(spark, folder):
    """Train, store, load, score and write; then read what was written."""
    return _stored_score(spark, folder, "first")


@query
def score_stored_inline(spark, folder):
    return _stored_score(spark, folder, "inline")


@query
def run_oof(spark, folder):
    """The out-of-fold file of a run."""
    run = store.current_run(finished_run(spark, folder))
    df = read_csv(spark, f"{run}/oof_predictions", {
        "sample_id": str, "fold_key": str, "y_true": float, "fold_model_y_pred": float})
    return rounded(df, y_true=2, fold_model_y_pred=3)


@query
def run_fold_measures(spark, folder):
    results = store.read_report(finished_run(spark, folder), "fold_measures")
    return rounded(results.drop("train_epochs"), **{
        f"{side}_{m}": 0 if m == "mse" else 3 for side in ("train", "evaluation", "baseline")
        for m in ("mse", "rmse", "mae", "huber_loss")})


@query
def run_preprocessing_page(spark, folder):
    return store.read_report(finished_run(spark, folder), "preprocessing_page")


@query
def run_fold_table(spark, folder):
    """The fold table file of a run."""
    run = store.current_run(finished_run(spark, folder))
    path = f"{run}/{FOLD_TABLE}"
    names = spark.read.option("header", True).csv(path).columns
    whole = ("fold key (o_year)", "train epochs count")
    table = read_csv(spark, path, {
        c: int if c in whole else str if c.endswith("size") else float for c in names})
    return rounded(table, **{c: 0 for c in names if "loss" in c})


@query
def run_summary_page(spark, folder):
    """The first page of a run, but for the time it took."""
    page = store.read_report(finished_run(spark, folder), "summary_page")
    return page.where("key <> 'pipeline execution duration'")


@query
def run_importance(spark, folder):
    """Importance of the number among the features, over all rows of the run."""
    table = store.read_report(finished_run(spark, folder), "importance")
    return rounded(table.where("feature = 'c_acctbal'"), importance=3)


@query
def holdout_fit(spark, folder):
    """Least squares with early stopping: fitted on the rows that are not held out."""
    task = b.BALANCE
    params = task.params(lambda n: LinearRegression(solver="normal"), seed=SEED,
                         early_stopping=EarlyStopping(0.2, 2))
    table = model_table(spark, folder, task)
    model = cv.fit_model(params, cv.training_vectors(table, params), 1)
    fitted = [(float(model.intercept), float(model.coefficients[0]))]
    return rounded(spark.createDataFrame(fitted, "intercept double, slope double"),
                   intercept=2, slope=4)


# ------------------------------------------------------------ the same over many ranges

_FEW_ROWS = 700  # forces many ranges; the default leaves test tables in one


@query
def oof_deviation_ranges(spark, folder):
    oof = cv.with_deviation(_ols(spark, folder, b.SEGMENTS)[1].oof)
    placed = dense_position(oof, ["row_id"], "sample_index", oof.count(), within=["fold_key"],
                            rows_per_range=_FEW_ROWS)
    return rounded(placed, y_true=2, fold_model_y_pred=3, deviation=3)


@query
def profile_quantiles_ranges(spark, folder):
    return rounded(profile.quantiles(_lineitem_numbers(spark, folder), _FEW_ROWS), q05=6, q25=6,
                   q50=6, q75=6, q95=6, iqr=6, range=6)


@query
def profile_shape_ranges(spark, folder):
    return rounded(profile.shape(_lineitem_numbers(spark, folder), _FEW_ROWS), skewness=6,
                   kurtosis=6, mad=6)


# ------------------------------------------------------------ warnings and report

@query
def warnings_report(spark, folder):
    task = b.DIRTY_ORDERS
    found = [quality.funnel_warnings(prepare.funnel(
        task.load(spark, folder), prepare.required_columns(task.config, task.fold_key)))]
    for task in (b.DOCUMENTS, b.PART, b.STATUSES):
        found.append(quality.encoding_warnings(
            encode.encoding_summary(distribution(spark, folder, task)), task.config.categorical))
    two = b.lineitem(spark, folder).select(F.col("l_linestatus").alias(FOLD_COLUMN))
    many = b.orders(spark, folder).select(
        F.concat_ws("-", "o_year", "c_mktsegment").alias(FOLD_COLUMN))
    for keys in (two, many):
        found.append(quality.fold_warnings(folds.fold_stats(folds.fold_sizes(keys).df)))
    return report.warnings_page(quality.warnings_table(*found))


@query
def display_texts(spark, folder):
    task = b.DIRTY_ORDERS
    required = prepare.required_columns(task.config, task.fold_key)
    funnel = prepare.funnel(task.load(spark, folder), required)
    return funnel.select(F.explode(F.array(
        report.entry("imputation funnel", text.funnel_text(
            F.col("rows_before"), F.col("rows_after"), F.col("remaining_pct"))),
        report.entry("dataset size", text.shape_text(F.col("rows_after"), F.lit(len(required)))),
        report.entry("warnings raised", text.warning_count_text(
            (F.col("remaining_pct") < quality.MIN_REMAINING_PCT).cast("int"))),
        report.entry("split setup", F.lit(text.fold_setup_text(task.fold_key))),
        report.entry("metric", text.metric_text(F.lit("huber_loss"))))).alias("e")).select("e.*")


@query
def summary_page(spark, folder):
    table, result = _ols(spark, folder, b.SEGMENTS)
    sizes = folds.fold_sizes(table.df)
    return report.evaluation_page(result.fold_results, folds.fold_stats(sizes.df), "mae", "rmse",
                                  FoldSplit(key_column="o_year"))


@query
def curve_cap(spark, folder):
    df = read_table(spark, folder, "events").select("event_id", "event_type", "value")
    # A row per event type.
    guess = df.groupBy("event_type").agg((F.avg("value") * 1.5).alias("limit"))
    capped = df.join(F.broadcast(guess), "event_type").select(
        "event_id", text.capped(F.col("value"), F.lit(1.0), F.col("limit")).alias("value"))
    return rounded(capped, value=6)


# ------------------------------------------------------------ profile

def _lineitem_numbers(spark, folder) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query
def profile_overview(spark, folder):
    df = read_table(spark, folder, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.when(F.col("l_linenumber") != 1, F.col("l_linenumber")).alias("l_linenumber"))
    return rounded(profile.overview(df), missing_pct=6, duplicate_pct=6)


@query
def profile_variables(spark, folder):
    return profile.variables(required_input(spark, folder, b.DIRTY_ORDERS))


@query
def profile_numeric(spark, folder):
    return rounded(profile.numeric_stats(_lineitem_numbers(spark, folder)), mean=4, std=4,
                   variance=2, sum=0, cv=6)


@query
def profile_quantiles(spark, folder):
    return rounded(profile.quantiles(_lineitem_numbers(spark, folder)), q05=6, q25=6, q50=6,
                   q75=6, q95=6, iqr=6, range=6)


@query
def profile_shape(spark, folder):
    return rounded(profile.shape(_lineitem_numbers(spark, folder)), skewness=6, kurtosis=6, mad=6)


@query
def profile_histogram(spark, folder):
    return rounded(profile.histogram(_lineitem_numbers(spark, folder), 8), bin_start=4)


@query
def profile_top_values(spark, folder):
    return profile.top_values(required_input(spark, folder, b.ORDERS).select(
        "o_orderpriority", "o_orderstatus", "c_mktsegment"), 3)


@query
def profile_extremes(spark, folder):
    return profile.extreme_values(_lineitem_numbers(spark, folder), 5)


_HEAVY = ["l_returnflag", "l_linenumber", "l_quantity", "l_linestatus", "l_partkey", "l_shipdate"]


@query
def profile_heavy_values(spark, folder):
    """Few counters, so that some columns lose counts and some are counted whole."""
    df = read_table(spark, folder, "lineitem").select(*_HEAVY)
    return summaries.heavy_values(df, 3, counters=32)


@query
def profile_extremes_by_task(spark, folder):
    return summaries.extreme_values(_lineitem_numbers(spark, folder), 5)


@query
def profile_distinct_sketches(spark, folder):
    """Sketches of three parts of a table, merged; estimates next to the exact counts."""
    df = read_table(spark, folder, "lineitem")
    parts = [summaries.distinct_sketches(df.where(F.col("l_returnflag") == flag).select(*_HEAVY))
             for flag in ("A", "N", "R")]
    near = summaries.variables(summaries.merged_sketches(parts)).withColumnRenamed(
        "distinct", "estimate")
    exact = profile.variables(df.select(*_HEAVY)).select("column", "distinct")
    off = F.abs(F.col("estimate") - F.col("distinct"))
    return near.join(exact, "column").select(
        "column", "count", "missing", "distinct",
        (off <= 0.04 * F.col("distinct")).alias("estimate_is_near"))


@query
def profile_text_lengths(spark, folder):
    df = read_table(spark, folder, "documents").select("text", "lang", "source")
    return rounded(profile.text_lengths(df), mean_length=6)


@query
def profile_correlations(spark, folder):
    return rounded(profile.correlations(_lineitem_numbers(spark, folder)), correlation=9)


@query
def profile_missing(spark, folder):
    return rounded(profile.missing(required_input(spark, folder, b.DIRTY_ORDERS)), missing_pct=6)


@query
def profile_missing_patterns(spark, folder):
    return rounded(profile.missing_patterns(_gappy_orders(spark, folder)), pct=6)


@query
def profile_missing_together(spark, folder):
    return profile.missing_together(_gappy_orders(spark, folder))


def _gappy_orders(spark, folder) -> DataFrame:
    """Orders with cells missing in three columns, some of them together."""
    return b.dirty_orders(spark, folder).select(
        "o_orderpriority", F.when(F.col("o_orderkey") % 6 > 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif("o_note", F.lit("")).alias("o_note"), "o_totalprice")


@query
def profile_alerts(spark, folder):
    df = b.dirty_orders(spark, folder).select(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        (F.col("o_orderkey") % 4).alias("quarter"), F.lit("x").alias("fixed"))
    return profile.alerts(df)


# ------------------------------------------------------------ estimators (rows only)

def _trees(n_features: int) -> GBTRegressor:
    return GBTRegressor(maxDepth=3, maxBins=16)


@query
def gbt_cv_folds(spark, folder):
    params = b.SEGMENTS.params(_trees, seed=SEED, epochs=3)
    return cv.cross_validate(model_table(spark, folder, b.SEGMENTS), params).fold_results


def _training_curves(spark, folder, builder, epochs: int) -> DataFrame:
    """Epoch history of one fit on the whole table, a fifth of it held out."""
    params = b.SEGMENTS.params(builder, seed=SEED, epochs=epochs,
                               early_stopping=EarlyStopping(0.2, 2))
    table = model_table(spark, folder, b.SEGMENTS)
    vectors = write_table(cv.training_vectors(table, params), "vectors")
    model = cv.fit_model(params, vectors, len(table.features))
    history = spark.createDataFrame(
        [("final", *h) for h in cv.fit_history(model, vectors, params)], cv.HISTORY_SCHEMA)
    guesses = spark.createDataFrame(
        [("final", *g) for g in cv.guess_on_train_rows(vectors, params)], cv.GUESS_SCHEMA)
    return cv.training_curves(history, guesses)


@query
def gbt_training_curves(spark, folder):
    return _training_curves(spark, folder, _trees, 3)


@query
def network_training_curves(spark, folder):
    return _training_curves(spark, folder, lambda n: DenseRegressor(
        hidden=[16], dropout=0.0, batchSize=256), 2)


@query
def network_descent(spark, folder):
    """Losses of a network without hidden layer under shared steps over all rows."""
    rows = read_table(spark, folder, "lineitem").select(
        F.array((q("l_discount") * 10).cast("double")).alias("x"),
        (q("l_quantity") / 50).cast("double").alias("label"))
    model = DenseRegressor(hidden=[], dropout=0.0, batchSize=1 << 40, maxIter=b.DESCENT_EPOCHS,
                           stepSize=b.DESCENT_RATE, optimizer="sgd", seed=SEED,
                           synchronous=True).fit(
        rows.select(array_to_vector("x").alias("features"), "label"))
    history = [(epoch, value) for epoch, _, _, value in model.history]
    return rounded(spark.createDataFrame(history, "epoch int, loss double"), loss=6)


@query
def shapley_importance(spark, folder):
    params = b.SEGMENTS.params(_trees, seed=SEED, epochs=3)
    table = model_table(spark, folder, b.SEGMENTS)
    model = cv.fit_model(params, cv.training_vectors(table, params), len(table.features))
    return explain.importance(explain.permutation_shapley(
        model, table, seed=SEED, permutations=2))


@query
def shapley_linear(spark, folder):
    """The general attribution on a least-squares model, where it has a closed form."""
    table = model_table(spark, folder, b.BALANCES)
    intercept, weights, _ = linear.fit_all(table.df, table.features)
    model = linear.LeastSquaresModel(intercept, weights)._set(
        featuresCol=cv.VECTOR_COLUMN, predictionCol=cv.PREDICTION)
    return rounded(explain.permutation_shapley(model, table, seed=SEED), phi=2)


@query
def boosted_stump_folds(spark, folder):
    """First tree of every fold model, all grown in one scan: its cut and the two steps."""
    task = b.QUANTITY
    params = task.params(lambda n: BoostedTreesRegressor(maxDepth=1), seed=SEED, epochs=1)
    table = model_table(spark, folder, task)
    vectors = write_table(cv.training_vectors(table, params), "vectors")
    names = [r[0] for r in folds.fold_sizes(vectors).df.select(FOLD_COLUMN).toLocalIterator()]
    grown = boosting.grow(vectors, cv.build_estimator(params, 1), names, FOLD_COLUMN)
    return rounded(spark.createDataFrame([
        (fold, m.base, float(m.trees[0].threshold[0]), int(m.trees[0].cover[1]),
         *[float(m.trees[0].value[i]) for i in (1, 2)]) for fold, m in zip(names, grown)],
        "fold string, base double, threshold double, left_rows bigint, left_step double, "
        "right_step double"), base=4, left_step=4, right_step=4)


@query
def boosted_cv_folds(spark, folder):
    """All folds grown together, each stopped by its own patience on rows held out."""
    params = b.LINEITEM.params(lambda n: BoostedTreesRegressor(maxDepth=3), seed=SEED, epochs=12,
                               early_stopping=EarlyStopping(0.2, 2))
    return cv.cross_validate(model_table(spark, folder, b.LINEITEM), params).fold_results


def _boosted(spark, folder):
    params = b.ORDERS.params(lambda n: BoostedTreesRegressor(maxDepth=4), seed=SEED, epochs=8)
    table = model_table(spark, folder, b.ORDERS).over(lambda t: write_table(spread(t), "prepared"))
    vectors = cv.training_vectors(table, params)
    return table, vectors, cv.fit_model(params, vectors, len(table.features))


@query
def tree_importance(spark, folder):
    """Mean absolute exact attribution over every row."""
    table, _, model = _boosted(spark, folder)
    return tree_paths.tree_importance(model, table)


@query
def tree_attribution_gap(spark, folder):
    """Per row, how far expectation and attributions are from the prediction: nowhere."""
    table, vectors, model = _boosted(spark, folder)
    ids = list(table.row_id)
    total = (tree_paths.tree_attribution(model, table).groupBy(*ids)
             .agg(F.sum("phi").alias("phi"), F.count("*").alias("features")))
    gap = F.abs(F.col("phi") + tree_paths.expectation(model) - F.col(cv.PREDICTION))
    return model.transform(vectors).join(total, ids).select(
        q(ids[0]).alias("o_orderkey"), "features", F.round(gap, 4).alias("gap"))


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline error per fold of the fully prepared orders table."""
    table = model_table(spark, folder, b.ORDERS)
    return baseline.baseline_by_fold(table.df).orderBy(FOLD_COLUMN)
