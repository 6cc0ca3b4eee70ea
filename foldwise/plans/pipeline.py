"""End-to-end runs: train and evaluate, and score with a stored model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.config import (FOLD_COLUMN, TARGET_COLUMN, FeaturesConfig, TrainParams,
                             parse_features_config, parse_train_params)
from foldwise.errors import ConfigError, DataError
from foldwise.functions.names import q, qs, quoted
from foldwise.functions.text import duration_text, warning_count_text
from foldwise.operators import cv, encode, explain, folds, prepare, profile, quality, summaries
from foldwise.operators.linear import LeastSquaresModel, linear_prediction
from foldwise.operators.table import VECTOR_COLUMN, ModelTable, Preparation, fit_preparation
from foldwise.operators.tree_paths import TREE_MODELS, tree_attribution, tree_importance
from foldwise.plans import report
from foldwise.sources import outputs, store
from foldwise.sources.settle import delete_folder, in_this_context, scratch_tables, spread, write_table

_GENERATED_ID = "_row_id"
OOF_TABLE = "oof_predictions"
FOLD_TABLE = "fold_results"


@dataclass(frozen=True)
class Run:
    """A finished run: where it lies, its model and every report table by name."""

    path: str
    model: Model
    preparation: Preparation
    tables: dict[str, DataFrame] = field(repr=False)


def train_and_evaluate(df: DataFrame, features: Mapping[str, Any] | FeaturesConfig,
                       params: Mapping[str, Any] | TrainParams, out_path: str,
                       row_id: Sequence[str] | None = None, parallel_fits: int = 4,
                       explained_rows: int = explain.SAMPLE_ROWS) -> Run:
    """Prepare, cross-validate, fit on all rows, explain, profile, report and store.

    ``row_id`` names the columns that identify a row. Without it ids are generated
    and frozen with the prepared table, so they hold for this run only. ``explained_rows``
    rows get an attribution each. The importance of the features of a linear model or of trees
    covers all rows, that of any other model the explained ones. Intermediate tables are deleted at
    the end; a run that fails leaves nothing.
    """
    started = datetime.now()
    features, params = parse_features_config(features), parse_train_params(params)
    split = params.fold_split
    required = prepare.required_columns(features, split.key_column)
    prepare.check_columns(df, [*required, *(row_id or [])])
    prepare.check_not_empty(df)
    run = store.new_run_folder(out_path)
    try:
        with scratch_tables(df.sparkSession):
            return _run(df, features, params, out_path, run, row_id, parallel_fits,
                        explained_rows, started)
    except BaseException:
        delete_folder(df.sparkSession, run)
        raise


def _run(df: DataFrame, features: FeaturesConfig, params: TrainParams, out_path: str, run: str,
         row_id: Sequence[str] | None, parallel_fits: int, explained_rows: int,
         started: datetime) -> Run:
    split = params.fold_split
    required = prepare.required_columns(features, split.key_column)
    ids = list(row_id) if row_id else [_GENERATED_ID]
    if row_id is None:
        df = df.withColumn(_GENERATED_ID, F.monotonically_increasing_id())

    tables: dict[str, DataFrame] = {}
    spark = df.sparkSession

    def keep(name: str, table: DataFrame) -> DataFrame:
        """Write a report table and go on with the written one."""
        outputs.write(table, f"{run}/report/{name}")
        tables[name] = spark.read.parquet(f"{run}/report/{name}")
        return tables[name]

    # The source, whatever it is, is read once; only the columns needed are kept, and rows are
    # dealt evenly, since every later step scans this table or one made from it.
    source = write_table(spread(df.select(*qs(dict.fromkeys([*ids, *required])))), "input")
    funnel = keep("funnel", prepare.funnel(source, required))
    n_rows = funnel.first()["rows_after"]
    if not n_rows:
        raise DataError("no row has a value in every required column")
    preparation, clean = fit_preparation(source, features, split.key_column)
    raw_table = preparation.train_table(clean, split, params.hash_seed, ids)
    table = raw_table.over(lambda t: write_table(t, "prepared"))
    n_columns = len(table.full_dataset.columns)

    found = [quality.funnel_warnings(funnel)]
    if preparation.encoder.encodings:
        categories = keep("categories", preparation.encoder.category_df)
        summary = keep("encoding_summary", encode.encoding_summary(categories))
        keep("category_page", report.category_page(encode.final_distribution(categories)))
        keep("other_breakdown", report.other_breakdown(categories))
        found.append(quality.encoding_warnings(summary, features.categorical))
    sizes = keep("fold_sizes", folds.fold_sizes(table.df).df)
    stats = keep("fold_stats", folds.fold_stats(sizes))
    cv.check_folds(stats.first()["folds"])
    found.append(quality.fold_warnings(stats))
    warnings = keep("warnings", report.warnings_page(quality.warnings_table(*found)))

    result = cv.cross_validate(table, params, parallel_fits)
    fold_results = keep("fold_measures", result.fold_results)
    keep("fold_summary", cv.summarise_folds(fold_results))
    oof = keep("oof", cv.with_deviation(result.oof))
    display = report.fold_table(fold_results, params.loss, params.metric, split.key_column)
    outputs.write_fold_table(keep("fold_table", display), f"{run}/{FOLD_TABLE}")
    sample_id = q(table.row_id[0]) if len(table.row_id) == 1 else F.concat_ws(
        "-", *qs(table.row_id))
    # The row id in the order splits a fold of any size over several sorted files.
    outputs.write_predictions(
        oof.withColumn("sample_id", sample_id).orderBy("fold_key", *qs(table.row_id)),
        f"{run}/{OOF_TABLE}")

    vectors = cv.training_vectors(table, params)
    if not cv.takes_closed_form(table, params):
        vectors = write_table(vectors, "final-vectors")
    model = cv.fit_final(table, params, vectors)
    history = spark.createDataFrame(
        [("final", *h) for h in cv.fit_history(model, vectors, params)], cv.HISTORY_SCHEMA)
    guesses = spark.createDataFrame(
        [("final", *g) for g in cv.guess_on_train_rows(vectors, params)], cv.GUESS_SCHEMA)
    if result.history is not None:
        history = history.unionByName(result.history)
        guesses = guesses.unionByName(result.guesses)
    keep("training_curves", cv.training_curves(history, guesses))
    keep("final_model", spark.createDataFrame(
        [(cv.epochs_of(model), type(model).__name__, len(table.features))],
        "train_epochs int, model string, features int"))
    attribution = keep("attribution", attribute(model, table, params.hash_seed, n_rows,
                                                explained_rows))
    weights = linear_weights(model)
    if weights is not None:
        ranked = explain.linear_importance(table.df, table.features, weights, feature_means(table))
        keep("importance", ranked.orderBy(F.desc("importance"), "feature"))
    else:
        keep("importance", tree_importance(model, table) if isinstance(model, TREE_MODELS)
             else explain.importance(attribution))

    if params.profile:
        sources = {"input": prepare.profiled_columns(source, required),
                   "prepared": table.full_dataset}
        if params.profile_values == "sketched":
            tell = {s: keep(f"profile_{s}_distinct_sketches", summaries.distinct_sketches(data))
                    for s, data in sources.items()}
            section = summaries.section
        else:
            tell = {s: profile.value_counts(data).written() for s, data in sources.items()}
            section = profile.section

        def write_section(source_name: str, name: str) -> None:
            keep(f"profile_{source_name}_{name}",
                 section(name, sources[source_name], tell[source_name]))

        sections = [(s, n) for s, data in sources.items() for n in profile.section_names(data)]
        with ThreadPoolExecutor(max_workers=parallel_fits) as pool:
            work = in_this_context(inheritable_thread_target(spark)(write_section))
            for done in [pool.submit(work, *s) for s in sections]:
                done.result()

    ended = datetime.now()
    texts = warnings.agg(F.count("*").alias("n")).select(
        warning_count_text(F.col("n")).alias("warned"),
        duration_text(F.lit(started), F.lit(ended)).alias("spent")).first()
    keep("summary_page", report.summary_page(fold_results, stats, params.metric, n_columns,
                                             texts["spent"], texts["warned"], params.seed))
    keep("preprocessing_page", report.preprocessing_page(
        funnel, n_columns,
        prepare.unused_column_count(df.drop(_GENERATED_ID), required)))
    keep("evaluation_page", report.evaluation_page(
        fold_results, stats, params.loss, params.metric, split))
    store.save_fitted(run, model, preparation)
    store.publish(out_path, run)
    return Run(run, model, preparation, tables)


def linear_weights(model: Model) -> Sequence[float] | None:
    """One weight per feature, where the model is a weighted sum."""
    if isinstance(model, LeastSquaresModel):
        return model.weights
    return model.coefficients.toArray() if isinstance(model, LinearRegressionModel) else None


def feature_means(table: ModelTable) -> list[float]:
    return list(table.df.selectExpr(*[f"avg({quoted(f)})" for f in table.features]).first())


def attribute(model: Model, table: ModelTable, seed: int, rows: int,
              size: int = explain.SAMPLE_ROWS) -> DataFrame:
    """``(row id, feature, phi)`` of ``size`` rows: exact if linear or trees, else permutations."""
    weights = linear_weights(model)
    if weights is None and not isinstance(model, TREE_MODELS):
        return explain.permutation_shapley(model, table, seed, size=size, rows=rows)
    sample = explain.sample_rows(table.df, table.row_id, size, seed, rows)
    if weights is None:
        return tree_attribution(model, table, sample)
    return explain.linear_attribution(sample, table.row_id, table.features, weights,
                                      feature_means(table))


def score(df: DataFrame, path: str, output: str = "model_prediction",
          check: str = "first") -> DataFrame:
    """Input rows and columns with the stored model's prediction behind.

    Missing columns, empty values and, unless allowed, unknown categories are errors.
    ``check="first"`` counts them in a pass of its own and names all of them;
    ``check="inline"`` scores in a single pass, which fails at the first bad row.
    An empty table is an error for both. The target column is not needed.
    """
    if check not in ("first", "inline"):
        raise ConfigError(f"check must be 'first' or 'inline', got {check!r}")
    model, preparation = store.load_fitted(path)
    if output in df.columns:
        raise ConfigError(f"the table already has a column '{output}'")
    if check == "inline":
        prepare.check_not_empty(df)
        df = preparation.inline_checked(df)
    else:
        preparation.check_scoring_table(df)
    features = [f"_x{i}" for i in range(len(preparation.output_columns))]
    wide = df.select(*qs(df.columns), *[
        c.cast("double").alias(n) for c, n in zip(preparation.feature_columns(), features)])
    if isinstance(model, LeastSquaresModel):
        # Straight from the feature expressions, without a vector in between.
        return wide.select(*qs(df.columns), linear_prediction(
            model.intercept, model.weights, features).alias(output))
    vector = array_to_vector(F.array(*features)).alias(VECTOR_COLUMN)
    scored = model.transform(wide.select(*qs(df.columns), vector))
    return scored.select(*qs(df.columns), q(cv.PREDICTION).alias(output))


__all__ = ["FOLD_COLUMN", "TARGET_COLUMN", "Run", "attribute", "score", "train_and_evaluate"]
