"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times (2 by default); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from foldwise.operators import prepare, profile
from foldwise.plans import bindings, catalog
from foldwise.plans.pipeline import score, train_and_evaluate
from foldwise.sources.settle import scratch_tables, write_table

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = ("impute_funnel", "category_distribution", "one_hot", "preprocessed_table",
            "hash_folds", "fold_gini", "baseline_by_fold", "metrics_all", "ols_cv_folds",
            "oof_deviation", "score_ols", "linear_importance", "profile_overview",
            "profile_variables", "profile_numeric", "profile_quantiles", "profile_correlations")


def drain(df: DataFrame) -> None:
    """Evaluate every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(work, runs: int) -> float:
    spent = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        work()
        spent.append(time.perf_counter() - start)
    return round(statistics.median(spent[1:]), 3)


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("foldwise-bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="foldwise-bench-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    registered, result = catalog.queries(), {}
    for name in HEADLINE:
        result[name] = timed(lambda: drain(registered[name](spark, FOLDER)), RUNS)

    task, out = bindings.ORDERS, tempfile.mkdtemp(prefix="foldwise-run-")

    def whole_run() -> None:
        train_and_evaluate(task.load(spark, FOLDER), task.config, task.params(seed=42), out,
                           task.row_id)

    def both_profiles() -> None:
        """All sections of the profile, of the input and of the prepared table."""
        with scratch_tables(spark):
            raw = task.load(spark, FOLDER)
            required = prepare.required_columns(task.config, task.fold_key)
            tables = (prepare.profiled_columns(raw, required),
                      catalog.model_table(spark, FOLDER, task).full_dataset)
            for table in (write_table(t, "profiled") for t in tables):
                counts = profile.value_counts(table).written()
                with ThreadPoolExecutor(max_workers=4) as pool:
                    list(pool.map(lambda name, t=table, c=counts: drain(profile.section(name, t, c)),
                                  profile.section_names(table)))

    result["profiles"] = timed(both_profiles, 1)
    result["train_and_evaluate"] = timed(whole_run, 1)
    result["score"] = timed(lambda: drain(score(task.load(spark, FOLDER), out)), RUNS)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(result.values()), 3), "unit": "sec",
        "queries": result, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS),
        "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
