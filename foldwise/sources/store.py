"""Save and load a fitted run.

A run is written in full to its own folder first. One row appended to ``published``
then makes it current, so a reader never meets half a run and a failed run leaves
the previous one in place.
"""

from __future__ import annotations

import importlib
import json
import uuid
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.config import parse_features_config
from foldwise.errors import StoreError
from foldwise.operators.encode import Encoder, FeatureEncoding
from foldwise.operators.table import Preparation
from foldwise.sources.settle import LOCAL_ROWS, Settled


def new_run_folder(path: str) -> str:
    return f"{path.rstrip('/')}/runs/{uuid.uuid4().hex}"


def _write_json(spark: SparkSession, value: dict, path: str) -> None:
    text = spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string")
    text.coalesce(1).write.text(path)


def save_fitted(run: str, model: Model | None, preparation: Preparation,
                is_fitted: bool = True) -> None:
    """Write model, artifacts and known categories to a run folder."""
    if not is_fitted or model is None:
        raise StoreError("only a fitted model can be stored")
    spark = SparkSession.active()
    model.save(f"{run}/model")
    encoder = preparation.encoder
    if encoder.encodings:
        encoder.category_df.write.parquet(f"{run}/categories")
    _write_json(spark, {
        "features_config": preparation.config.to_dict(),
        "encodings": [asdict(e) for e in encoder.encodings],
        "model_columns": preparation.output_columns,
        "model_class": f"{type(model).__module__}:{type(model).__name__}",
        "is_fitted": True,
    }, f"{run}/artifacts")


def publish(path: str, run: str) -> None:
    """Make a finished run the current one."""
    spark = SparkSession.active()
    row = spark.createDataFrame([(run.rsplit("/", 1)[1],)], "run string")
    (row.withColumn("at", F.current_timestamp()).coalesce(1)
     .write.mode("append").json(f"{path.rstrip('/')}/published"))


def current_run(path: str) -> str:
    try:
        rows = SparkSession.active().read.schema("run string, at timestamp").json(
            f"{path.rstrip('/')}/published")
        newest = rows.orderBy(F.desc("at")).first()
    except AnalysisException as ex:
        raise StoreError(f"no model is stored at {path}") from ex
    if newest is None:
        raise StoreError(f"no model is stored at {path}")
    return f"{path.rstrip('/')}/runs/{newest['run']}"


def load_fitted(path: str) -> tuple[Model, Preparation]:
    """Model and preparation of the current run."""
    run, spark = current_run(path), SparkSession.active()
    art = json.loads(spark.read.text(f"{run}/artifacts").first()[0])
    if not art["is_fitted"]:
        raise StoreError(f"the model stored at {path} is not fitted")
    encodings = tuple(FeatureEncoding(**(e | {"own": tuple(e["own"])})) for e in art["encodings"])
    categories = None
    if encodings:
        small = sum(e.rare_count for e in encodings) <= LOCAL_ROWS
        categories = Settled(spark.read.parquet(f"{run}/categories"), local=small)
    preparation = Preparation(parse_features_config(art["features_config"]),
                              Encoder(encodings, categories))
    if preparation.output_columns != art["model_columns"]:
        raise StoreError("the stored columns do not fit the stored encodings")
    module, name = art["model_class"].split(":")
    return getattr(importlib.import_module(module), name).load(f"{run}/model"), preparation


def read_report(path: str, table: str) -> DataFrame:
    """A report table of the current run."""
    return SparkSession.active().read.parquet(f"{current_run(path)}/report/{table}")
