"""The training-data pipeline: five stages from raw documents to token ids.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``. An empty table passes through all stages; how each stage reads nulls and
repeated rows is told in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import bpe, jaccard_join, mixing, secret_scan, toxicity
from foldwise.llm.queries import held_out, read, word_vocabulary
from foldwise.llm.shared import Scratch

#: A classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the multiple-instance model does not call toxic."""
    labels = read(spark, sf_dir, "labels").where(~held_out())
    return toxicity.keep(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by shared shingles."""
    return jaccard_join.survivors(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials masked in the text; ``n_chars`` stays right."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, arranged in the mixed order of their sources."""
    return mixing.arranged(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document with its place in the mix: file number and row within it."""
    return bpe.apply(with_place(docs), word_vocabulary(), carry=("source", "shard", "row")).drop(
        "decoded")


def with_place(docs: DataFrame) -> DataFrame:
    """Number of the file and of the row in it; rows of no file all get the number zero."""
    if not docs.inputFiles():
        return docs.withColumns({"shard": F.lit(0), "row": F.monotonically_increasing_id()})
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    return docs.withColumns({"shard": F.coalesce(number.try_cast("int"), F.lit(0)),
                             "row": F.col("_metadata.row_index")})


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; tables that are no longer read are deleted."""
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.drop((docs,))
    return STAGES[-1][1](spark, docs, sf_dir)
