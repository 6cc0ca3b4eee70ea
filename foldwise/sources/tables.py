"""Table readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES = {
    float: T.DoubleType(), "float": T.DoubleType(), "double": T.DoubleType(),
    str: T.StringType(), "str": T.StringType(), "string": T.StringType(),
    int: T.LongType(), "int": T.LongType(),
}


def read_csv(spark: SparkSession, path: str, dtypes: Mapping[str, object] | None = None
             ) -> DataFrame:
    """CSV with a header line, whose columns have the declared types.

    Columns are matched by name; undeclared ones are read as text. Empty fields
    are null, and text is taken as it stands.
    """
    dtypes = dict(dtypes or {})
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in dtypes if c not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in {path}")
    schema = T.StructType([
        T.StructField(c, dtypes[c] if isinstance(dtypes.get(c), T.DataType)
                      else _TYPES[dtypes.get(c, str)]) for c in header
    ])
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
