"""Settle intermediate tables so later steps do not recompute them.

Two sizes exist. A per-group aggregate is usually tiny: it comes back through the
driver, behind a check of its row count, and may then be broadcast. Anything
larger is written to the folder the cluster shares for checkpoints, which
outlives a lost executor, and is read back from there.
"""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.errors import DataError

#: Rows an aggregate may have to be held locally and broadcast.
LOCAL_ROWS = 50_000

_fallback_dir: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, by call or by setting.

    A temporary one is made only where none is set and driver and tasks are one process.
    """
    global _fallback_dir
    context = spark.sparkContext
    configured = (context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
                  or context.getConf().get("spark.checkpoint.dir"))
    if configured:
        return configured.rstrip("/")
    if context.master.split("[")[0] != "local":
        raise DataError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="foldwise-")
    return _fallback_dir


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting lineage.

    Within :func:`scratch_tables` the table goes when the job ends, else it stays.
    """
    scratch = _current.get()
    if scratch is not None:
        return scratch.write(df, name)
    path = f"{shared_folder(df.sparkSession)}/foldwise-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` with its rows dealt evenly, for tables that are scanned many times.

    A source of few files or row groups would else leave most tasks of every scan idle.
    """
    return df.hint("rebalance")


class Scratch:
    """Intermediate tables of one job, deleted when the job no longer reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}/foldwise-{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: tuple[DataFrame, ...] = ()) -> None:
        """Delete all tables but those that the plans of ``keep`` still read."""
        read = [f for df in keep for f in df.inputFiles()]
        left = []
        for path in self.paths:
            if any(path.rstrip("/").rsplit("/", 1)[-1] in f for f in read):
                left.append(path)
            else:
                delete_folder(self.spark, path)
        self.paths = left


_current: contextvars.ContextVar[Scratch | None] = contextvars.ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Scratch]:
    """Delete what is written by :func:`write_table` inside, also when the job fails."""
    scratch = Scratch(spark)
    token = _current.set(scratch)
    try:
        yield scratch
    finally:
        _current.reset(token)
        scratch.drop()


def in_this_context(work: Callable) -> Callable:
    """``work`` for another thread, writing its tables as the calling thread would."""
    context = contextvars.copy_context()
    return lambda *args: context.copy().run(work, *args)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, wherever the session's file systems put it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@dataclass(frozen=True)
class Settled:
    df: DataFrame
    local: bool

    @property
    def joinable(self) -> DataFrame:
        """The table with a broadcast hint where its size allows one."""
        return F.broadcast(self.df) if self.local else self.df

    def over(self, step: Callable[[DataFrame], DataFrame]) -> Settled:
        """The same table after a step that does not add rows."""
        return Settled(step(self.df), self.local)


def settle(df: DataFrame, name: str, max_rows: int = LOCAL_ROWS) -> Settled:
    """Evaluate an aggregate once and keep it: locally if small, else as a table."""
    spark = df.sparkSession
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        head = df.limit(max_rows + 1).toArrow()
        if head.num_rows <= max_rows:
            return Settled(spark.createDataFrame(head, schema=df.schema).coalesce(1), local=True)
        return Settled(write_table(df, name), local=False)
    finally:
        df.unpersist()
