"""Working storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUN: ContextVar[str | None] = ContextVar("prepmill_run", default=None)


def _root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only where the setting is missing and the
    executors run inside the driver's own process (local mode).
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="prepmill-")
    return f"{root.rstrip('/')}/prepmill"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def working_storage(spark: SparkSession) -> Iterator[str]:
    """A folder that owns everything stored inside the block, and is deleted with it at the block's end.

    Use the results of a plan inside the block, or write them elsewhere: tables that read from the
    folder are gone afterwards. An inner block owns what is stored inside it. Without any block
    working storage stays until somebody deletes it.
    """
    folder = f"{_root(spark)}/run-{uuid.uuid4().hex}"
    outer = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(outer)
        delete(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder of the surrounding ``working_storage``, or else below the shared folder."""
    return f"{_RUN.get() or _root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to working storage and return the stored table.

    This cuts the lineage, survives the loss of executors, and gives Catalyst the true size of
    the table: a later join broadcasts it only if it is below the broadcast threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """The size of a table as Catalyst knows it: true for what was read from files, an estimate above them."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
