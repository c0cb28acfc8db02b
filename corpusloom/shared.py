"""Intermediate tables in the folder the cluster shares.

A table written there survives the loss of any executor, and reading it back
starts a new, short lineage.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where that is unset, and all of Spark is this one process, it is a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "checkpoints", context.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    path = f"{shared_folder(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table, in whatever store it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that were written inside. Nothing lazy may outlive it."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            remove_path(spark, path)


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
