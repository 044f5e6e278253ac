"""Intermediate tables in the cluster's shared checkpoint folder.

Some operators read one intermediate result more than once: a table laid out in
global order, a table of per-group limits. They write it here and read it back,
which

* fixes its content, so every reader sees the same rows even after lost executors;
* cuts lineage;
* lets the optimiser see the true size of a small join side, so that Spark itself
  chooses a broadcast join below ``spark.sql.autoBroadcastJoinThreshold`` and a
  sort-merge join (with AQE skew splitting) above it. No join here carries a hint.

The tables sit under one sub-folder per application. Like Spark's own checkpoints they
stay until the folder's retention removes them, since a lazy result may still need them;
a job that has written its results wraps itself in :func:`scratch_scope`, which removes
what it made.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


@cache
def _local_folder() -> str:
    """A folder of this process for local runs without setting; it goes when they end."""
    folder = tempfile.mkdtemp(prefix="shopfloor-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only for local runs."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_SETTING} must name a folder shared by all executors"
        )
    return _local_folder()


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.conf.get("spark.app.id", "application")
    folder = _scope.get() or f"{scratch_root(spark)}/shopfloor/{app}"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(folder: str) -> Iterator[str]:
    """Put the scratch tables made inside below ``folder``, which stays."""
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Remove the scratch tables made inside on leaving.

    Results have to be written by then; a lazy one would lose its input.
    """
    folder = scratch_path(spark, "scope")
    try:
        with scratch_folder(folder):
            yield folder
    finally:
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and return a scan of that table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
