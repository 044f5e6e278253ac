"""Scratch tables of a pipeline that runs in stages."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shopfloor import scratch

# Folders of earlier stages, by application: their results have been written by now.
_open: dict[str, list[str]] = {}


@contextmanager
def in_stage(spark: SparkSession) -> Iterator[None]:
    """Put the scratch tables made inside into one folder, and remove those of earlier stages.

    A stage's lazy result reads its own folder, which therefore stays until the next stage
    begins: by then the result has been written, as the pipeline's contract says.
    """
    app = spark.conf.get("spark.app.id", "application")
    for folder in _open.pop(app, []):
        scratch.remove(spark, folder)
    folder = scratch.scratch_path(spark, "stage")
    _open[app] = [folder]
    with scratch.scratch_folder(folder):
        yield


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written outside of any stage's folder and read again."""
    return scratch.materialize(df, f"pipeline-{label}")
