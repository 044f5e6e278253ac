"""Data tests and the gate they form before publication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DataCheckError(RuntimeError):
    """Raised by :func:`gate` when a data test fails."""


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: ``column_name, failures``."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "failures")


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; keys with a NULL part are ignored."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return (
        df.where(present)
        .groupBy(*key)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: repeated, or with a NULL part."""
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    reason = F.when(has_null, F.lit("null")).otherwise(F.lit("duplicate"))
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("n_records"))
        .where(has_null | (F.col("n_records") > 1))
        .withColumn("violation", reason)
    )


def summarize(failing_rows: DataFrame, check: str) -> DataFrame:
    """One row for a test whose failures are rows."""
    return failing_rows.agg(F.count("*").alias("failures")).select(
        F.lit(check).alias("check_name"), "failures"
    )


def check_summary(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    unique: Sequence[str | Sequence[str]] = (),
) -> DataFrame:
    """One row per data test: ``check_name, failures, should_warn, should_error``."""
    parts = []
    if not_null:
        name = F.concat(F.lit(f"not_null_{table}_"), F.col("column_name"))
        parts.append(
            check_not_null(df, not_null).select(name.alias("check_name"), "failures")
        )
    for key in unique:
        key = [key] if isinstance(key, str) else list(key)
        parts.append(
            summarize(check_unique(df, key), f"unique_{table}_{'_'.join(key)}")
        )
    failed = F.col("failures") != 0
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("should_warn", failed)
        .withColumn("should_error", failed)
    )


def gate(summary: DataFrame) -> DataFrame:
    """Raise if any test failed, else return the summary.

    The summary has one row per declared test, whatever the size of the tested table.
    """
    failed = summary.where("should_error").collect()
    if failed:
        found = ", ".join(f"{row.check_name} ({row.failures})" for row in failed)
        raise DataCheckError(f"data tests failed: {found}")
    return summary


def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, ``table_name, row_count``, in one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_name, row_count`` of Parquet tables from their files' footers alone.

    The count is pushed down to the reader, which takes it from the metadata of each file: no
    column is read, however large the tables. The setting for that belongs to a session of its own.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = row_count_audit({name: session.read.parquet(path) for name, path in paths.items()})
    # One row per table; the sum over no file at all is null.
    rows = [(row.table_name, row.row_count or 0) for row in counts.collect()]
    return spark.createDataFrame(rows, "table_name string, row_count long")
