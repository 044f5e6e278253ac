"""File sinks. Every sink overwrites its own target, so a rerun needs no clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet directory and return a scan of what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_date(
    df: DataFrame, path: str, date: str, replace_all: bool = True
) -> DataFrame:
    """Write one folder per date and return a scan of the table.

    Rows of a date are brought together first, so a date does not end up as one small
    file per task. The rebalance hint leaves the sizes to AQE, which splits a heavy
    date over several tasks. With ``replace_all=False`` only the dates present in
    ``df`` are replaced.
    """
    mode = "static" if replace_all else "dynamic"
    (
        df.hint("rebalance", date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(date)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header and a fixed column order."""
    chosen = df if columns is None else df.select(*columns)
    chosen.write.mode("overwrite").option("header", True).csv(path)
