"""Typing, quarantine and deduplication of raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(
    df: DataFrame, ts: str, date: str | None = None, fmt: str | None = None
) -> DataFrame:
    """Parse ``ts`` to a timestamp and add its date; text that does not parse is NULL."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.StringType):
        parsed = F.try_to_timestamp(ts, F.lit(fmt)) if fmt else F.try_to_timestamp(ts)
        df = df.withColumn(ts, parsed)
    return df if date is None else df.withColumn(date, F.to_date(ts))


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that satisfy ``valid``, and the quarantined rest (false or NULL)."""
    keep = F.coalesce(valid, F.lit(False))
    return df.where(keep), df.where(~keep)


def deduplicate(
    df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the least by ``order``, then by the remaining columns.

    Spark keeps the first row per key inside each map task before it shuffles (the
    partial ``WindowGroupLimit`` of the plan), so of a key that owns a large part of
    the table only one row per task travels.
    """
    rest = [c for c in df.columns if c not in key and c not in (order or ())]
    ranking = [*(order or ()), *rest]
    if not ranking:
        return df.distinct()
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*ranking))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")
