"""Catalog tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def publish_table(df: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """Create or replace ``database.table`` from a query and return the table.

    The files go to ``location``, if given, and else to the warehouse.
    """
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    writer = df.write.mode("overwrite")
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return spark.table(name)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register a query under a name for this session."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ordered_table(spark: SparkSession, name: str, *order: str) -> DataFrame:
    """A catalog table, read in the given order."""
    return spark.table(name).orderBy(*order)
