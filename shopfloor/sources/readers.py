"""File scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FILE_POSITION = ("source_file", "source_row")
ARRIVAL = ("arrived_at", "source_file", "source_block", "source_row")


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at an extra pass.

    With a schema, a line that does not parse keeps its text in ``_corrupt_record``
    instead of failing the job; see :func:`split_corrupt`.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, without the marker column, and the lines that did not."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull())


def read_parquet(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    date: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """A Parquet directory, plain or date-partitioned.

    ``columns`` prunes the scan. ``start`` and ``end`` (inclusive) on the partition
    column ``date`` skip whole folders.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if date is not None and start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if date is not None and end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    return df if columns is None else df.select(*columns)


def with_arrival(df: DataFrame) -> DataFrame:
    """A scan of text files plus where each row came from, in the order of arrival.

    Files follow by modification time, then path; within a file the blocks by their start,
    and within a block the rows as they stand. Add it where the files are read and store
    it: what is written from them no longer tells.
    """
    names = ("file_modification_time", "file_path", "file_block_start")
    placed = [F.col(f"_metadata.{n}").alias(a) for n, a in zip(names, ARRIVAL, strict=False)]
    return df.select("*", *placed, F.monotonically_increasing_id().alias(ARRIVAL[-1]))


def with_file_position(df: DataFrame) -> DataFrame:
    """A Parquet scan plus each row's file and its place in that file.

    The pair identifies a row and survives retries, so it completes an order whose columns
    may tie. It says nothing about the order of arrival; see :func:`with_arrival`.
    """
    file_column, row_column = FILE_POSITION
    return df.select(
        "*",
        F.col("_metadata.file_name").alias(file_column),
        F.col("_metadata.row_index").alias(row_column),
    )
