"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to equally filled cells, the cells' place on the Hilbert
curve orders the rows, and the ordered rows are cut into runs. Neighbours on the curve
are near in every dimension, so each shard spans a small box and a filter on any
dimension skips most files.

Cell bounds: at most ``2**bits - 1`` values per dimension, taken from exact counts of the
values, which are summed in order without a single task seeing all of them. These bounded
lists are all the driver collects.

Edge cases: a null dimension takes cell 0; a null text counts as no bytes; repeated rows
each get a place of their own (ties in every ordering column are interchangeable); an empty
table gives an empty result. The columns of the input sit in a struct, so extra ones cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm.layout import table, with_rank, with_total_before
from shopfloor.scratch import materialize

LAWS = ("rows", "bytes")


def hilbert_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """The place on the Hilbert curve of points whose coordinates have ``bits`` bits.

    Skilling's transform, on whole arrays.
    """
    x = [c.astype(np.int64) for c in cells]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap) if i else np.where(
                inverted, x[0] ^ low, x[0]
            )
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where(x[-1] & (1 << level), flip ^ ((1 << level) - 1), flip)
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for coordinate in x:
            place = (place << 1) | (((coordinate ^ flip) >> level) & 1)
    return place


def cell_bounds(df: DataFrame, dimension: str, bits: int) -> list:
    """The least value of each cell but the first; cells hold about equally many rows."""
    counts = df.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.count("*").alias("n"))
    summed = materialize(
        with_total_before(counts, [dimension], "n", "before", f"cells-{dimension}"), "cells"
    )
    total = summed.agg(F.sum("n")).first()[0] or 0
    if not total:
        return []
    cell = F.floor(F.col("before") * (1 << bits) / F.lit(total)).alias("cell")
    firsts = summed.groupBy(cell).agg(F.min(dimension).alias("least"))
    return sorted(row["least"] for row in firsts.collect())[1:]


def hilbert_ordered(df: DataFrame, dimensions: Sequence[str], bits: int = 6) -> DataFrame:
    """``df`` plus ``curve_index``, its rows' place on the curve through ``dimensions``."""
    if bits * len(dimensions) > 62:
        raise ValueError("bits times dimensions must stay within 62")
    bounds = {d: cell_bounds(df, d, bits) for d in dimensions}

    def place(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            cells = []
            for name, values in zip(dimensions, batch, strict=True):
                known = values.notna().to_numpy()
                cell = np.zeros(len(values), dtype=np.int64)
                edges = np.array(bounds[name], dtype=object if values.dtype == object else None)
                if len(edges) and known.any():
                    kept = values[known].to_numpy()
                    cell[known] = np.searchsorted(edges, kept, side="right")
                cells.append(cell)
            yield pd.Series(hilbert_index(cells, bits))

    curve = F.pandas_udf(place, T.LongType())
    return df.withColumn("curve_index", curve(*dimensions))


def hilbert_shards(
    df: DataFrame,
    dimensions: Sequence[str],
    shards: int,
    size: str,
    tie_break: Sequence[str],
    law: str = "rows",
    bits: int = 6,
) -> DataFrame:
    """Per row: ``row`` (a struct of ``df``), ``curve_index``, ``shard``, ``slot`` within the shard.

    ``law`` is "rows" (the shards' row counts differ by one at most) or "bytes" (their
    totals of ``size`` differ by no more than one row can). ``df`` is read several times:
    pass a narrow written table.
    """
    if law not in LAWS:
        raise ValueError(f"law must be one of {LAWS}")
    dims = [f"d{i}" for i in range(len(dimensions))]
    ties = [f"t{i}" for i in range(len(tie_break))]
    narrow = df.select(
        F.struct("*").alias("row"),
        F.col(size).alias("size"),
        *[F.col(c).alias(d) for c, d in zip(dimensions, dims, strict=True)],
        *[F.col(c).alias(t) for c, t in zip(tie_break, ties, strict=True)],
    )
    curved = hilbert_ordered(narrow, dims, bits).select("row", "size", "curve_index", *ties)
    ranked = materialize(
        with_rank(curved, ["curve_index", *ties], "rank", "curve"), "curve-ranked"
    )
    if law == "rows":
        total = ranked.count()
        shard = F.expr(f"(rank * {shards}) div {max(total, 1)}").cast("int")
        first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
        return ranked.withColumn("shard", shard).select(
            "row", "curve_index", "shard", (F.col("rank") - first).alias("slot")
        )
    total = ranked.agg(F.sum("size")).first()[0] or 1
    summed = with_total_before(ranked, ["rank"], "size", "before", "curve-bytes")
    shard = F.least(F.expr(f"(before * {shards}) div {total}"), F.lit(shards - 1)).cast("int")
    cut = materialize(summed.withColumn("shard", shard), "curve-cut")
    firsts = cut.groupBy("shard").agg(F.min("rank").alias("first"))
    return cut.join(firsts, "shard").select(
        "row", "curve_index", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in slot order, for readers that prune by statistics."""
    (
        sharded.select("row.*", "shard", "slot")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equally many rows, by source, language and size."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    narrow = materialize(documents, "shard-input")
    sharded = hilbert_shards(
        narrow,
        dimensions=["source", "lang", "size"],
        shards=16,
        size="size",
        tie_break=["doc_id", "text_crc32"],
        law="rows",
    )
    return sharded.select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve_index",
    )
