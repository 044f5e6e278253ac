"""Approximate nearest neighbours by cross-polytope hashing.

A vector is scaled to unit length, put through a fast pseudo-rotation (three rounds of random
signs and a Hadamard transform, padded to a power of two) and assigned to the nearest signed
axis: the coordinate of largest magnitude and its sign. ``hashes`` independent rotations make
one bucket of a table; there are ``tables`` of them. A query visits the ``probes`` buckets of
each table whose axes lie nearest to it, and the vectors it meets there are ranked by their
exact distance on the original vectors. A query that meets fewer than ``k`` others, though its
length has more, goes on to ``FURTHER`` times as many buckets until it has them or has visited
all. All buckets of one table hold every vector, so then the result is exact.

Rows with equal vectors are one class with its ``k + 1`` smallest ids, found with a limit on the
map side, so a hot vector is one entry of the index. Buckets are cut into blocks of about
``BLOCK`` vectors and ``BLOCK`` probing queries by hash, sized from the counted buckets; a task
holds one block of either side, however many rows a bucket has, and hands on the ``k + 1``
nearest classes of each query.

How many buckets are probed follows from the padded length (``probed``): 24 of 128 for 64 numbers,
384 of 1,024 for 512, as the nearest axes tell less the more there are. With eight tables that was
chosen by recall against brute force on the embeddings of this project and on random vectors,
whose neighbours are hardly nearer than the rest (1.04 against 1.41), which is the hard case: 0.9
takes more than half of the vectors, and the default has a margin. Data with closer neighbours needs fewer probes, and
larger tables more ``hashes`` to a bucket.

Edge cases: vectors that are null, zero or hold a null or non-finite component take no part,
nor do rows without id; vectors meet only those of their own length; an id with several rows
keeps each of its vectors, and is never its own neighbour; with fewer than ``k`` candidates all
are returned; an empty table gives an empty result. Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.layout import table
from shopfloor.scratch import materialize

BLOCK = 4096
ROUNDS = 3
TABLES = 8
# Probes of vectors with up to 64 numbers.
LEAST_PROBES = 24
# By how much the probes of a query grow that met too few vectors.
FURTHER = 4
# Probing vectors are hashed in lots of about so many numbers to hand on.
LOT_NUMBERS = 1 << 22


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row; the length is a power of two."""
    n = x.shape[1]
    half = 1
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x


def padded(length: int) -> int:
    """The power of two that vectors are padded to."""
    return 1 << max(length - 1, 0).bit_length()


def probed(length: int) -> int:
    """How many buckets of a table vectors of a length probe, at least."""
    size = padded(length)
    return max(LEAST_PROBES, 2 * size * (size.bit_length() - 4) // 16)


def every_bucket(length: int, hashes: int) -> int:
    """How many buckets a table has for vectors of a length."""
    return (2 * padded(length)) ** hashes


def rotated(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Unit vectors after the pseudo-rotation that ``seed`` names, up to a common factor."""
    size = padded(vectors.shape[1])
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / scale
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = np.zeros((len(vectors), size))
    out[:, : vectors.shape[1]] = unit
    signs = np.random.default_rng([seed, size]).choice([-1.0, 1.0], (ROUNDS, size))
    for sign in signs:
        out = _hadamard(out * sign)
    return out


def buckets(vectors: np.ndarray, one_table: int, hashes: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the ``probes`` buckets nearest to each vector in a table."""
    rows = np.repeat(np.arange(len(vectors)), 1)
    code = np.zeros((len(vectors), 1), dtype=np.int64)
    value = np.zeros((len(vectors), 1))
    for h in range(hashes):
        y = rotated(vectors, one_table * 64 + h)
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        both = np.concatenate([y, -y], axis=1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :probes]
        near = np.take_along_axis(both, top, axis=1)
        code = (code[:, :, None] * both.shape[1] + top[:, None, :]).reshape(len(vectors), -1)
        value = (value[:, :, None] + near[:, None, :]).reshape(len(vectors), -1)
        best = np.argsort(-value, axis=1, kind="stable")[:, :probes]
        code = np.take_along_axis(code, best, axis=1)
        value = np.take_along_axis(value, best, axis=1)
    rows = np.repeat(np.arange(len(vectors)), code.shape[1])
    return rows, code.ravel()


def _vectors(column: pa.Array) -> np.ndarray:
    """Equal-length lists as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _hash(tables: int, hashes: int, probes: int | None, times: int = 1):
    """(id, vector) to (tab, bucket, id, vector) of ``times`` as many buckets as ``probes`` says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(1)], dtype=np.int64)
            for size in np.unique(sizes):
                every = every_bucket(int(size), hashes)
                wanted = min(every, times * (probes or probed(int(size))))
                own = np.flatnonzero(sizes == size)
                step = max(1, LOT_NUMBERS // (wanted * int(size)))
                for at in range(0, len(own), step):
                    part = batch.take(pa.array(own[at : at + step]))
                    vectors = _vectors(part.column(1))
                    # All buckets of one table hold every vector.
                    for tab in range(1 if wanted == every else tables):
                        rows, code = buckets(vectors, tab, hashes, wanted)
                        taken = part.take(pa.array(rows))
                        yield pa.record_batch(
                            [
                                pa.array(np.full(len(rows), tab, dtype=np.int32)),
                                pa.array(code * 4096 + size % 4096),
                                taken.column(0),
                                taken.column(1),
                            ],
                            ["tab", "bucket", "id", "vector"],
                        )

    return run


def _nearest(keep: int):
    """A block of vectors and one of queries to the nearest of each query: (query, id, score)."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(index) and len(queries):
            x = _vectors(index["vector"].combine_chunks())
            q = _vectors(queries["vector"].combine_chunks())
            ids, names = index["id"].to_numpy(), queries["id"].to_numpy()
            by_id = np.argsort(ids, kind="stable")
            x, ids = x[by_id], ids[by_id]
            step = max(1, 4_000_000 // max(x.size, 1))
            for at in range(0, len(q), step):
                apart = q[at : at + step, None, :] - x[None, :, :]
                score = np.sqrt((apart * apart).sum(axis=2))
                # Stable: equal scores stay in the order of ids.
                best = np.argsort(score, axis=1, kind="stable")[:, :keep]
                found.append(
                    (
                        np.repeat(names[at : at + step], best.shape[1]),
                        ids[best].ravel(),
                        np.take_along_axis(score, best, axis=1).ravel(),
                    )
                )
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            {n: pa.array(c, t) for n, c, t in zip(("query", "id", "score"), columns, kinds, strict=True)}
        )

    return run


def _usable(vector: str) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return finite & F.exists(vector, lambda x: x != 0)


def _met(indexed: DataFrame, asked: DataFrame, k: int, probe) -> DataFrame:
    """The ``k + 1`` nearest classes that each of ``asked`` meets: (query, rep, score)."""
    probing = materialize(asked.mapInArrow(probe, indexed.schema), "vector-probes")
    # Blocks per bucket: one row for each bucket that has vectors and queries.
    place = ["tab", "bucket"]
    sizes = (
        indexed.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
        .join(probing.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asked")), place)
    )
    sizes = materialize(sizes, "bucket-parts")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return rows.join(sizes, place).select(*place, "id", "vector", mine, every)

    block = [*place, "parts", "asked"]
    left = dealt(indexed, "parts", "asked").select(*block, "id", "vector")
    right = dealt(probing, "asked", "parts").select(*block, "id", "vector")
    met = (
        left.groupBy(*block)
        .cogroup(right.groupBy(*block))
        .applyInArrow(_nearest(k + 1), "query long, id long, score double")
    )
    nearest = Window.partitionBy("query").orderBy("score", "id")
    near = (
        met.distinct()
        .withColumn("place", F.row_number().over(nearest))
        .where(F.col("place") <= k + 1)
        .select("query", F.col("id").alias("rep"), "score")
    )
    return materialize(near, "near-classes")


def _short(near: DataFrame, members: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The asking classes that met fewer than ``k`` others, though there are more: (id, length)."""
    few = near.groupBy("query").agg(F.count_distinct("rep").alias("n")).where(F.col("n") <= k)
    # Few classes may hold enough ids; each class counts itself.
    found = (
        near.join(few.select("query"), "query")
        .join(members.select("rep", F.col("id").alias("found")), "rep")
        .groupBy("query").agg(F.count_distinct("found").alias("n")).where(F.col("n") <= k)
        .join(asked.select(F.col("id").alias("query"), F.size("vector").alias("length")), "query")
    )
    found = materialize(found, "short-queries")
    if found.isEmpty():
        return found.select(F.col("query").alias("id"), "length")
    given = members.groupBy(F.size("vector").alias("length")).agg(F.count_distinct("id").alias("given"))
    more = found.join(given, "length").where("n < given")
    return materialize(more.select(F.col("query").alias("id"), "length"), "short-queries")


def neighbours(
    embeddings: DataFrame,
    queries: Column,
    k: int = 10,
    tables: int = TABLES,
    probes: int | None = None,
    hashes: int = 1,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of each row where ``queries`` holds: (query_id, rank, id, score).

    ``probes`` are the buckets of each table that a query visits at first; ``probed`` by default.
    """
    given = embeddings.select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), queries.alias("asks")
    ).where(F.col("id").isNotNull() & F.coalesce(_usable("vector"), F.lit(False)))
    same = Window.partitionBy("vector").orderBy("id")
    members = materialize(
        given.select("id", "vector").distinct()
        .withColumn("place", F.row_number().over(same))
        .where(F.col("place") <= k + 1)
        .withColumn("rep", F.first("id").over(same))
        .select("rep", "id", "vector"),
        "vector-classes",
    )
    classes = members.where("rep = id").select("id", "vector")
    asking = materialize(
        given.where("asks").select(F.col("id").alias("query_id"), "vector").distinct()
        .join(classes, "vector")
        .select("query_id", "id", "vector"),
        "asking",
    )
    indexed = materialize(
        classes.mapInArrow(
            _hash(tables, hashes, 1),
            f"tab int, bucket long, id long, vector {classes.schema['vector'].dataType.simpleString()}",
        ),
        "vector-buckets",
    )
    asked = asking.select("id", "vector").dropDuplicates(["id"])
    near = _met(indexed, asked, k, _hash(tables, hashes, probes))
    times = 1
    while True:
        short = _short(near, members, asked, k)
        longest = short.agg(F.max("length")).first()[0]
        if longest is None or times * (probes or probed(longest)) >= every_bucket(longest, hashes):
            break
        times *= FURTHER
        further = _met(indexed, asked.join(short, "id", "left_semi"), k, _hash(tables, hashes, probes, times))
        kept = near.join(short.select(F.col("id").alias("query")), "query", "left_anti")
        near = materialize(kept.unionByName(further), "near-classes")
    # Each class stands for its smallest ids; a query drops its own.
    candidates = near.join(members.select("rep", F.col("id").alias("found")), "rep")
    ranked = Window.partitionBy("query_id").orderBy("score", "found")
    return (
        asking.select("query_id", F.col("id").alias("query"))
        .join(candidates, "query")
        .where("found <> query_id")
        .groupBy("query_id", "found")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias(key), "score")
    )


def op9_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every hundredth vector among all."""
    embeddings = table(spark, sf_dir, "embeddings")
    return neighbours(embeddings, F.col("vec_id") % 100 == 0, k=10)
