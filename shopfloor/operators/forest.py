"""A fitted forest as a table of nodes, and scoring as a walk over it.

The walk is independent of the library that fitted the forest, so it can check what that library
scores, and it lets a forest be scored, audited and explained by SQL alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators.model import bucketizer
from shopfloor.scratch import materialize, scratch_path

LEAF = -1


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved forest of two classes, read from its own files.

    ``tree, node, feature, threshold, left, right, share, weight, rows, gain``: a row goes
    ``left`` if its feature is at most ``threshold``; ``feature`` is -1 at a leaf; ``share`` is
    the weighted share of class 1 and ``weight`` the weight of the node's training rows.
    """
    node = F.col("nodeData")
    split, stats = node["split"], node["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path.rstrip('/')}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        split["featureIndex"].alias("feature"),
        F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        (stats[1] / total).alias("share"),
        total.alias("weight"),
        node["rawCount"].alias("rows"),
        node["gain"].alias("gain"),
    )


def nodes_of(model: PipelineModel) -> DataFrame:
    """The node table of a fitted pipeline's forest; its size depends on the forest alone.

    If the pipeline puts its features into bins first, the thresholds are the bins' edges, so
    that they hold for the features themselves.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    model.stages[-1].write().save(path)
    nodes = node_table(spark, path)
    for stage in model.stages:
        if isinstance(stage, Bucketizer):
            edges = [
                F.array(*[F.lit(math.nextafter(s, -math.inf)) for s in splits[1:]])
                for splits in stage.getSplitsArray()
            ]
            edge = F.get(F.get(F.array(*edges), F.col("feature")), F.floor("threshold").cast("int"))
            nodes = nodes.withColumn("threshold", F.when(F.col("feature") != LEAF, edge))
    return materialize(nodes, "forest-nodes")


def depth_of(model: PipelineModel) -> int:
    return max(tree.depth for tree in model.stages[-1].trees)


def walk(
    rows: DataFrame, nodes: DataFrame, key: Sequence[str], features: Sequence[str], depth: int
) -> DataFrame:
    """``key`` and the mean ``score`` of the leaves that each row reaches, one per tree.

    Rows between the same thresholds in every feature reach the same leaves. So the rows are put
    into cells between the forest's thresholds, each cell descends all trees level by level, and a
    row takes the score of its cell; rows with the same ``key`` are averaged. ``rows`` is read
    twice. The node table is small, so the levels are joins without a shuffle, and a cell's
    leaves are averaged where they are found.
    """
    trees = nodes.agg(F.max("tree")).scalar()
    every_tree = F.explode(F.sequence(F.lit(0), trees)).alias("tree")
    binned, bins = _between_thresholds(rows, nodes, key, features)
    # Any row of a cell stands for it.
    cells = binned.groupBy(*bins).agg(F.min("__x").alias("__x"))
    # Few rows, but much work for each.
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    state = (
        materialize(cells, "forest-cells")
        .repartition(spread, *bins)
        .select(*bins, "__x", every_tree)
        .withColumn("node", F.lit(0))
    )
    value = F.get(F.col("__x"), F.col("feature"))
    below = F.when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
    step = F.when(F.col("feature") == LEAF, F.col("node")).otherwise(below)
    split = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        state = state.join(split, ["tree", "node"]).select(*bins, "__x", "tree", step.alias("node"))
    leaves = nodes.where(F.col("feature") == LEAF).select("tree", "node", "share")
    scores = materialize(
        state.join(leaves, ["tree", "node"]).groupBy(*bins).agg(F.avg("share").alias("score")),
        "forest-cell-scores",
    )
    return (
        binned.select(*key, *bins).join(scores, bins).groupBy(*key).agg(F.avg("score").alias("score"))
    )


def _between_thresholds(
    rows: DataFrame, nodes: DataFrame, key: Sequence[str], features: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """``rows`` with their features as ``__x``, and their bins between the thresholds.

    A missing feature is at most no threshold, and so is NaN: they share a bin.
    """
    found = nodes.where(F.col("feature") != LEAF).groupBy("feature").agg(
        F.collect_set("threshold").alias("edges")
    )
    edges = {r["feature"]: r["edges"] for r in found.collect()}
    columns = [F.col(c).cast("double") for c in features]
    values, bins = ([f"__{kind}_{k}" for k in range(len(columns))] for kind in ("value", "bin"))
    plain = rows.select(
        *key,
        F.array(*columns).alias("__x"),
        *[F.coalesce(c, F.lit(math.nan)).alias(v) for c, v in zip(columns, values, strict=True)],
    )
    cut = bucketizer([edges.get(k, []) for k in range(len(columns))], values, bins, "keep")
    return cut.transform(plain).drop(*values), bins


def importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, importance``: weighted gain per feature, each tree and the whole scaled to one."""
    gained = (
        nodes.where(F.col("feature") != LEAF)
        .groupBy("tree", "feature")
        .agg(F.sum(F.col("gain") * F.col("weight")).alias("gained"))
    )
    totals = gained.groupBy("tree").agg(F.sum("gained").alias("total")).where("total > 0")
    shares = (
        gained.join(totals, "tree")
        .groupBy("feature")
        .agg(F.sum(F.col("gained") / F.col("total")).alias("share"))
    )
    whole = F.coalesce(shares.agg(F.sum("share")).scalar(), F.lit(1.0))
    spark = nodes.sparkSession
    names = spark.createDataFrame(list(enumerate(features)), "number int, name string")
    return names.join(shares, F.col("number") == F.col("feature"), "left").select(
        F.col("name").alias("feature"),
        (F.coalesce("share", F.lit(0.0)) / whole).alias("importance"),
    )


def audit(nodes: DataFrame) -> DataFrame:
    """Per tree its nodes, leaves, roots, orphans, depth-first order and least rows of a leaf.

    ``n_strays`` counts children that are missing or have several parents.
    """
    children = nodes.where(F.col("feature") != LEAF).select(
        "tree", F.explode(F.array("left", "right")).alias("node")
    )
    parents = children.groupBy("tree", "node").agg(F.count("*").alias("n_parents"))
    joined = nodes.join(parents, ["tree", "node"], "full")
    own = F.coalesce("n_parents", F.lit(0))
    expected = F.when(F.col("node") == 0, 0).otherwise(1)
    return joined.groupBy("tree").agg(
        F.count("feature").alias("n_nodes"),
        F.count_if(F.col("feature") == LEAF).alias("n_leaves"),
        F.count_if(F.col("feature").isNull() | (own != expected)).alias("n_strays"),
        F.min(F.when(F.col("feature") == LEAF, F.col("rows"))).alias("least_rows"),
    )
