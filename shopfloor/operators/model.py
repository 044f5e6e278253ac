"""The failure classifier: split, class weights, random forest, run record."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.functions import guarded_round, hash_bucket
from shopfloor.operators.evaluation import classification_metrics, roc_auc, to_long
from shopfloor.operators.joins import join_on
from shopfloor.operators.ordered import with_sequence
from shopfloor.scratch import materialize

FEATURES = ("temperature_c", "vibration_mm_s", "pressure_psi")
LABEL = "will_fail_within_6h"


def hash_split(
    df: DataFrame, key: Sequence[str], test_percent: int = 25, name: str = "is_test"
) -> DataFrame:
    """``df`` plus 1 for test rows, chosen by the hash of ``key``.

    Independent of row order and partitioning. Key on the machine, or on the machine
    and the day, to keep neighbouring readings on one side. Class shares hold in
    expectation; :func:`split_balance` reports them.
    """
    bucket = hash_bucket([F.col(c) for c in key])
    return df.withColumn(name, (bucket < test_percent).cast("int"))


def time_split(
    df: DataFrame, ts: str, test_from: str, name: str = "is_test"
) -> DataFrame:
    """``df`` plus 1 for rows at or after ``test_from``: train on the past only."""
    return df.withColumn(name, (F.col(ts) >= F.lit(test_from).cast("timestamp")).cast("int"))


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    label: str = LABEL,
    test_fraction: float = 0.25,
    name: str = "is_test",
    pieces: int | None = None,
) -> DataFrame:
    """``df`` plus 1 for test rows, the same share of each class to the row.

    Within a class the rows with the least key hashes form the test side. ``key`` has to
    identify a row. ``df`` is evaluated and written once; then the last test row of each class is
    found by counting hash prefixes (:func:`kth_least`), and all rows are compared with it where
    they lie. With ``pieces`` the rows are sorted in that many pieces instead.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    hashed = materialize(df.withColumn("__hash", F.md5(text)), "split-input")
    sizes = materialize(
        hashed.groupBy(label).agg(
            F.round(F.count("*") * test_fraction).cast("bigint").alias("__n_test")
        ),
        "class-sizes",
    )
    if pieces is None:
        wanted = sizes.select(label, F.col("__n_test").alias("rank"))
        last = kth_least(hashed, wanted, label, "__hash", key).select(
            label, F.col("last").alias("__last")
        )
        up_to = F.struct("__hash", *key) <= F.col("__last")
        return join_on(hashed, last, [label], "left").select(
            *df.columns, F.coalesce(up_to, F.lit(False)).cast("int").alias(name)
        )
    ranked = with_sequence(
        hashed,
        [label],
        ["__hash", *key],
        df.columns,
        "__sequence",
        pieces,
    )
    in_test = F.col("__sequence") < F.col("__n_test")
    return join_on(ranked, sizes, [label]).select(
        *df.columns, in_test.cast("int").alias(name)
    )


def kth_least(
    rows: DataFrame,
    wanted: DataFrame,
    label: str,
    hashed: str,
    ties: Sequence[str],
    digits: int = 4,
    few: int = 10_000,
) -> DataFrame:
    """Per class of ``wanted`` its row of place ``rank``, from 1, in the order of (hash, ties).

    ``label, last``, the latter a struct of hash and ties. ``hashed`` holds hexadecimal text.
    A class's rows are counted by the next ``digits`` of their hash, on the map side; the
    prefix that holds the place is refined until no more than ``few`` rows share it, and only
    these are sorted. So ``n`` rows take a scan for every factor of ``16 ** digits`` in ``n / few``.
    """
    state = materialize(
        wanted.where(F.col("rank") > 0).select(
            label, F.lit("").alias("prefix"), "rank", F.lit(None).cast("bigint").alias("held")
        ),
        "split-state",
    )

    def inside(state: DataFrame) -> DataFrame:
        given = state.select(label, "prefix", "rank")
        return join_on(rows.select(label, hashed, *ties), given, [label]).where(
            F.startswith(F.col(hashed), F.col("prefix"))
        )

    for known in range(0, 32, digits):
        counted = (
            inside(state)
            .groupBy(label, "rank", F.substring(hashed, 1, known + digits).alias("prefix"))
            .agg(F.count("*").alias("held"))
        )
        # At most 16 ** digits rows of a class.
        upto = F.sum("held").over(Window.partitionBy(label).orderBy("prefix"))
        state = materialize(
            counted.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("held") < F.col("rank")))
            .select(label, "prefix", (F.col("rank") - F.col("upto") + F.col("held")).alias("rank"), "held"),
            "split-state",
        )
        # One row per class.
        if state.where(F.col("held") > few).isEmpty():
            break
    order = [hashed, *ties]
    place = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    found = inside(state).withColumn("place", place).where(F.col("place") == F.col("rank"))
    return materialize(found.select(label, F.struct(*order).alias("last")), "split-borders")


def split_balance(df: DataFrame, label: str = LABEL, split: str = "is_test") -> DataFrame:
    """Rows and positive share on each side of a split."""
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("n_positive"),
        guarded_round(F.avg(label), 6).alias("positive_rate"),
    )


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight ``n / (k * n_c)`` of each of the k classes; NULL is no class."""
    counts = materialize(
        df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows")), "class-counts"
    )
    total = counts.agg(F.sum("n_rows")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return counts.withColumn("weight", total / (classes * F.col("n_rows")))


def with_class_weights(
    df: DataFrame, label: str = LABEL, name: str = "weight"
) -> DataFrame:
    """``df`` plus the balanced weight of each row's class."""
    return join_on(df, class_weights(df, label), [label]).select(
        *df.columns, F.col("weight").alias(name)
    )


def trainable(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL
) -> tuple[DataFrame, DataFrame]:
    """The rows with a label and all features, and the rest."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*features, label]])
    return df.where(complete), df.where(~complete)


def bucketizer(
    edges: Sequence[Sequence[float]], features: Sequence[str], names: Sequence[str], invalid: str = "error"
) -> Bucketizer:
    """The bin of each feature: how many of its ``edges`` lie below the value."""
    splits = []
    for own in edges:
        # A bucket does not hold its upper split, but a bin holds its edge.
        above = sorted({math.nextafter(e, math.inf) for e in own} - {math.inf}) or [0.0]
        splits.append([-math.inf, *above, math.inf])
    return Bucketizer(
        splitsArray=splits, inputCols=list(features), outputCols=list(names), handleInvalid=invalid
    )


def bin_edges(
    weighted: DataFrame,
    features: Sequence[str],
    label: str,
    max_bins: int,
    seed: int,
    partitions: int,
) -> list[list[float]]:
    """Per feature the upper edges of at most ``max_bins`` bins.

    As MLlib does, the edges are taken of ``max_bins ** 2`` rows, at least 10,000, drawn by
    ``weight``: all values if they are few, else as many quantiles of each class.
    """
    columns = weighted.columns
    dealt = weighted.repartition(partitions, *columns).sortWithinPartitions(*columns)
    share = max(max_bins**2, 10_000) / max(weighted.count(), 1)
    drawn = materialize(dealt.where(F.rand(seed) < F.col("weight") * share), "bin-rows")
    classes = drawn.select(label).distinct().count()
    cuts = max(max_bins // max(classes, 1), 2)
    shares = [k / cuts for k in range(1, cuts)]
    # This accuracy is exact for so few rows.
    quantiles = drawn.groupBy(label).agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, 1_000_000).alias(c) for c in features]
    ).collect()
    values = [F.collect_set(F.col(c).cast("double")) for c in features]
    few = drawn.agg(
        *[F.when(F.size(v) <= max_bins, F.sort_array(v)).alias(c) for v, c in zip(values, features, strict=True)]
    ).first()
    return [
        few[c][:-1] if few[c] is not None else sorted({q for row in quantiles for q in row[c]})
        for c in features
    ]


def train_forest(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    trees: int = 200,
    max_depth: int = 8,
    min_leaf: int = 5,
    max_bins: int = 128,
    features_per_split: str = "1",
    cache_node_ids: bool = False,
    seed: int = 42,
    training_partitions: int = 16,
    max_training_rows: int | None = None,
    cell_parts: int = 64,
) -> PipelineModel:
    """Random forest with balanced class weights.

    ``features_per_split="1"`` tries one random feature per split, the integer square
    root of three features. Rows without label or with a missing feature are left out.
    The training columns are written once, since fitting reads them several times.

    The learner tells rows apart by their bins and class alone, so all rows are counted in cells
    of (bins, class) and the forest is fitted on these. A cell of up to ``cell_parts`` rows enters
    as its rows, a larger one as ``cell_parts`` parts that share its whole weight: each tree's
    bootstrap draws parts instead of single rows there. So the fit grows with the cells, not
    with the rows; ``cell_parts`` at or above the rows draws every row by itself.

    MLlib draws its bootstrap samples per partition, so the parts are dealt into
    ``training_partitions`` by their hash and sorted there: the model depends on the rows,
    the seed and that number, not on the cluster. Raise it with the number of cells.
    ``max_training_rows`` bounds the rows by their hash (in expectation).
    ``cache_node_ids`` keeps each part's node per tree, which spares walking every tree anew
    at every level at the price of four bytes per part and tree.
    """
    complete, _ = trainable(train, features, label)
    rows = complete.select(*features, F.col(label).cast("double").alias(label))
    if max_training_rows is not None:
        share = min(1.0, max_training_rows / max(rows.count(), 1))
        chosen = F.pmod(F.xxhash64(*rows.columns, F.lit(seed)), F.lit(1_000_000))
        rows = rows.where(chosen < round(share * 1_000_000))
    weighted = materialize(with_class_weights(rows, label), "training-rows")
    bins = [f"__bin_{c}" for c in features]
    binning = bucketizer(
        bin_edges(weighted, features, label, max_bins, seed, training_partitions), features, bins
    )
    # The cast drops the mark of a nominal column: bins have an order.
    numbers = [F.col(b).cast("int").alias(b) for b in bins]
    binned = binning.transform(weighted).select(*numbers, label, "weight")
    cells = materialize(
        binned.groupBy(*bins, label, "weight").agg(F.count("*").alias("n_rows")), "training-cells"
    )
    parts = F.least(F.col("n_rows"), F.lit(cell_parts))
    drawn = cells.select(
        *bins,
        label,
        (F.col("weight") * (F.col("n_rows") / parts)).alias("weight"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), parts)).alias("part"),
    )
    columns = drawn.columns
    drawn = drawn.repartition(training_partitions, *columns).sortWithinPartitions(*columns)
    assembler = VectorAssembler(inputCols=bins, outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        maxBins=max_bins,
        featureSubsetStrategy=features_per_split,
        cacheNodeIds=cache_node_ids,
        seed=seed,
    )
    return PipelineModel([binning, *Pipeline(stages=[assembler, forest]).fit(drawn).stages])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus the class-1 probability ``score`` and the hard ``prediction``.

    Rows with a missing feature cannot be scored; see :func:`trainable`.
    """
    return model.transform(df).select(
        *[F.col(c) for c in df.columns],
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def feature_importance(
    spark: SparkSession, model: PipelineModel, features: Sequence[str] = FEATURES
) -> DataFrame:
    """One ``(feature, importance)`` row per feature."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double")


def evaluation_metrics(
    scored: DataFrame, label: str = LABEL, score_column: str = "score"
) -> DataFrame:
    """Long ``(metric, value)`` rows: precision, recall, F1 and ROC-AUC."""
    hard = classification_metrics(scored, label, score_column, digits=None)
    area = roc_auc(scored, label, score_column, digits=None)
    return to_long(hard.select("precision", "recall", "f1_score")).unionByName(
        to_long(area.select("roc_auc"))
    )


def run_record(
    metrics: DataFrame,
    run_name: str,
    params: dict[str, object],
    started: datetime | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Long rows of one training run, ready to append.

    ``run_id, started_at, run_name, kind, name, value``; every call is a run of its own
    unless ``run_id`` says otherwise.
    """
    spark = metrics.sparkSession
    run_id = run_id or uuid.uuid4().hex
    started = started or datetime.now(UTC)
    identity = [
        F.lit(run_id).alias("run_id"),
        F.lit(started.isoformat()).cast("timestamp").alias("started_at"),
    ]
    given = spark.createDataFrame(
        [(run_name, "param", name, str(value)) for name, value in params.items()],
        "run_name string, kind string, name string, value string",
    )
    measured = metrics.select(
        F.lit(run_name).alias("run_name"),
        F.lit("metric").alias("kind"),
        F.col("metric").alias("name"),
        F.col("value").cast("string").alias("value"),
    )
    return given.unionByName(measured).select(*identity, "*")


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    """Persist a fitted model under its name and version."""
    path = f"{root.rstrip('/')}/{name}/{version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}/{version}")
