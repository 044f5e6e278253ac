"""The registered queries: each operator applied to the provided tables.

The provided tables are not shop-floor tables, so each plays a role: an event type
stands for a production line, a user for a machine, an ``error`` event for a failure
or a stop, an order priority for a downtime reason.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions import capability_grade, guarded_round, spec_flag
from shopfloor.operators import (
    checks,
    conform,
    evaluation,
    forest,
    labels,
    model,
    oee,
    pareto,
    silver,
    spc,
)
from shopfloor.operators.ordered import with_sequence
from shopfloor.plans import incremental
from shopfloor.plans.roles import TARGET, TOLERANCE, measurements, stops_as_raw, table
from shopfloor.plans.streams import STREAM_QUERIES
from shopfloor.scratch import materialize, scratch_path
from shopfloor.sources import buckets, tables, versions
from shopfloor.sources.readers import (
    ARRIVAL,
    read_csv,
    read_parquet,
    split_corrupt,
    with_arrival,
)
from shopfloor.sources.schemas import (
    DOWNTIME_EVENTS,
    SERVED_CAPABILITY,
    SERVED_CONTROL_CHART,
    SERVED_MACHINE_DAILY_OEE,
    STG_DOWNTIME_EVENTS,
    STG_MACHINE_DAILY_OEE,
)
from shopfloor.sources.writers import write_by_date, write_csv
from shopfloor.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# For queries that set the number of pieces of an ordered pass.
PIECES = 16
USL, LSL = TARGET + TOLERANCE, TARGET - TOLERANCE
FEATURES = ("value", "hour_of_day", "vibration")
# What a forest has to reach on the test rows: guessing gives 0.5 and no gap between the classes.
LEAST_AUC, LEAST_GAP = 0.75, 0.2
TREES, MAX_DEPTH, MIN_LEAF = 200, 8, 5
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


# --- roles ---------------------------------------------------------------------------


def _machine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("machine_id"),
        (F.col("user_id") % 5).alias("line_id"),
        "ts",
        "event_type",
        "value",
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _machine_rows(spark, sf_dir).where(F.col("event_type") != "error")
    return rows.select(
        "machine_id",
        "line_id",
        F.to_date("ts").alias("measured_date"),
        spec_flag(F.col("value"), TARGET, TOLERANCE).alias("in_spec"),
    )


def downtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _machine_rows(spark, sf_dir).where(F.col("event_type") == "error")
    return rows.select(
        "machine_id",
        "line_id",
        F.to_date("ts").alias("downtime_date"),
        (F.col("value") / 100).alias("downtime_hours"),
    )


def stops_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("reason"),
        F.col("o_totalprice").alias("downtime_hours"),
    )


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return failed.select("user_id", F.col("ts").alias("failure_ts"))


def labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    readings = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", *columns)
    return labels.failure_horizon_label(
        readings,
        _failures(spark, sf_dir),
        machine="user_id",
        ts="ts",
        failure_ts="failure_ts",
        label="label",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir, "value").select(
        "label", (F.col("value") / 500).alias("score")
    )


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings; a machine that has just failed vibrates more than others."""
    failed = (F.col("event_type") == "error").cast("int")
    rows = labelled(spark, sf_dir, "value", "event_type").select(
        "event_id",
        "value",
        F.hour("ts").cast("double").alias("hour_of_day"),
        (F.col("value") / 50 + 5 * failed).alias("vibration"),
        "label",
    )
    return model.hash_split(rows, ["event_id"])


_forests: dict[tuple, PipelineModel] = {}


def _forest(spark: SparkSession, sf_dir: str, trees: int = TREES) -> PipelineModel:
    """The forest of the training rows, fitted once for all queries of an application."""
    key = (spark.conf.get("spark.app.id", ""), sf_dir, trees)
    if key not in _forests:
        rows = training_rows(spark, sf_dir).where("is_test = 0")
        _forests[key] = model.train_forest(
            rows, FEATURES, "label", trees=trees, max_depth=MAX_DEPTH, min_leaf=MIN_LEAF
        )
    return _forests[key]


# --- silver --------------------------------------------------------------------------


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("string").alias("reading_ts")
    )
    good, _ = silver.split_valid(
        silver.typed(raw, "reading_ts", "reading_date"), F.col("reading_ts").isNotNull()
    )
    return good.withColumn("reading_ts", F.col("reading_ts").cast("timestamp_ntz"))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_quantity",
        "l_extendedprice",
    )
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    return silver.deduplicate(rows, ["l_orderkey", "l_linenumber"], order)


def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    return read_parquet(spark, path, columns)


def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the events by date, read the table back with a pruned projection."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("reading_date")
    )
    path = scratch_path(spark, "events-by-date")
    write_by_date(rows, path, "reading_date")
    return read_parquet(
        spark, path, ["event_id", "value", "reading_date"], schema=rows.schema
    )


def scan_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of some days, read from the folders of these days alone."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "value", F.to_date("ts").alias("reading_date")
    )
    path = scratch_path(spark, "events-by-date")
    write_by_date(rows, path, "reading_date")
    return read_parquet(
        spark, path, schema=rows.schema, date="reading_date", start="2024-01-05", end="2024-01-11"
    )


def csv_scan(spark: SparkSession, sf_dir: str, declared: bool = True) -> DataFrame:
    """Write the stops as CSV and read them back, with declared or inferred types."""
    path = scratch_path(spark, "stops-csv")
    rows = stops_as_raw(spark, sf_dir)
    write_csv(rows, path, rows.columns)
    read = read_csv(spark, path, DOWNTIME_EVENTS if declared else None)
    if declared:
        read, _ = split_corrupt(materialize(read, "stops-read"))
    stamp = F.col("downtime_start_ts").cast("timestamp_ntz")
    return read.withColumn("downtime_start_ts", stamp)


def dedup_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice, later with another value: the first one stays."""
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    folder = scratch_path(spark, "arrivals")
    for turn in range(2):
        later = rows.withColumn("value", F.col("value") + 1000 * turn)
        write_csv(later, f"{folder}/{turn}", later.columns)
    schema = "event_id bigint, value double"
    read = spark.read.schema(schema).option("header", True).csv(f"{folder}/*")
    arrived = materialize(with_arrival(read), "arrived")
    return silver.deduplicate(arrived, ["event_id"], ARRIVAL).select("event_id", "value")


def streaming_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops as a stream of CSV files, typed and free of copies, read from the sink."""
    rows = stops_as_raw(spark, sf_dir)
    source, sink = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    write_csv(rows.unionByName(rows), source, rows.columns)
    key = ["machine_id", "downtime_start_ts", "downtime_hours"]
    raw = ingest.read_csv_stream(spark, source, DOWNTIME_EVENTS)
    clean = ingest.silver_stream(raw, "downtime_start_ts", "downtime_date", key)
    checkpoint = scratch_path(spark, "stream-state")
    ingest.start_parquet_sink(clean, sink, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(clean.schema).parquet(sink).withColumn(
        "downtime_start_ts", F.col("downtime_start_ts").cast("timestamp_ntz")
    )


# --- quality, downtime, OEE ----------------------------------------------------------


def spec_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = spec_flag(F.col("value"), TARGET, TOLERANCE)
    return table(spark, sf_dir, "events").select(
        "event_id", "value", flag.alias("in_spec")
    )


def quality_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oee.quality_daily(quality(spark, sf_dir))


def downtime_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oee.downtime_daily(downtime(spark, sf_dir))


def machine_daily_oee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oee.machine_daily_oee(
        quality_daily(spark, sf_dir), downtime_daily(spark, sf_dir)
    )


def line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oee.line_summary(machine_daily_oee(spark, sf_dir))


def line_oee(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = oee.line_oee(machine_daily_oee(spark, sf_dir))
    return days.withColumn(
        "performance_assumed", F.col("performance_assumed").cast("double")
    )


def line_oee_with_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("line_id"),
        (F.col("r_regionkey") * 0.02).alias("target_units_per_hour"),
    )
    return oee.line_oee_with_rate(machine_daily_oee(spark, sf_dir), rates)


# --- statistical process control -----------------------------------------------------


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spc.subgroups(measurements(spark, sf_dir), tie_break=["event_id"])


def _capability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spc.capability_report(_groups(spark, sf_dir), usl=USL, lsl=LSL)


def _groups_shown(groups: DataFrame) -> DataFrame:
    return groups.select(
        "line_id",
        "subgroup_index",
        "subgroup_start_ts",
        guarded_round(F.col("xbar"), 6).alias("xbar"),
        guarded_round(F.col("range"), 6).alias("range"),
    )


def spc_subgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups_shown(_groups(spark, sf_dir))


def spc_subgroups_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut into a given number of pieces, as in the other ``in_pieces`` queries."""
    rows = measurements(spark, sf_dir)
    return _groups_shown(spc.subgroups(rows, tie_break=["event_id"], pieces=PIECES))


def spc_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = spc.control_limits(_groups(spark, sf_dir))
    figures = ["xbar_bar", "r_bar", "ucl_xbar", "lcl_xbar", "ucl_r", "lcl_r"]
    return limits.select(
        "line_id",
        "n_subgroups",
        *[guarded_round(F.col(c), 6).alias(c) for c in figures],
    )


def spc_control_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spc.control_chart(_groups(spark, sf_dir))


def spc_range_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spc.range_chart(_groups(spark, sf_dir))


def spc_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = spc.control_chart(_groups(spark, sf_dir), keep_index=True)
    return spc.first_subgroups(chart, 80)


def capability_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = _capability(spark, sf_dir).orderBy("cpk", "line_id")
    return ranked.select("line_id", "cpk", "n_subgroups")


def capability_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capability(spark, sf_dir).select(
        "line_id", "cpk", capability_grade(F.col("cpk")).alias("grade")
    )


# --- Pareto --------------------------------------------------------------------------


def downtime_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto.downtime_pareto(stops_by_reason(spark, sf_dir))


def downtime_pareto_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto.with_cumulative(downtime_pareto(spark, sf_dir))


# --- labels, split, evaluation -------------------------------------------------------


def failure_horizon_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir)


def next_failure(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    return labels.next_failure(
        table(spark, sf_dir, "events").select("event_id", "user_id", "ts"),
        _failures(spark, sf_dir),
        machine="user_id",
        ts="ts",
        failure_ts="failure_ts",
        how=how,
    )


def next_failure_in_pieces(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """By pieces of the timeline, as for machines with very many rows in one horizon."""
    return labels.next_failure_in_pieces(
        table(spark, sf_dir, "events").select("event_id", "user_id", "ts"),
        _failures(spark, sf_dir),
        machine="user_id",
        ts="ts",
        failure_ts="failure_ts",
        how=how,
        tie_break=["event_id"],
        pieces=PIECES,
    )


def label_positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.positive_rate(labelled(spark, sf_dir))


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id")
    return model.hash_split(rows, ["event_id"])


def stratified_split(
    spark: SparkSession, sf_dir: str, pieces: int | None = None
) -> DataFrame:
    rows = labelled(spark, sf_dir).select("event_id", "label")
    return model.stratified_split(rows, ["event_id"], "label", pieces=pieces)


def split_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = model.hash_split(labelled(spark, sf_dir), ["event_id"])
    return model.split_balance(split, "label")


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = model.class_weights(labelled(spark, sf_dir), "label")
    return weights.withColumn("weight", guarded_round(F.col("weight"), 6))


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.classification_metrics(scored(spark, sf_dir), threshold=0.1)


def roc_auc(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    return evaluation.roc_auc(scored(spark, sf_dir), pieces=pieces)


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(scored(spark, sf_dir), "scored")
    hard = evaluation.classification_metrics(rows, threshold=0.1, digits=None)
    area = evaluation.roc_auc(rows, digits=None)
    return evaluation.to_long(
        hard.select("precision", "recall", "f1_score")
    ).unionByName(evaluation.to_long(area.select("roc_auc")))


def rf_scores(spark: SparkSession, sf_dir: str, trees: int = TREES) -> DataFrame:
    """Every test event once, with its label and whether score and prediction agree."""
    test = training_rows(spark, sf_dir).where("is_test = 1")
    complete, _ = model.trainable(test, FEATURES, "label")
    return model.score(_forest(spark, sf_dir, trees), complete).select(
        "event_id",
        "label",
        F.col("score").between(0, 1).alias("score_in_range"),
        ((F.col("score") > 0.5).cast("int") == F.col("prediction")).alias("prediction_agrees"),
    )


def rf_importance(spark: SparkSession, sf_dir: str, trees: int = TREES) -> DataFrame:
    """Every feature with whether its importance is a share, and their sum."""
    found = model.feature_importance(spark, _forest(spark, sf_dir, trees), FEATURES)
    total = found.agg(F.round(F.sum("importance"), 6)).first()[0]
    return found.select(
        "feature",
        F.col("importance").between(0, 1).alias("is_share"),
        F.lit(total).alias("total"),
    )


def forest_walk(spark: SparkSession, sf_dir: str, trees: int = TREES) -> DataFrame:
    """Every event, scored by the fitted forest, by the saved and loaded one and by a walk over
    the saved one's nodes: whether all three agree."""
    fitted = _forest(spark, sf_dir, trees)
    root = scratch_path(spark, "models")
    model.save_model(fitted, root, "failure", 1)
    loaded = model.load_model(root, "failure", 1)
    nodes = forest.nodes_of(loaded)
    rows = materialize(training_rows(spark, sf_dir), "forest-rows")
    walked = forest.walk(rows, nodes, ["event_id"], FEATURES, forest.depth_of(loaded))
    by_fitted = model.score(fitted, rows).select("event_id", "label", "score", "prediction")
    by_loaded = model.score(loaded, rows).select("event_id", F.col("score").alias("loaded"))
    both = by_fitted.join(by_loaded, "event_id").join(
        walked.withColumnRenamed("score", "walked"), "event_id"
    )
    gap = F.abs(F.col("score") - F.col("walked"))
    return both.select(
        "event_id",
        "label",
        (F.col("score") == F.col("loaded")).alias("loads_alike"),
        (gap < 1e-9).alias("walks_alike"),
        # A tie is 0.5 give or take the order of addition.
        ((gap < 1e-9) & ((F.abs(F.col("walked") - 0.5) < 1e-9) | (
            (F.col("walked") > 0.5).cast("int") == F.col("prediction")
        ))).alias("predicts_alike"),
    )


def forest_quality(spark: SparkSession, sf_dir: str, trees: int = TREES) -> DataFrame:
    """What a forest that has learned nothing misses, by the walk's scores of the test events."""
    fitted = _forest(spark, sf_dir, trees)
    test = materialize(training_rows(spark, sf_dir).where("is_test = 1"), "forest-test")
    nodes = forest.nodes_of(fitted)
    walked = forest.walk(test, nodes, ["event_id"], FEATURES, forest.depth_of(fitted))
    rows = materialize(test.join(walked, "event_id").select("label", "score"), "forest-scores")
    area = evaluation.roc_auc(rows, digits=None)
    means = rows.agg(
        F.avg(F.when(F.col("label") == 1, F.col("score"))).alias("positive"),
        F.avg(F.when(F.col("label") == 0, F.col("score"))).alias("negative"),
        F.countDistinct("score").alias("n_scores"),
    )
    return area.select(
        "n_positive",
        "n_negative",
        (F.col("roc_auc") >= LEAST_AUC).alias("ranks_failures_first"),
        means.select(F.col("positive") - F.col("negative") >= LEAST_GAP)
        .scalar()
        .alias("scores_failures_higher"),
        means.select(F.col("n_scores") >= 20).scalar().alias("tells_rows_apart"),
    )


def forest_importance(spark: SparkSession, sf_dir: str, trees: int = TREES) -> DataFrame:
    """Importance from the node table beside the model's own; the informative feature leads."""
    fitted = _forest(spark, sf_dir, trees)
    own = forest.importance(forest.nodes_of(fitted), FEATURES)
    given = model.feature_importance(spark, fitted, FEATURES).withColumnRenamed("importance", "given")
    return own.join(given, "feature").select(
        "feature",
        (F.abs(F.col("importance") - F.col("given")) < 1e-9).alias("agrees"),
        (F.col("importance") > 0.5).alias("leads"),
    )


def forest_audit(spark: SparkSession, sf_dir: str, trees: int = TREES) -> DataFrame:
    """Every tree: whether it is a binary tree from one root with leaves of enough rows."""
    found = forest.audit(forest.nodes_of(_forest(spark, sf_dir, trees)))
    return found.select(
        F.col("tree").cast("bigint").alias("tree"),
        (F.col("n_nodes") == 2 * F.col("n_leaves") - 1).alias("is_binary"),
        (F.col("n_strays") == 0).alias("is_connected"),
        (F.col("n_leaves").between(2, 1 << MAX_DEPTH)).alias("is_grown"),
        (F.col("least_rows") >= MIN_LEAF).alias("leaves_are_large"),
    )


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of two runs appended to one table: what each holds, and in how many runs."""
    path = scratch_path(spark, "model-runs")
    measured = materialize(metrics_long(spark, sf_dir), "metrics")
    params = {"trees": TREES, "max_depth": MAX_DEPTH, "class_weights": "balanced"}
    for _ in range(2):
        model.run_record(measured, "failure-1", params).write.mode("append").parquet(path)
    is_metric = F.col("kind") == "metric"
    return (
        spark.read.parquet(path)
        .groupBy("run_name", "kind", "name")
        .agg(F.countDistinct("run_id").alias("n_runs"), F.min("value").alias("held"))
        .select(
            "run_name",
            "kind",
            "name",
            "n_runs",
            F.when(is_metric, F.col("held").try_cast("double")).alias("metric"),
            F.when(~is_metric, F.col("held")).alias("param"),
        )
    )


# --- increments and published versions -----------------------------------------------

QUALITY_FACT = incremental.Fact("quality_measurements", "ts", "measured_date", ("event_id",))
STOPS_FACT = incremental.Fact("downtime_events", "ts", "downtime_date", ("event_id",))
_delivered: dict[tuple, incremental.Tables] = {}


def _deliveries(spark: SparkSession, sf_dir: str) -> incremental.Tables:
    """The layers after three deliveries of the events, made once for all queries.

    The first holds the days up to the middle of the month, the second the later ones and copies
    of some earlier rows, and the third brings late rows of all days.
    """
    key = (spark.conf.get("spark.app.id", ""), sf_dir)
    if key in _delivered:
        return _delivered[key]
    late = F.col("event_id") % 97 == 0
    early = F.to_date("ts") <= F.lit("2024-01-15").cast("date")
    parts = {
        1: early & ~late,
        2: (~early & ~late) | (early & ~late & (F.col("event_id") % 7 == 0)),
        3: late,
    }
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("machine_id"),
        (F.col("user_id") % 5).alias("line_id"),
        "ts",
        "event_type",
        spec_flag(F.col("value"), TARGET, TOLERANCE).alias("in_spec"),
        (F.col("value") / 100).alias("downtime_hours"),
        F.concat(F.lit("reason "), F.col("user_id") % 3).alias("reason"),
    )
    target = scratch_path(spark, "increments")
    for batch in parts:
        own = rows.where(parts[batch])
        layers = incremental.run_increment(
            own.where("event_type <> 'error'").drop("event_type", "downtime_hours", "reason"),
            own.where("event_type = 'error'").drop("event_type", "in_spec"),
            target,
            batch,
            QUALITY_FACT,
            STOPS_FACT,
        )
    _delivered[key] = layers
    return layers


def incremental_machine_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deliveries(spark, sf_dir)["fct_machine_daily_oee"]


def incremental_line_oee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deliveries(spark, sf_dir)["fct_line_oee"].withColumn(
        "performance_assumed", F.col("performance_assumed").cast("double")
    )


def incremental_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.pareto_of_days(_deliveries(spark, sf_dir)["downtime_by_reason"])


def delivery_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which days of which table each delivery has touched."""
    return _deliveries(spark, sf_dir)["manifest"]


def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table are published and a third is written but not committed; then, per
    event, what a reader of the table and a reader of its first version see."""
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    root = scratch_path(spark, "published")
    versions.publish_version(rows.where("event_id % 2 = 0"), root)
    versions.publish_version(rows, root)
    versions.stage(rows.withColumn("value", F.lit(-1.0)), root)
    first = versions.read_version(spark, root, 1).select("event_id", F.lit(True).alias("in_first"))
    return versions.read_version(spark, root).join(first, "event_id", "left").select(
        "event_id", "value", F.coalesce("in_first", F.lit(False)).alias("in_first")
    )


def published_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart is published to the catalog, replaced, staged as a view, read in order and audited:
    every row with its place in that reading and the audited row count."""
    days = machine_daily_oee(spark, sf_dir)
    name = f"mart_{uuid.uuid4().hex}"
    tables.publish_table(days.where("line_id = 0"), name, scratch_path(spark, "mart"))
    tables.publish_table(days, name, scratch_path(spark, "mart"))
    view = f"stg_{name}"
    tables.publish_view(conform.staged(spark.table(name), STG_MACHINE_DAILY_OEE), view)
    audit = materialize(checks.row_count_audit({view: spark.table(view)}), "audit")
    read = tables.ordered_table(spark, view, "production_date", "machine_id", "line_id")
    rows = materialize(
        read.select(
            "machine_id",
            "line_id",
            "production_date",
            F.monotonically_increasing_id().alias("turn"),
        ),
        "ordered-reading",
    )
    keep = ["machine_id", "line_id", "production_date"]
    return with_sequence(rows, [], ["turn"], keep, "place").withColumn(
        "row_count", audit.select("row_count").scalar()
    )


def bucketed_machine_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machine-day fact from facts in buckets: raw rows with copies are written once in the
    layout that deduplication, both aggregates and their join read without another shuffle."""
    key = ["machine_id", "line_id", "day"]
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("machine_id"),
        (F.col("user_id") % 5).alias("line_id"),
        F.to_date("ts").alias("day"),
        "event_type",
        spec_flag(F.col("value"), TARGET, TOLERANCE).alias("in_spec"),
        (F.col("value") / 100).alias("downtime_hours"),
    )
    rows = rows.unionByName(rows.where("event_id % 3 = 0"))
    parts = {"quality": rows.where("event_type <> 'error'"), "stops": rows.where("event_type = 'error'")}
    facts = {}
    for name, part in parts.items():
        stored = buckets.write_bucketed(
            part, f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name), key, PIECES
        )
        facts[name] = silver.deduplicate(stored, [*key, "event_id"])
    return oee.machine_daily_oee(
        oee.quality_daily(facts["quality"], date="day"),
        oee.downtime_daily(facts["stops"], date="day"),
    )


def gate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables behind their data tests: each test, its failures, and whether the gate has
    let the table be published."""
    lines, orders = (table(spark, sf_dir, n) for n in ("lineitem", "orders"))
    plan = {
        "orders": (orders, ["o_orderkey", "o_totalprice"], ["o_orderkey"]),
        "lineitem": (lines, ["l_orderkey"], [["l_orderkey", "l_linenumber"]]),
        "days": (_days_before_fill(spark, sf_dir), ["machine_id", "downtime_hours"], []),
    }
    root = scratch_path(spark, "gated")
    found = []
    for name, (rows, not_null, unique) in plan.items():
        summary = materialize(checks.check_summary(rows, name, not_null, unique), "summary")
        try:
            checks.gate(summary)
            versions.publish_version(rows.select(*not_null), f"{root}/{name}")
        except checks.DataCheckError:
            pass
        shown = bool(versions.versions(spark, f"{root}/{name}"))
        found.append(
            summary.select(
                F.lit(name).alias("table_name"),
                "check_name",
                "failures",
                F.lit(shown).alias("published"),
            )
        )
    return reduce(DataFrame.unionByName, found)


# --- data tests, conformance, audit --------------------------------------------------


def _days_before_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["machine_id", "line_id", "production_date"]
    days = quality_daily(spark, sf_dir)
    return days.join(downtime_daily(spark, sf_dir), key, "left")


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_not_null(
        _days_before_fill(spark, sf_dir),
        ["machine_id", "production_date", "quality_rate", "downtime_hours"],
    )


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_summary(
        table(spark, sf_dir, "lineitem"),
        "lineitem",
        not_null=["l_orderkey", "l_returnflag"],
        unique=["l_partkey", ["l_orderkey", "l_linenumber"]],
    )


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pk_violations(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def staged_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.staged(machine_daily_oee(spark, sf_dir), STG_MACHINE_DAILY_OEE)


def staged_downtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stops_as_raw(spark, sf_dir).withColumn("extra", F.lit("left behind"))
    staged = conform.staged(rows, STG_DOWNTIME_EVENTS)
    stamp = F.col("downtime_start_ts").cast("timestamp_ntz")
    return staged.withColumn("downtime_start_ts", stamp)


def served_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control chart as served: renamed, flags as booleans, decimals shown as text."""
    served = conform.conform(spc_control_chart(spark, sf_dir), SERVED_CONTROL_CHART)
    stamp = F.col("subgroup_start_ts").cast("timestamp_ntz")
    return _decimals_as_text(served).withColumn("subgroup_start_ts", stamp)


def served_capability(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = conform.conform(_capability(spark, sf_dir), SERVED_CAPABILITY)
    return _decimals_as_text(served)


def _decimals_as_text(served: DataFrame) -> DataFrame:
    decimals = [f.name for f in served.schema if f.dataType.typeName() == "decimal"]
    return served.withColumns({c: F.col(c).cast("string") for c in decimals})


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform(machine_daily_oee(spark, sf_dir), SERVED_MACHINE_DAILY_OEE)


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals as text, which shows their scale as well as their value."""
    return _decimals_as_text(_conformed(spark, sf_dir))


def conform_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = materialize(_conformed(spark, sf_dir), "served")
    return conform.conform_violations(served, SERVED_MACHINE_DAILY_OEE)


def row_count_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_count_audit({name: table(spark, sf_dir, name) for name in TABLES})


def row_counts_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {name: f"{sf_dir.rstrip('/')}/{name}.parquet" for name in TABLES}
    return checks.footer_counts(spark, paths)


QUERIES: dict[str, Query] = {
    "silver_typed": silver_typed,
    "silver_dedup": silver_dedup,
    "scan_pruned": scan_pruned,
    "partitioned_scan": partitioned_scan,
    "scan_dates": scan_dates,
    "csv_scan": csv_scan,
    "csv_inferred": partial(csv_scan, declared=False),
    "dedup_by_arrival": dedup_by_arrival,
    "streaming_silver": streaming_silver,
    "spec_flag": spec_flags,
    "quality_daily": quality_daily,
    "downtime_daily": downtime_daily,
    "machine_daily_oee": machine_daily_oee,
    "line_summary": line_summary,
    "line_oee": line_oee,
    "line_oee_with_rate": line_oee_with_rate,
    "spc_subgroups": spc_subgroups,
    "spc_subgroups_in_pieces": spc_subgroups_in_pieces,
    "spc_limits": spc_limits,
    "spc_control_chart": spc_control_chart,
    "spc_range_chart": spc_range_chart,
    "spc_capability": _capability,
    "spc_first_n": spc_first_n,
    "capability_ranked": capability_ranked,
    "capability_grade": capability_grades,
    "downtime_pareto": downtime_pareto,
    "downtime_pareto_cumulative": downtime_pareto_cumulative,
    "failure_horizon_label": failure_horizon_label,
    "next_failure": next_failure,
    "next_failure_in_pieces": next_failure_in_pieces,
    "next_failure_left_in_pieces": partial(next_failure_in_pieces, how="left"),
    "next_failure_left": partial(next_failure, how="left"),
    "label_positive_rate": label_positive_rate,
    "hash_split": hash_split,
    "stratified_split": stratified_split,
    "stratified_split_in_pieces": partial(stratified_split, pieces=PIECES),
    "split_balance": split_balance,
    "class_weights": class_weights,
    "classification_metrics": classification_metrics,
    "roc_auc": roc_auc,
    "roc_auc_in_pieces": partial(roc_auc, pieces=PIECES),
    "metrics_long": metrics_long,
    "rf_scores": rf_scores,
    "rf_importance": rf_importance,
    "forest_walk": forest_walk,
    "forest_quality": forest_quality,
    "forest_importance": forest_importance,
    "forest_audit": forest_audit,
    "run_records": run_records,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_summary": check_summary,
    "pk_violations": pk_violations,
    "staged_projection": staged_projection,
    "staged_downtime": staged_downtime,
    "served_chart": served_chart,
    "served_capability": served_capability,
    "conform_schema": conform_schema,
    "conform_violations": conform_violations,
    "row_count_audit": row_count_audit,
    "row_counts_from_footers": row_counts_from_footers,
    "incremental_machine_days": incremental_machine_days,
    "incremental_line_oee": incremental_line_oee,
    "incremental_pareto": incremental_pareto,
    "delivery_manifest": delivery_manifest,
    "published_versions": published_versions,
    "published_layer": published_layer,
    "gate_blocks": gate_blocks,
    "bucketed_machine_days": bucketed_machine_days,
    **STREAM_QUERIES,
}
