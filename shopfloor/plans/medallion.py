"""The whole shop-floor job: bronze, silver, gold, SPC, marts and the failure model.

Each layer is written once and read back, so a later step never recomputes an earlier
one and the row counts are those of the stored tables. Everything is overwritten in
place; a rerun needs no clean-up. Only the record of model runs is appended to.

After the transform three branches run beside each other: charts and served tables, marts, and
the failure model. A failed data test stops what depends on it and is raised at the end; the other
branches are finished all the same.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators import checks, conform, model, oee, pareto, silver, spc
from shopfloor.scratch import materialize, scratch_scope
from shopfloor.sources import schemas
from shopfloor.sources.readers import (
    ARRIVAL,
    CORRUPT,
    read_csv,
    with_arrival,
)
from shopfloor.sources.tables import publish_table, publish_view
from shopfloor.sources.writers import write_by_date, write_csv, write_parquet

Tables = dict[str, DataFrame]

# Timestamp, date column and key of the raw fact tables.
FACTS = {
    "sensor_readings": ("reading_ts", "reading_date", ("machine_id", "reading_ts")),
    "quality_measurements": (
        "measured_ts",
        "measured_date",
        ("machine_id", "measured_ts"),
    ),
    "downtime_events": ("downtime_start_ts", "downtime_date", ()),
}


@dataclass(frozen=True)
class Settings:
    """What a plant may want to change."""

    planned_hours: float = oee.PLANNED_HOURS
    usl: float = spc.USL
    lsl: float = spc.LSL
    subgroup_size: int = spc.SUBGROUP_SIZE
    trees: int = 200
    max_depth: int = 8
    min_leaf: int = 5
    test_percent: int = 25
    split_key: tuple[str, ...] = ("machine_id", "reading_ts")
    max_bins: int = 128
    features_per_split: str = "1"
    seed: int = 42
    training_partitions: int = 16
    model_name: str = "predictive-maintenance"
    model_version: int = 1
    catalog: bool = False
    raw_tables: dict = field(default_factory=lambda: dict(schemas.RAW_TABLES))


def together(builders: dict[str, Callable[[], DataFrame]]) -> Tables:
    """Build independent tables at the same time, so a small one fills idle cores."""
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        running = {
            name: pool.submit(copy_context().run, build)
            for name, build in builders.items()
        }
        return {name: future.result() for name, future in running.items()}


def attempt(build: Callable[..., Tables], *args) -> tuple[Tables, checks.DataCheckError | None]:
    """What a branch has built, or the failed data test that stopped it."""
    try:
        return build(*args), None
    except checks.DataCheckError as error:
        return {}, error


def build_bronze(spark: SparkSession, source: str, target: str, settings: Settings) -> Tables:
    """Raw CSV as Parquet, with the order of arrival.

    Lines that do not parse keep their text beside empty columns.
    """

    def build(name: str) -> DataFrame:
        raw = read_csv(spark, f"{source}/{name}.csv", settings.raw_tables[name])
        return write_parquet(with_arrival(raw), f"{target}/bronze/{name}")

    return together({name: partial(build, name) for name in settings.raw_tables})


def build_silver(bronze: Tables, target: str) -> Tables:
    """Typed, valid and deduplicated rows; the rest goes to ``quarantine``, with a reason.

    Of several readings of a machine at one time the first to arrive stays. Downtime
    events are not deduplicated: a machine may stop for two reasons at once.
    """

    def fact(name: str) -> DataFrame:
        ts, date, key = FACTS[name]
        arrived = silver.typed(bronze[name], ts, date)
        reason = (
            F.when(F.col(CORRUPT).isNotNull(), "unparsable")
            .when(F.col("machine_id").isNull(), "no_machine")
            .when(F.col(ts).isNull(), "no_time")
        )
        good, rest = silver.split_valid(arrived, reason.isNull())
        write_parquet(
            rest.withColumn("reason_rejected", reason).drop(*ARRIVAL),
            f"{target}/quarantine/{name}",
        )
        good = good.drop(CORRUPT)
        if key:
            good = silver.deduplicate(good, key, ARRIVAL)
        good = good.drop(*ARRIVAL)
        path = f"{target}/silver/{name}"
        # Sensor and quality rows are many per day; stops are few.
        return write_by_date(good, path, date) if key else write_parquet(good, path)

    def shift_log() -> DataFrame:
        shifts, rest = silver.split_valid(bronze["shift_log"], F.col(CORRUPT).isNull())
        rest = rest.withColumn("reason_rejected", F.lit("unparsable"))
        write_parquet(rest.drop(*ARRIVAL), f"{target}/quarantine/shift_log")
        shifts = shifts.drop(CORRUPT, *ARRIVAL)
        return write_parquet(shifts, f"{target}/silver/shift_log")

    facts = {name: partial(fact, name) for name in FACTS}
    return together({**facts, "shift_log": shift_log})


def lost_rows(bronze: Tables, clean: Tables, target: str) -> DataFrame:
    """``table_name, reason, rows``: what of bronze is not in silver or not in the charts.

    Per table, bronze = silver + rejected rows + duplicates; measurements without a value
    stay in silver and are left out of the charts.
    """
    spark = next(iter(bronze.values())).sparkSession
    parts = []
    for name, table in clean.items():
        rejected = spark.read.parquet(f"{target}/quarantine/{name}")
        reasons = rejected.groupBy(F.col("reason_rejected").alias("reason")).agg(
            F.count("*").alias("rows")
        )
        balance = (
            bronze[name].agg(F.count("*").alias("n"))
            .unionByName(table.agg((-F.count("*")).alias("n")))
            .unionByName(rejected.agg((-F.count("*")).alias("n")))
        )
        duplicates = balance.agg(F.sum("n").alias("rows")).select(
            F.lit("duplicate").alias("reason"), "rows"
        )
        parts.append(reasons.unionByName(duplicates).withColumn("table_name", F.lit(name)))
    blank = clean["quality_measurements"].agg(
        F.count_if(F.col("part_dimension_mm").isNull()).alias("rows")
    )
    parts.append(
        blank.select(
            F.lit("no_value").alias("reason"),
            "rows",
            F.lit("quality_measurements").alias("table_name"),
        )
    )
    found = reduce(DataFrame.unionByName, parts).select("table_name", "reason", "rows")
    return write_parquet(found, f"{target}/checks/lost_rows")


def build_gold(silver_tables: Tables, target: str, settings: Settings) -> DataFrame:
    days = oee.machine_daily_oee(
        oee.quality_daily(silver_tables["quality_measurements"]),
        oee.downtime_daily(silver_tables["downtime_events"]),
        planned_hours=settings.planned_hours,
    )
    return write_parquet(days, f"{target}/gold/fct_machine_daily_oee")


def build_spc(bronze: Tables, target: str, settings: Settings) -> Tables:
    """Control chart and capability, from the measurements as they arrived."""
    arrived = bronze["quality_measurements"].where(
        F.col(CORRUPT).isNull() & F.col("measured_ts").isNotNull()
    )
    groups = spc.subgroups(
        arrived, tie_break=["machine_id", *ARRIVAL], size=settings.subgroup_size
    )
    limits = spc.control_limits(groups, size=settings.subgroup_size)
    chart = spc.control_chart(groups, limits)
    report = spc.capability_report(
        groups, limits, usl=settings.usl, lsl=settings.lsl, size=settings.subgroup_size
    )

    def store(name: str, df: DataFrame) -> DataFrame:
        table = write_parquet(df, f"{target}/gold/{name}")
        write_csv(table, f"{target}/export/{name}", table.columns)
        return table

    return together(
        {
            "spc_control_chart_data": partial(store, "spc_control_chart_data", chart),
            "process_capability": partial(store, "process_capability", report),
        }
    )


def build_served(days: DataFrame, charts: Tables, target: str) -> Tables:
    """The published tables in their declared types, each behind its declared rules.

    ``served_violations`` counts, per table and rule, what breaks the declaration. A table
    that breaks one keeps its last published state, and the error is raised once the
    others are written.
    """
    plan = {
        "fct_machine_daily_oee": (days, schemas.SERVED_MACHINE_DAILY_OEE),
        "spc_control_chart_data": (
            charts["spc_control_chart_data"],
            schemas.SERVED_CONTROL_CHART,
        ),
        "process_capability": (charts["process_capability"], schemas.SERVED_CAPABILITY),
    }
    ready = together(
        {
            name: partial(materialize, conform.conform(df, table), f"served-{name}")
            for name, (df, table) in plan.items()
        }
    )
    violations = [
        conform.conform_violations(ready[name], table).select(
            F.lit(name).alias("table_name"), "rule", "failures"
        )
        for name, (_, table) in plan.items()
    ]
    report = write_parquet(
        reduce(DataFrame.unionByName, violations), f"{target}/checks/served_violations"
    )
    # One row per declared rule.
    broken = report.where("failures > 0").collect()
    bad = {row["table_name"] for row in broken}
    served = together(
        {
            name: partial(write_parquet, df, f"{target}/served/{name}")
            for name, df in ready.items()
            if name not in bad
        }
    )
    if broken:
        found = ", ".join(f"{r.table_name}.{r.rule} ({r.failures})" for r in broken)
        raise checks.DataCheckError(f"served tables break their rules: {found}")
    served["served_violations"] = report
    return served


def build_marts(days: DataFrame, downtime: DataFrame, target: str) -> Tables:
    """Line OEE and the downtime Pareto, each behind the data tests of its own input.

    A mart is not written unless the tests of its staging table pass, and is tested after
    it is built. A failure is raised once the other mart is done.
    """
    staged_days = conform.staged(days, schemas.STG_MACHINE_DAILY_OEE)
    staged_stops = conform.staged(downtime, schemas.STG_DOWNTIME_EVENTS)
    plan = {
        "fct_line_oee": (
            checks.check_summary(
                staged_days, "stg_machine_daily_oee", not_null=["machine_id", "availability"]
            ),
            lambda: oee.line_oee(staged_days),
            {"not_null": ["line_id", "oee"]},
        ),
        "fct_downtime_pareto": (
            checks.check_summary(staged_stops, "stg_downtime_events", not_null=["machine_id"]),
            lambda: pareto.downtime_pareto(staged_stops),
            {"not_null": ["reason"], "unique": ["reason"]},
        ),
    }
    errors: list[checks.DataCheckError] = []

    def build(name: str) -> DataFrame | None:
        before, mart, tests = plan[name]
        try:
            checks.gate(write_parquet(before, f"{target}/checks/staging/{name}"))
            table = write_parquet(mart(), f"{target}/marts/{name}")
            after = checks.check_summary(table, name, **tests)
            checks.gate(write_parquet(after, f"{target}/checks/marts/{name}"))
        except checks.DataCheckError as error:
            errors.append(error)
            return None
        return table

    marts = together({name: partial(build, name) for name in plan})
    if errors:
        raise checks.DataCheckError("; ".join(str(e) for e in errors))
    return marts


def build_model(readings: DataFrame, target: str, settings: Settings) -> Tables:
    """Train, evaluate, record and save the failure classifier.

    Readings without label or with a missing feature are left out and counted.
    """
    started = datetime.now(UTC)
    spark = readings.sparkSession
    columns = dict.fromkeys(
        ["machine_id", "reading_ts", *settings.split_key, *model.FEATURES, model.LABEL]
    )
    complete, rest = model.trainable(readings.select(*columns))
    rows = model.hash_split(complete, settings.split_key, settings.test_percent)
    train, test = rows.where(F.col("is_test") == 0), rows.where(F.col("is_test") == 1)
    params = {
        "numTrees": settings.trees,
        "maxDepth": settings.max_depth,
        "minInstancesPerNode": settings.min_leaf,
        "maxBins": settings.max_bins,
        "featureSubsetStrategy": settings.features_per_split,
        "seed": settings.seed,
        "trainingPartitions": settings.training_partitions,
        "classWeights": "balanced",
        "splitKey": ",".join(settings.split_key),
        "testPercent": settings.test_percent,
    }
    fitted = model.train_forest(
        train,
        trees=settings.trees,
        max_depth=settings.max_depth,
        min_leaf=settings.min_leaf,
        max_bins=settings.max_bins,
        features_per_split=settings.features_per_split,
        seed=settings.seed,
        training_partitions=settings.training_partitions,
    )
    scores = model.score(fitted, test).select(
        "machine_id", "reading_ts", model.LABEL, "score", "prediction"
    )
    scores = write_parquet(scores, f"{target}/gold/failure_scores")
    importance = model.feature_importance(spark, fitted).select(
        F.concat(F.lit("feature_importance_"), F.col("feature")).alias("metric"),
        F.round("importance", 4).alias("value"),
    )
    metrics = write_parquet(
        model.evaluation_metrics(scores).unionByName(importance),
        f"{target}/gold/predictive_maintenance_metrics",
    )
    write_csv(metrics, f"{target}/export/predictive_maintenance_metrics")
    sizes = model.split_balance(rows).select(
        F.when(F.col("is_test") == 1, "n_test").otherwise("n_train").alias("metric"),
        F.col("n_rows").cast("double").alias("value"),
    )
    incomplete = rest.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("n_incomplete").alias("metric"), "value"
    )
    run_name = f"{settings.model_name}-{settings.model_version}"
    record = model.run_record(
        metrics.unionByName(sizes).unionByName(incomplete), run_name, params, started
    )
    record.write.mode("append").parquet(f"{target}/model_runs")
    model.save_model(
        fitted, f"{target}/models", settings.model_name, settings.model_version
    )
    return {"predictive_maintenance_metrics": metrics}


def publish(
    days: DataFrame, downtime: DataFrame, charts: Tables, marts: Tables
) -> Tables:
    """Catalog tables of the raw layer and the marts, and views of the staging layer."""
    raw = {
        "fct_machine_daily_oee": days,
        "downtime_events": downtime.select(*schemas.DOWNTIME_EVENTS.names),
        **charts,
    }
    done = {f"raw.{n}": publish_table(df, f"raw.{n}") for n, df in raw.items()}
    publish_view(
        conform.staged(done["raw.fct_machine_daily_oee"], schemas.STG_MACHINE_DAILY_OEE),
        "stg_machine_daily_oee",
    )
    publish_view(
        conform.staged(done["raw.downtime_events"], schemas.STG_DOWNTIME_EVENTS),
        "stg_downtime_events",
    )
    for name, df in marts.items():
        done[f"marts.{name}"] = publish_table(df, f"marts.{name}")
    return done


def run_medallion(
    spark: SparkSession, source: str, target: str, settings: Settings | None = None
) -> DataFrame:
    """Run every step in dependency order; returns ``table_name, row_count``.

    ``source`` holds one CSV file or folder per raw table, named ``<table>.csv``.
    Raises :class:`shopfloor.operators.checks.DataCheckError` if a data test fails.
    """
    settings = settings or Settings()
    with scratch_scope(spark):
        bronze = build_bronze(spark, source, target, settings)
        clean = build_silver(bronze, target)
        days = build_gold(clean, target, settings)
        lost = lost_rows(bronze, clean, target)
        charts: Tables = {}

        def charted() -> Tables:
            charts.update(build_spc(bronze, target, settings))
            return build_served(days, charts, target)

        branches = together(
            {
                "served": partial(attempt, charted),
                "marts": partial(attempt, build_marts, days, clean["downtime_events"], target),
                "model": partial(attempt, build_model, clean["sensor_readings"], target, settings),
            }
        )
    failed = [str(error) for _, error in branches.values() if error is not None]
    if failed:
        raise checks.DataCheckError("; ".join(failed))
    served, marts, metrics = (branches[name][0] for name in ("served", "marts", "model"))
    written = {
        **{f"bronze.{name}": df for name, df in bronze.items()},
        **{f"silver.{name}": df for name, df in clean.items()},
        "gold.fct_machine_daily_oee": days,
        **{f"gold.{name}": df for name, df in {**charts, **metrics}.items()},
        **{f"served.{name}": df for name, df in served.items()},
        **{f"marts.{name}": df for name, df in marts.items()},
        "checks.lost_rows": lost,
    }
    if settings.catalog:
        written |= publish(days, clean["downtime_events"], charts, marts)
    return checks.row_count_audit(written).orderBy("table_name")
