"""Times the registered queries and the steps of the whole job; prints one JSON line.

Settings come from BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS
(default 8). Every query runs once unmeasured and then twice; the faster run counts.
The steps of the job run once, after a small rehearsal, on shop-floor CSV files derived
from the events table.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions import spec_flag
from shopfloor.plans import medallion, queries
from shopfloor.plans.queries import QUERIES, TARGET, TOLERANCE, labelled, table
from shopfloor.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


# What several queries share is made anew for the first of them, so that its time counts once.
SHARED = {"rf_scores": queries._forests, "incremental_machine_days": queries._delivered}


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def write_inputs(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The raw shop-floor tables, with the events in their roles."""
    machine = F.concat(F.lit("M"), F.col("user_id"))
    line = F.concat(F.lit("LINE-"), F.col("user_id") % 5)
    rows = labelled(spark, sf_dir, "value", "event_type").select(
        machine.alias("machine_id"),
        line.alias("line_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"),
        "value",
        "event_type",
        "label",
    )
    stopped = F.col("event_type") == "error"
    tables = {
        "machines": rows.select(
            "machine_id",
            "line_id",
            F.lit("CNC Mill").alias("machine_type"),
            F.lit("2024-01-01").alias("install_date"),
        ).distinct(),
        "sensor_readings": rows.select(
            "machine_id",
            "line_id",
            F.col("at").alias("reading_ts"),
            F.col("value").alias("temperature_c"),
            F.round(F.col("value") / 50, 3).alias("vibration_mm_s"),
            F.round(100 - F.col("value") / 10, 2).alias("pressure_psi"),
            F.lit(0.0).alias("latent_wear"),
            F.col("label").alias("will_fail_within_6h"),
        ),
        "quality_measurements": rows.where(~stopped).select(
            "machine_id",
            "line_id",
            F.col("at").alias("measured_ts"),
            F.col("value").alias("part_dimension_mm"),
            spec_flag(F.col("value"), TARGET, TOLERANCE).alias("in_spec"),
        ),
        "downtime_events": rows.where(stopped).select(
            "machine_id",
            "line_id",
            F.col("at").alias("downtime_start_ts"),
            (F.col("value") / 100).alias("downtime_hours"),
            F.lit("Equipment Failure").alias("reason"),
        ),
        "shift_log": rows.select(
            "line_id",
            F.substring("at", 1, 10).alias("shift_date"),
            F.lit("Day").alias("shift"),
            F.lit(8.0).alias("planned_production_hours"),
        ).distinct(),
    }
    for name, df in tables.items():
        df.write.option("header", True).csv(f"{folder}/{name}.csv")


def job_steps(spark: SparkSession, source: str, target: str, trees: int) -> dict[str, float]:
    settings = medallion.Settings(usl=80.0, lsl=20.0, trees=trees)
    state: dict = {}

    def transform() -> None:
        state["bronze"] = medallion.build_bronze(spark, source, target, settings)
        state["silver"] = medallion.build_silver(state["bronze"], target)
        state["days"] = medallion.build_gold(state["silver"], target, settings)

    def charts() -> None:
        state["charts"] = medallion.build_spc(state["bronze"], target, settings)

    def served() -> None:
        medallion.build_served(state["days"], state["charts"], target)

    def marts() -> None:
        stops = state["silver"]["downtime_events"]
        medallion.build_marts(state["days"], stops, target)

    def failure_model() -> None:
        medallion.build_model(state["silver"]["sensor_readings"], target, settings)

    return {
        "job_transform": timed(transform),
        "job_spc": timed(charts),
        "job_serving_tables": timed(served),
        "job_marts_and_tests": timed(marts),
        f"job_model_{trees}_trees": timed(failure_model),
    }


def main() -> None:
    scratch = tempfile.TemporaryDirectory(prefix="shopfloor-bench-")
    spark = build_session(
        "shopfloor-bench",
        master=f"local[{CPUS}]",
        extra={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": scratch.name,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = set(sys.argv[1:])
    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        if wanted and name not in wanted:
            continue

        def once(query=query, name=name) -> None:
            SHARED.get(name, {}).clear()
            run(query(spark, SF_DIR))

        once()
        repeats = 1 if name in SHARED else 2
        seconds[name] = min(timed(once) for _ in range(repeats))
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    if not wanted or "job" in wanted:
        work = f"{scratch.name}/job"
        write_inputs(spark, SF_DIR, f"{work}/in")
        job_steps(spark, f"{work}/in", f"{work}/rehearsal", 2)
        seconds |= job_steps(spark, f"{work}/in", f"{work}/out", 200)
    found = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "rows": table(spark, SF_DIR, "events").count(),
            }
        )
    )
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
