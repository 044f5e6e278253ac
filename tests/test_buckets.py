from pyspark.sql import functions as F

from shopfloor.operators import oee, silver
from shopfloor.plans.queries import bucketed_machine_days
from shopfloor.sources.buckets import write_bucketed

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_step_shuffles_the_facts_again(spark):
    """Deduplication, both aggregates and the join, also without broadcast joins."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        days = bucketed_machine_days(spark, SF_DIR)
        days.collect()
        plan = plan_of(days)
    finally:
        spark.conf.set(setting, before)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_the_same_steps_on_plain_files_do(spark, tmp_path):
    rows = spark.range(50).select(
        (F.col("id") % 5).alias("machine_id"), F.lit(0).alias("line_id"), F.lit("2026-05-01").cast("date").alias("day"),
        F.col("id").alias("event_id"), F.lit(1).alias("in_spec"),
    )
    rows.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    stored = write_bucketed(plain, "bucket_test", str(tmp_path / "b"), ["machine_id", "line_id", "day"], 4)
    assert write_bucketed(plain, "bucket_test", str(tmp_path / "c"), ["machine_id", "line_id", "day"], 4).count() == 50
    for df, shuffles in ((plain, True), (spark.table("bucket_test"), False)):
        daily = oee.quality_daily(silver.deduplicate(df, ["machine_id", "line_id", "day", "event_id"]), date="day")
        assert ("Exchange" in plan_of(daily)) == shuffles
        assert daily.agg(F.sum("units_measured")).first()[0] == 50
    assert stored.columns == plain.columns
