import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.operators import checks, conform, silver
from shopfloor.sources import schemas


def test_typed_and_quarantine(spark):
    df = spark.createDataFrame(
        [("2026-07-09T09:40:00",), ("not a time",), (None,)], "reading_ts string"
    )
    good, bad = silver.split_valid(
        silver.typed(df, "reading_ts", "reading_date"), F.col("reading_ts").isNotNull()
    )
    row = good.collect()
    assert [(str(r.reading_ts), str(r.reading_date)) for r in row] == [
        ("2026-07-09 09:40:00", "2026-07-09")
    ]
    assert bad.count() == 2


@pytest.mark.parametrize("partitions", [1, 8])
def test_deduplicate_keeps_the_least_row(spark, partitions):
    rows = [(k, k % 3, v, f"p{v}") for k in range(20) for v in (5, 3, 9, 3)]
    df = spark.createDataFrame(rows, "a int, b int, v int, payload string")
    found = silver.deduplicate(df.repartition(partitions), ["a", "b"], ["v"])
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect())) == [
        (k, k % 3, 3, "p3") for k in range(20)
    ]


def test_deduplicate_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 k", "id v")
    plan = silver.deduplicate(df, ["k"], ["v"])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_checks_on_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in checks.check_not_null(df, ["x"]).collect()] == [("x", 1)]
    assert [tuple(r) for r in checks.check_unique(df, ["x"]).collect()] == [("b", 2)]
    summary = checks.check_summary(df, "t", not_null=["x"], unique=["x"])
    assert sorted(tuple(r) for r in summary.collect()) == [
        ("not_null_t_x", 1, True, True),
        ("unique_t_x", 1, True, True),
    ]
    with pytest.raises(checks.DataCheckError, match="not_null_t_x"):
        checks.gate(summary)
    clean = checks.check_summary(df.where("x = 'a'"), "t", not_null=["x"], unique=["x"])
    assert checks.gate(clean).count() == 2


def test_pk_violations(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)], "k int, l string"
    )
    found = {(r.k, r.l): (r.n_records, r.violation) for r in checks.pk_violations(df, ["k", "l"]).collect()}
    assert found == {
        (1, "a"): (2, "duplicate"),
        (None, "c"): (1, "null"),
        (3, None): (1, "null"),
    }


def test_conform_control_chart(spark):
    df = spark.createDataFrame(
        [("LINE-A", "2026-07-01 00:00:00", 50.12345, 0.4, 50.5, 49.5, 50.0, 1)],
        "line_id string, subgroup_start_ts string, xbar double, range double, "
        "ucl_xbar double, lcl_xbar double, centerline_xbar double, out_of_control int",
    )
    served = conform.conform(df, schemas.SERVED_CONTROL_CHART)
    assert served.columns == schemas.SERVED_CONTROL_CHART.schema.names
    assert [f.dataType for f in served.schema] == [
        f.dataType for f in schemas.SERVED_CONTROL_CHART.schema
    ]
    row = served.first()
    assert (str(row.xbar), str(row.range_val), row.out_of_control) == (
        "50.1235",
        "0.4000",
        True,
    )


def test_conform_reports_what_does_not_fit(spark):
    df = spark.createDataFrame(
        [
            ("LINE-A", 10, 0.5, 1, 0.1),
            ("LINE-A", 10, 5000.0, 1, 0.1),
            ("A-VERY-LONG-LINE", 10, 0.5, None, 0.1),
        ],
        "line_id string, n_subgroups int, cpk double, out_of_control_subgroups int, "
        "out_of_control_pct double",
    )
    served = conform.conform(df, schemas.SERVED_CAPABILITY)
    report = conform.conform_violations(served, schemas.SERVED_CAPABILITY)
    failed = {r.rule: r.failures for r in report.collect() if r.failures}
    assert failed == {
        "not_null_cpk": 1,
        "not_null_out_of_control_subgroups": 1,
        "max_length_line_id": 1,
        "primary_key_line_id": 1,
    }


def test_row_count_audit(spark):
    audit = checks.row_count_audit({"a": spark.range(3), "b": spark.range(0)})
    assert {tuple(r) for r in audit.collect()} == {("a", 3), ("b", 0)}


def test_conform_keeps_every_digit_of_decimals(spark):
    table = schemas.ServingTable(
        schema=T.StructType([T.StructField("x", T.DecimalType(38, 4)), T.StructField("y", T.DecimalType(6, 2))])
    )
    df = spark.sql(
        "select cast('123456789012345678901234.56785' as decimal(38,6)) x, cast('1.005' as decimal(10,4)) y"
        " union all select cast(-1.00005 as decimal(38,6)), cast(99999.999 as decimal(10,4))"
    )
    rows = [(str(r.x), None if r.y is None else str(r.y)) for r in conform.conform(df, table).collect()]
    assert rows == [("123456789012345678901234.5679", "1.01"), ("-1.0001", None)]


def test_footer_counts_read_no_column(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    rows.write.parquet(str(tmp_path / "plain"))
    rows.write.partitionBy("part").parquet(str(tmp_path / "parts"))
    rows.limit(0).write.parquet(str(tmp_path / "empty"))
    plans = []
    audit = checks.row_count_audit

    def spy(tables):
        counted = audit(tables)
        plans.append(counted._jdf.queryExecution().executedPlan().toString())
        return counted

    monkeypatch.setattr(checks, "row_count_audit", spy)
    found = checks.footer_counts(spark, {n: str(tmp_path / n) for n in ("plain", "parts", "empty")})
    assert dict(map(tuple, found.collect())) == {"plain": 1000, "parts": 1000, "empty": 0}
    assert plans[0].count("PushedAggregation: [COUNT(*)]") == 3
    # The caller's session is as before.
    assert "FileScan parquet" in spark.read.parquet(str(tmp_path / "plain"))._jdf.queryExecution().executedPlan().toString()
