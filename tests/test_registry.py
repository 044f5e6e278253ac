"""Every registered query beside its SQL twin, on the smallest provided tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from shopfloor.plans.oracle import ORACLE
from shopfloor.plans.queries import QUERIES, TABLES
from tools.check_queries import SQL_TYPES, compare

SF_DIR = "/root/testdata/sf0.001"
JOINING = (
    "machine_daily_oee",
    "line_oee_with_rate",
    "spc_control_chart",
    "spc_subgroups_in_pieces",
    "failure_horizon_label",
    "next_failure_in_pieces",
    "stratified_split_in_pieces",
    "downtime_pareto",
    "roc_auc_in_pieces",
)

pytestmark = pytest.mark.skipif(
    not Path(SF_DIR).exists(), reason="the provided tables are not here"
)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def check(spark, sql, name):
    ours = registry.queries()[name](spark, SF_DIR)
    twin = sql.execute(registry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in twin.description}
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in ours.schema} == types
    assert compare(ours.toPandas(), twin.df()) == "ok"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql_twin(spark, sql, name):
    check(spark, sql, name)


@pytest.mark.parametrize("name", JOINING)
def test_results_do_not_depend_on_broadcast_joins(spark, sql, name):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        check(spark, sql, name)
    finally:
        spark.conf.set(setting, before)


def test_every_query_of_the_library_has_a_twin():
    assert set(QUERIES) <= set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    rows = registry.entry(spark)
    assert rows.columns[0] == "line_id"
    assert rows.count() > 0
