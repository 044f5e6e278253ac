import random

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import evaluation, forest, model

F7 = [(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.2), (0, 0.4)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(F7, "label int, score double")


@pytest.mark.parametrize("pieces", [7, None])
def test_hand_computed_metrics(scored, pieces):
    row = evaluation.classification_metrics(scored).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 1, 2)
    assert (row.precision, row.recall, row.f1_score) == (0.5, 0.5, 0.5)
    area = evaluation.roc_auc(scored, pieces=pieces).first()
    assert (area.n_positive, area.n_negative, area.roc_auc) == (2, 3, 0.75)


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    row = evaluation.classification_metrics(df).first()
    assert (row.precision, row.recall, row.f1_score) == (0.0, 0.0, 0.0)
    assert evaluation.roc_auc(df).first().roc_auc is None


@pytest.mark.parametrize("pieces", [7, None])
def test_auc_against_all_pairs(spark, pieces):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.randint(0, 40) / 40) for _ in range(400)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    df = spark.createDataFrame(rows, "label int, score double")
    area = evaluation.roc_auc(df, digits=None, pieces=pieces).first()
    assert area.roc_auc == pytest.approx(wins / len(pos) / len(neg))


def test_class_weights(scored):
    weights = {r.label: r.weight for r in model.class_weights(scored, "label").collect()}
    assert weights == pytest.approx({1: 1.25, 0: 5 / 6})
    rows = model.with_class_weights(scored, "label").collect()
    assert sum(r.weight for r in rows) == pytest.approx(5)


def test_positive_rate(scored):
    assert tuple(evaluation.positive_rate(scored).first()) == (5, 2, 0.4)


@pytest.fixture(scope="module")
def readings(spark):
    """A class that shows in two of three features."""
    return spark.range(3000).select(
        "id",
        (F.col("id") % 12).alias("machine_id"),
        (F.hash("id") % 10 == 0).cast("int").alias("will_fail_within_6h"),
    ).select(
        "*",
        (60 + 12 * F.col("will_fail_within_6h") + F.pmod(F.hash("id", F.lit(1)), 10)).cast("double").alias("temperature_c"),
        (1 + 3 * F.col("will_fail_within_6h") + F.pmod(F.hash("id", F.lit(2)), 10) / 10).alias("vibration_mm_s"),
        F.pmod(F.hash("id", F.lit(3)), 100).cast("double").alias("pressure_psi"),
    )


def test_hash_split_is_independent_of_order(readings):
    once = model.hash_split(readings, ["id"]).where("is_test = 1")
    again = model.hash_split(readings.orderBy(F.desc("id")).repartition(7), ["id"])
    assert once.count() == pytest.approx(750, abs=100)
    assert once.select("id").exceptAll(again.where("is_test = 1").select("id")).count() == 0
    by_machine = model.hash_split(readings, ["machine_id"])
    sides = by_machine.groupBy("machine_id").agg(F.countDistinct("is_test").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_time_split(spark):
    df = spark.sql("select timestamp'2026-07-01 00:00:00' + make_interval(0,0,0,id) ts from range(4)")
    split = model.time_split(df, "ts", "2026-07-03 00:00:00").orderBy("ts")
    assert [r.is_test for r in split.collect()] == [0, 0, 1, 1]


@pytest.mark.parametrize("pieces", [7, None])
def test_stratified_split_is_exact(readings, pieces):
    split = model.stratified_split(readings, ["id"], pieces=pieces)
    balance = {r.is_test: (r.n_rows, r.n_positive) for r in model.split_balance(split).collect()}
    sizes = dict(readings.groupBy(model.LABEL).count().collect())
    # Half up, as the rows of a class are counted.
    expected = {c: int(n * 0.25 + 0.5) for c, n in sizes.items()}
    assert balance[1] == (sum(expected.values()), expected[1])
    assert balance[0][0] + balance[1][0] == 3000


def test_splits_by_selection_and_by_sorting_are_the_same(readings):
    chosen = model.stratified_split(readings, ["id"]).where("is_test = 1").select("id").collect()
    ranked = model.stratified_split(readings, ["id"], pieces=5).where("is_test = 1").select("id").collect()
    assert sorted(chosen) == sorted(ranked)


@pytest.mark.parametrize("few", [0, 3, 10_000])
def test_kth_least_refines_prefixes(spark, few):
    rows = spark.range(3000).select(
        (F.col("id") % 3).alias("label"),
        # A third of the rows share one hash, so that the ties decide.
        F.md5(F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string"))).alias("h"),
        "id",
    )
    ranks = {0: 1, 1: 700, 2: 1000}
    wanted = spark.createDataFrame([(k, v) for k, v in ranks.items()] + [(9, 4)], "label long, rank long")
    found = model.kth_least(rows, wanted, "label", "h", ["id"], digits=1, few=few).collect()
    every = rows.collect()
    for r in found:
        own = sorted((x["h"], x["id"]) for x in every if x["label"] == r["label"])
        assert tuple(r["last"]) == own[ranks[r["label"]] - 1]
    assert len(found) == 3


def test_selection_does_not_shuffle_rows(spark, readings):
    split = model.stratified_split(readings, ["id"])
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and plan.count("Exchange") == plan.count("BroadcastExchange")


def test_stratified_split_with_null_and_single_classes(spark):
    df = spark.sql("select id, case when id % 5 = 0 then null when id = 1 then 7 else 0 end will_fail_within_6h from range(40)")
    for pieces in (None, 3):
        split = model.stratified_split(df, ["id"], pieces=pieces)
        assert split.count() == 40
        tested = dict(split.where("is_test = 1").groupBy(model.LABEL).count().collect())
        assert tested == {None: 2, 0: 8}


def test_forest_recovers_the_signal(spark, readings, tmp_path):
    split = model.hash_split(readings, ["id"])
    fitted = model.train_forest(split.where("is_test = 0"), trees=10, max_depth=4)
    test = split.where("is_test = 1")
    scores = model.score(fitted, test)
    assert scores.count() == test.count()
    metrics = {r.metric: r.value for r in model.evaluation_metrics(scores).collect()}
    assert set(metrics) == {"precision", "recall", "f1_score", "roc_auc"}
    assert metrics["roc_auc"] > 0.95
    importance = model.feature_importance(spark, fitted).collect()
    values = {r.feature: r.importance for r in importance}
    assert sum(values.values()) == pytest.approx(1)
    assert values["pressure_psi"] < min(values["temperature_c"], values["vibration_mm_s"])

    model.save_model(fitted, str(tmp_path), "forest", 1)
    restored = model.score(model.load_model(str(tmp_path), "forest", 1), test)
    assert restored.exceptAll(scores).count() == 0


def test_run_record(spark):
    metrics = spark.createDataFrame([("roc_auc", 0.9)], "metric string, value double")
    found = model.run_record(metrics, "run-1", {"trees": 200}).collect()
    assert len({(r.run_id, r.started_at) for r in found}) == 1
    assert [tuple(r)[2:] for r in found] == [
        ("run-1", "param", "trees", "200"),
        ("run-1", "metric", "roc_auc", "0.9"),
    ]


def test_forest_does_not_depend_on_the_number_of_cores(readings):
    """The rows' arrangement and the default parallelism play no part."""
    importances = []
    for arranged in (readings.coalesce(1), readings.repartition(9, "id")):
        fitted = model.train_forest(arranged, trees=5, max_depth=4)
        importances.append(fitted.stages[-1].featureImportances.toArray().tolist())
    assert importances[0] == importances[1]


def test_incomplete_rows_are_left_out(spark):
    rows = [(1.0, 0), (2.0, 0), (8.0, 1), (9.0, 1), (None, 1), (3.0, None)] * 10
    df = spark.createDataFrame(rows, "x double, label int")
    complete, rest = model.trainable(df, ["x"], "label")
    assert (complete.count(), rest.count()) == (40, 20)
    weights = {r.label: r.weight for r in model.class_weights(df, "label").collect()}
    assert weights == {0: pytest.approx(50 / 40), 1: pytest.approx(50 / 60)}
    fitted = model.train_forest(df, ["x"], "label", trees=3, max_depth=2, min_leaf=1)
    assert model.score(fitted, complete).count() == 40


def test_training_rows_are_bounded_by_hash(readings):
    once = model.train_forest(readings, trees=2, max_depth=2, max_training_rows=500)
    again = model.train_forest(readings.repartition(5), trees=2, max_depth=2, max_training_rows=500)
    # All but the first line, which holds the fit's own name.
    trees = [m.stages[-1].toDebugString.partition("\n")[2] for m in (once, again)]
    assert trees[0] == trees[1]


def test_forest_is_fitted_on_cells_that_count_every_row(spark):
    """Twelve cells however many rows; their weight is that of all rows."""
    rows = spark.range(24_000).select(
        (F.col("id") % 3 * 10).cast("double").alias("x"),
        F.pmod(F.hash("id"), F.lit(2)).cast("double").alias("y"),
        (F.col("id") % 3 == 2).cast("int").alias("label"),
    )
    sizes = {}
    for parts in (64, 100_000):
        fitted = model.train_forest(rows, ["x", "y"], "label", trees=3, max_depth=2, cell_parts=parts)
        nodes = forest.nodes_of(fitted)
        roots = nodes.where("node = 0").collect()
        assert all(r["weight"] == pytest.approx(24_000, rel=0.25) for r in roots)
        sizes[parts] = max(r["rows"] for r in roots)
        assert {r["threshold"] for r in nodes.where("feature = 0").collect()} <= {0.0, 10.0}
        scored = {r["x"]: r["score"] for r in model.score(fitted, rows.limit(3)).collect()}
        assert scored[20.0] > scored[0.0]
    assert sizes[64] < 1000 and sizes[100_000] == pytest.approx(24_000, rel=0.1)


def test_bins_are_ordered_numbers_of_every_class(spark):
    """A rare class far away gets edges of its own, and a value on an edge belongs below it."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 400 == 0, 1000 + F.col("id") / 40_000).otherwise(F.col("id") / 40_000).alias("x"),
        (F.col("id") % 400 == 0).cast("double").alias("label"),
    )
    weighted = model.with_class_weights(rows, "label")
    (edges,) = model.bin_edges(weighted, ["x"], "label", 32, 1, 4)
    assert edges == sorted(edges) and len(edges) < 32
    assert sum(e > 1000 for e in edges) >= 10 and sum(e < 1 for e in edges) >= 10
    binning = model.bucketizer([[0.0, 1.5]], ["x"], ["bin"])
    values = spark.createDataFrame([(-0.0,), (0.0,), (1.0,), (1.5,), (2.0,)], "x double")
    assert [r["bin"] for r in binning.transform(values).collect()] == [0, 0, 1, 1, 2]
