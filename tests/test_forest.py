import pytest
from pyspark.sql import functions as F

from shopfloor.operators import evaluation, forest, model

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def rows(spark):
    noise = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 1000
    return spark.range(1500).select(
        "id",
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 10).alias("a"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)).cast("double").alias("b"),
        noise.alias("c"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) + 20 * noise > 60).cast("int").alias("label"),
    )


@pytest.fixture(scope="module")
def fitted(rows):
    return model.train_forest(rows, FEATURES, "label", trees=7, max_depth=5)


def plain_score(nodes, x):
    """The mean share of the leaves, following the children by hand."""
    shares = []
    for tree in {n["tree"] for n in nodes}:
        own = {n["node"]: n for n in nodes if n["tree"] == tree}
        at = own[0]
        while at["feature"] >= 0:
            at = own[at["left"] if x[at["feature"]] <= at["threshold"] else at["right"]]
        shares.append(at["share"])
    return sum(shares) / len(shares)


def test_walk_is_the_library_and_the_hand(spark, rows, fitted):
    nodes = forest.nodes_of(fitted)
    walked = {r["id"]: r["score"] for r in forest.walk(rows, nodes, ["id"], FEATURES, forest.depth_of(fitted)).collect()}
    given = model.score(fitted, rows).collect()
    assert len(walked) == len(given) == 1500
    assert all(abs(walked[r["id"]] - r["score"]) < 1e-9 for r in given)
    by_hand = nodes.collect()
    for r in given[:40]:
        assert plain_score(by_hand, (r["a"], r["b"], r["c"])) == pytest.approx(walked[r["id"]])


def test_walk_shuffles_no_rows_before_they_are_combined(rows, fitted):
    nodes = forest.nodes_of(fitted)
    plan = forest.walk(rows, nodes, ["id"], FEATURES, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") <= 1 and "SortMergeJoin" not in plan


def test_walk_carries_cells_and_not_rows_through_the_trees(rows, fitted):
    """The rows are read and joined with their cells' scores; only cells meet every tree."""
    nodes = forest.nodes_of(fitted)
    plan = forest.walk(rows, nodes, ["id"], FEATURES, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("BroadcastHashJoin") <= 1


def test_walk_with_missing_features_thresholds_and_repeated_keys(spark, fitted):
    nodes = forest.nodes_of(fitted)
    by_hand = nodes.collect()
    on = next(n["threshold"] for n in by_hand if n["feature"] == 0)
    nan, inf = float("nan"), float("inf")
    given = [
        (1, on, 3.0, 0.5), (2, None, 3.0, 0.5), (3, nan, 3.0, 0.5), (4, inf, -inf, 0.5),
        (5, -0.0, 0.0, -0.0), (6, 1.0, 2.0, 0.1), (6, 9.0, 2.0, 0.9), (None, 9.0, 2.0, 0.9),
    ]
    walked = forest.walk(
        spark.createDataFrame(given, "id long, a double, b double, c double"),
        nodes, ["id"], FEATURES, forest.depth_of(fitted),
    ).collect()
    expected = {}
    for k, *x in given:
        # A missing feature is at most no threshold.
        expected.setdefault(k, []).append(plain_score(by_hand, [inf if v is None or v != v else v for v in x]))
    assert len(walked) == len(expected) == 7
    assert all(r["score"] == pytest.approx(sum(expected[r["id"]]) / len(expected[r["id"]])) for r in walked)


def test_importance_is_the_library(rows, fitted):
    own = {r["feature"]: r["importance"] for r in forest.importance(forest.nodes_of(fitted), FEATURES).collect()}
    given = fitted.stages[-1].featureImportances.toArray()
    assert [own[f] for f in FEATURES] == pytest.approx(list(given))
    assert own["a"] > 0.5


def test_audit_finds_broken_trees(spark, fitted):
    nodes = forest.nodes_of(fitted)
    fine = forest.audit(nodes).collect()
    assert all(r["n_nodes"] == 2 * r["n_leaves"] - 1 and r["n_strays"] == 0 for r in fine)
    assert all(r["least_rows"] >= 5 for r in fine)
    lost = nodes.where("not (tree = 0 and node = 1)")
    twice = nodes.withColumn("right", F.when(F.col("tree") == 1, F.col("left")).otherwise(F.col("right")))
    assert {r["tree"]: r["n_strays"] for r in forest.audit(lost).collect()}[0] > 0
    assert {r["tree"]: r["n_strays"] for r in forest.audit(twice).collect()}[1] > 0


def test_a_useless_forest_is_found_out(rows, fitted):
    """The facts of the registered query do not hold for constant scores or shuffled labels."""
    test = rows.where("id % 4 = 0")
    nodes = forest.nodes_of(fitted)
    depth = forest.depth_of(fitted)
    good = forest.walk(test, nodes, ["id"], FEATURES, depth).join(test.select("id", "label"), "id")
    assert evaluation.roc_auc(good).first()["roc_auc"] > 0.9
    flat = good.withColumn("score", F.lit(0.5))
    assert evaluation.roc_auc(flat).first()["roc_auc"] == 0.5
    swapped = nodes.withColumn("share", 1 - F.col("share"))
    bad = forest.walk(test, swapped, ["id"], FEATURES, depth).join(test.select("id", "label"), "id")
    assert evaluation.roc_auc(bad).first()["roc_auc"] < 0.1
