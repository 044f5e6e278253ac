import numpy as np
import pytest
from pyspark.sql import functions as F
from shopfloor.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, id int, vector string"


def brute(rows, query_id, k):
    vectors = dict(rows)
    q = np.asarray(vectors[query_id], dtype=float)
    scored = sorted(
        (float(np.sqrt(((np.asarray(v, dtype=float) - q) ** 2).sum())), i)
        for i, v in rows
        if i != query_id
    )
    return scored[:k]


def test_query_recall_and_scores(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [
        (r["vec_id"], r["embedding"])
        for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ]
    found = {}
    for r in ann.op9_cross_polytope_neighbours(spark, sf_dir).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == sorted(i for i, _ in rows if i % 100 == 0)
    hits = 0
    for query_id, near in found.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, 11))
        every = {i: s for s, i in brute(rows, query_id, len(rows))}
        assert all(every[i] == pytest.approx(s, rel=1e-12) for _, i, s in near)
        best = {i for _, i in brute(rows, query_id, 10)}
        hits += len(best & {i for _, i, _ in near})
    assert hits >= 0.95 * 10 * len(found)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "x") for i, v in rows], SCHEMA)


def test_all_probes_are_exact_with_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 5).astype(float).tolist()) for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0]) for i in range(60)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = vectors(spark, rows)
    found = ann.neighbours(df, F.col("vec_id") % 10 == 0, k=4, tables=1, probes=16).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert set(by_query) == {i for i, _ in rows if i % 10 == 0}
    for query_id, near in by_query.items():
        expected = brute(rows, query_id, 4)
        assert [(pytest.approx(s), i) for s, i in expected] == [(s, i) for _, s, i in sorted(near)]


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]),
        (1, None),
        (2, [0.0, 0.0]),
        (3, [1.0, None]),
        (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]),
        (6, [1.0, 1.0, 1.0]),
        (7, [0.9, 0.1]),
        (None, [1.0, 0.1]),
        (8, []),
        (0, [1.0, 0.0]),
    ]
    found = ann.neighbours(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=3, probes=4)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found.collect()] == [(0, 1, 7)]
    empty = vectors(spark, rows).where("false")
    assert ann.neighbours(empty, F.col("vec_id") % 100 == 0).collect() == []


def test_rotations_keep_lengths_and_angles():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(20, 48))
    y = ann.rotated(x, 3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    turned = y / np.linalg.norm(y, axis=1, keepdims=True)
    assert np.allclose(unit @ unit.T, turned @ turned.T)


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("count", [5, 8, 11])
def test_few_vectors_are_all_candidates(spark, count):
    rng = np.random.default_rng(count)
    rows = [(i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(count)]
    near = by_query(ann.neighbours(vectors(spark, rows), F.lit(True), k=10).collect())
    for query_id, _ in rows:
        expected = brute(rows, query_id, 10)
        assert len(expected) == min(10, count - 1)
        assert near[query_id] == [(pytest.approx(s), i) for s, i in expected]


def test_queries_that_meet_too_few_go_on(spark):
    """Two far clusters: a lone vector's own buckets hold nothing else."""
    rng = np.random.default_rng(9)
    axis = np.eye(64)
    rows = [(i, (axis[0] + 0.001 * rng.normal(size=64)).tolist()) for i in range(60)]
    rows += [(100 + i, (axis[i + 1] * 5).tolist()) for i in range(3)]
    near = by_query(ann.neighbours(vectors(spark, rows), F.col("vec_id") >= 100, k=5, probes=1).collect())
    assert sorted(near) == [100, 101, 102]
    for query_id, found in near.items():
        assert len(found) == 5
        assert [s for s, _ in found] == sorted(s for s, _ in found)
        assert query_id not in {i for _, i in found}


def test_recall_of_long_vectors(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(1000, 384)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    near = by_query(ann.neighbours(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=10).collect())
    assert len(near) == 20 and all(len(found) == 10 for found in near.values())
    hits = 0
    for query_id, found in near.items():
        apart = np.sqrt(((x.astype(float) - x[query_id]) ** 2).sum(axis=1))
        apart[query_id] = np.inf
        hits += len(set(np.argsort(apart)[:10].tolist()) & {i for _, i in found})
    assert hits >= 0.93 * 200
