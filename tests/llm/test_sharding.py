import zlib
from itertools import pairwise

import numpy as np
import pytest
from shopfloor.llm import sharding


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    cells = [a.ravel() for a in axes]
    place = sharding.hilbert_index(cells, bits)
    assert sorted(place) == list(range(1 << (bits * dimensions)))
    path = np.stack(cells, axis=1)[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_shards(rows, shards):
    counts = [0] * shards
    slots = {}
    for r in rows:
        counts[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return counts


def test_query(spark, sf_dir):
    rows = sharding.op1_hilbert_sharding(spark, sf_dir).collect()
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    counts = check_shards(rows, 16)
    assert max(counts) - min(counts) <= 1
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert all(a["curve_index"] <= b["curve_index"] for a, b in pairwise(ordered))


@pytest.fixture
def odd_documents(make_documents, odd_rows):
    df = make_documents([*odd_rows, *[(i, "same text", "en", f"s{i % 7}") for i in range(300, 380)]])
    return df.withColumn("size", sharding.text_size(df["text"]))


@pytest.mark.parametrize("law", sharding.LAWS)
def test_laws_on_odd_rows(odd_documents, law):
    found = sharding.hilbert_shards(
        odd_documents, ["source", "lang", "size"], 7, "size", ["doc_id"], law
    )
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    counts = check_shards(rows, 7)
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    else:
        sizes = [sum(r["row"]["size"] for r in rows if r["shard"] == s) for s in range(7)]
        largest = max(r["row"]["size"] for r in rows)
        assert max(sizes) <= sum(sizes) / 7 + largest


def test_empty_table(odd_documents):
    empty = odd_documents.where("false")
    for law in sharding.LAWS:
        found = sharding.hilbert_shards(empty, ["source", "lang", "size"], 16, "size", ["doc_id"], law)
        assert found.collect() == []


def test_files_of_shards_prune(spark, tmp_path):
    """A shard spans a small box: most need not be read for a range of two dimensions."""
    points = spark.range(4096).selectExpr("id", "id % 64 AS x", "id div 64 AS y", "1 AS size")
    found = sharding.hilbert_shards(points, ["x", "y"], 64, "size", ["id"])
    path = str(tmp_path / "shards")
    sharding.write_shards(found, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4096
    boxes = stored.groupBy("shard").agg({"x": "min", "y": "min"}).collect()
    assert len(boxes) == 64
    touched = stored.where("x < 16 AND y < 16").select("shard").distinct().count()
    assert touched <= 64 * (1 / 16) + 2


def plain_hilbert(point, bits):
    """The place of one point on the curve, bit by bit with Python's numbers."""
    x = list(point)
    n, bit = len(x), 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            if x[i] & bit:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0] ^= t
                x[i] ^= t
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, bit = 0, 1 << (bits - 1)
    while bit > 1:
        if x[-1] & bit:
            t ^= bit - 1
        bit >>= 1
    x = [v ^ t for v in x]
    place = 0
    for level in range(bits - 1, -1, -1):
        for v in x:
            place = place << 1 | v >> level & 1
    return place


def test_query_is_the_plain_order_of_the_table(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    rows = [(r["source"], r["lang"], len((r["text"] or "").encode()) + 1, r["doc_id"], zlib.crc32((r["text"] or "").encode())) for r in given]
    cells = []
    for axis in range(3):
        values = sorted(r[axis] for r in rows if r[axis] is not None)
        least = {}
        for at, value in enumerate(values):
            if not at or value != values[at - 1]:
                least.setdefault(at * 64 // len(values), value)
        bounds = sorted(least.values())[1:]
        cells.append([0 if r[axis] is None else sum(b <= r[axis] for b in bounds) for r in rows])
    ordered = sorted((plain_hilbert(point, 6), *r[3:]) for point, r in zip(zip(*cells, strict=True), rows, strict=True))
    expected = {}
    for rank, (place, doc_id, checksum) in enumerate(ordered):
        shard = rank * 16 // len(rows)
        expected[doc_id] = (checksum, place, shard, rank - -(-shard * len(rows) // 16))
    found = sharding.op1_hilbert_sharding(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["text_crc32"], r["curve_index"], r["shard"], r["slot"]) for r in found} == expected
