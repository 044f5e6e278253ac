import zlib
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from shopfloor.llm import lexical, packing


@pytest.fixture(scope="module")
def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def check(rows, texts, encoder, window, end_id=1):
    """Every id lies in one piece, places have no gap; returns padding and sequences."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    left = Counter()
    for doc_id, text in texts:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, end_id]
        own = sorted(pieces[doc_id], key=lambda r: r["start"])
        assert {r["doc_tokens"] for r in own} == {len(ids)}
        at = 0
        for r in own:
            raw = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(raw))
            at += r["length"]
        assert at == len(ids)
        left[doc_id] += 1
    assert set(pieces) == set(left)
    return padding, len(sequences)


def test_query_round_trip(spark, sf_dir, encoder):
    rows = lexical.op13_lexical_retrieval_packing(spark, sf_dir).collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    padding, used = check(rows, texts, encoder, 2048)
    assert padding == 0
    # Whole windows, and at most eleven powers of two of each task.
    assert used <= sum(r["length"] for r in rows) // 2048 + 11 * 5


def plain_scores(ids, seed, idf, mean):
    """BM25 of each piece for the seed's different terms."""
    scores = []
    for own in ids:
        often = Counter(own.tolist())
        norm = 1.2 * (1 - 0.75 + 0.75 * len(own) / mean)
        scores.append(
            sum(idf[t] * often[t] * 2.2 / (often[t] + norm) for t in set(ids[seed].tolist()) if often[t])
        )
    return scores


def test_neighbours_are_those_of_plain_bm25():
    rng = np.random.default_rng(3)
    ids = [(rng.integers(0, 40, rng.integers(1, 30)) ** 2 // 40).astype("<u4") for _ in range(50)]
    holds = Counter(t for own in ids for t in set(own.tolist()))
    idf = np.array([log(1 + (50 - holds[t] + 0.5) / (holds[t] + 0.5)) for t in range(40)])
    mean = float(np.mean([len(x) for x in ids]))
    shard = lexical.Shard(ids, lexical.Statistics(idf, mean))
    shard.unused[[3, 7]] = False
    for seed in range(50):
        scores = plain_scores(ids, seed, idf, mean)
        assert shard.scores(seed).tolist() == pytest.approx(scores, rel=1e-5, abs=1e-5)
        found = shard.neighbours(seed, 10**6).tolist()
        some = shard.neighbours(seed, 20).tolist()
        assert some == found[: len(some)] and sum(len(ids[i]) for i in some) >= 20
        assert sorted(found) == [i for i in range(50) if i not in (3, 7)]
        ranked = [scores[i] for i in found]
        assert all(a >= b - 1e-4 for a, b in zip(ranked, ranked[1:], strict=False))


def test_windows_hold_the_seed_and_its_best_neighbours():
    ids = [np.array(x, dtype="<u4") for x in ([1, 2, 3], [9, 9, 9], [1, 2, 4], [9, 8, 9], [3, 2, 1], [8, 9])]
    known = lexical.Statistics(np.ones(10), 3.0)
    order = lexical.Shard(ids, known).fill(0, 8)
    # The seed 0 and its likes fill the first window; the one cut goes on as seed.
    assert order[:3] == [0, 4, 2] and sorted(order) == list(range(6))
    # An open window of an earlier shard counts.
    assert sorted(lexical.Shard(ids, known).fill(7, 8)) == list(range(6))


def test_statistics_are_those_of_all_pieces(make_documents):
    df = make_documents([(i, "alpha beta " * (i % 3) + "gamma", "en", "s") for i in range(30)])
    pieces = lexical.cut_windows(df, packing.default_tokenizer(), 64)
    known = lexical.statistics(pieces, 50_257)
    rows = [np.frombuffer(r["ids"], dtype="<u4") for r in pieces.collect()]
    holds = Counter(t for own in rows for t in set(own.tolist()))
    for term, n in holds.items():
        assert known.idf[term] == pytest.approx(log(1 + (30 - n + 0.5) / (n + 0.5)))
    assert known.mean == pytest.approx(np.mean([len(x) for x in rows]))


def test_like_pieces_meet(make_documents, encoder):
    """Documents of one topic share windows far more often than by chance."""
    topics = [" ".join(f"{t}{c}" for c in "abcdefgh") for t in ("north", "salt", "wheel", "opera")]
    rows = [(i, f"{topics[i % 4]} number {i} " * 3, "en", "s") for i in range(400)]
    packed = lexical.retrieval_packed(make_documents(rows), window=512).collect()
    held = defaultdict(set)
    for r in packed:
        held[r["sequence_id"]].add(r["doc_id"] % 4)
    assert np.mean([len(x) for x in held.values()]) < 1.6


def test_powers_of_two():
    tape = lexical.Tape(16, 5)
    for k, size in enumerate((7, 20, 3, 1)):
        tape.add(k, 0, size, np.arange(size, dtype="<u4"))
    tape.close()
    found = defaultdict(int)
    for _, _, _, ids, offset, sequence in tape.done:
        assert offset == found[sequence]
        found[sequence] += len(ids)
    assert dict(found) == {5: 16, 6: 8, 7: 4, 8: 2, 9: 1}


def test_odd_rows(make_documents, odd_rows, encoder):
    odd_rows = [*odd_rows, (30, "x <|endoftext|> y", "en", "s")]
    df = make_documents(odd_rows)
    rows = lexical.retrieval_packed(df, window=64, shard_pieces=3).collect()
    total = sum(len(encoder.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows)
    assert sum(r["length"] for r in rows) == total
    by_sequence = defaultdict(int)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by_sequence[r["sequence_id"]] += r["length"]
    assert all(n & (n - 1) == 0 for n in by_sequence.values())
    assert lexical.retrieval_packed(df.where("false")).collect() == []
    with pytest.raises(ValueError):
        lexical.retrieval_packed(df, window=100)
