"""Packing by lexical retrieval: neighbours by BM25 fill a seed document's window.

1. Documents become token ids. Whole windows of long ones are sequences of their own; what is left
   of each document, less than a window, is a piece to be packed with others.
2. Terms are token ids, so document frequencies are one number per entry of the vocabulary: the
   only data that is collected and broadcast, bounded by the vocabulary.
3. Pieces are dealt into index shards by likeness. Each draws ``SAMPLES`` of its terms, by random
   clocks that all pieces share, sped up by how often the piece has the term and by how rare it is;
   so like pieces draw alike. Vocabularies list frequent entries first, so the id itself tells the
   rarity here and the draw needs no pass of its own. Range partitions of (drawn terms, id, place) hold like pieces side by side; a hot
   draw, such as a group of copies, is cut by the id. Within a partition shards of
   ``SHARD_PIECES`` are indexed one after the other: postings per term with BM25 weights, by
   the frequencies of the whole corpus.
4. In a shard the first unused piece is the seed. The index ranks the unused pieces by their score
   for the seed's terms, and they fill the window in this order. The one that reaches over its end
   is cut there, and its rest is the next seed. So windows are full, and a piece is cut once.
5. A window still open at the end of a shard goes on in the next one. At the end of a partition it
   is cut into powers of two, which need no padding.

A partition needs memory for one shard, and no two tasks have to agree: pieces in different
partitions are not considered as neighbours.

Edge cases: a null or empty text is its end token alone; repeated rows are packed as often as they
occur; rows without id are packed like others; pieces without a common term score 0 and follow in
their order; very long texts give many whole windows; literals of added tokens become that token;
columns that are not named are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import table
from shopfloor.llm.tokens import Encoder, default_tokenizer, lots, token_bytes
from shopfloor.scratch import materialize

WINDOW = 2048
END_ID = 1
SHARD_PIECES = 1024
SAMPLES = 4
# Terms that more than this share of a shard's pieces hold have a dense row.
DENSE_SHARE = 1 / 8
# So many neighbours are ranked at first; more if they do not fill the window.
FIRST_NEIGHBOURS = 16
# BM25's usual saturation and length normalisation.
K1, B = 1.2, 0.75
_SEED = 13
# The sequences of one task are numbered in these bits.
TASK_BITS = 40


@dataclass
class Statistics:
    """What BM25 needs to know of all pieces: ``idf`` per term and the mean length."""

    idf: np.ndarray
    mean: float


DRAWS = [f"draw_{k}" for k in range(SAMPLES)]


def _kinds(key: str) -> str:
    return f"`{key}` long, start long, length long, doc_tokens long, ids binary"


def vocabulary_size(tokenizer: str, end_id: int) -> int:
    return max(len(token_bytes(tokenizer)), end_id + 1)


# --- pieces --------------------------------------------------------------------------


def cut_windows(
    documents: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Whole windows of each document and its rest: id, ``start``, ``length``, ``doc_tokens``, ``ids``.

    The ``draw`` columns hold the drawn terms of a rest; those of a whole window are null.
    """
    terms = vocabulary_size(tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer, added_tokens=True)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for first, lot in lots(batch.column(1)):
                rows, starts, lengths, totals, ids, rests = [], [], [], [], [], []
                for row, found in enumerate(encoder.ids(lot), first):
                    raw = found + end
                    total = len(raw) // 4
                    if total % window:
                        rests.append(len(rows) + total // window)
                    for start in range(0, total, window):
                        stop = min(start + window, total)
                        rows.append(row)
                        starts.append(start)
                        lengths.append(stop - start)
                        totals.append(total)
                        ids.append(raw[4 * start : 4 * stop])
                drawn = np.zeros((len(rows), SAMPLES), dtype=np.int32)
                if rests:
                    numbers = [np.frombuffer(ids[k], dtype="<u4") for k in rests]
                    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
                    drawn[rests] = drawn_terms(np.concatenate(numbers).astype(np.int64), sizes, terms)
                whole = np.array(lengths, dtype=np.int64) == window
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(totals, pa.int64()),
                        pa.array(ids, pa.binary()),
                        *(pa.array(np.ascontiguousarray(d), mask=whole) for d in drawn.T),
                    ],
                    [key, "start", "length", "doc_tokens", "ids", *DRAWS],
                )

    given = documents.select(F.col(key).cast("long").alias(key), F.col(text).cast("string"))
    return given.mapInArrow(run, f"{_kinds(key)}, {', '.join(f'{d} int' for d in DRAWS)}")


# --- terms ---------------------------------------------------------------------------


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of packed ids, and how many each row has."""
    found = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in ids]
    sizes = np.array([len(x) for x in found], dtype=np.int64)
    return np.concatenate(found or [np.empty(0, "<u4")]).astype(np.int64), sizes


def _terms(flat: np.ndarray, sizes: np.ndarray, terms: int) -> tuple[np.ndarray, ...]:
    """(row, term, frequency) of the different terms of each row, by row and term."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    pair, often = np.unique(rows * terms + flat, return_counts=True)
    return pair // terms, pair % terms, often


def weights(
    rows: np.ndarray, term: np.ndarray, often: np.ndarray, sizes: np.ndarray, known: Statistics
) -> np.ndarray:
    """BM25 weight of each (row, term, frequency)."""
    norm = K1 * (1 - B + B * sizes / known.mean)
    return known.idf[term] * often * (K1 + 1) / (often + norm[rows])


def statistics(pieces: DataFrame, terms: int) -> Statistics:
    """``idf`` per term and mean length of the pieces; frequencies are summed per task, then by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                own = _flat(batch.column(0).slice(begin, 256))
                holds += np.bincount(_terms(*own, terms)[1], minlength=terms)
        term = np.flatnonzero(holds)
        yield pa.record_batch([pa.array(term), pa.array(holds[term])], ["term", "n"])

    total = pieces.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    # One row per entry of the vocabulary at most.
    found = (
        pieces.select("ids")
        .mapInArrow(count, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    holds = np.zeros(terms)
    holds[found["term"].to_numpy()] = found["n"].to_numpy()
    idf = np.log1p((total["n"] - holds + 0.5) / (holds + 0.5))
    return Statistics(idf, float(total["mean"] or 1))


@cache
def _clocks(terms: int, samples: int) -> np.ndarray:
    """Per sample and term when its shared clock rings, by the rarity that the id tells."""
    rings = np.random.default_rng(_SEED).exponential(size=(samples, terms))
    return rings / np.log(np.arange(terms) + 2.0)


def drawn_terms(flat: np.ndarray, sizes: np.ndarray, terms: int, samples: int = SAMPLES) -> np.ndarray:
    """Per row and sample the term whose clock rings first, sped up by its frequency there."""
    rows, term, often = _terms(flat, sizes, terms)
    speed = often * (K1 + 1) / (often + K1)
    begin = np.searchsorted(rows, np.arange(len(sizes)))
    drawn = np.empty((len(sizes), samples), dtype=np.int32)
    for k, clock in enumerate(_clocks(terms, samples)):
        rings = clock[term] / speed
        first = np.flatnonzero(rings == np.minimum.reduceat(rings, begin)[rows])
        own, at = np.unique(rows[first], return_index=True)
        drawn[own, k] = term[first[at]]
    return drawn


# --- the index and the windows -------------------------------------------------------


class Shard:
    """An inverted index of the pieces of one shard.

    Terms that many pieces hold have a dense row of weights, the others a list of postings.
    """

    def __init__(self, ids: list[np.ndarray], known: Statistics):
        terms = len(known.idf)
        self.sizes = np.array([len(x) for x in ids], dtype=np.int64)
        rows, term, often = _terms(np.concatenate(ids).astype(np.int64), self.sizes, terms)
        weight = weights(rows, term, often, self.sizes, known).astype(np.float32)
        self.term, self.first = term, np.searchsorted(rows, np.arange(len(ids) + 1))
        frequent = np.flatnonzero(np.bincount(term, minlength=terms) > DENSE_SHARE * len(ids))
        self.dense_row = np.full(terms, -1, dtype=np.int64)
        self.dense_row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), len(ids)), dtype=np.float32)
        row = self.dense_row[term]
        self.dense[row[row >= 0], rows[row >= 0]] = weight[row >= 0]
        rest = np.flatnonzero(row < 0)
        rest = rest[np.argsort(term[rest], kind="stable")]
        self.holder, self.weight = rows[rest], weight[rest]
        self.begin = np.searchsorted(term[rest], np.arange(terms + 1))
        self.unused = np.ones(len(ids), dtype=bool)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of each piece for the seed's terms."""
        own = self.term[self.first[seed] : self.first[seed + 1]]
        row = self.dense_row[own]
        score = self.dense[row[row >= 0]].sum(axis=0)
        rare = own[row < 0]
        spans = list(zip(self.begin[rare].tolist(), self.begin[rare + 1].tolist(), strict=True))
        if spans:
            holder = np.concatenate([self.holder[x:y] for x, y in spans])
            weight = np.concatenate([self.weight[x:y] for x, y in spans])
            score = score + np.bincount(holder, weight, len(score)).astype(np.float32)
        return score

    def neighbours(self, seed: int, enough: int) -> np.ndarray:
        """The unused pieces, best score for the seed's terms first; ties in their order.

        Those after the first ones that hold ``enough`` tokens together may be left out.
        """
        left = np.flatnonzero(self.unused)
        score = self.scores(seed)[left]
        some = FIRST_NEIGHBOURS
        while some < len(left):
            best = np.flatnonzero(score >= np.partition(score, -some)[-some])
            if self.sizes[left[best]].sum() >= enough:
                left, score = left[best], score[best]
                break
            some *= 8
        return left[np.argsort(-score, kind="stable")]

    def fill(self, filled: int, window: int) -> list[int]:
        """The order of all pieces, the first window being ``filled`` already.

        Laid end to end in this order and cut at the windows' ends, each window holds its seed,
        the rest of the piece that the end before has cut, and the seed's best neighbours.
        """
        order: list[int] = []
        seed = -1
        while True:
            if seed < 0:
                left = np.flatnonzero(self.unused)
                if not len(left):
                    return order
                seed = int(left[0])
                self.unused[seed] = False
                order.append(seed)
                filled = (filled + int(self.sizes[seed])) % window
            ranked = self.neighbours(seed, window - filled)
            reach = np.cumsum(self.sizes[ranked])
            count = int(np.searchsorted(reach, window - filled)) + 1
            taken = ranked[:count]
            self.unused[taken] = False
            order.extend(taken.tolist())
            filled = (filled + int(self.sizes[taken].sum())) % window
            # An exactly full window leaves no rest to go on with.
            seed = int(taken[-1]) if len(taken) and filled else -1


def power_parts(size: int) -> list[int]:
    """The powers of two that make up ``size``, largest first."""
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


class Tape:
    """Cuts pieces laid end to end into windows, and the last open one into powers of two."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.open: list[tuple] = []
        self.filled = 0
        self.done: list[tuple] = []

    def add(self, key, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids):
            part = ids[: self.window - self.filled]
            self.open.append((key, start, total, part, self.filled))
            self.filled += len(part)
            start, ids = start + len(part), ids[len(part) :]
            if self.filled == self.window:
                self.done += [(*x, self.sequence) for x in self.open]
                self.open, self.filled, self.sequence = [], 0, self.sequence + 1

    def close(self) -> None:
        rest, left = self.open, power_parts(self.filled)
        self.open, self.filled, window = [], 0, self.window
        for key, start, total, ids, _ in rest:
            while len(ids):
                self.window = left[0]
                part = ids[: self.window - self.filled]
                last = self.sequence
                self.add(key, start, total, part)
                start, ids = start + len(part), ids[len(part) :]
                if self.sequence != last:
                    left.pop(0)
        self.window = window

    def batch(self, names: list[str]) -> pa.RecordBatch:
        rows, self.done = self.done, []
        key, start, total, ids, offset, sequence = zip(*rows, strict=True) if rows else ((),) * 6
        return pa.record_batch(
            [
                pa.array(key, pa.int64()),
                pa.array(start, pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array(total, pa.int64()),
                pa.array([x.tobytes() for x in ids], pa.binary()),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            names,
        )


# --- the job -------------------------------------------------------------------------


def retrieval_packed(
    documents: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_pieces: int = SHARD_PIECES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece its document, ``start``, ``length``, ``doc_tokens``, ``ids``, sequence and ``offset``.

    ``window`` is a power of two.
    """
    if window & (window - 1):
        raise ValueError("the window has to be a power of two")
    tokenizer = tokenizer or default_tokenizer()
    cut = materialize(cut_windows(documents, tokenizer, window, end_id, key, text), "windows")
    columns = [key, "start", "length", "doc_tokens", "ids"]
    names = [*columns, "sequence_id", "offset"]
    whole = cut.where(F.col("length") == window).select(
        *columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    pieces = cut.where(F.col("length") < window)
    # One number per entry of the vocabulary.
    known = documents.sparkSession.sparkContext.broadcast(
        statistics(pieces, vocabulary_size(tokenizer, end_id))
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tape = Tape(window, TaskContext.get().partitionId() << TASK_BITS)
        held: list[tuple] = []

        def index() -> None:
            shard = Shard([x[3] for x in held], known.value)
            for k in shard.fill(tape.filled, window):
                tape.add(*held[k])
            held.clear()

        for batch in batches:
            read = (batch.column(c).to_pylist() for c in (key, "start", "doc_tokens", "ids"))
            for name, start, total, ids in zip(*read, strict=True):
                held.append((name, start, total, np.frombuffer(ids, dtype="<u4")))
                if len(held) == shard_pieces:
                    index()
                    yield tape.batch(names)
        if held:
            index()
        tape.close()
        yield tape.batch(names)

    order = [*DRAWS, key, "start", F.crc32("ids")]
    shards = pieces.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    packed = shards.mapInArrow(fill, f"{_kinds(key)}, sequence_id long, offset long")
    return packed.union(whole)


def op13_lexical_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens, each filled with its seed's neighbours."""
    return retrieval_packed(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
