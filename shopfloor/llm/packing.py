"""Packing token pieces into few sequences by linear grouping.

Lengths are integers up to the sequence length, so the number of pieces per length is all
that the optimisation needs: a list of at most ``max_tokens`` counts, however many documents
there are. On it the driver

1. sorts the large lengths, cuts them into groups of equal cardinality and rounds each up to
   the largest of its group, which leaves a few sizes;
2. solves the configuration programme of these sizes (which mixes of sizes fill a sequence,
   and how often to use each) by column generation, and keeps the whole part of the solution;
3. substitutes the actual lengths, in order, into the places of their group;
4. puts what is left, and the small lengths, into the fullest sequences that have room.

The outcome is a list of runs: "the pieces of length L from rank r on go to the sequences
from s on, at offset o". Its length depends on ``max_tokens`` alone. Spark ranks the pieces
within their length over all executors and looks each one's run up.

Edge cases: a null or empty text is its end token alone; a text longer than a sequence is cut
into full pieces, the first one taking the remainder; repeated rows are packed as often as
they occur; literals of added tokens (``<|endoftext|>``) become that token, as the tokenizer file
has it; columns that are not named are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import table, with_rank
from shopfloor.llm.tokens import Encoder, default_tokenizer, lots
from shopfloor.scratch import materialize

MAX_TOKENS = 1024
END_ID = 2
# Tried in turn: lengths above which part of a sequence are large, and into how many groups
# they go. The choice that needs the fewest sequences stays.
CHOICES = ((1 / 3, 16), (1 / 3, 48), (1 / 4, 48), (1 / 8, 48), (1 / 2, 16))


# --- tokens --------------------------------------------------------------------------


def cut_documents(
    documents: DataFrame,
    tokenizer: str,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of at most ``max_tokens``: id, ``piece``, ``start``, ``length``, ``ids``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer, added_tokens=True)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for first, lot in lots(batch.column(1)):
                rows, pieces, starts, lengths, ids = [], [], [], [], []
                for row, found in enumerate(encoder.ids(lot), first):
                    raw = found + end
                    size = len(raw) // 4
                    start = 0
                    stop = size % max_tokens or min(max_tokens, size)
                    number = 0
                    while start < size:
                        rows.append(row)
                        pieces.append(number)
                        starts.append(start)
                        lengths.append(stop - start)
                        ids.append(raw[4 * start : 4 * stop])
                        start, stop, number = stop, stop + max_tokens, number + 1
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(pieces, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    [key, "piece", "start", "length", "ids"],
                )

    given = documents.select(F.col(key).cast("long").alias(key), text)
    return given.mapInArrow(run, f"`{key}` long, piece int, start long, length long, ids binary")


# --- the plan on counts --------------------------------------------------------------


@dataclass
class Runs:
    """Pieces of one length with consecutive ranks, ``per`` of them in each sequence."""

    length: list[int]
    rank: list[int]
    sequence: list[int]
    offset: list[int]
    per: list[int]

    def add(self, length: int, rank: int, sequence: int, offset: int, per: int) -> None:
        for column, value in zip(
            (self.length, self.rank, self.sequence, self.offset, self.per),
            (length, rank, sequence, offset, per),
            strict=True,
        ):
            column.append(value)


def group_lengths(counts: np.ndarray, large: int, groups: int) -> tuple[list[int], list[dict]]:
    """Large lengths in groups of equal cardinality: rounded sizes, and length -> count."""
    total = int(counts[large:].sum())
    each = max(1, -(-total // groups))
    sizes: list[int] = []
    members: list[dict] = []
    room = 0
    for length in range(len(counts) - 1, large - 1, -1):
        left = int(counts[length])
        while left:
            if not room:
                if sizes and sizes[-1] == length:
                    room = each
                else:
                    sizes.append(length)
                    members.append({})
                    room = each
            taken = min(room, left)
            members[-1][length] = members[-1].get(length, 0) + taken
            left -= taken
            room -= taken
    return sizes, members


def _best_mix(sizes: Sequence[int], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable mix of sizes that fits (an unbounded knapsack)."""
    array = np.asarray(sizes)
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(int(array.min()), capacity + 1):
        fits = np.flatnonzero(array <= room)
        reached = value[room - array[fits]] + worth[fits]
        best = int(reached.argmax())
        if reached[best] > value[room - 1] + 1e-12:
            value[room], choice[room] = reached[best], fits[best]
        else:
            value[room] = value[room - 1]
    mix = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        mix[choice[room]] += 1
        room -= int(array[choice[room]])
    return float(value[capacity]), mix


def configurations(sizes: Sequence[int], demand: Sequence[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Mixes of sizes and how often to use each, covering ``demand`` with least use."""
    needed = np.asarray(demand, dtype=float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(40 * len(sizes)):
        inverse = np.linalg.inv(basis)
        used = inverse @ needed
        worth = inverse.sum(axis=0)
        value, mix = _best_mix(sizes, np.maximum(worth, 0), capacity)
        if value <= 1 + 1e-7:
            break
        along = inverse @ mix
        steps = np.where(along > 1e-9, used / np.where(along > 1e-9, along, 1), np.inf)
        leaving = int(steps.argmin())
        if not np.isfinite(steps[leaving]):
            break
        basis[:, leaving] = mix
    used = np.linalg.solve(basis, needed)
    return [(basis[:, k].round().astype(int), float(used[k])) for k in range(len(sizes))]


class _Packer:
    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).copy()
        self.rank = np.zeros(len(counts), dtype=np.int64)
        self.capacity = capacity
        self.runs = Runs([], [], [], [], [])
        self.sequences = 0
        # Sequences by free room: (first sequence, how many).
        self.free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def take(self, length: int, count: int, sequence: int, offset: int, per: int = 1) -> None:
        self.runs.add(length, int(self.rank[length]), sequence, offset, per)
        self.rank[length] += count
        self.left[length] -= count

    def substitute(self, sizes: Sequence[int], members: list[dict], plan) -> None:
        """Fill the places of each configuration with actual lengths of the group."""
        waiting = [[list(x) for x in sorted(m.items(), reverse=True)] for m in members]
        for mix, use in plan:
            bins = int(use + 1e-6)
            places = [g for g in range(len(sizes)) for _ in range(mix[g])]
            if not bins or not places:
                continue
            first, self.sequences = self.sequences, self.sequences + bins
            # Cut the places' queues into stretches over which no length changes.
            stretches = [[] for _ in places]
            for spot, group in enumerate(places):
                want = bins
                while want and waiting[group]:
                    length, count = waiting[group][0]
                    taken = min(count, want)
                    stretches[spot].append((bins - want, taken, length))
                    want -= taken
                    waiting[group][0][1] -= taken
                    if not waiting[group][0][1]:
                        waiting[group].pop(0)
            cuts = sorted({0, bins, *(x for s in stretches for a, n, _ in s for x in (a, a + n))})
            for begin, end in zip(cuts, cuts[1:], strict=False):
                filled = 0
                for stretch in stretches:
                    for start, n, length in stretch:
                        if start <= begin < start + n:
                            self.take(length, end - begin, first + begin, filled)
                            filled += length
                self.free[self.capacity - filled].append((first + begin, end - begin))

    def best_fit(self) -> None:
        """Everything that is left, longest first, into the fullest sequences with room."""
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                gap = next((g for g in range(length, self.capacity + 1) if self.free[g]), None)
                if gap is None:
                    gap = self.capacity
                    bins = -(-int(self.left[length]) // (gap // length))
                    self.free[gap].append((self.sequences, bins))
                    self.sequences += bins
                first, bins = self.free[gap].pop()
                per, offset = gap // length, self.capacity - gap
                full = min(bins, int(self.left[length]) // per)
                if full:
                    self.take(length, full * per, first, offset, per)
                    self.free[gap - per * length].append((first, full))
                rest = int(self.left[length]) if full < bins and self.left[length] < per else 0
                if rest:
                    self.take(length, rest, first + full, offset, rest)
                    self.free[gap - rest * length].append((first + full, 1))
                used = full + (1 if rest else 0)
                if used < bins:
                    self.free[gap].append((first + used, bins - used))


def plan_runs(
    counts: np.ndarray, capacity: int, choices: Sequence[tuple[float, int]] = CHOICES
) -> tuple[Runs, int]:
    """Runs and the number of sequences, by the choice that needs the fewest."""
    best: _Packer | None = None
    fewest = -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    for part, groups in choices:
        packer = _Packer(counts, capacity)
        sizes, members = group_lengths(counts, int(capacity * part) + 1, groups)
        if sizes:
            plan = configurations(sizes, [sum(m.values()) for m in members], capacity)
            packer.substitute(sizes, members, plan)
        packer.best_fit()
        if best is None or packer.sequences < best.sequences:
            best = packer
        if best.sequences == fewest:
            break
    return best.runs, best.sequences


# --- placing -------------------------------------------------------------------------


def pack(pieces: DataFrame, order: Sequence[str], max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``.

    ``pieces`` has a ``length`` and is read three times: pass a written narrow table.
    ``order`` says which of two pieces of one length comes first; ties are interchangeable.
    """
    counted = pieces.groupBy("length").count().collect()
    counts = np.zeros(max_tokens + 1, dtype=np.int64)
    for row in counted:
        counts[row["length"]] = row["count"]
    runs, _ = plan_runs(counts, max_tokens)
    shift = np.int64(1) << np.int64(48)
    starts = np.array(runs.length, dtype=np.int64) * shift + np.array(runs.rank, dtype=np.int64)
    by_start = np.argsort(starts)
    starts, length, rank, sequence, offset, per = (
        np.array(x, dtype=np.int64)[by_start]
        for x in (starts, runs.length, runs.rank, runs.sequence, runs.offset, runs.per)
    )
    shorter = np.concatenate([[0], np.cumsum(counts)])

    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, ranks in batches:
            size = lengths.to_numpy()
            own = ranks.to_numpy() - shorter[size]
            run = np.searchsorted(starts, size * shift + own, side="right") - 1
            nth = own - rank[run]
            yield pd.DataFrame(
                {
                    "sequence_id": sequence[run] + nth // per[run],
                    "offset": offset[run] + nth % per[run] * length[run],
                }
            )

    place = F.pandas_udf(look_up, "sequence_id long, offset long")
    ranked = with_rank(pieces, ["length", *order], "__rank", "pack")
    return ranked.withColumn("__place", place("length", "__rank")).select(
        *pieces.columns, "__place.sequence_id", "__place.offset"
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence from packed pieces with ``ids``: its ids and where documents begin."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"),
        F.col("parts.offset").alias("begins"),
    )


def packed_documents(
    documents: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Per piece its document, extent, digest of the ids, sequence and place there."""
    pieces = materialize(
        cut_documents(documents, tokenizer or default_tokenizer(), max_tokens), "pieces"
    )
    narrow = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return pack(materialize(narrow, "piece-lengths"), ["doc_id", "piece", "ids_crc32"], max_tokens)


def op6_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))
