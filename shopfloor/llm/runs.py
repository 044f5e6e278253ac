"""Periodic runs of words inside texts, by seeds on diagonals that are extended.

A run is a stretch of words with smallest period ``q``, at least ``least`` words and ``times``
periods long, that neither neighbour extends. On the diagonal of lag ``q`` (word ``x`` against
word ``x + q``) it is a stretch of matches, at least ``overlap(q) = max(least - q, (times - 1) q)``
long. Lags are dealt with in classes 1, 2, 3-4, 5-8, ...; for each

1. all k-grams are indexed whose length ``k`` is the overlap that the class guarantees. Only a
   position whose k-gram recurs in its text is handed on to the next class, as no longer one can
   recur elsewhere, so plain prose leaves the index at once;
2. each occurrence is paired with the next one of the same text, if its lag is in the class.
   As ``k`` reaches the largest lag of the class, a k-gram inside a run of period ``q`` recurs
   ``q`` words on and nowhere before: next occurrences find every run, lags that are multiples of
   the smallest period are never met, and there are no more pairs than words;
3. a pair is a seed. A table per lag holds how far its diagonal is covered; a seed short of that is
   dropped, any other is extended both ways until the words differ.

The k-grams are numbered exactly (pairs of numbers of shorter ones), not by a hash; a hash only
rules out words of which no k-gram can recur. The work is some ``n log n`` for ``n`` words,
also if a whole text is one run. Texts do not leave their row: nothing is shuffled, and a group
of copies is dealt like other rows.

Edge cases: a null or blank text has no words, no runs and an empty collapsed text; repeated rows
and rows without id are judged each by itself; runs of different periods may overlap and all count;
very long texts are processed whole, in memory of some hundred bytes a word; columns that are
not named are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import table
from shopfloor.llm.tokens import lots

LEAST_WORDS = 6
LEAST_PERIODS = 4
RUN = "struct<start: long, length: long, period: long>"
# Words compared at first when a seed is extended; doubled as long as they match.
FIRST_BLOCK = 64

Edit = Callable[[int, int], np.ndarray | None]


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers from 0 of the different (left, right) pairs of small numbers."""
    key = left.astype(np.int64) << 32 | right
    return np.unique(key, return_inverse=True)[1]


def _recurring(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Which entries equal a neighbour in ``order``; ``same`` compares each with the one after."""
    found = np.zeros(len(order), dtype=bool)
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    return found


def _candidates(words: np.ndarray, owner: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Positions whose ``size``-gram may recur in its text, by a hash of both."""
    places = np.flatnonzero(np.arange(len(words)) + size <= ends[owner])
    mixed = np.uint64(0x9E3779B97F4A7C15) * (owner[places].astype(np.uint64) + np.uint64(1))
    for k in range(size):
        mixed ^= words[places + k].astype(np.uint64)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    mixed = mixed[order]
    return places[_recurring(order, mixed[1:] == mixed[:-1])]


class _Diagonals:
    """Seeds in, maximal stretches of matches out."""

    def __init__(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        self.words, self.begins, self.ends = words, begins, ends
        self.covered: dict[int, int] = {}

    def _matches(self, first: int, second: int, room: int, step: int) -> int:
        """How many words match from two places on, in steps of 1 or -1, up to ``room``."""
        done, block = 0, FIRST_BLOCK
        while done < room:
            size = min(block, room - done)
            reach = slice(None) if step > 0 else slice(None, None, -1)
            a, b = (
                self.words[x + done : x + done + size][reach]
                if step > 0
                else self.words[x - done - size + 1 : x - done + 1][reach]
                for x in (first, second)
            )
            differ = a != b
            if differ.any():
                return done + int(differ.argmax())
            done, block = done + size, 2 * block
        return done

    def extend(self, place: int, lag: int, size: int, owner: int) -> tuple[int, int] | None:
        """First place and end of the stretch through a seed, or None if it is covered."""
        if place < self.covered.get(lag, 0):
            return None
        begin, end = int(self.begins[owner]), int(self.ends[owner])
        left = self._matches(place - 1, place - 1 + lag, place - begin, -1)
        after = place + size
        stop = after + self._matches(after, after + lag, end - lag - after, 1)
        self.covered[lag] = stop
        return place - left, stop


def runs_of(
    words: np.ndarray,
    sizes: np.ndarray,
    least: int = LEAST_WORDS,
    times: int = LEAST_PERIODS,
) -> np.ndarray:
    """(text, start, length, period) of all runs, in this order, of texts laid end to end.

    ``words`` holds a number per word, ``sizes`` the words of each text.
    """
    if not 3 <= times <= least < 2 * times:
        raise ValueError("needs 3 <= times <= least < 2 * times")
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    diagonals = _Diagonals(words, begins, ends)
    found: list[tuple[int, int, int, int]] = []
    low = high = 1
    size = max(least - low, times - 1)
    places = _candidates(words, owner, ends, size)
    number = words[places]
    for k in range(1, size):
        number = _pairs(number, words[places + k])
    while len(places):
        order = np.argsort(number, kind="stable")
        sorted_places, sorted_numbers = places[order], number[order]
        own = owner[sorted_places]
        same = (sorted_numbers[1:] == sorted_numbers[:-1]) & (own[1:] == own[:-1])
        lag = sorted_places[1:] - sorted_places[:-1]
        seeds = same & (lag >= low) & (lag <= high)
        at, lags = sorted_places[:-1][seeds], lag[seeds]
        # Seeds next to each other on a diagonal lie on one stretch: the first stands for all.
        by_lag = np.lexsort((at, lags))
        at, lags = at[by_lag], lags[by_lag]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (lags[1:] != lags[:-1]) | (at[1:] != at[:-1] + 1) | (
            owner[at[1:]] != owner[at[:-1]]
        )
        for place, step in zip(at[first].tolist(), lags[first].tolist(), strict=True):
            text = int(owner[place])
            stretch = diagonals.extend(place, step, size, text)
            if stretch is None:
                continue
            length = stretch[1] - stretch[0] + step
            if length >= max(least, times * step):
                found.append((text, stretch[0] - int(begins[text]), length, step))
        # On to the next class: k-grams of both halves have to recur for a longer one to.
        numbered = np.full(len(words), -1, dtype=np.int64)
        stays = _recurring(order, same)
        numbered[places[stays]] = number[stays]
        low, high = high + 1, 2 * high
        longer = max(least - low, (times - 1) * low)
        places = places[stays]
        places = places[places + longer <= ends[owner[places]]]
        places = places[numbered[places + longer - size] >= 0]
        number = _pairs(numbered[places], numbered[places + longer - size])
        size = longer
    rows = np.array(found, dtype=np.int64).reshape(-1, 4)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _repeats(runs: np.ndarray, size: int) -> np.ndarray:
    """Which words a run contains after its first period."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def periodic_runs(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_WORDS,
    times: int = LEAST_PERIODS,
    edit: Edit | None = None,
) -> DataFrame:
    """Per row its id, ``n_words``, its ``runs`` by start and period, and its ``collapsed`` text.

    ``collapsed`` joins by one space the words that no run contains after its first period.
    ``edit(id, words)`` may name the words to read instead, as an array of their numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, lot in lots(batch.column(1)):
                keys = batch.column(0).slice(first, len(lot))
                split = [t.encode().split() for t in lot]
                if edit is not None:
                    for k, (name, own) in enumerate(zip(keys.to_pylist(), split, strict=True)):
                        order = None if name is None else edit(name, len(own))
                        if order is not None:
                            split[k] = [own[i] for i in order.tolist()]
                sizes = np.array([len(x) for x in split], dtype=np.int64)
                every = [w for own in split for w in own]
                coded = pa.array(every, pa.binary()).dictionary_encode().indices
                words = coded.to_numpy(zero_copy_only=False).astype(np.int64)
                rows = runs_of(words, sizes, least, times)
                bounds = np.searchsorted(rows[:, 0], np.arange(len(split) + 1))
                collapsed = []
                for k, own in enumerate(split):
                    mine = rows[bounds[k] : bounds[k + 1]]
                    if len(mine):
                        gone = _repeats(mine, len(own)).tolist()
                        own = [w for w, drop in zip(own, gone, strict=True) if not drop]
                    collapsed.append(b" ".join(own))
                fields = [pa.array(rows[:, c]) for c in (1, 2, 3)]
                runs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                yield pa.record_batch(
                    [
                        keys,
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    [key, "n_words", "runs", "collapsed"],
                )

    given = documents.select(F.col(key).cast("long").alias(key), F.col(text).cast("string"))
    return given.mapInArrow(run, f"`{key}` long, n_words long, runs array<{RUN}>, collapsed string")


def longest(runs: Column) -> Column:
    """The longest run; of several the one that starts first, then that of the shortest period."""
    order = F.transform(
        runs,
        lambda r: F.struct(
            r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
        ),
    )
    return F.array_max(order)


def planted_order(doc_id: int, size: int) -> np.ndarray | None:
    """The words of every tenth document (by checksum) from some place on, as one repeated stretch."""
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10 or not size:
        return None
    rest = checksum // 10
    begin = rest % size
    period = 1 + (size - begin) // (3 + rest % 8)
    order = np.arange(size)
    order[begin:] = begin + (order[begin:] - begin) % period
    return order


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents, with repeated stretches planted in every tenth."""
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=planted_order)
    line = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    best = F.col("best")
    return found.withColumn("best", longest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"),
        best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
