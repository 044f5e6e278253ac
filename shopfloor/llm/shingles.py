"""Distinct word-shingle sets of whole texts, as 64-bit hashes, a batch at a time.

A batch of texts becomes one byte array; words, their hashes and the shingles are found
with array operations, so cost and memory follow the batch's bytes. Long texts are batches
of their own. Two texts get the same set exactly if their lower-cased (A-Z) word windows
agree, up to collisions of a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Texts are hashed in slabs of about so many bytes.
SLAB_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Sets(NamedTuple):
    """Sorted distinct hashes of each text, one after the other; text i has ``ends[i-1]:ends[i]``."""

    hashes: np.ndarray
    ends: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0xD6E8FEB86659FD93
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    """The first ``2**bits`` powers of ``base`` modulo 2**64."""
    out = np.full(1 << bits, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges, from running sums modulo 2**64."""
    bits = max(20, int(len(data)).bit_length())
    summed = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, bits)[: len(data)], out=summed[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), bits)
    raw = (summed[ends] - summed[starts]) * back[starts]
    return mix(raw ^ (ends - starts).astype(np.uint64) * MULTIPLIER)


def _slab(texts: list[bytes], words: int) -> Sets:
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    upto = np.searchsorted(starts, np.cumsum(lengths + 1))
    hashed = _word_hashes(data, starts, ends)
    n = max(len(hashed) - words + 1, 0)
    # The windows of `words` words, as the sum of differently weighted word hashes.
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(words if n else 0):
        rolled = rolled * MULTIPLIER + hashed[i : n + i]
    rolled = mix(rolled)
    sets, first = [], 0
    for last in upto.tolist():
        if last - first >= words:
            own = np.sort(rolled[first : last - words + 1])
            fresh = np.empty(len(own), dtype=bool)
            fresh[0] = True
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            sets.append(own[fresh])
        else:
            sets.append(_short(hashed[first:last]))
        first = last
    sizes = np.fromiter((len(s) for s in sets), dtype=np.int64, count=len(sets))
    return Sets(np.concatenate(sets), np.cumsum(sizes))


def _short(hashed: np.ndarray) -> np.ndarray:
    """Fewer words than a window: the sequence as a whole, marked by its length."""
    if not len(hashed):
        return hashed
    value = np.array([len(hashed)], dtype=np.uint64)
    for h in hashed:
        value = mix(value * MULTIPLIER + h)
    return value


def slabs(texts: pa.Array, words: int) -> Iterator[tuple[int, Sets]]:
    """(first row, sets) of consecutive runs of ``texts``; null is the empty text."""
    held: list[bytes] = []
    begin, size = 0, 0
    for row, text in enumerate(texts):
        raw = (text.as_py() or "").encode()
        if held and size + len(raw) > SLAB_BYTES:
            yield begin, _slab(held, words)
            held, begin, size = [], row, 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield begin, _slab(held, words)


def signatures(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Digests of 64 and 32 bits of each set; together they name the set."""
    out = []
    for salt in (0x51ED270B, 0x2545F491):
        weighed = mix(sets.hashes + np.uint64(salt)) if len(sets.hashes) else sets.hashes
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(weighed, dtype=np.uint64)])
        begin = np.concatenate([[0], sets.ends[:-1]]) if len(sets.ends) else sets.ends
        digest = mix((total[sets.ends] - total[begin]) ^ (sets.ends - begin).astype(np.uint64))
        out.append(digest.view(np.int64))
    return out[0], (out[1] >> np.int64(32)).astype(np.int32)


def bitmaps(sets: Sets) -> list[bytes]:
    """Per set a bitmap of 2 to 4 bits per token: which low bits of hashes occur."""
    out, first = [], 0
    for last in sets.ends.tolist():
        size = 1 << max(6, int(2 * (last - first) - 1).bit_length())
        hit = np.zeros(size, dtype=bool)
        hit[(sets.hashes[first:last] & np.uint64(size - 1)).astype(np.int64)] = True
        out.append(np.packbits(hit, bitorder="little").tobytes())
        first = last
    return out


def most_common(one: bytes, two: bytes, n1: int, n2: int) -> int:
    """An upper bound of two sets' common tokens from their bitmaps and sizes.

    Each bit that one bitmap alone has stands for a token that the other set lacks.
    """
    a, b = (np.frombuffer(x, dtype=np.uint64) for x in (one, two))
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    both = a & b
    lacks1 = int(np.bitwise_count(a ^ both).sum())
    lacks2 = int(np.bitwise_count(b ^ both).sum())
    return min(n1 - lacks1, n2 - lacks2)
