"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict


def words_of(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]


def shingle_set(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard_components(rows, size: int, percent: int) -> list[tuple]:
    """Per (id, text): id, set size, least id reachable; by counting common shingles."""
    sets = [shingle_set(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        common: dict[int, int] = defaultdict(int)
        for shingle in own:
            for j in holders[shingle]:
                common[j] += 1
            holders[shingle].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, (key, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = key if known is None else known if key is None else min(known, key)
    return [
        (key, len(sets[i]), least[root(i)] if sets[i] else key) for i, (key, _) in enumerate(rows)
    ]
