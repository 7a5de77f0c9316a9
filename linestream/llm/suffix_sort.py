"""Suffix array by linear grouping (no recursion, no renaming).

Phase 1 starts with suffixes grouped by first symbol and goes through the
groups in descending order. Each suffix of the current group points to the
previous suffix of a smaller group; suffixes that are pointed to k times move
to a new group right after their own, the largest k last. In the end a group
holds the suffixes with one longest Lyndon prefix. Phase 2 goes through the
suffix array in ascending order and puts the suffix before each one, and what
its pointers lead to, at the front of its group.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence


def _groups(text: Sequence[int]) -> tuple[list[int], list[int]]:
    """Phase 1: for every suffix, where its group starts and the pointer to
    the previous suffix of a smaller group (-1: none)."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start, last = 0, None
    for at, i in enumerate(order):
        if text[i] != last:
            start, last = at, text[i]
        place[i], group[i] = at, start
        size[start] += 1
    previous = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        hits: list[int] = []
        for i in sorted(order[start:end]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                hits.append(j)
        end = start
        if not hits:
            continue
        if len(hits) == 1:
            by_count = ((1, hits),)
        else:
            times = Counter(hits)
            sets = defaultdict(list)
            for j, k in times.items():
                sets[k].append(j)
            by_count = sorted(sets.items(), reverse=True)
        for _, chosen in by_count:
            moved: list[int] = []
            for j in chosen:  # to the end of its group
                g = group[j]
                to = g + size[g] - 1
                size[g] -= 1
                at, other = place[j], order[to]
                order[at], order[to] = other, j
                place[other], place[j] = at, to
                moved.append(to)
            if len(moved) > 1:
                moved.sort()
            began, before, last_group = -1, -2, -1
            for to in moved:  # runs of neighbours that left one group are a new one
                j = order[to]
                if to != before + 1 or group[j] != last_group:
                    began, last_group = to, group[j]
                size[began] = to - began + 1
                group[j] = began
                before = to
    return group, previous


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of `text` in ascending order."""
    group, previous = _groups(text)
    n = len(text)
    out = [-1] * n
    front = list(range(n))
    placed = bytearray(n)
    j = n - 1
    for at in range(-1, n):
        if at >= 0:
            j = out[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            placed[j] = 1
            j = previous[j]
    return out
