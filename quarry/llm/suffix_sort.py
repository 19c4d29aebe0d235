"""Suffix sorting by Lyndon groups, in linear grouping steps.

Suffixes are grouped by their Lyndon prefix first.  They start in groups
by their first symbol, and groups are gone through in descending order.
Each suffix of the group at hand gets a pointer to the nearest earlier
suffix of a smaller group; a suffix that such pointers reach has its
prefix extended by the group's as often as it is pointed to, so those
reached equally often leave their group together for a new one right
behind it.  When all groups are done they stand in order, and one scan
from the left puts suffixes in their places: each placed suffix places
the one that begins a symbol earlier, then what that one points to, and
so on until one is met that has its place.  No suffix is renamed and
nothing recurs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """Starts of the suffixes of ``text`` (integers, the last of them the
    one smallest) in lexicographic order."""
    n = len(text)
    if n < 2:
        return list(range(n))
    by_symbol = np.argsort(text, kind="stable")
    sorted_symbols = text[by_symbol]
    starts = np.flatnonzero(np.r_[True, sorted_symbols[1:] != sorted_symbols[:-1]])
    sizes = np.diff(np.r_[starts, n])
    group = np.empty(n, np.int64)
    group[by_symbol] = np.repeat(starts, sizes)
    place = np.empty(n, np.int64)
    place[by_symbol] = np.arange(n)
    size = np.zeros(n, np.int64)
    size[starts] = sizes
    order, group, place, size = by_symbol.tolist(), group.tolist(), place.tolist(), size.tolist()
    before = _group_by_prefix(order, group, place, size)
    return _place(group, before)


def _group_by_prefix(order: list[int], group: list[int], place: list[int], size: list[int]) -> list[int]:
    """Refine the groups (named by where they start in ``order``); returns
    every suffix's pointer to the nearest earlier one of a smaller group."""
    before = [-1] * len(order)
    end = len(order)
    while end:
        first = group[order[end - 1]]
        members = order[first:end]
        if len(members) > 1:
            members.sort()
        reached: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = before[j]
            before[i] = j
            if j >= 0:
                reached[j] = reached.get(j, 0) + 1
        together: dict[tuple[int, int], list[int]] = {}
        for j, times in reached.items():
            together.setdefault((times, group[j]), []).append(j)
        for (_, old), leaving in sorted(together.items(), reverse=True) if len(together) > 1 else together.items():
            if len(leaving) == size[old]:
                continue
            at = old + size[old]
            for j in leaving:
                at -= 1
                p, other = place[j], order[at]
                order[p], order[at] = other, j
                place[other], place[j] = p, at
            size[old] -= len(leaving)
            size[at] = len(leaving)
            for j in leaving:
                group[j] = at
        end = first
    return before


def _place(group: list[int], before: list[int]) -> list[int]:
    n = len(group)
    out, free, placed = [-1] * n, list(range(n)), [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return out


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """At each place of the order, the symbols its suffix shares with the one before."""
    n = len(order)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    out, h = [0] * n, 0
    for i in range(n):
        r = rank[i]
        if r:
            j = order[r - 1]
            last = n - max(i, j)
            while h < last and text[i + h] == text[j + h]:
                h += 1
            out[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return out
