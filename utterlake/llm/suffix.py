"""Suffix arrays by linear grouping.

Suffixes are grouped by their longest Lyndon prefix. Groups are taken from the highest down; each member's pointer to the
previous suffix of a lower group says whose Lyndon prefix grows by this group's: those suffixes leave their groups for new
ones right above, sorted by how many members point at them. When all groups are final, a suffix is its group's
prefix followed by the next smaller suffix, so going through the array in order and appending to their groups the suffixes
that continue with the one just read emits every group in order. Nothing is renamed or sorted recursively.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix of text (whose last symbol is its unique least): the first place of its final group, and the length of its Lyndon prefix."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # of a suffix in `order`
    start = [0] * n  # of a suffix's group
    size: dict[int, int] = {}
    length: dict[int, int] = {}
    at = 0
    for i, s in enumerate(order):
        place[s] = i
        if text[s] != text[order[at]]:
            at = i
        start[s] = at
        size[at] = size.get(at, 0) + 1
        length[at] = 1
    prev = [-1] * n
    top = n
    while top > 0:
        g = start[order[top - 1]]
        members = order[g:top]
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and start[j] >= g:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if len(pointed) == 1:
            ((j, times),) = pointed.items()
            split = [((times, start[j]), [j])]
        else:
            by: dict[tuple[int, int], list[int]] = defaultdict(list)
            for j, times in pointed.items():
                by[times, start[j]].append(j)
            split = sorted(by.items(), reverse=True) if len(by) > 1 else by.items()
        for (times, old), leaving in split:
            n_old = size[old]
            new = old + n_old - len(leaving)
            grown = length[old] + times * length[g]
            if new == old:  # the whole group moves on together
                length[old] = grown
                continue
            end = old + n_old
            for j in leaving:
                end -= 1
                other, p = order[end], place[j]
                if other != j:
                    order[p], order[end] = other, j
                    place[other], place[j] = p, end
            for j in leaving:
                start[j] = new
            size[old], size[new] = n_old - len(leaving), len(leaving)
            length[new] = grown
        top = g
    return start, [length[s] for s in start]


def suffix_array(text: Sequence[int]) -> np.ndarray:
    """Start positions of text's suffixes in ascending order. A symbol below all others is taken to follow the text."""
    symbols = np.asarray(text, np.int64)
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    start, length = lyndon_groups([*symbols.tolist(), int(symbols.min()) - 1])
    # suffixes by the one that they continue with
    follow = np.arange(n + 1) + np.array(length)
    by = np.argsort(follow, kind="stable")
    first = np.searchsorted(follow[by], np.arange(n + 2)).tolist()
    by = by.tolist()
    free = start
    slot = list(range(n + 1))  # next free place of the group that begins here
    out = [0] * (n + 1)
    out[0] = n
    for i in range(n + 1):
        s = out[i]
        for j in by[first[s] : first[s + 1]]:
            g = free[j]
            out[slot[g]] = j
            slot[g] += 1
    return np.array(out[1:], np.int64)
