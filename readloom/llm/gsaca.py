"""Suffix array by linear grouping.

Suffixes start in groups by first symbol. Groups are taken from the largest down; each suffix of the
group points to the nearest suffix before it in a smaller group, and the suffixes pointed to move to
the upper end of their own groups, those with more pointers higher: afterwards suffixes of a group
share their longest Lyndon prefix. A pass over the array from its begin then puts each suffix, and
those on its chain of pointers, at the next free place of its group. Nothing is renamed or solved by
recursion.
"""

from __future__ import annotations

from collections import Counter

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of non-negative integers."""
    n = len(text) + 1
    symbols = np.zeros(n, np.int64)
    symbols[:-1] = np.asarray(text, np.int64) + 1
    first = np.argsort(symbols, kind="stable")
    at = np.empty(n, np.int64)
    at[first] = np.arange(n)
    starts = np.flatnonzero(np.diff(symbols[first], prepend=-1))
    size_of = np.zeros(n, np.int64)
    size_of[starts] = np.diff(np.append(starts, n))
    group_of = np.empty(n, np.int64)
    group_of[first] = np.repeat(starts, size_of[starts])
    order, place, group, size = first.tolist(), at.tolist(), group_of.tolist(), size_of.tolist()
    before = [-1] * n

    end = n
    while end > 0:
        g = group[order[end - 1]]
        if end - g == 1:
            # A suffix alone in its group moves one other at most.
            i = order[g]
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            end = g
            if j >= 0:
                h = group[j]
                count = size[h]
                if count > 1:
                    last, p = h + count - 1, place[j]
                    other = order[last]
                    order[p], order[last] = other, j
                    place[other], place[j] = p, last
                    size[h], size[last], group[j] = count - 1, 1, last
            continue
        members = order[g:end]
        members.sort()
        targets = []
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                targets.append(j)
        end = g
        once = set(targets)
        if len(once) == len(targets):
            levels = [targets] if targets else []
        else:
            by_count: dict[int, list[int]] = {}
            for j, count in Counter(targets).items():
                by_count.setdefault(count, []).append(j)
            levels = [by_count[count] for count in sorted(by_count, reverse=True)]
        for level in levels:
            parts: dict[int, list[int]] = {}
            for j in level:
                h = group[j]
                if h in parts:
                    parts[h].append(j)
                else:
                    parts[h] = [j]
            for h, moved in parts.items():
                count = size[h] - len(moved)
                if not count:
                    continue
                last = h + size[h] - 1
                for j in moved:
                    p, other = place[j], order[last]
                    order[p], order[last] = other, j
                    place[other], place[j] = p, last
                    last -= 1
                size[h] = count
                new = last + 1
                size[new] = len(moved)
                for j in moved:
                    group[j] = new

    free = list(range(n))
    out = [-1] * n
    out[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            p = free[g]
            out[p] = j
            free[g] = p + 1
            done[j] = 1
            j = before[j]
    return np.asarray(out[1:], np.int64)
