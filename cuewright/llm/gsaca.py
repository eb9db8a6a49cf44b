"""Suffix array of an integer sequence by linear grouping.

First part: suffixes are grouped by first symbol, then groups are taken from
the highest down.  When a group is taken, each of its suffixes finds its
previous smaller one (the nearest suffix to the left in a lower group), and
those so found leave their group for a new one right above it, further up the
more often they were found; afterwards each suffix stands in the group of its
longest Lyndon prefix.  Second part: from the smallest suffix on, the suffix to
the left of each emitted one, and its chain of previous smaller ones, take the
next free places of their groups.  Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int] | np.ndarray) -> list[int]:
    """Start positions of all suffixes in order; a suffix sorts before its extensions."""
    a = np.asarray(text)
    n = len(a)
    if n == 0:
        return []
    order = np.argsort(a, kind="stable")
    first = np.ones(n, bool)
    first[1:] = a[order[1:]] != a[order[:-1]]
    starts = np.flatnonzero(first)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    ends = [0] * n
    for s, e in zip(starts.tolist(), np.append(starts[1:], n).tolist(), strict=True):
        ends[s] = e
    at, where, group = order.tolist(), np.argsort(order).tolist(), group.tolist()
    before = _group_by_lyndon_prefix(n, at, where, group, ends)
    return _emit(n, group, before)


def _group_by_lyndon_prefix(n: int, at: list[int], where: list[int], group: list[int], ends: list[int]) -> list[int]:
    """Refine group in place; returns each suffix's previous smaller one (-1: none).

    at and where hold the suffixes in group order and its inverse; a group's
    name is the place where it starts, ends gives where it ends.
    """
    before, jump = [-1] * n, list(range(-1, n - 1))
    end = n
    while end:
        g = group[at[end - 1]]
        if end - g == 1:
            i = at[g]
            r = jump[i]
            if r >= 0 and group[r] >= g:
                seen = []
                while r >= 0 and group[r] >= g:
                    seen.append(r)
                    r = jump[r]
                for j in seen:
                    jump[j] = r
            jump[i] = before[i] = r
            if r >= 0:
                old = group[r]
                last = ends[old] - 1
                if last != old:
                    p, other = where[r], at[last]
                    at[p], where[other] = other, p
                    at[last], where[r] = r, last
                    ends[old] = last
                    group[r] = last
                    ends[last] = last + 1
            end = g
            continue
        found: dict[int, int] = {}
        for i in sorted(at[g:end]):
            r = jump[i]
            if r >= 0 and group[r] >= g:
                seen = []
                while r >= 0 and group[r] >= g:
                    seen.append(r)
                    r = jump[r]
                for j in seen:
                    jump[j] = r
            jump[i] = before[i] = r
            if r >= 0:
                found[r] = found.get(r, 0) + 1
        levels: dict[int, list[int]] = {}
        for r, times in found.items():
            levels.setdefault(times, []).append(r)
        for times in sorted(levels, reverse=True):
            tops: dict[int, int] = {}
            for r in levels[times]:
                old = group[r]
                last = ends[old] - 1
                tops.setdefault(old, last + 1)
                p, other = where[r], at[last]
                at[p], where[other] = other, p
                at[last], where[r] = r, last
                ends[old] = last
            for r in levels[times]:
                group[r] = ends[group[r]]
            for old, top in tops.items():
                ends[ends[old]] = top
        end = g
    return before


def _emit(n: int, group: list[int], before: list[int]) -> list[int]:
    free, out, placed = list(range(n)), [-1] * n, bytearray(n)
    j, i = n - 1, 0
    while True:
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
        if i == n:
            return out
        j = out[i] - 1
        i += 1
