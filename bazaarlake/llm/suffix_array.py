"""Suffix arrays by linear grouping, for many texts side by side.

The suffixes of a text are grouped by the longest Lyndon word that they begin with. Groups are visited from the highest to
the lowest: each suffix of a group looks for the nearest suffix to its left in a lower group (its previous smaller one), and
suffixes that are found so rise, by how often they are found, into new groups right above their own. When all
groups are final, one pass from the smallest suffix on emits each group's order. Nothing is renamed or sorted again.

The steps of one text depend on each other, so thousands of texts take them together, each step a few array operations.
"""

from __future__ import annotations

import numpy as np


def suffix_orders(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Suffix arrays, one after the other, of the texts that begin at ``starts`` of an integer array.

    The last value of each text must be smaller than all its others. Positions count from the start of the array.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.r_[starts[1:], n]
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    group, previous = _group(text, starts, ends, owner)
    return _emit(n, starts, ends, owner, group, previous)


def _group(text, starts, ends, owner) -> tuple[np.ndarray, np.ndarray]:
    """Group of each suffix, given as the first place of the group in the suffix array, and its previous smaller suffix."""
    n, key = len(text), owner * (int(text.max()) + 1) + text
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    sizes = np.diff(np.r_[first, n])
    group, place, size = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    group[order], place[order], size[first] = np.repeat(first, sizes), np.arange(n), sizes
    previous = np.arange(n) - 1
    previous[starts] = -1
    rising, border, active = np.zeros(n, bool), ends.copy(), np.arange(len(starts))
    while len(active):
        # The highest group of each text that has not been visited.
        top = group[order[border[active] - 1]]
        count = border[active] - top
        suffix = order[np.repeat(top - np.cumsum(count) + count, count) + np.arange(count.sum())]
        own, left = np.repeat(top, count), previous[suffix]
        higher = np.flatnonzero(left >= 0)
        higher = higher[group[left[higher]] >= own[higher]]
        while len(higher):
            left[higher] = previous[left[higher]]
            higher = higher[left[higher] >= 0]
            higher = higher[group[left[higher]] >= own[higher]]
        previous[suffix] = left
        border[active] = top
        active = active[top > starts[active]]
        found, times = np.unique(left[left >= 0], return_counts=True)
        if not len(found):
            continue
        old = group[found]
        by = np.lexsort((times, old))
        found, times, old = found[by], times[by], old[by]
        change = np.r_[True, old[1:] != old[:-1]]
        begin = np.flatnonzero(change)
        many = np.diff(np.r_[begin, len(found)])
        low = old[begin] + size[old[begin]] - many
        # They change places with whatever stands at the end of their group.
        target = np.repeat(low - begin, many) + np.arange(len(found))
        rising[found] = True
        there, here = order[target], place[found]
        pushed, free = there[~rising[there]], here[here < np.repeat(low, many)]
        rising[found] = False
        order[free], place[pushed] = pushed, free
        order[target], place[found] = found, target
        begin_new = np.flatnonzero(change | np.r_[True, times[1:] != times[:-1]])
        many_new = np.diff(np.r_[begin_new, len(found)])
        group[found] = np.repeat(target[begin_new], many_new)
        size[old[begin]] -= many
        size[target[begin_new]] = many_new
    return group, previous


def _emit(n, starts, ends, owner, group, previous) -> np.ndarray:
    """Order of the suffixes: each emitted suffix lets the one before it, and its previous smaller ones, follow."""
    result, follow, done = np.full(n, -1), np.arange(n), np.zeros(n, bool)
    result[starts] = ends - 1
    done[ends - 1] = True
    follow[group[ends - 1]] += 1
    at, chain, active = starts.copy(), np.full(len(starts), -1), np.arange(len(starts))
    while len(active):
        fresh = active[chain[active] < 0]
        nxt = result[at[fresh]] - 1
        chain[fresh] = np.where(nxt >= starts[fresh], nxt, -1)
        at[fresh] += 1
        now = active[chain[active] >= 0]
        suffix = chain[now]
        open_ = ~done[suffix]
        chain[now[~open_]] = -1
        now, suffix = now[open_], suffix[open_]
        slot = follow[group[suffix]]
        result[slot] = suffix
        follow[group[suffix]] += 1
        done[suffix] = True
        chain[now] = previous[suffix]
        active = active[(at[active] < ends[active]) | (chain[active] >= 0)]
    return result
