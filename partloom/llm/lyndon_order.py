"""Suffix orders of many strings at once, by grouping suffixes under their Lyndon prefixes.

The construction has two phases. In the first, suffixes are kept in groups that are ordered as the suffixes
are; a group's suffixes share a prefix. Groups are processed from the highest down: for each member the nearest place to
its left in a lower group is found by following the pointers of higher, already processed members; those places
are prefixed by the member's group, so they leave their own group and form new ones right above it, by how many members
follow them. In the end a group's common prefix is the longest Lyndon word that its suffixes begin with.
In the second, groups are emitted from the lowest up: members are ordered by the rank of the suffix
behind their Lyndon prefix, which is lower and thus known. Nothing is renamed or recursed into.

A string alone is a long sequence of small steps, so strings are taken through the phases side by side:
step k processes the k-th group of every string, as arrays over all of their members.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, … (count[0] of them), start[1], …"""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def _heads(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    flags = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=flags[1:])
    return flags


def suffix_orders(symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each string ``symbols[places[i]:places[i + 1]]`` its suffixes' places in ascending order, at those same slots.

    Symbols are small non-negative numbers; a suffix that is the beginning of another one is lower.
    """
    places = np.asarray(places, np.int64)
    sizes = np.diff(places)
    order, group, length, size = _groups(np.asarray(symbols, np.int64), places, sizes)
    return _emitted(order, group, length, size, places, sizes)


def _groups(symbols: np.ndarray, places: np.ndarray, sizes: np.ndarray):
    """Phase one: slots ordered by group, each suffix's group (its first slot), and per group prefix length and size."""
    n = len(symbols)
    by = np.repeat(np.arange(len(sizes)), sizes) * (int(symbols.max(initial=0)) + 1) + symbols
    order = np.argsort(by)
    starts = np.flatnonzero(_heads(by[order]))
    counts = np.diff(starts, append=n)
    group, slot, size, length = (np.zeros(n, np.int64) for _ in range(4))
    slot[order] = np.arange(n)
    group[order] = np.repeat(starts, counts)
    size[starts] = counts
    length[starts] = 1
    left = np.full(n, -1)
    member, moving = np.zeros(n, np.int64), np.zeros(n, bool)
    first, end = places[:-1][sizes > 0], places[1:][sizes > 0]
    while len(first):
        top = group[order[end - 1]]
        counts = end - top
        single = counts.max() == 1
        at = order[top] if single else order[_ranges(top, counts)]
        own = top if single else np.repeat(top, counts)
        low = first if single else np.repeat(first, counts)

        # The nearest place to the left in a lower group.
        to = at - 1
        todo = np.flatnonzero(to >= low)
        todo = todo[group[to[todo]] > own[todo]]
        while len(todo):
            jumped = left[to[todo]]
            to[todo] = jumped
            inside = jumped >= low[todo]
            todo, jumped = todo[inside], jumped[inside]
            todo = todo[group[jumped] > own[todo]]
        if not single:
            same = np.flatnonzero(to >= low)
            same = same[group[to[same]] == own[same]]
            if len(same):
                member[at] = np.arange(len(at))
            while len(same):
                to[same] = to[member[to[same]]]
                same = same[to[same] >= low[same]]
                same = same[group[to[same]] == own[same]]
        held = to >= low
        left[at] = np.where(held, to, -1)

        to, own = to[held], own[held]
        if len(to):
            if not single:
                by = np.argsort(to)
                to, own = to[by], own[by]
            heads = np.flatnonzero(_heads(to))
            times = np.diff(heads, append=len(to))
            _move(to[heads], times, length[own[heads]] * times, order, slot, group, size, length, moving)
        end = top
        going = end > first
        if not going.all():
            first, end = first[going], end[going]
    return order, group, length, size


def _move(place, times, longer, order, slot, group, size, length, moving) -> None:
    """Take places out of their groups into new ones right above, the more often followed ones higher."""
    home = group[place]
    # No place counts as often as there are places; the order of equal ones does not matter.
    by = np.argsort(home * len(order) + times)
    place, times, longer, home = place[by], times[by], longer[by], home[by]
    heads = _heads(home)
    first = np.flatnonzero(heads)
    count = np.diff(first, append=len(home))
    homes = home[first]
    border = homes + size[homes] - count
    border_of = np.repeat(border, count)
    goal = border_of + np.arange(len(home)) - np.repeat(first, count)

    # Who stands there and stays takes the slots that are left.
    moving[place] = True
    there = order[goal]
    staying = there[~moving[there]]
    moving[place] = False
    if len(staying):
        were = slot[place]
        free = were[were < border_of]
        order[free] = staying
        slot[staying] = free
    order[goal] = place
    slot[place] = goal

    heads[1:] |= times[1:] != times[:-1]
    runs = np.flatnonzero(heads)
    fresh, counts = goal[runs], np.diff(runs, append=len(home))
    grown = length[home[runs]] + longer[runs]
    size[homes] -= count
    size[fresh] = counts
    length[fresh] = grown
    group[place] = np.repeat(fresh, counts)


def _emitted(order, group, length, size, places, sizes) -> np.ndarray:
    """Phase two: members of a group by the rank of what follows their prefix."""
    n = len(order)
    rank = np.full(n + 1, -1)
    starts = np.flatnonzero(size > 0)
    alone = starts[size[starts] == 1]
    rank[order[alone]] = alone
    several = starts[size[starts] > 1]
    if not len(several):
        return order
    string = np.searchsorted(places, several, side="right") - 1
    turn = np.arange(len(several)) - np.flatnonzero(_heads(string))[np.cumsum(_heads(string)) - 1]
    by = np.argsort(turn, kind="stable")
    several, string = several[by], string[by]
    member = np.zeros(n, np.int64)
    for chunk, ends in zip(np.split(several, np.cumsum(np.bincount(turn))[:-1]), np.split(places[string + 1], np.cumsum(np.bincount(turn))[:-1])):
        counts = size[chunk]
        slots = _ranges(chunk, counts)
        at, own = order[slots], np.repeat(chunk, counts)
        end = np.repeat(ends, counts)
        member[at] = np.arange(len(at))
        to, hops = at + length[own], np.zeros(len(at), np.int64)
        # A prefix that is followed by itself: what counts is how often, then what comes behind.
        same = np.flatnonzero(to < end)
        same = same[group[to[same]] == own[same]]
        while len(same):
            next_one = member[to[same]]
            hops[same], to[same] = hops[same] + 1 + hops[next_one], to[next_one]
            same = same[to[same] < end[same]]
            same = same[group[to[same]] == own[same]]
        behind = np.where(to < end, rank[np.minimum(to, n)], -1)
        # Ranks behind are below n.
        by = np.argsort(own * (n + 1) + behind + 1) if not hops.any() else np.lexsort((behind, hops, own))
        sorted_at = at[by]
        order[slots] = sorted_at
        rank[sorted_at] = slots
    return order
