"""Suffix order by grouping on Lyndon prefixes, in time linear up to the sorting of each group."""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """The order of all suffixes of ``symbols`` (any integers).

    First phase: suffixes start grouped by their first symbol; groups are taken from the highest
    down. ``prev`` of a suffix is the nearest suffix to its left in a lower group, found along
    the pointers of higher groups. The group's string extends the Lyndon prefix of every suffix
    that such a pointer meets, so those suffixes leave their group for a higher place right
    behind it, the more often met the higher. Second phase: from the lowest suffix up, each
    one settles its left neighbour, and along ``prev`` further ones, at the front of their
    groups. No renaming and no recursion takes place.
    """
    n = len(symbols) + 1  # with an end that is lower than everything
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    order = [n - 1]
    group = [0] * n       # first place of the suffix's group
    size = [0] * n        # by first place
    size[0] = 1
    for c in sorted(by_symbol):
        members = by_symbol[c]
        start = len(order)
        size[start] = len(members)
        for i in members:
            group[i] = start
        order += members
    place = [0] * n
    for k, i in enumerate(order):
        place[i] = k

    prev = [-1] * n
    end = n
    while end > 0:
        i = order[end - 1]
        start = group[i]
        if start == end - 1:  # a group of one, by far the most frequent
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                g = group[j]
                last = g + size[g] - 1
                if last != g:
                    size[g] -= 1
                    at, other = place[j], order[last]
                    order[at], order[last] = other, j
                    place[other], place[j] = at, last
                    group[j] = last
                    size[last] = 1
            end = start
            continue
        met: dict[int, int] = {}
        # from left to right, so that a neighbour in the same group has its pointer already
        members = order[start:end]
        members.sort()
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        if met:
            times: dict[int, list[int]] = {}
            for j, k in met.items():
                times.setdefault(k, []).append(j)
            for k in sorted(times, reverse=True):
                moved = times[k]
                for j in moved:
                    g = group[j]
                    last = g + size[g] - 1
                    size[g] -= 1
                    at, other = place[j], order[last]
                    order[at], order[last] = other, j
                    place[other], place[j] = at, last
                starts = [group[j] + size[group[j]] for j in moved]
                for j, g in zip(moved, starts, strict=True):
                    group[j] = g
                    size[g] = 0
                for g in starts:
                    size[g] += 1
        end = start

    out = [0] * n
    out[0] = n - 1
    filled = [0] * n
    settled = bytearray(n)
    settled[n - 1] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not settled[j]:
            g = group[j]
            out[g + filled[g]] = j
            filled[g] += 1
            settled[j] = 1
            j = prev[j]
    return out[1:]


def neighbour_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """For each position, the longest prefix (in symbols) its suffix shares with any other."""
    n = len(symbols)
    rank = [0] * n
    for k, i in enumerate(order):
        rank[i] = k
    best = [0] * n
    h = 0
    for i in range(n):
        k = rank[i]
        if k == 0:
            h = 0
            continue
        j = order[k - 1]
        while i + h < n and j + h < n and symbols[i + h] == symbols[j + h]:
            h += 1
        if h > best[i]:
            best[i] = h
        if h > best[j]:
            best[j] = h
        if h:
            h -= 1
    return best
