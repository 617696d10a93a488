"""Suffix array by grouping on Lyndon prefixes, and neighbours' common prefixes.

Phase 1 refines groups of suffixes from the highest to the lowest. A group
holds the suffixes that share a Lyndon prefix v. Each suffix's previous
smaller suffix is found by following the pointers of higher groups; the
previous suffixes, whose prefix u is followed by k copies of v, leave their
group upwards, those with larger k higher, and form the groups of u v^k. When
all groups are done each is the set of suffixes with one Lyndon prefix.
Phase 2 emits the order: a suffix places the suffix before it, and that one's
chain of previous smaller suffixes, at the front of their groups.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes of ``text`` (any integers); a suffix that is a prefix of another comes first."""
    n = len(text) + 1  # with an end symbol below all others
    by_symbol: dict[int, list[int]] = {}
    for i, x in enumerate(text):
        by_symbol.setdefault(x, []).append(i)
    order = [n - 1]
    group = [0] * n  # start of each suffix's group in ``order``
    size = [0] * n  # of the group that starts there
    size[0] = 1
    for x in sorted(by_symbol):
        own, at = by_symbol[x], len(order)
        size[at] = len(own)
        for i in own:
            group[i] = at
        order += own
    place = [0] * n
    for at, i in enumerate(order):
        place[i] = at
    before = [-1] * n  # previous smaller suffix

    end = n - 1
    while end > 0:
        start = group[order[end]]
        members = sorted(order[start : end + 1]) if end > start else [order[end]]
        followed: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > start:
                p = before[p]
            if p >= 0 and group[p] == start:
                p = before[p]  # the member before it is done: same chain
            before[s] = p
            if p >= 0:
                followed[p] = followed.get(p, 0) + 1
        levels: dict[int, list[int]] = {}
        for p, k in followed.items():
            levels.setdefault(k, []).append(p)
        for k in sorted(levels, reverse=True):
            moved = levels[k]
            for p in moved:
                g = group[p]
                size[g] -= 1
                last = g + size[g]
                at, other = place[p], order[last]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
            starts = [group[p] + size[group[p]] for p in moved]
            for p, at in zip(moved, starts):
                group[p] = at
                size[at] += 1
        end = start - 1

    front: dict[int, int] = {}
    done = [False] * n
    out = [0] * n
    out[0] = n - 1
    done[n - 1] = True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            at = front.get(g, g)
            out[at] = s
            front[g] = at + 1
            done[s] = True
            s = before[s]
    return out[1:]


def longest_matches(text: list[int], order: list[int]) -> list[int]:
    """For each position, the longest common prefix with any other suffix."""
    n = len(text)
    rank = [0] * n
    for at, i in enumerate(order):
        rank[i] = at
    best = [0] * n
    k = 0
    for i in range(n):
        if rank[i] == 0:
            k = 0
            continue
        j = order[rank[i] - 1]
        while i + k < n and j + k < n and text[i + k] == text[j + k]:
            k += 1
        if k > best[i]:
            best[i] = k
        if k > best[j]:
            best[j] = k
        if k:
            k -= 1
    return best
