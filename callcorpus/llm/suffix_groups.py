"""Suffix array by Lyndon groups: linear grouping construction.

Phase 1 groups suffixes by their Lyndon prefix. Groups start as one per first symbol and are
processed from the highest down. The previous-smaller pointer of a suffix in the current
group names the nearest earlier suffix of a lower group; that suffix's Lyndon prefix goes on
with the current group's, so it moves to a new group just above its own, further up the more
often it is named. When all groups are processed, their order is that of the Lyndon prefixes.

Phase 2 emits the order inside the groups in one scan: the suffix before the next smallest
one is the smallest left of its group, and so are the suffixes along its pointers, until one
that is placed already. No renaming and no recursion; both phases take linear time.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes of ``text`` in ascending order. A suffix that is a
    prefix of another comes first (an end below all symbols is implied)."""
    n = len(text)
    if n < 2:
        return list(range(n))
    group, members, lower, higher, top = _initial_groups(text)
    pointer = list(range(-1, n - 1))  # previous-smaller pointers, followed and shortened as groups close
    closed = [False] * len(members)
    now = top
    while now >= 0:
        named: dict[int, int] = {}
        own = [i for i in members[now] if group[i] == now]
        closed[now] = True
        for i in own:
            j = pointer[i]
            while j >= 0 and closed[group[j]]:
                j = pointer[j]
            pointer[i] = j
            if j >= 0:
                named[j] = named.get(j, 0) + 1
        members[now] = own
        if named:
            moves: dict[tuple[int, int], list[int]] = {}
            for j, times in named.items():
                moves.setdefault((group[j], times), []).append(j)
            for (old, _), js in sorted(moves.items(), key=lambda x: (x[0][0], -x[0][1])):  # the least often named end up lowest
                new, above = len(members), higher[old]
                members.append(js)
                closed.append(False)
                lower.append(old)
                higher.append(above)
                higher[old] = new
                if above >= 0:
                    lower[above] = new
                for j in js:
                    group[j] = new
        now = lower[now]
    return _emit(n, group, members, higher, pointer)


def _initial_groups(text: list[int]):
    """One group per first symbol, linked in ascending order."""
    by: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by.setdefault(c, []).append(i)
    order = sorted(by)
    number = {c: g for g, c in enumerate(order)}
    last = len(order) - 1
    return [number[c] for c in text], [by[c] for c in order], list(range(-1, last)), [*range(1, last + 1), -1], last


def _emit(n: int, group: list[int], members: list[list[int]], higher: list[int], pointer: list[int]) -> list[int]:
    """Phase 2."""
    nxt = [0] * len(members)
    at, g = 0, 0  # group 0 holds the smallest symbol and stays the lowest
    while g >= 0:
        nxt[g] = at
        at += len(members[g])
        g = higher[g]
    out = [-1] * n
    placed = [False] * n
    # the implied end is the smallest suffix; the one before it is n - 1
    s, k = n - 1, -1
    while True:
        while s >= 0 and not placed[s]:
            g = group[s]
            out[nxt[g]] = s
            nxt[g] += 1
            placed[s] = True
            s = pointer[s]
        k += 1
        if k == n:
            return out
        s = out[k] - 1
