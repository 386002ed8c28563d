"""Suffix array by linear grouping: Lyndon-prefix groups in descending order, then one pass that emits each group's order.

Phase 1 keeps the suffixes in groups of equal known prefix, ordered by that
prefix, and takes the groups from the highest down.  For each suffix of the
group taken, the previous smaller pointer leads to the nearest suffix on the left that lies
in a lower group; that suffix's known prefix grows by the group's, once for
every pointer that leads to it, so it moves to a new group just above its old
one.  When a group is taken its prefix is the suffix's longest Lyndon prefix.

Phase 2 reads the array from the left.  The suffix before each entry, and the
suffixes along its pointers, are the next of their groups.  Nothing is renamed
or sorted recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Start positions of the suffixes in ascending order (a proper prefix comes before the longer suffix)."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    members: list[list[int]] = []
    group = [0] * n
    named: dict[int, int] = {}
    for symbol in sorted(set(symbols)):
        named[symbol] = len(members)
        members.append([])
    for i, symbol in enumerate(symbols):
        g = named[symbol]
        group[i] = g
        members[g].append(i)
    top = len(members) - 1
    below, above = list(range(-1, top)), list(range(1, top + 2))      # neighbours of a group; -1 and top + 1 stand for none
    above[top] = -1
    pointer = [-1] * n
    taken = bytearray(n)
    descending: list[int] = []

    g = top
    while g >= 0:
        suffixes = [s for s in members[g] if group[s] == g]
        if suffixes:
            if len(suffixes) > 1:
                suffixes.sort()
            members[g] = suffixes
            descending.append(g)
            for s in suffixes:
                taken[s] = 1
            grown: dict[int, int] = {}
            for s in suffixes:
                p = s - 1
                while p >= 0 and taken[p]:
                    p = pointer[p]
                pointer[s] = p
                if p >= 0:
                    grown[p] = grown.get(p, 0) + 1
            most = max(grown.values(), default=0)
            # the more often a prefix grows, the higher its new group
            for times in sorted(set(grown.values()), reverse=True) if most > 1 else (1,) if most else ():
                new: dict[int, int] = {}
                for p in grown if most == 1 else [p for p, k in grown.items() if k == times]:
                    old = group[p]
                    to = new.get(old)
                    if to is None:
                        to = new[old] = len(members)
                        members.append([])
                        up = above[old]
                        below.append(old)
                        above.append(up)
                        above[old] = to
                        below[up] = to              # the group taken, at the highest, lies above
                    group[p] = to
                    members[to].append(p)
        g = below[g]

    place = [0] * len(members)
    at = 0
    for g in reversed(descending):
        place[g] = at
        at += len(members[g])
    out = [-1] * n
    s, i = n - 1, -1
    while True:
        while s >= 0 and taken[s]:                  # now: not yet emitted
            taken[s] = 0
            g = group[s]
            out[place[g]] = s
            place[g] += 1
            s = pointer[s]
        i += 1
        if i == n:
            return out
        s = out[i] - 1
