"""Suffix arrays by linear grouping.

A suffix's group is its Lyndon prefix: the text from its start up to the next smaller suffix. The first phase starts from
groups by first symbol and visits groups in descending order. When a group is visited, the Lyndon prefixes of its suffixes
are complete; each of them is the next part of the prefix of the suffix that its previous-smaller pointer names, which
so moves up within its own group, the further the more such parts it has. The second phase walks the suffix array from the
smallest suffix on: the suffixes whose next smaller suffix has just been placed take the next free places of their
groups. No text is renamed and nothing recurs; every suffix is moved once for each pointer to it, so the work is linear.

The text is a sequence of integers whose last one is smaller than all others.
"""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(text: Sequence[int]) -> tuple[list[list[int]], list[int], list[int]]:
    """The groups in descending order, each suffix's group number, and each suffix's previous smaller suffix (or -1)."""
    n = len(text)
    members: list[list[int]] = []  # may still list suffixes that have moved on: `group` decides
    size: list[int] = []
    above: list[int] = []
    below: list[int] = []
    group = [0] * n
    starts: dict[int, list[int]] = {}
    for at, symbol in enumerate(text):
        starts.setdefault(symbol, []).append(at)
    for name, symbol in enumerate(sorted(starts)):
        members.append(starts[symbol])
        size.append(len(starts[symbol]))
        below.append(name - 1)
        above.append(name + 1)
        for at in starts[symbol]:
            group[at] = name
    visited = bytearray(n)
    previous = list(range(-1, n - 1))
    order: list[list[int]] = []
    current = len(members) - 1
    while current >= 0:
        suffixes = [at for at in members[current] if group[at] == current]
        order.append(suffixes)
        for at in suffixes:
            visited[at] = 1
        parts: dict[int, int] = {}
        for at in suffixes:  # the nearest suffix to the left in a lower group
            p = previous[at]
            while p >= 0 and visited[p]:
                p = previous[p]
            previous[at] = p
            if p >= 0:
                parts[p] = parts.get(p, 0) + 1
        if len(parts) == 1:
            p = next(iter(parts))
            moves = [((group[p], parts[p]), [p])]
        else:
            by_place: dict[tuple[int, int], list[int]] = {}
            for p, times in parts.items():
                by_place.setdefault((group[p], times), []).append(p)
            moves = sorted(by_place.items(), reverse=True)  # of one group, those with the most parts first
        for (old, _), moved in moves:
            if len(moved) == size[old]:
                continue  # all that is left of a group moves, which is where it stands already
            new = len(members)
            members.append(moved)
            size.append(len(moved))
            size[old] -= len(moved)
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up < len(below) and up != new:
                below[up] = new
            for p in moved:
                group[p] = new
        current = below[current]
    return order, group, previous


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of text in ascending order."""
    order, group, previous = lyndon_groups(text)
    free: dict[int, int] = {}
    place = 0
    for suffixes in reversed(order):
        free[group[suffixes[0]]] = place
        place += len(suffixes)
    array = [0] * len(text)
    array[0] = len(text) - 1
    for smallest in range(len(text)):
        suffix = array[smallest]
        stop = previous[suffix]
        at = suffix - 1
        while at != stop:  # the suffixes whose next smaller one is `suffix`
            name = group[at]
            array[free[name]] = at
            free[name] += 1
            at = previous[at]
    return array
