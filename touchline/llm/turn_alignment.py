"""Alignment of a conversation's turns with the strings of its grammar.

The role initials of a well-formed conversation are one of the strings (s?(ua)+)?. For each length there is one such
string at most, so a repair is an edit script from the turns to the string of some length: Keep 0, Rerole (to u or a) 1,
Delete 2, Insert (u or a) 5, and 5 more for a cut-off turn that stays. Blank and repeated turns must be deleted.

The Wagner-Fischer table runs from the end: entry (i, r) is the cheapest way to align the turns from i on with the last r
symbols of the string. These symbols depend on r alone, so one table serves every feasible length, and a length's cost is
read from the first row. Ukkonen's band bounds the table: no script is cheaper than deleting all faulty turns, every
further deletion adds 2 and every further symbol 3 or more, so entries off the diagonal by more than the incumbent cost
allows are left out; the band starts narrow and takes the incumbent found in it. Scripts of equal cost are backtraced
for each length and compared as text. A trace takes the least letter at each step, which is exact since a letter decides
the next entry.

A long conversation is aligned in pieces. A piece is entered and left in one of four states: nothing said yet (N), after
the system turn (S), after a user turn (U), after an assistant turn (A).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

STATES = "NSUA"
RACE = {"N": "NSUA", "S": "SUA", "U": "UA", "A": "UA"}  # the states in which a piece entered in a state can be left
INSERT, DELETE, REROLE, CUT = 5, 2, 1, 5
_NEVER = 1 << 60


class Turn(NamedTuple):
    initial: str
    doomed: bool  # blank or said before: has to go
    cut: bool


class _Table:
    """Costs of aligning turns[i:] with the last r symbols of a string that ends in `end`, within a band."""

    def __init__(self, turns: Sequence[Turn], end: str, slack: int):
        self.turns, self.slack = turns, slack
        self.symbols = "ua" if end == "A" else "au"  # by the parity of r
        sound = 0
        self.rows = [(0, [INSERT * r for r in range(slack // 3 + 1)])]
        for initial, doomed, cut in reversed(turns):
            sound += not (doomed or cut)
            below_low, below = self.rows[-1]
            low, high = max(0, sound - slack // 2), sound + slack // 3
            costs, left = [], _NEVER
            for r in range(low, high + 1):
                k = r - below_low
                best = below[k] + DELETE if 0 <= k < len(below) else _NEVER
                if r:
                    best = min(best, left + INSERT)
                    if not doomed and 0 < k <= len(below):
                        best = min(best, below[k - 1] + CUT * cut + REROLE * (initial != self.symbols[r & 1]))
                costs.append(best)
                left = best
            self.rows.append((low, costs))
        self.rows.reverse()

    def cost(self, i: int, r: int) -> int:
        low, costs = self.rows[i]
        return costs[r - low] if 0 <= r - low < len(costs) else _NEVER

    def lengths(self, i: int, first: str) -> Iterator[int]:
        """The lengths within the band at row i whose string begins with `first`."""
        low, costs = self.rows[i]
        return (r for r in range(max(low, 1), low + len(costs)) if self.symbols[r & 1] == first)

    def trace(self, i: int, r: int) -> str:
        letters = []
        while i < len(self.turns) or r:
            cost = self.cost(i, r)
            if i < len(self.turns) and self.cost(i + 1, r) + DELETE == cost:
                letters.append("D")
                i += 1
            elif r and self.cost(i, r - 1) + INSERT == cost:
                letters.append("I")
                r -= 1
            else:
                letters.append("K" if self.turns[i].initial == self.symbols[r & 1] else "R")
                i, r = i + 1, r - 1
        return "".join(letters)


def _starts(table: _Table, turns: Sequence[Turn], enter: str, leave: str) -> Iterator[tuple[int, str, int, int]]:
    """(cost, letters so far, row, length) of every feasible length, with and without a system turn kept first."""
    if enter == leave:
        yield table.cost(0, 0), "", 0, 0
    for r in table.lengths(0, "a" if enter == "U" else "u"):
        yield table.cost(0, r), "", 0, r
    if enter == "N":
        for k, (initial, doomed, cut) in enumerate(turns):
            if initial == "s" and not doomed:
                for r in table.lengths(k + 1, "u"):
                    yield DELETE * k + CUT * cut + table.cost(k + 1, r), "D" * k + "K", k + 1, r


def _only_deletions(turns: Sequence[Turn], enter: str, leave: str) -> tuple[int, str] | None:
    """To a state before the first user turn leads no insertion, and only the system turn's keeping."""
    n = len(turns)
    if enter == leave:
        return DELETE * n, "D" * n
    kept = [(DELETE * (n - 1) + CUT * t.cut, "D" * k + "K" + "D" * (n - 1 - k)) for k, t in enumerate(turns) if t.initial == "s" and not t.doomed]
    return min(kept, default=None)


def alignments(turns: Sequence[Turn], enters: str = STATES, leaves: str = STATES) -> dict[tuple[str, str], tuple[int, str]]:
    """The least cost, and of its edit scripts the ASCII-least, between each two states where there is a way."""
    found: dict[tuple[str, str], tuple[int, str]] = {}
    floor = DELETE * sum(t.doomed or t.cut for t in turns)
    for leave in leaves:
        able = [e for e in enters if leave in RACE[e]]
        if leave in "NS":
            ways = {(e, leave): _only_deletions(turns, e, leave) for e in able}
            found.update({k: v for k, v in ways.items() if v})
            continue
        slack, waiting = 10, able
        while waiting:
            table = _Table(turns, leave, slack)
            dearest = 0
            for enter in waiting:
                least = min((c for c, *_ in _starts(table, turns, enter, leave)), default=_NEVER)
                dearest = max(dearest, least - floor)
                if least - floor <= slack:
                    tied = {(done, i, r) for c, done, i, r in _starts(table, turns, enter, leave) if c == least}
                    found[enter, leave] = least, min(done + table.trace(i, r) for done, i, r in tied)
            waiting = [e for e in waiting if (e, leave) not in found]
            slack = dearest if slack < dearest < _NEVER // 2 else 2 * slack
    return found


def whole_alignment(turns: Sequence[Turn]) -> tuple[int, str]:
    """Cost and audit of a whole conversation, which may end before its first or after an assistant turn."""
    found = alignments(turns, "N", "NA")
    return min(found.values())


def applied(audit: str, rows: Iterable[tuple[str, str]], state: str = "N") -> Iterator[tuple[str, str]]:
    """The repaired (role, text) turns from the rows, from the state in which these are entered."""
    given = iter(rows)
    for letter in audit:
        role, text = next(given) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter == "K" and state == "N" and role[:1] == "s":
            state = "S"
        else:
            if letter != "K":
                role = "assistant" if state == "U" else "user"
            state = "A" if state == "U" else "U"
        yield role, text


def joined(tables: Iterable[tuple[int, dict[tuple[str, str], tuple[int, str]]]]) -> tuple[int, list[tuple[int, str, str]]]:
    """Cost and (piece, state it is entered in, audit) of the pieces of one conversation, which come last piece first."""
    best: dict[str, tuple[int, tuple | None]] = {"N": (0, None), "A": (0, None)}

    def text(way: tuple | None) -> str:
        parts = []
        while way:
            parts.append(way[2])
            way = way[3]
        return "".join(parts)

    for piece, table in tables:
        here: dict[str, tuple[int, tuple | None]] = {}
        for (enter, leave), (cost, audit) in table.items():
            if leave not in best:
                continue
            total, way = cost + best[leave][0], (piece, enter, audit, best[leave][1])
            old = here.get(enter)
            if old is None or total < old[0] or total == old[0] and text(way) < text(old[1]):
                here[enter] = total, way
        best = here
    cost, way = best["N"]
    plan = []
    while way:
        plan.append(way[:3])
        way = way[3]
    return cost, plan
