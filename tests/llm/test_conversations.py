"""Conversation repair against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import conversation_repair as cr
from touchline.llm.support import table
from touchline.llm.turn_alignment import Turn, alignments, joined, whole_alignment

STEPS = {("N", "s"): "S", ("N", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def least_script(turns):
    """Cost and least audit by the grammar's automaton, turn by turn."""
    def with_inserts(best):
        waiting = list(best)
        while waiting:
            state = waiting.pop()
            for symbol in "ua":
                to = STEPS.get((state, symbol))
                new = (best[state][0] + 5, best[state][1] + "I")
                if to and (to not in best or new < best[to]):
                    best[to] = new
                    waiting.append(to)
        return best

    best = with_inserts({"N": (0, "")})
    for initial, doomed, cut in turns:
        following = {}
        for state, (cost, audit) in best.items():
            ways = [(state, cost + 2, "D")]
            for symbol in "" if doomed else "sua":
                to = STEPS.get((state, symbol))
                if to and symbol == initial:
                    ways.append((to, cost + 5 * cut, "K"))
                elif to and symbol != "s":
                    ways.append((to, cost + 5 * cut + 1, "R"))
            for to, price, letter in ways:
                following[to] = min(following.get(to, (1 << 60, "")), (price, audit + letter))
        best = with_inserts(following)
    return min(best[s] for s in "NA" if s in best)


def random_turns(dice, n):
    turns = []
    for _ in range(n):
        doomed = dice.random() < 0.2
        turns.append(Turn(dice.choice(["s", "u", "u", "a", "a", "x", ""]), doomed, not doomed and dice.random() < 0.3))
    return turns


def test_alignment_is_the_cheapest_script():
    dice = random.Random(1)
    for _ in range(1500):
        turns = random_turns(dice, dice.randrange(40))
        assert whole_alignment(turns) == least_script(turns)


def test_pieces_join_to_the_cheapest_script():
    dice = random.Random(2)
    for _ in range(400):
        turns, size = random_turns(dice, dice.randrange(1, 40)), dice.randrange(1, 12)
        parts = [turns[k : k + size] for k in range(0, len(turns), size)]
        cost, plan = joined((k, alignments(parts[k])) for k in reversed(range(len(parts))))
        assert (cost, "".join(audit for _, _, audit in plan)) == least_script(turns)


def faulty(rows):
    """The damage of the contract."""
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        for _ in range((1, 0, 2)[(code == 0) + 2 * (code == 3)]):
            yield conv, turn, role, text


def by_hand(original):
    after, result = list(faulty(original)), {}
    for conv in {r[0] for r in original}:
        rows = [r[1:] for r in after if r[0] == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, turns, blank, double, cut = set(), [], 0, 0, 0
        for _, role, text in rows:
            solid = re.findall("[^\x20\x09-\x0D]", text)
            kinds = [not solid, (role, text) in seen, bool(solid) and solid[-1] not in ".!?"]
            seen.add((role, text))
            first = kinds.index(True) if True in kinds else None
            blank, double, cut = blank + (first == 0), double + (first == 1), cut + (first == 2)
            turns.append(Turn(role[:1], first in (0, 1), first == 2))
        numbers = {r[0] for r in rows} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = least_script(turns)
        lines, given = [], iter(rows)
        length = len(audit) - audit.count("D")
        wanted = ["user", "assistant"] * (length // 2)
        if length % 2:
            wanted = [None, *wanted]
        for letter in audit:
            _, role, text = next(given) if letter != "I" else (None, None, "")
            if letter != "D":
                due = wanted[len(lines)]
                lines.append((role if letter == "K" else due, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        result[conv] = (gaps, blank, double, cut, illegal, cost, audit, digest), lines
    return result


def talk(dice):
    rows = []
    for conv in [*range(-3, 60), None]:
        n = dice.choice([1, 2, 3, 5, 8, 30])
        for turn in range(n):
            role = dice.choice(["user", "assistant"]) if dice.random() < 0.3 else ("user", "assistant")[turn % 2]
            if turn == 0 and dice.random() < 0.4:
                role = "system"
            role = dice.choice([role] * 12 + [None, "", "tool", "unit"])
            text = dice.choice([f"Said {turn}.", f"Said {turn}.", "Yes!", "So \t\n", "Why? \v", "no end", "", None, "Ünd ", "ß."])
            number = dice.choice([turn] * 15 + [None, turn - 1, turn * 3])
            rows += [(conv, number, role, text)] * dice.choice([1] * 12 + [2])
    # A conversation of which nothing is left, and one that is long.
    rows += [(c, t, "user", "Gone.") for c in range(1000, 1100) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    rows += [(2000, t, ("user", "assistant")[t % 2], f"Word {t % 50}.") for t in range(300)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("long,piece", [(1024, 512), (4, 3)])
def test_repair_equals_plain_python(spark, long, piece):
    rows = talk(random.Random(piece))
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as gaps", "'x' as name", "2 as cost", "3 as first", "4 as _c")
    expected = by_hand(rows)
    got = cr.repair(cr.damaged(frame), long, piece).collect()
    assert len(got) == len(expected)
    assert {r[0]: tuple(r)[1:] for r in got} == {c: facts for c, (facts, _) in expected.items()}
    turns = {}
    for r in cr.repaired_turns(cr.damaged(frame), long, piece).collect():
        turns.setdefault(r["conv_id"], {})[r["place"]] = (r["role"], r["text"])
    assert {c: [t[k] for k in range(len(t))] for c, t in turns.items()} == {c: lines for c, (_, lines) in expected.items() if lines}


def test_repair_without_damage_and_of_nothing(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "assistant", "Two."), (2, 0, "assistant", "x" * 100_000 + ".")]
    got = {r["conv_id"]: (r["audit"], r["cost"]) for r in cr.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ("KK", 0), 2: ("D", 2)}
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair(cr.damaged(empty)).collect() == [] and cr.repaired_turns(empty).collect() == []


def test_damage_equals_the_contract(spark):
    rows = table(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect()
    got = cr.damaged(spark.createDataFrame(rows, SCHEMA)).where(~F.col("gone")).drop("gone").collect()
    assert sorted(map(tuple, got)) == sorted(faulty(map(tuple, rows)))
