"""The prefix trie against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def contract():
    return {"sharing": F.expr("conv_id - conv_id % 100"), "head": F.expr("crc32(cast(cast(conv_id as string) as binary)) % 6")}


def head_of(conv):
    return zlib.crc32(str(conv).encode()) % 6


def by_hand(rows, head=head_of):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    def place(t):
        return t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()

    own = {c: [t[1:] for t in sorted(ts, key=place)] for c, ts in turns.items()}
    rebuilt = {c: own.get(int(c / 100) * 100, [])[: head(c)] + ts[head(c) :] for c, ts in own.items()}
    nodes = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    result = {}
    for key, convs in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(key))
        result[len(key), min(convs)] = (
            min(nodes[key[:-1]]) if key else None, len(convs), sum(len(k) == len(key) + 1 for k in below),
            sum(not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in below) for k in below),
            sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return result


def found(spark, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as conv", "'x' as part", "3 as n", "4 as saved")
    got = pt.prefix_trie(frame, **settings).collect()
    result = {(r["depth"], r["conv_id"]): tuple(r)[2:] for r in got}
    assert len(result) == len(got)
    return result


def talk(dice):
    rows = []
    for conv in [*range(-5, 12), *range(90, 130), 205, 377, *range(400, 415), None]:
        kind, n = dice.randrange(4), dice.choice([1, 1, 2, 3, 4, 6, 9])
        for turn in range(n):
            role = dice.choice([("user", "assistant")[turn % 2]] * 9 + [None, ""])
            text = dice.choice([f"k{kind}t{turn}"] * 12 + [None, "", "ü😀", f"{conv}"])
            rows += [(conv, dice.choice([turn] * 12 + [None]), role, text)] * dice.choice([1] * 12 + [2])
    # Copies, a conversation that begins another one, and a long one beside its copy.
    for conv in (500, 501, 507, 590):
        rows += [(conv, t, "user", f"copy {t}") for t in range(7 + (conv == 590))]
    for conv in (600, 601):
        rows += [(conv, t, "user", "again" if t % 3 else "once") for t in range(150)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_trie_equals_plain_python(spark, seed):
    rows = talk(random.Random(seed))
    expected = by_hand(rows)
    got = found(spark, rows, **contract())
    assert got == expected


def test_trie_without_sharing(spark):
    rows = talk(random.Random(7))
    assert found(spark, rows) == by_hand(rows, lambda c: 0)


def test_borders_of_partitions_do_not_matter(spark):
    rows = talk(random.Random(3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, **contract()) == by_hand(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_colliding_fingerprints_are_seen(spark, monkeypatch):
    """With B = 1 the order of turns does not count; the check finds it and takes another B."""
    real, seeds = pt.base_of, []
    monkeypatch.setattr(pt, "base_of", lambda seed: seeds.append(seed) or (1 if seed == 0 else real(seed)))
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a")]
    assert found(spark, rows) == by_hand(rows, lambda c: 0)
    assert seeds == [0, 1]


def test_trie_of_nothing(spark):
    assert found(spark, [], **contract()) == {} and found(spark, [(None, 0, "user", "x")]) == {}
    lone = [(701, 0, "user", "x")]  # its base is absent, and it has a head of that many turns to lose
    assert found(spark, lone, **contract()) == by_hand(lone)
