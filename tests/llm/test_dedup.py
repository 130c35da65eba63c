"""Parity-sketch join and suffix dedup against plain Python."""

import random

import numpy as np
import pytest
from brute import near_components as brute_components
from brute import repeats as brute_repeats

from touchline.llm import parity_join, suffix_dedup
from touchline.llm.lyndon_suffixes import suffix_array
from touchline.llm.support import components


def near_copies(dice, n_base=6, copies=14, words=60):
    pool = [f"w{k}" for k in range(400)]
    texts = [None, "", "  ", "one", "One", "two words", "same text of some words", "Same  text\tof SOME words"]
    for _ in range(n_base):
        base = [dice.choice(pool) for _ in range(dice.randint(words // 2, words * 3))]
        for _ in range(copies):
            copy = list(base)
            for _ in range(dice.choice([0, 0, 1, 1, 2, 3, 5])):
                at = dice.randrange(len(copy))
                copy[at : at + dice.choice([0, 1])] = [dice.choice(pool)]
            texts.append(" ".join(copy))
    dice.shuffle(texts)
    return [(3 * k + 1, t) for k, t in enumerate(texts)]


def test_bands_and_bound():
    for percent in (80, 90):
        bands = parity_join.Bands(percent)
        for small in range(1, 400):
            for large in range(small, small * 100 // percent + 1):
                assert bands.band(large) - bands.band(small) in (0, 1)
                g = bands.band(large)
                most = bands.differ(small + large)  # with k = 1 each part may hold one more
                assert most < (2 if bands.part_words == 3 else 1) * bands.parts(g) or most == 0
        assert bands.differ(2 * 190) == 2 * 190 * (100 - percent) // (100 + percent)


def test_distance_is_a_lower_bound():
    dice = np.random.default_rng(2)
    for _ in range(50):
        x = np.unique(dice.integers(0, 2**63, 300).astype(np.uint64))
        y = np.unique(np.concatenate([x[: dice.integers(0, 300)], dice.integers(0, 2**63, dice.integers(1, 40)).astype(np.uint64)]))
        a, b = parity_join.sketch(x, 20), parity_join.sketch(y, 20)
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
    long = parity_join.sketch(x, 1300) ^ parity_join.sketch(y, 1300)
    for largest, words in ((10**6, 512), (3000, 188), (10, 1)):
        short = parity_join.folded(long, largest)
        assert len(short) == words and np.bitwise_count(short).sum() <= np.bitwise_count(long).sum()


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key(percent):
    dice, bands = np.random.default_rng(percent), parity_join.Bands(percent)
    linked = 0
    for n in [*range(3, 60), *range(60, 400, 20)]:
        for _ in range(12):
            x = np.unique(dice.integers(0, 2**63, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[dice.integers(0, max(1, n // 8)) :], dice.integers(0, 2**63, dice.integers(0, n // 8 + 1)).astype(np.uint64)]))
            shared = len(np.intersect1d(x, y))
            if 100 * shared < percent * (len(x) + len(y) - shared):
                continue
            g = max(bands.band(len(x)), bands.band(len(y)))
            assert abs(bands.band(len(x)) - bands.band(len(y))) <= 1
            if not bands.parts(g):
                assert shared == len(x) == len(y)
                continue
            keys = [parity_join.sketch_keys(parity_join.sketch(s, bands.words(g)), bands.part_words, g) for s in (x, y)]
            assert (keys[0] == keys[1]).any()
            linked += shared < len(x)
    assert linked > 100


def test_further_turns_meet_every_near_pair_once():
    dice = np.random.default_rng(4)
    base = np.unique(dice.integers(0, 2**63, 40).astype(np.uint64))
    sets = [np.unique(np.concatenate([base, dice.integers(0, 2**63, 3).astype(np.uint64)])) for _ in range(40)]
    bucket = {
        "rep": np.arange(40), "n": np.array(list(map(len, sets))), "upper": np.arange(40) % 5 > 0, "component": np.arange(40) // 2,
        "words": np.stack([parity_join.sketch(x, 10) for x in sets]),
    }
    met, turn, again = [], 0, True
    while again:
        found = parity_join._further(bucket, 80, turn)
        again = parity_join.OPEN in found
        some = [p for p in found if p != parity_join.OPEN]
        assert len(some) <= 40 * 7 << 3 * turn
        met, turn = met + some, turn + 1
    expected = [
        (a, b) for a in range(40) for b in range(a + 1, 40)
        if a // 2 != b // 2 and (a % 5 or b % 5) and parity_join._near(bucket["words"], bucket["n"], a, np.array([b]), 80)[0]
    ]
    assert sorted(met) == expected and turn > 1
    rows = len(parity_join._forest(bucket, 80))
    assert rows < 40


def test_a_bucket_of_ten_thousand_leaves_a_forest():
    """What once was the bucket of words without a bit: unrelated sketches of one hundred shingles."""
    dice = np.random.default_rng(1)
    n = 10_000
    bucket = {
        "rep": np.arange(n), "n": np.full(n, 100), "upper": np.ones(n, bool), "component": np.arange(n),
        "words": dice.integers(0, 2**63, (n, 4)).astype(np.uint64),
    }
    assert len(parity_join._forest({k: v[:2048] for k, v in bucket.items()}, 80)) < 2048
    bands = parity_join.Bands(80)
    g = bands.band(100)
    empty = [parity_join.sketch_keys(np.zeros(bands.words(g), np.uint64), 3, g)]
    shared = sum(
        (parity_join.sketch_keys(parity_join.sketch(x, bands.words(g)), 3, g) == empty[0]).sum()
        for x in dice.integers(0, 2**63, (n, 100)).astype(np.uint64)
    )
    assert shared < 0.01 * n * len(empty[0])  # one key in a hundred at most has no bit


@pytest.mark.parametrize("block", [2048, 5])
def test_components_equal_all_pairs(documents, block):
    rows = near_copies(random.Random(block))
    got = parity_join.near_components(documents(rows), block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows)


def test_a_failed_edge_loses_no_link(documents):
    rows = near_copies(random.Random(9), 3, 20)
    # Sketches of one word are all alike: every pair of a bucket may be linked, and many edges fail.
    got = parity_join.near_components(documents(rows), bits=0).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows)


def test_join_edges(documents):
    text = " ".join(f"v{k}" for k in range(50))
    rows = [(5, text), (5, text), (9, text), (None, text), (2, "other words entirely"), (9, "another text of nine")]
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in parity_join.near_components(documents(rows)).collect())
    assert got == [("2", 1, 2), ("5", 48, 5), ("5", 48, 5), ("9", 2, 5), ("9", 48, 5), ("None", 48, None)]
    assert parity_join.near_components(documents([])).collect() == []
    kept = sorted(str(r["doc_id"]) for r in parity_join.one_of_each(documents(rows)).collect())
    assert kept == ["2", "5", "None"]


def test_components(spark):
    dice = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(dice.randrange(60), dice.randrange(60)) for _ in range(40)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    up = {}
    root = lambda x: x if up.setdefault(x, x) == x else root(up[x])
    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


def test_suffix_array():
    dice = random.Random(0)
    for _ in range(1500):
        symbols = dice.choice([1, 2, 3, 26])
        text = [dice.randint(1, symbols) for _ in range(dice.randint(0, 40))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda k: text[k:])


def repeated_texts(dice):
    pool = [f"wört{k}" if k % 7 == 0 else f"w{k}" for k in range(300)]
    line = lambda n: " ".join(dice.choice(pool) for _ in range(n))
    passage, foot = line(40), line(20)
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 350, "ab" * 200, passage, "é😀" * 60, "é😀" * 60]
    for k in range(60):
        text = line(dice.randint(5, 120))
        if k % 3 == 0:
            at = dice.randrange(len(text))
            text = text[:at] + passage[dice.randrange(30) :] + text[at:]
        if k % 4 == 0:
            text += "\n" + foot
        texts.append(text)
        if k % 5 == 0:
            at = dice.randrange(len(text))
            texts += [text, text[:at] + "x" + text[at + 1 :]]
    dice.shuffle(texts)
    return [(2 * k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("per_anchor", [2000, 2])
def test_repeats_equal_brute_force(documents, per_anchor):
    rows = repeated_texts(random.Random(per_anchor))
    got = suffix_dedup.suffix_dedup(documents(rows), per_anchor=per_anchor).collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in got} == brute_repeats(rows)
    for r in got:
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_chunks_do_not_change_repeats(documents, monkeypatch):
    rows = repeated_texts(random.Random(3))
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 150)
    data = next(t for _, t in rows if t and len(t) > 600).encode()
    whole = suffix_dedup.contexts(data, 100, 24)
    assert (whole[3] >> 12).sum() == len(data) - 99 and whole[2][0] == 0


def test_repeats_edges(documents):
    text = " ".join(f"v{k}" for k in range(60))
    rows = [(None, text), (4, text), (4, text), (4, "other"), (1, text + text)]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.suffix_dedup(documents(rows)).collect())
    n = len(text)
    assert got == [("1", 2 * n, 2 * n), ("4", 5, 0), ("4", n, n), ("4", n, n), ("None", n, 0)]
    assert suffix_dedup.suffix_dedup(documents([])).collect() == []


@pytest.mark.parametrize("most", [3, 2000])
def test_rows_of_an_anchor_are_not_held(most):
    dice = random.Random(most)
    rows = []
    for anchor, n in ((1, 1), (2, 2), (3, 900), (4, 3), (5, 4), (6, 1)):
        for content in range(n):
            rows += [(anchor, content, doc, dice.randrange(50), 1, False) for doc in range(dice.choice([1, 1, 2, 3]))]
    rows += [(anchor, 0, 9, 9, 1, True) for anchor in (2, 3, 7)]
    rows.sort(key=lambda r: (r[0], r[5], *r[1:4]))
    first, different = {}, {}
    for r in rows:
        if not r[5] and first.setdefault(r[:2], r) is r:
            different[r[0]] = different.get(r[0], 0) + 1
    expected = []
    for a, c, doc, start, strings, gone in rows:
        gone = gone or first[a, c] != (a, c, doc, start, strings, gone)
        if gone or different[a] > 1:
            expected.append((a, doc, start, strings, gone, 0 if gone else min(different[a], most + 1)))
    for size in (1, 7, 100, len(rows)):
        given, got = 0, []

        def batches():
            nonlocal given
            for k in range(0, len(rows), size):
                part = rows[k : k + size]
                # What has neither left nor vanished is at most `most` rows of the last anchor, besides lone contexts.
                assert given - len(got) <= most + 5
                given += len(part)
                yield [np.array(c, bool if n == 5 else np.int64) for n, c in enumerate(zip(*part))]

        for columns in suffix_dedup.settled_rows(batches(), most):
            got += zip(*[c.tolist() for c in columns])
        assert sorted(got) == sorted(expected)
