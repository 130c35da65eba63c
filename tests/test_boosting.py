"""The softmax ensemble against a plain recursive version."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from touchline.operators import boosting

COLUMNS = ["x", "y", "z"]


def random_rows(dice, n):
    rows = []
    for _ in range(n):
        x, y, z = dice.choice(range(12)), round(dice.gauss(0, 1), 1), float(dice.randrange(3))
        rows.append((float(x), y, z, float((x % 3 + (y > 0.3)) % 3 if dice.random() < 0.9 else dice.randrange(3))))
    return rows


def plain_margins(rows, classes, rounds, depth, rate):
    """Recursive trees on exact cuts at every value; a node without a good split is a leaf."""
    values, labels = [r[:-1] for r in rows], [int(r[-1]) for r in rows]
    cuts = [sorted({v[f] for v in values}) for f in range(len(COLUMNS))]
    margins = [[0.0] * classes for _ in rows]

    def leaf(part, g, h):
        value = -rate * sum(g[i] for i in part) / (sum(h[i] for i in part) + 1)
        return {i: value for i in part}

    def grow(part, g, h, level):
        all_g, all_h = sum(g[i] for i in part), sum(h[i] for i in part)
        best, chosen = 1e-6, None
        for f in range(len(COLUMNS)):
            for c in cuts[f] if level < depth else ():
                left = [i for i in part if values[i][f] <= c]
                lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                if lh < 1 or all_h - lh < 1:
                    continue
                gain = lg**2 / (lh + 1) + (all_g - lg) ** 2 / (all_h - lh + 1) - all_g**2 / (all_h + 1)
                if gain > best + 1e-9:
                    best, chosen = gain, (f, c)
        if chosen is None:
            return leaf(part, g, h)
        f, c = chosen
        return {**grow([i for i in part if values[i][f] <= c], g, h, level + 1), **grow([i for i in part if values[i][f] > c], g, h, level + 1)}

    for _ in range(rounds):
        slopes = []
        for m, y in zip(margins, labels):
            odds = [math.exp(v) for v in m]
            shares = [o / sum(odds) for o in odds]
            slopes.append([(p - (k == y), 2 * p * (1 - p)) for k, p in enumerate(shares)])
        steps = [grow(list(range(len(rows))), [s[k][0] for s in slopes], [s[k][1] for s in slopes], 0) for k in range(classes)]
        for i, m in enumerate(margins):
            for k in range(classes):
                m[k] += steps[k][i]
    return np.array(margins)


@pytest.mark.parametrize("depth,rounds", [(1, 4), (3, 3)])
def test_ensemble_equals_the_plain_version(spark, monkeypatch, depth, rounds):
    monkeypatch.setattr(boosting, "SETTLE_ROUNDS", 2)  # margins are stored, and applied on the fly
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    rows = random_rows(random.Random(depth), 160)
    frame = spark.createDataFrame(rows, [*COLUMNS, "label"])
    fitted = boosting.fit_softmax(frame, COLUMNS, "label", 3, rounds, depth, 0.3)
    assert fitted.leaves.shape == (3 * rounds, 1 << depth) and fitted.depth == depth
    values = np.array([r[:-1] for r in rows])
    np.testing.assert_allclose(fitted.margins(values), plain_margins(rows, 3, rounds, depth, 0.3), atol=1e-5)


def test_order_and_blocks_do_not_matter(spark, monkeypatch):
    rows = random_rows(random.Random(8), 300)
    one = boosting.fit_softmax(spark.createDataFrame(rows, [*COLUMNS, "label"]), COLUMNS, "label", 3, 3, 3, 0.1)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 17)
    random.Random(1).shuffle(rows)
    other = boosting.fit_softmax(spark.createDataFrame(rows, [*COLUMNS, "label"]).repartition(5), COLUMNS, "label", 3, 3, 3, 0.1)
    assert one.to_json() == other.to_json()


def test_stage_is_saved_and_adds_shares(spark, tmp_path):
    rows = random_rows(random.Random(2), 200)
    frame = spark.createDataFrame(rows, [*COLUMNS, "label"])
    fitted = boosting.fit_softmax(frame, COLUMNS, "label", 3, 20, 3, 0.3)
    PipelineModel([boosting.SoftmaxTrees(inputCols=COLUMNS, trees=fitted.to_json())]).save(str(tmp_path / "model"))
    scored = PipelineModel.load(str(tmp_path / "model")).transform(frame).collect()
    for r in scored:
        expected = boosting.softmax(fitted.margins(np.array([[r.x, r.y, r.z]])))[0]
        np.testing.assert_allclose(r.shares, expected, rtol=1e-12)
    assert sum(max(range(3), key=lambda k: r.shares[k]) == r.label for r in scored) > 150


def test_one_class_and_no_rounds(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], ["x", "label"])
    assert boosting.fit_softmax(frame, ["x"], "label", 3, 0, 2, 0.1).margins(np.ones((2, 1))).tolist() == [[0, 0, 0]] * 2
    lone = boosting.fit_softmax(frame, ["x"], "label", 3, 5, 2, 0.5)
    shares = boosting.softmax(lone.margins(np.array([[1.0], [9.0]])))
    assert (shares.argmax(axis=1) == 0).all() and np.isinf(lone.cuts).all()


def test_equal_rows_are_trained_as_one(spark, monkeypatch):
    """Three million rows of sixty kinds: what a level reads does not grow with the copies, and the sums stay exact."""
    rows = random_rows(random.Random(5), 60)
    frame = spark.createDataFrame(rows, [*COLUMNS, "label"])
    cuts = [np.unique([r[f] for r in rows]) for f in range(len(COLUMNS))]
    held = boosting._blocks(frame.crossJoin(spark.range(50_000).select()), COLUMNS, "label", cuts, 3).collect()
    found = [boosting._block(b.asDict(), len(COLUMNS), 3) for b in held]
    assert sum(len(counts) for _, _, counts, _ in found) == len(set(rows))
    assert sum(int(counts.sum()) for _, _, counts, _ in found) == 3_000_000
    one = boosting.fit_softmax(frame, COLUMNS, "label", 3, 2, 2, 0.3, weight=1.0, least=1.0)
    many = boosting.fit_softmax(frame.crossJoin(spark.range(1000).select()), COLUMNS, "label", 3, 2, 2, 0.3, weight=1000.0, least=1000.0)
    np.testing.assert_allclose(one.leaves, many.leaves, rtol=1e-6)
    assert (one.features == many.features).all() and (one.cuts == many.cuts).all()


@pytest.mark.parametrize("depth", [0, 1, 3, 4, 5])
def test_marks_lead_to_the_leaf_that_walking_finds(depth):
    dice = np.random.default_rng(depth)
    bins = dice.integers(0, 9, (500, 3))
    for _ in range(20):
        features, cuts = dice.integers(0, 3, (1 << depth) - 1), dice.integers(-1, 8, (1 << depth) - 1)
        at = np.zeros(500, int)
        for _ in range(depth):
            at = np.array([2 * a + 1 + int(cuts[a] >= 0 and row[features[a]] > cuts[a]) for a, row in zip(at, bins)])
        assert (boosting.reached(list(bins.T), [9] * 3, features, cuts, depth) == at - (1 << depth) + 1).all()


def test_values_beyond_the_cuts_and_no_numbers():
    trees = boosting.Ensemble(np.array([[0, 1, 0]]), np.array([[1.0, np.inf, 3.0]]), np.array([[1.0, 2.0, 3.0, 4.0]]), 1)
    values = np.array([[1.0, 9], [1.5, 0], [3.0, 0], [3.5, 0], [np.nan, 0], [np.inf, 0], [-np.inf, np.inf]])
    assert trees.margins(values)[:, 0].tolist() == [1, 3, 3, 4, 1, 4, 1]


def test_sums_of_many_tasks_equal_those_of_few(spark, monkeypatch):
    frame = spark.createDataFrame(random_rows(random.Random(9), 300), [*COLUMNS, "label"])
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 17)
    few = boosting.fit_softmax(frame, COLUMNS, "label", 3, 2, 3, 0.1)
    monkeypatch.setattr(boosting, "FEW_TASKS", 0)
    assert boosting.fit_softmax(frame.repartition(5), COLUMNS, "label", 3, 2, 3, 0.1).to_json() == few.to_json()
