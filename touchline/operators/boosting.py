"""Boosted trees for several classes in one ensemble, trained by histograms.

Each round grows one tree per class on the gradients of the softmax loss, all of them level by level together: one pass
over the data sums gradient and curvature by class, node, feature and bin, Spark adds these histograms up, and the driver,
which gets classes x nodes x features x bins numbers whatever the number of rows, takes the best split of each node.

The rows are binned once, rows equal in all bins and the label become one with their number, and these are kept as blocks
of arrays with their margins. Trees that are newer than the stored margins are applied on the fly; the margins are brought
up to date, and the lineage cut, every few rounds. Sums are of whole numbers, so that neither the blocks nor their order
matters: equal rows give an equal model.

Trees are applied by marks: each column's bin says which leaves its cuts leave open, one bit a leaf, and the first leaf that
all columns leave open is the one reached.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.keyed import settled

BINS = 256
BLOCK_ROWS = 50_000
SETTLE_ROUNDS = 10
FEW_TASKS = 16  # so many tasks' histograms are added up on the driver, more by Spark
_SCALE = float(1 << 32)  # gradients lie in [-1, 1]: sums of 2^31 rows fit 64 bits


@dataclass
class Ensemble:
    """Complete binary trees, round by round and class by class, in heap order: a row goes left where its value is at most the cut."""
    features: np.ndarray  # [trees, 2^depth - 1], int
    cuts: np.ndarray  # [trees, 2^depth - 1], infinite where a node is not split
    leaves: np.ndarray  # [trees, 2^depth]
    classes: int

    @property
    def depth(self) -> int:
        return self.leaves.shape[1].bit_length() - 1

    def margins(self, values: np.ndarray) -> np.ndarray:
        """[rows, classes]: the sums of each class' leaves."""
        total = np.zeros((len(values), self.classes))
        if len(self.leaves) == 0:
            return total
        # Between two neighbouring cuts of a column no tree tells values apart; a value that is no number is below all cuts.
        finite = np.isfinite(self.cuts)
        known = [np.unique(self.cuts[(self.features == f) & finite]) for f in range(values.shape[1])]
        places = [np.where(np.isnan(values[:, f]), 0, np.searchsorted(c, values[:, f])) for f, c in enumerate(known)]
        sizes = [len(c) + 1 for c in known]
        for t in range(len(self.leaves)):
            cuts = np.full(self.cuts.shape[1], -1, np.int64)
            for node in np.flatnonzero(finite[t]):
                cuts[node] = np.searchsorted(known[self.features[t][node]], self.cuts[t][node])
            total[:, t % self.classes] += self.leaves[t][reached(places, sizes, self.features[t], cuts, self.depth)]
        return total

    def to_json(self) -> str:
        cuts = [[None if np.isinf(c) else c for c in tree] for tree in self.cuts.tolist()]
        return json.dumps({"features": self.features.tolist(), "cuts": cuts, "leaves": self.leaves.tolist(), "classes": self.classes})

    @classmethod
    def from_json(cls, text: str) -> Ensemble:
        found = json.loads(text)
        cuts = np.array([[np.inf if c is None else c for c in tree] for tree in found["cuts"]])
        return cls(np.array(found["features"], np.int64), cuts, np.array(found["leaves"]), found["classes"])


def reached(places: Sequence[np.ndarray], sizes: Sequence[int], features: np.ndarray, cuts: np.ndarray, depth: int) -> np.ndarray:
    """The place within level `depth` that each row reaches in a tree: places[f] are its bins of column f, below sizes[f].

    Right of a node go rows whose bin is greater than its cut; a cut of -1 sends all to the left.
    """
    if depth > _MARKED_DEPTH:
        at, rows, bins = np.zeros(len(places[0]), np.int64), np.arange(len(places[0])), np.stack(places, axis=1)
        for _ in range(depth):
            cut = cuts[at]
            at = 2 * at + 1 + ((bins[rows, features[at]] > cut) & (cut >= 0))
        return at - (1 << depth) + 1
    every = np.uint16((1 << (1 << depth)) - 1)
    opened: dict[int, np.ndarray] = {}
    closed = np.uint16(0)  # leaves right of nodes that are not split
    for node in range((1 << depth) - 1):
        level = (node + 1).bit_length() - 1
        half = 1 << (depth - level - 1)
        first = (node + 1 - (1 << level)) * 2 * half
        left = np.uint16(((1 << half) - 1) << first)
        if cuts[node] < 0:
            closed |= np.uint16(int(left) << half)
            continue
        marks = opened.setdefault(int(features[node]), np.full(sizes[features[node]], every, np.uint16))
        marks[cuts[node] + 1:] &= ~left
    if not opened:
        return np.zeros(len(places[0]), np.int64)
    left_open = [marks[places[f]] for f, marks in opened.items()]
    for other in left_open[1:]:
        left_open[0] &= other
    return _FIRST_BIT[left_open[0] & ~closed]


_MARKED_DEPTH = 4  # sixteen leaves in sixteen bits
_FIRST_BIT = np.zeros(1 << 16, np.int64)
for _bit in reversed(range(16)):
    _FIRST_BIT[1 << _bit :: 1 << (_bit + 1)] = _bit


def softmax(margins: np.ndarray) -> np.ndarray:
    odds = np.exp(margins - margins.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of each row and class as whole numbers."""
    shares = softmax(margins)
    slopes = shares - (np.arange(shares.shape[1]) == labels[:, None])
    return np.rint(slopes * _SCALE).astype(np.int64), np.rint(np.maximum(2 * shares * (1 - shares), 1e-9) * _SCALE).astype(np.int64)


def histograms(
    bins: np.ndarray, counts: np.ndarray, nodes: np.ndarray, slopes: np.ndarray, curves: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """[classes, width, features, BINS] sums, of rows whose node of this level is nodes[row, class], each so many times."""
    shape = (slopes.shape[1], width, bins.shape[1], BINS)
    parts = [[_thirds(sums[:, k] * counts) for k in range(shape[0])] for sums in (slopes, curves)]
    found = np.zeros((2, *shape), np.int64)
    for k in range(shape[0]):
        for f in range(shape[2]):
            cell = nodes[:, k] * BINS + bins[:, f]
            for which in range(2):
                high, middle, low = (np.bincount(cell, part, width * BINS).astype(np.int64) for part in parts[which][k])
                found[which, k, :, f] = ((high << 42) + (middle << 21) + low).reshape(width, BINS)
    return found[0], found[1]


def _thirds(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """bincount adds in double precision: thirds of 64 bits stay exact up to 2^31 rows."""
    return sums >> 42, (sums >> 21) & 0x1FFFFF, sums & 0x1FFFFF


def best_splits(slopes: np.ndarray, curves: np.ndarray, weight: float, least: float) -> tuple[np.ndarray, ...]:
    """Per class and node: feature, bin (-1: no split), and the sums that go left and right; ties to the first feature and bin."""
    left_g, left_h = np.cumsum(slopes, axis=3), np.cumsum(curves, axis=3)
    all_g, all_h = left_g[:, :, :1, -1:], left_h[:, :, :1, -1:]
    lg, lh, g, h = (x / _SCALE for x in (left_g, left_h, all_g, all_h))
    rg, rh = g - lg, h - lh
    gain = lg**2 / (lh + weight) + rg**2 / (rh + weight) - g**2 / (h + weight)
    gain = np.where((lh >= least) & (rh >= least), gain, -np.inf)
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(axis=2)
    splits = np.take_along_axis(flat, best[..., None], 2)[..., 0] > 1e-6
    feature, cut = np.divmod(best, BINS)
    k, n = np.indices(best.shape)
    both = np.stack([left_g[k, n, feature, cut], left_h[k, n, feature, cut]], axis=-1)
    whole = np.stack([all_g[..., 0, 0], all_h[..., 0, 0]], axis=-1)
    left = np.where(splits[..., None], both, whole)
    return np.where(splits, feature, 0), np.where(splits, cut, -1), left, whole - left


class _Grower:
    """Trees of the rounds that the stored margins lack, in terms of bins, and the round in work."""

    def __init__(self, classes: int, depth: int):
        self.classes, self.depth = classes, depth
        self.done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per round: features, bins, leaves
        self.features = np.zeros((classes, 0), np.int64)
        self.bins = np.zeros((classes, 0), np.int64)

    def nodes(self, bins: Sequence[np.ndarray], k: int, features: np.ndarray, cuts: np.ndarray, depth: int) -> np.ndarray:
        """The place within the level that each row has reached in class k's tree."""
        return reached(bins, [BINS] * len(bins), features[k], cuts[k], depth)

    def margins(self, bins: Sequence[np.ndarray], stored: np.ndarray) -> np.ndarray:
        total = stored.copy()
        for features, cuts, leaves in self.done:
            for k in range(self.classes):
                total[:, k] += leaves[k][self.nodes(bins, k, features, cuts, self.depth)]
        return total


def _block(row: dict, features: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all features, labels, how many rows each stands for, and margins."""
    keys = np.frombuffer(row["keys"], np.uint8).reshape(-1, features + 1).astype(np.int64)
    return keys[:, :-1], keys[:, -1], np.frombuffer(row["counts"], np.int64), np.frombuffer(row["margins"], np.float64).reshape(-1, classes)


_BLOCKS = "keys binary, counts binary, margins binary"


def _blocks(rows: DataFrame, columns: Sequence[str], label: str, cuts: list[np.ndarray], classes: int) -> DataFrame:
    """The distinct rows of bins and label, BLOCK_ROWS to a block. Equal rows are counted within a task before they are sent."""
    width = len(columns) + 1

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _gathered(batches, lambda batch: np.stack([c.to_numpy() for c in batch.columns], axis=1)):
            keys = [np.searchsorted(c, values[:, f]) for f, c in enumerate(cuts)]
            keys = np.ascontiguousarray(np.stack([*keys, values[:, -1]], axis=1).astype(np.uint8))
            distinct, counts = np.unique(keys.view(f"V{width}")[:, 0], return_counts=True)
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(distinct), [None, pa.py_buffer(distinct.tobytes())])
            yield pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(counts, pa.int64())], ["key", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(batch: pa.RecordBatch) -> np.ndarray:
            found = np.zeros(batch.num_rows, [("key", f"V{width}"), ("n", np.int64)])
            keys = batch.column("key").cast(pa.binary(width))
            found["key"] = np.frombuffer(keys.buffers()[1], f"V{width}", batch.num_rows, keys.offset * width)
            found["n"] = batch.column("n").to_numpy()
            return found

        for block in _gathered(batches, pairs):
            parts = block["key"].tobytes(), block["n"].tobytes(), np.zeros((len(block), classes)).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["keys", "counts", "margins"])

    numbers = rows.select(*[F.col(c).cast("double") for c in [*columns, label]])
    distinct = numbers.mapInArrow(binned, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(pack, _BLOCKS)


def _gathered(batches: Iterator[pa.RecordBatch], read: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[np.ndarray]:
    """Arrays of BLOCK_ROWS rows or a little more, the last one of what is left."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(read(batch))
        if sum(map(len, held)) >= BLOCK_ROWS:
            yield np.concatenate(held)
            held.clear()
    if sum(map(len, held)):
        yield np.concatenate(held)


def _level(blocks: DataFrame, grower: _Grower, level: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The histograms of one level of this round's trees, over all rows."""
    classes, width = grower.classes, 1 << level

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, classes, width, features, BINS), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                bins, labels, counts, stored = _block(batch.slice(k, 1).to_pylist()[0], features, classes)
                columns = list(bins.T)
                slopes, curves = gradients(grower.margins(columns, stored), labels)
                nodes = np.stack([grower.nodes(columns, c, grower.features, grower.bins, level) for c in range(classes)], axis=1)
                total += np.stack(histograms(bins, counts, nodes, slopes, curves, width))
        flat = total.reshape(2, -1)
        cells = np.flatnonzero(flat.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cells, flat[0][cells], flat[1][cells])], ["cell", "g", "h"])

    partial = blocks.mapInArrow(sums, "cell bigint, g bigint, h bigint")
    if blocks.rdd.getNumPartitions() > FEW_TASKS:
        partial = partial.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    found = partial.toArrow()
    whole = np.zeros((2, classes * width * features * BINS), np.int64)
    for which, name in enumerate(("g", "h")):
        np.add.at(whole[which], found["cell"].to_numpy(), found[name].to_numpy())
    shaped = whole.reshape(2, classes, width, features, BINS)
    return shaped[0], shaped[1]


def fit_softmax(
    rows: DataFrame, columns: Sequence[str], label: str, classes: int, rounds: int, depth: int, rate: float, weight: float = 1.0, least: float = 1.0
) -> Ensemble:
    """Train on complete numeric columns and labels 0 ... classes - 1.

    `weight` is the leaves' quadratic penalty, `least` the curvature that each side of a split keeps. Cuts are quantiles
    within a thousandth, all values of a column with few of them.
    """
    asked = [q / (BINS - 1) for q in range(BINS)]
    cuts = [np.unique(c)[: BINS - 1] for c in rows.select(*[F.col(c).cast("double") for c in columns]).approxQuantile(list(columns), asked, 0.001)]
    blocks = settled(_blocks(rows, columns, label, cuts, classes))
    grower, kept = _Grower(classes, depth), []
    for turn in range(rounds):
        grower.features, grower.bins = np.zeros((2, classes, 0), np.int64)
        for level in range(depth):
            feature, cut, left, right = best_splits(*_level(blocks, grower, level, len(columns)), weight, least)
            grower.features, grower.bins = np.hstack([grower.features, feature]), np.hstack([grower.bins, cut])
        sums = np.stack([left, right], axis=2).reshape(classes, -1, 2) / _SCALE
        leaves = -rate * sums[..., 0] / (sums[..., 1] + weight)
        grower.done.append((grower.features, grower.bins, leaves))
        kept.append(grower.done[-1])
        if len(grower.done) == SETTLE_ROUNDS and turn + 1 < rounds:
            blocks = _settled_margins(blocks, grower, len(columns))
            grower = _Grower(classes, depth)
    features = np.concatenate([f for f, _, _ in kept]) if kept else np.zeros((0, (1 << depth) - 1), np.int64)
    bins = np.concatenate([b for _, b, _ in kept]) if kept else features
    values = np.full(bins.shape, np.inf)
    for f, c in enumerate(cuts):
        here = (features == f) & (bins >= 0) & (bins < len(c))
        values[here] = c[bins[here]]
    leaves = np.concatenate([x for _, _, x in kept]) if kept else np.zeros((0, 1 << depth))
    return Ensemble(features, values, leaves, classes)


def _settled_margins(blocks: DataFrame, grower: _Grower, features: int) -> DataFrame:
    classes = grower.classes

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                bins, _, _, stored = _block(one.to_pylist()[0], features, classes)
                margins = pa.array([grower.margins(list(bins.T), stored).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([one.column("keys"), one.column("counts"), margins], ["keys", "counts", "margins"])

    return settled(blocks.mapInArrow(update, _BLOCKS))


class SoftmaxTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `shares`, the probability of each class, computed from the columns `inputCols` batch by batch."""

    inputCols = Param(Params._dummy(), "inputCols", "feature columns", typeConverter=TypeConverters.toListString)
    trees = Param(Params._dummy(), "trees", "the ensemble as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, trees: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def shares(self) -> Column:
        ensemble = Ensemble.from_json(self.getOrDefault(self.trees))

        @F.pandas_udf("array<double>")
        def evaluate(*columns: pd.Series) -> pd.Series:
            values = np.stack([c.to_numpy(np.float64) for c in columns], axis=1)
            return pd.Series(list(softmax(ensemble.margins(values))))

        return evaluate(*self.getOrDefault(self.inputCols))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("shares", self.shares())
