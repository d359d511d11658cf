"""Boosted trees and forests on cells: rows whose features fall into the same bins lie in the same leaves of any tree.

The features are cut into bins as Spark's trees do it, but by all rows. A cell is one bin of each feature; with 32 bins, four features
have at most about a million of them, however many rows there are. A tree only needs sums of each cell: the driver keeps these and grows
the trees, all models of a search side by side. Rows stay in blocks, sorted by cell and label, at most about BLOCK_ROWS distinct ones in each; what a round needs of them,
the rows below the cell's prediction, is found there by halving. No row is sampled or left out.

The results are models of Spark ML. More cells than CELLS are not planned: `Cells.of` gives None, and the caller has Spark train.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells that a table may have; rows of a block; values of a feature that one task reports; numbers of cells and trees that reach the driver at once.
CELLS = 1 << 21
BLOCK_ROWS = 500_000
POINTS = 1024
AT_ONCE = 1 << 22
#: Shares of rows that a sample with replacement has at most 0, 1, 2, ... times.
POISSON = np.cumsum([np.exp(-1) / factorial(k) for k in range(16)])

# tasks get the functions themselves, as executors need not know this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- bins ------------------------------------------------------------------------------

def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Columns as numbers, null as NaN."""
    return [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns]


def _fewer(values: np.ndarray, n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All values if there are few, else some that stand for equal numbers of rows."""
    if len(values) <= most:
        return values, n
    total = np.cumsum(n)
    ends = np.unique(np.searchsorted(total, np.linspace(0, total[-1], most + 1)[1:] - 0.5))
    return values[ends], np.diff(total[ends], prepend=0)


def _points(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, value, n) of a task: at most POINTS values of each feature."""
    known: list[tuple[np.ndarray, np.ndarray]] = []
    waiting: list[list[np.ndarray]] = []

    def together() -> None:
        for i, xs in enumerate(zip(*waiting, strict=True)):
            x = np.concatenate(xs)
            x = x[~np.isnan(x)]
            if len(known) == i:
                known.append((x[:0], x[:0]))
            values, at = np.unique(np.concatenate([known[i][0], x]), return_inverse=True)
            n = np.bincount(at, np.concatenate([known[i][1], np.ones(len(x))]), len(values))
            # a task has no more than some millions of rows, so this loses next to nothing
            known[i] = _fewer(values, n, 64 * POINTS)
        waiting.clear()

    rows = 0
    for batch in batches:
        waiting.append(_columns(batch))
        rows += batch.num_rows
        if rows > BLOCK_ROWS:
            together()
            rows = 0
    together()
    for i, (values, n) in enumerate(known):
        values, n = _fewer(values, n, POINTS)
        yield pa.record_batch([pa.array(np.full(len(values), i, "i4")), pa.array(values), pa.array(n)], ["feature", "value", "n"])


def _between(values: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """The cuts between the bins of a feature, by the rule of Spark's trees: between all values if there are few, else a stride of rows apart."""
    if len(values) - 1 <= most:
        cuts = (values[:-1] + values[1:]) / 2
    else:
        stride = n.sum() / (most + 1)
        total, target, cuts = np.cumsum(n).tolist(), stride, []
        for i in range(1, len(values)):
            if abs(total[i - 1] - target) < abs(total[i] - target):
                cuts.append((values[i - 1] + values[i]) / 2)
                target += stride
    return np.array([c for c in cuts if not np.isnan(c)])


def cuts_of(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """The cuts of each column of `rows`, all of them numbers; NULL and NaN lie above all cuts."""
    points = rows.mapInArrow(_points, "feature int, value double, n double").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    feature, value, n = (c.to_numpy() for c in points.toArrow().columns)
    order = np.lexsort((value, feature))
    feature, value, n = feature[order], value[order], n[order]
    return [_between(value[feature == i], n[feature == i], bins - 1) for i in range(len(rows.columns))]


# --- trees -----------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes by number: sums (n, y, y * y), gain, feature (none: -1), cut, and the number of the left child, the right one's is next."""

    sums: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    #: The leaf of each cell.
    leaf: np.ndarray

    @property
    def means(self) -> np.ndarray:
        return self.sums[:, 1] / self.sums[:, 0]


@dataclass
class Growth:
    """What limits a tree: its depth, rows of a leaf, gain of a split; features that a node looks at, drawn by `draw`."""

    depth: int = 5
    least: int = 1
    gain: float = 0.0
    looked_at: int | None = None
    draw: np.random.Generator | None = None


def grow(bins: np.ndarray, cuts: Sequence[np.ndarray], sums: np.ndarray, growth: Growth, centred: bool = False) -> Tree:
    """A tree of least squares, level by level; bins: a row for each feature, sums: n, y and y * y of each cell.

    `centred` compares splits by what labels are above their mean, because labels far from 0 have gains that are lost in rounding.
    """
    cells = np.flatnonzero(sums[0])
    rows = [sums[:, cells].sum(axis=1)]
    mean = rows[0][1] / rows[0][0] if centred else 0.0
    gains, features, at, left = [0.0], [-1], [0.0], [-1]
    place = np.zeros(len(cells), "i8")  # the open node of each cell of an open node
    leaf = np.zeros(sums.shape[1], "i8")
    opened = [0]
    for _ in range(growth.depth):
        k = len(opened)
        n, s = sums[0, cells], sums[1, cells] - mean * sums[0, cells]
        own_n, own_s = (np.bincount(place, v, k)[:, None] for v in (n, s))
        best, by, cut = np.zeros(k), np.full(k, -1), np.zeros(k, "i8")
        allowed = np.ones((len(bins), k), bool)
        if growth.looked_at is not None and growth.looked_at < len(bins):
            allowed = np.argsort(np.argsort(growth.draw.random((len(bins), k)), axis=0), axis=0) < growth.looked_at
        for i, (bin_, ends) in enumerate(zip(bins, cuts, strict=True)):
            if not len(ends):
                continue
            width = len(ends) + 1
            key = place * width + bin_[cells]
            ln, ls = (np.cumsum(np.bincount(key, v, k * width).reshape(k, width), axis=1)[:, :-1] for v in (n, s))
            rn, rs = own_n - ln, own_s - ls
            fits = (ln >= max(growth.least, 1)) & (rn >= max(growth.least, 1)) & allowed[i][:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                whole = own_s**2 / own_n
                raised = ls**2 / ln + rs**2 / rn - whole
            # what rounding leaves is no gain
            raised = np.where(fits & (raised > 1e-12 * np.abs(whole)), raised / own_n, 0.0)
            j = raised.argmax(axis=1)
            found = raised[np.arange(k), j]
            better = (found > best) & (found >= growth.gain)
            best, by, cut = np.where(better, found, best), np.where(better, i, by), np.where(better, j, cut)
        leaf[cells] = np.array(opened)[place]
        split = np.flatnonzero(by >= 0)
        if not len(split):
            break
        nth = np.full(k, -1)
        nth[split] = np.arange(len(split))
        kept = nth[place] >= 0
        cells, place = cells[kept], place[kept]
        place = 2 * nth[place] + (bins[by[place], cells] > cut[place])
        below = np.stack([np.bincount(place, sums[v, cells], 2 * len(split)) for v in range(3)], axis=1)
        before, opened = opened, list(range(len(rows), len(rows) + 2 * len(split)))
        for m, o in enumerate(split):
            node = before[o]
            gains[node], features[node], at[node], left[node] = best[o], by[o], cuts[by[o]][cut[o]], opened[2 * m]
        rows.extend(below)
        for known, empty in ((gains, 0.0), (features, -1), (at, 0.0), (left, -1)):
            known.extend([empty] * len(below))
        leaf[cells] = np.array(opened)[place]
    return Tree(np.array(rows), np.array(gains), np.array(features), np.array(at), np.array(left), leaf)


# --- rows in blocks --------------------------------------------------------------------

#: Rows of some groups (cell and part) in order: the groups, where their rows begin and end, labels in order, and how many rows have one.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _sums(block: Block) -> tuple[np.ndarray, np.ndarray]:
    groups, starts, y, n = block
    return groups, np.stack([np.add.reduceat(v, starts[:-1]) for v in (n.astype("f8"), n * y, n * y**2)])


def _below(block: Block, scores: np.ndarray) -> np.ndarray:
    """Of each group, the rows with a label below its score."""
    _, starts, y, n = block
    low, high = starts[:-1].copy(), starts[1:].copy()
    while (low < high).any():
        middle = (low + high) // 2
        less = (low < high) & (y[np.minimum(middle, len(y) - 1)] < scores)
        low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
    total = np.concatenate([[0], np.cumsum(n)])
    return total[low] - total[starts[:-1]]


def _errors(block: Block, scores: np.ndarray) -> np.ndarray:
    """Of each group, the sum of the absolute errors."""
    _, starts, y, n = block
    return np.add.reduceat(np.abs(y - np.repeat(scores, np.diff(starts))) * n, starts[:-1])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, mixed well (the last step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bagged(block: Block, tree: int) -> np.ndarray:
    """n, y and y * y of each group if each row is drawn as often as in a sample with replacement: by its cell, label, number among
    its equals and the tree, however the rows are dealt."""
    groups, starts, y, known = block
    row = _mixed(y.view("u8") ^ _mixed(np.repeat(groups, np.diff(starts)).view("u8") + np.uint64(1))) ^ _mixed(np.array([tree + 1], "u8"))
    total, n = np.cumsum(known), np.zeros(len(y))
    for low in range(0, total[-1], 2 * BLOCK_ROWS):
        copy = np.arange(low, min(low + 2 * BLOCK_ROWS, total[-1]))
        of = np.searchsorted(total, copy, "right")
        nth = (copy - total[of] + known[of]).view("u8")
        share = (_mixed(row[of] + nth * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53
        n += np.bincount(of, np.searchsorted(POISSON, share, "right"), len(y))
    return np.stack([np.add.reduceat(v, starts[:-1]) for v in (n, n * y, n * y**2)])


def _firsts(sorted_: np.ndarray) -> np.ndarray:
    """The places at which a value differs from the one before."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))


def _block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's rows (g, y) as the bytes of a block; equal rows become one with a number whenever many have come."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def together() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, y, n = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((y, g))
        g, y, n = g[order], y[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (y[1:] != y[:-1])]))
        return g[first], y[first], np.add.reduceat(n, first)

    waiting = 0
    for batch in batches:
        if batch.num_rows:
            g, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            held.append((g, y, np.ones(len(g), "i8")))
            waiting += len(g)
        if waiting > 2 * BLOCK_ROWS:
            held, waiting = [together()], 0
    if held:
        g, y, n = together()
        starts = _firsts(g)
        parts = (g[starts], np.append(starts, len(g)), y, n)
        yield pa.record_batch([pa.array([p.tobytes()], pa.binary()) for p in parts], ["groups", "starts", "y", "n"])


class Cells:
    """The rows of a table by cell. `parts`: the number of parts that rows were dealt into; to be closed."""

    def __init__(self, spark: SparkSession, cuts: list[np.ndarray], parts: int, coded: DataFrame, kept: DataFrame):
        self.spark, self.cuts, self.parts, self.coded, self.kept = spark, cuts, parts, coded, kept
        self.blocks = None

    @classmethod
    def of(cls, rows: DataFrame, label: str, cols: Sequence[str], bins: int, parts: int = 1, seed: int = 42) -> Cells | None:
        """None if there might be too many cells."""
        part: Column = F.floor(F.rand(seed) * parts) if parts > 1 else F.lit(0)
        inputs = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
        kept = rows.select(*inputs, F.col(f"`{label}`").cast("double").alias("y"), part.cast("double").alias("part")).persist(StorageLevel.MEMORY_AND_DISK)
        cuts = cuts_of(kept.drop("y", "part"), bins)
        if float(np.prod([len(c) + 1.0 for c in cuts])) > CELLS:
            kept.unpersist()
            return None

        def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *xs, y, part = _columns(batch)
                if np.isnan(y).any():
                    raise ValueError("Labels must not be null or NaN")
                g = np.zeros(len(y), "i8")
                for x, c in zip(xs, cuts, strict=True):
                    g = g * (len(c) + 1) + np.searchsorted(c, x)
                yield pa.record_batch([pa.array(g * parts + part.astype("i8")), pa.array(y + 0.0)], ["g", "y"])

        return cls(rows.sparkSession, cuts, parts, kept.mapInArrow(coded, "g bigint, y double"), kept)

    def close(self) -> None:
        self.kept.unpersist()
        if self.blocks is not None:
            self.blocks.unpersist()

    def _known(self, codes: np.ndarray) -> None:
        """The cells that have rows, and their bins."""
        if not len(codes):
            raise ValueError("There are no rows to train on")
        self.codes, self.bins = codes, np.zeros((len(self.cuts), len(codes)), "i8")
        for i in reversed(range(len(self.cuts))):
            codes, self.bins[i] = np.divmod(codes, len(self.cuts[i]) + 1)

    def labels(self) -> np.ndarray:
        """Rows of each cell with the labels 0, 1, 2, ...: one row of the result for each label."""
        g, y, n = (c.to_numpy() for c in self.coded.groupBy("g", "y").count().toArrow().columns)
        self._known(np.unique(g))
        out = np.zeros((int(y.max()) + 1, len(self.codes)))
        np.add.at(out, (y.astype("i8"), np.searchsorted(self.codes, g)), n)
        return out

    def sums(self) -> np.ndarray:
        """n, y and y * y by part and cell; deals the rows into blocks, once."""
        if self.blocks is not None:
            return self._sums
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-self.kept.count() // BLOCK_ROWS))
        dealt = self.coded.repartitionByRange(tasks, "g", "y").mapInArrow(_block, "groups binary, starts binary, y binary, n binary")
        kinds = ("i8", "i8", "f8", "i8")
        self.blocks = dealt.rdd.map(lambda r: tuple(np.frombuffer(c, k) for c, k in zip(r, kinds, strict=True))).persist(StorageLevel.MEMORY_AND_DISK)
        found = self.blocks.map(_sums).collect()
        groups = np.concatenate([g for g, _ in found]) if found else np.zeros(0, "i8")
        self._known(np.unique(groups // self.parts))
        self.kept.unpersist()
        self._sums = np.zeros((self.parts, 3, len(self.codes)))
        for groups, numbers in found:
            # a group has one place in a block
            self._sums[groups % self.parts, :, np.searchsorted(self.codes, groups // self.parts)] += numbers.T
        return self._sums

    def _asked(self, how: Callable[[Block, np.ndarray], np.ndarray], scores: np.ndarray, used: np.ndarray) -> np.ndarray:
        """What `how` says of the blocks by model and cell to the scores of models (model, cell), over the parts that a model uses (model, part)."""
        sent = self.spark.sparkContext.broadcast((self.codes, scores, used))
        parts = self.parts

        def answer(block: Block) -> tuple[np.ndarray, np.ndarray]:
            codes, scores, used = sent.value
            code, part = np.divmod(block[0], parts)
            at, first = np.searchsorted(codes, code), _firsts(code)
            return at[first], np.stack([np.add.reduceat(how(block, s[at]) * u[part], first) for s, u in zip(scores, used, strict=True)])

        out = np.zeros(scores.shape)
        try:
            for at, numbers in self.blocks.map(answer).collect():
                out[:, at] += numbers
        finally:
            sent.destroy()
        return out

    def boost_absolute(self, models: Sequence[dict]) -> list[tuple[list[Tree], np.ndarray]]:
        """For each model (its `growth`, `trees`, `rate`, and `without`, the part it leaves out) its trees and the scores of the cells.

        The first tree is fitted to the labels and counts in full, the others to the signs of the errors, as Spark does it.
        """
        sums = self.sums()
        used = np.array([[p != m["without"] for p in range(self.parts)] for m in models])
        own = np.stack([sums[u].sum(axis=0) for u in used])
        if not own[:, 0].sum(axis=1).all():
            raise ValueError("There are no rows to train on")
        grown: list[list[Tree]] = [[] for _ in models]
        scores = np.zeros((len(models), len(self.codes)))
        for nth in range(max(m["trees"] for m in models)):
            going = [i for i, m in enumerate(models) if nth < m["trees"]]
            if nth:
                below = self._asked(_below, scores[going], used[going])
            for j, i in enumerate(going):
                n = own[i, 0]
                tree = grow(self.bins, self.cuts, own[i] if not nth else np.stack([n, n - 2 * below[j], n]), models[i]["growth"], centred=not nth)
                grown[i].append(tree)
                # cells without rows that the model may see are not in its tree yet
                scores[i] += (models[i]["rate"] if nth else 1.0) * self.reached(tree)
        return list(zip(grown, scores, strict=True))

    def reached(self, tree: Tree) -> np.ndarray:
        """The value that a tree has for each cell."""
        node = np.zeros(len(self.codes), "i8")
        limits = np.array([np.searchsorted(c, tree.cut) for c in self.cuts])
        inner = np.flatnonzero(tree.feature[node] >= 0)
        while len(inner):
            at = node[inner]
            feature = tree.feature[at]
            node[inner] = tree.left[at] + (self.bins[feature, inner] > limits[feature, at])
            inner = inner[tree.feature[node[inner]] >= 0]
        return tree.means[node]

    def errors(self, fitted: Sequence[tuple[int, np.ndarray]]) -> list[float]:
        """Mean absolute error of each model (part, scores) on the rows of that part."""
        used = np.array([[p == part for p in range(self.parts)] for part, _ in fitted])
        found = self._asked(_errors, np.stack([s for _, s in fitted]), used).sum(axis=1)
        n = self._sums[:, 0].sum(axis=1)
        return [float(e / n[part]) if n[part] else float("nan") for e, (part, _) in zip(found, fitted, strict=True)]

    def boost_classes(self, growth: Growth, trees: int, rate: float) -> list[list[Tree]]:
        """Boosted trees on the log loss for each class against the rest."""
        classes = self.labels()
        n, out = classes.sum(axis=0), []
        for yes in classes:
            grown, score = [], np.zeros(len(n))
            for nth in range(trees):
                up, down = (4 / (1 + np.exp(2 * score)), -4 / (1 + np.exp(-2 * score))) if nth else (1.0, -1.0)
                grown.append(grow(self.bins, self.cuts, np.stack([n, yes * up + (n - yes) * down, yes * up**2 + (n - yes) * down**2]), growth))
                score += (rate if nth else 1.0) * grown[-1].means[grown[-1].leaf]
            out.append(grown)
        return out

    def forest(self, growth: Growth, trees: int) -> list[Tree]:
        """Trees on samples with replacement."""
        self.sums()
        out = []
        together = max(1, AT_ONCE // len(self.codes))
        for first in range(0, trees, together):
            numbers = range(first, min(first + together, trees))
            sums = np.zeros((3 * len(numbers), len(self.codes)))
            for groups, drawn in self.blocks.map(lambda b: (b[0], np.concatenate([_bagged(b, t) for t in numbers]))).collect():  # noqa: B023
                sums[:, np.searchsorted(self.codes, groups)] += drawn
            out += [grow(self.bins, self.cuts, sums[3 * t : 3 * t + 3], growth, centred=True) for t in range(len(numbers))]
        return out


# --- Spark's models --------------------------------------------------------------------

def _java_trees(spark: SparkSession, trees: Sequence[Tree], features: int):
    """An array of Spark's regression trees."""
    sc = spark.sparkContext
    ml, variance = sc._jvm.org.apache.spark.ml, sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    kind, leaf, inner, continuous = ml.regression.DecisionTreeRegressionModel, ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    out = sc._gateway.new_array(kind, len(trees))
    for k, tree in enumerate(trees):
        # the arrays of all nodes in one call
        arrays = _py2java(sc, DenseMatrix(3, len(tree.sums), tree.sums.ravel())).colIter()
        stats = [variance(arrays.next().toArray(), n) for n in tree.sums[:, 0].astype("i8").tolist()]
        n, s, q = tree.sums.T
        means, impurity, gain = tree.means.tolist(), np.maximum((q - s * s / n) / n, 0).tolist(), tree.gain.tolist()
        nodes = [None] * len(n)
        for i in reversed(range(len(n))):
            if tree.feature[i] < 0:
                nodes[i] = leaf(means[i], impurity[i], stats[i])
            else:
                split, left = continuous(int(tree.feature[i]), float(tree.cut[i])), int(tree.left[i])
                nodes[i] = inner(means[i], impurity[i], gain[i], nodes[left], nodes[left + 1], split, stats[i])
        out[k] = kind(f"dtr_{k}", nodes[0], features)
    return out


def spark_model(spark: SparkSession, estimator, trees: Sequence[Tree], features: int, rate: float | None = None):
    """The fitted model of an `estimator` of Spark ML; `rate`: what each tree but the first counts in boosted ones."""
    from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
    from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel

    # Spark checks the parameters
    estimator._transfer_params_to_java()
    sc, ml = spark.sparkContext, spark.sparkContext._jvm.org.apache.spark.ml
    grown = _java_trees(spark, trees, features)
    if rate is None:
        model = RandomForestRegressionModel(ml.regression.RandomForestRegressionModel(estimator.uid, grown, features))
    else:
        weights = _py2java(sc, Vectors.dense([1.0] + [rate] * (len(trees) - 1))).values()
        if isinstance(estimator, GBTRegressor):
            model = GBTRegressionModel(ml.regression.GBTRegressionModel(estimator.uid, grown, weights, features))
        else:
            assert isinstance(estimator, GBTClassifier)
            model = GBTClassificationModel(ml.classification.GBTClassificationModel(estimator.uid, grown, weights, features, 2))
    model = estimator._copyValues(model)
    model._transfer_params_to_java()
    return model
