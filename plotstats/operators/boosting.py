"""Boosted regression trees with Huber loss, best-leaf-first growth and tree dropout, as aggregates over a binned table.

The features are cut into bins once. A tree then grows by tables of gradient sums: one aggregate gives, for all leaves
that are not yet looked at, the sums of gradients, weights and rows per feature and bin, at most leaves x features x bins
numbers. The driver sees these tables only; rows are never sampled, collected or moved, as sums are combined before the exchange. Leaves are
split in order of their gain, whatever their depth, until a tree has its number of leaves.

With dropout, each tree is fitted to what a random part of the earlier trees leaves unexplained, and then
shares its weight with them, so late trees do not only polish single rows.
"""

from __future__ import annotations

import heapq
import json
import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotstats.session import remove, scratch_path

# Trees that are added up in one expression when a model is applied.
TOGETHER = 8


@dataclass
class Split:
    """A node: rows with `feature` at most `value` (or without a value) go left. A leaf has no feature but a `weight`."""

    feature: int | None = None
    value: float = 0.0
    gain: float = 0.0
    weight: float = 0.0
    left: Split | None = None
    right: Split | None = None

    def column(self, features: Sequence[Column]) -> Column:
        if self.feature is None:
            return F.lit(float(self.weight))
        x = features[self.feature]
        return F.when(x.isNull() | (x <= F.lit(self.value)), self.left.column(features)).otherwise(self.right.column(features))

    def leaves(self) -> list[Split]:
        return [self] if self.feature is None else [*self.left.leaves(), *self.right.leaves()]

    def plain(self) -> dict:
        if self.feature is None:
            return {"weight": self.weight}
        return {"feature": self.feature, "value": self.value, "gain": self.gain, "left": self.left.plain(), "right": self.right.plain()}

    @staticmethod
    def of(plain: dict) -> Split:
        if "weight" in plain:
            return Split(weight=plain["weight"])
        return Split(plain["feature"], plain["value"], plain["gain"], 0.0, Split.of(plain["left"]), Split.of(plain["right"]))


@dataclass
class Model:
    features: list[str]
    base: float
    trees: list[Split] = field(default_factory=list)
    scales: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Adds the prediction. Trees are added up in steps, which keeps each expression short."""
        inputs = [F.col(f"`{c}`").cast("double") for c in self.features]
        out = df.withColumn(name, F.lit(self.base))
        for at in range(0, len(self.trees), TOGETHER):
            part = zip(self.trees[at : at + TOGETHER], self.scales[at : at + TOGETHER], strict=True)
            out = out.withColumn(name, F.col(name) + reduce(lambda a, b: a + b, [t.column(inputs) * float(s) for t, s in part]))
        return out

    def importances(self, spark: SparkSession) -> DataFrame:
        """Share of each feature in the gain of all splits, largest first."""
        total = dict.fromkeys(range(len(self.features)), 0.0)

        def add(node: Split) -> None:
            if node.feature is not None:
                total[node.feature] += node.gain
                add(node.left)
                add(node.right)

        for tree in self.trees:
            add(tree)
        whole = sum(total.values()) or 1.0
        rows = [(self.features[i], v / whole) for i, v in total.items()]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"features": self.features, "base": self.base, "trees": [t.plain() for t in self.trees], "scales": self.scales})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        kept = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return Model(kept["features"], kept["base"], [Split.of(t) for t in kept["trees"]], kept["scales"])


def bin_ends(df: DataFrame, features: Sequence[str], bins: int = 255) -> list[list[float]]:
    """Upper ends of each feature's bins but the last: all values of a feature that has few, else approximate quantiles."""
    values = [F.col(f"`{c}`").cast("double") for c in features]
    entries = F.array(*[F.struct(F.lit(i).alias("feature"), v.alias("x")) for i, v in enumerate(values)])
    distinct = df.select(F.inline(entries)).where("x is not null and not isnan(x)").distinct()
    held = {r["feature"]: r["count"] for r in distinct.groupBy("feature").count().collect()}
    few = [i for i, n in held.items() if n <= bins]
    found = {i: [] for i in range(len(features))}
    for r in distinct.where(F.col("feature").isin(few)).collect() if few else []:
        found[r["feature"]].append(r["x"])
    many = [i for i in held if i not in few]
    if many:
        points = [i / bins for i in range(1, bins)]
        row = df.agg(*[F.percentile_approx(F.when(~F.isnan(values[i]), values[i]), points, 10 * bins).alias(str(i)) for i in many]).first()
        for i in many:
            found[i] = list(row[str(i)])
    ends = [sorted(set(found[i])) for i in range(len(features))]
    # the last value of a feature with few ends no bin: nothing lies above it
    return [e[:-1] if i in few else e for i, e in enumerate(ends)]


def _gradient(score: Column, delta: float) -> Column:
    """Of the Huber loss: the error, cut at `delta`."""
    return F.greatest(F.least(score - F.col("y"), F.lit(delta)), F.lit(-delta)) * F.col("w")


Sums = tuple[float, float, int]


@dataclass
class Found:
    """The best split of a node, the sums of its two sides, and the children it would have."""

    gain: float = 0.0
    feature: int | None = None
    bin: int = 0
    value: float = 0.0
    children: tuple[int, int] | None = None
    sides: tuple[Sums, Sums] | None = None


def _best(table: dict[int, dict[int, Sums]], ends: list[list[float]], least: int) -> tuple[Found, Sums]:
    """The best split of one node from its sums by feature and bin, and the node's own sums."""
    whole = tuple(sum(s[i] for s in next(iter(table.values())).values()) for i in range(3))
    best = Found()
    base = whole[0] ** 2 / whole[1] if whole[1] > 0 else 0.0
    for feature, by_bin in sorted(table.items()):
        left = (0.0, 0.0, 0)
        for bin_ in sorted(b for b in by_bin if b < len(ends[feature])):
            left = tuple(a + b for a, b in zip(left, by_bin[bin_], strict=True))
            right = tuple(a - b for a, b in zip(whole, left, strict=True))
            if min(left[2], right[2]) < least or min(left[1], right[1]) <= 0:
                continue
            gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - base
            if gain > best.gain + 1e-12:
                best = Found(gain, feature, bin_, ends[feature][bin_], None, (left, right))
    return best, whole


def _sums(rows: DataFrame, node: Column, gradient: Column, ends: list[list[float]]) -> dict[int, dict[int, dict[int, Sums]]]:
    """node -> feature -> bin -> (gradients, weights, rows)."""
    entries = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"x{i}").alias("bin")) for i in range(len(ends))])
    marked = rows.select(node.alias("node"), gradient.alias("g"), "w", entries.alias("bins")).where("node is not null")
    table = marked.select("node", "g", "w", F.inline("bins")).groupBy("node", "feature", "bin")
    out: dict[int, dict] = {}
    for r in table.agg(F.sum("g").alias("g"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect():
        out.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["g"], r["w"], r["n"])
    return out


def _grow(rows: DataFrame, gradient: Column, ends: list[list[float]], leaves: int, least: int, depth: int | None) -> Split:
    """One tree, its leaves' weights the steps that lower the loss.

    Nodes are split best first. What the children of all nodes hold that would be split by what is known so far
    is found by one aggregate, so a tree takes about as many of them as it has levels.
    """
    known: dict[int, Found] = {}
    own: dict[int, Sums] = {}
    level = {0: 0}
    wanted = [0]
    while True:
        sums = _sums(rows, _number(known, 0, set(wanted)), gradient, ends)
        for node in wanted:
            known[node], own[node] = _best(sums[node], ends, least) if node in sums else (Found(), own.get(node, (0.0, 0.0, 0)))
        chosen, wanted, exact = _best_first(known, level, own, leaves, depth)
        if exact:
            return _tree(0, chosen, known, own)


def _best_first(known: dict[int, Found], level: dict[int, int], own: dict[int, Sums], leaves: int, depth: int | None) -> tuple[set[int], list[int], bool]:
    """The nodes to split, their children that are not looked at yet, and whether looking at these could change the choice."""
    heap, chosen, wanted, exact = [], set(), [], True

    def push(node: int) -> None:
        if known[node].feature is not None and (depth is None or level[node] < depth):
            heapq.heappush(heap, (-known[node].gain, node))

    push(0)
    while heap and len(chosen) + 1 < leaves:
        # children that are not looked at might gain more than this one
        exact = not wanted
        _, node = heapq.heappop(heap)
        chosen.add(node)
        found = known[node]
        if found.children is None:
            found.children = (len(level), len(level) + 1)
            for child, sums in zip(found.children, found.sides, strict=True):
                level[child], own[child] = level[node] + 1, sums
        for child in found.children:
            if child in known:
                push(child)
            elif depth is None or level[child] < depth:
                wanted.append(child)
    # with room left, those children may still be split
    exact = exact and not (wanted and len(chosen) + 1 < leaves)
    return chosen, wanted, exact


def _tree(node: int, chosen: set[int], known: dict[int, Found], own: dict[int, Sums]) -> Split:
    if node not in chosen:
        g, w, _ = own[node]
        return Split(weight=-g / w if w > 0 else 0.0)
    found = known[node]
    return Split(found.feature, found.value, found.gain, 0.0, *[_tree(c, chosen, known, own) for c in found.children])


def _number(known: dict[int, Found], node: int, wanted: set[int]) -> Column:
    """Number of the wanted node a binned row falls into, NULL in all others."""
    if node in wanted:
        return F.lit(node)
    found = known.get(node)
    if found is None or found.children is None:
        return F.lit(None).cast("int")
    left, right = (_number(known, c, wanted) for c in found.children)
    return F.when(F.col(f"x{found.feature}") <= found.bin, left).otherwise(right)


def _binned(tree: Split, ends: list[list[float]]) -> Column:
    if tree.feature is None:
        return F.lit(float(tree.weight))
    bin_ = ends[tree.feature].index(tree.value)
    return F.when(F.col(f"x{tree.feature}") <= bin_, _binned(tree.left, ends)).otherwise(_binned(tree.right, ends))


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The table, stored by column, as every level of a tree reads it again; and its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _binned_table(df: DataFrame, label: str, features: Sequence[str], weight: str | None, bins: int) -> tuple[DataFrame, str, list[list[float]]]:
    """The written `binned_rows`, their path and the ends of the bins; `df` is computed once."""
    own = list(dict.fromkeys([label, *features, *([weight] if weight else [])]))
    raw, raw_path = _written(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(own)]), "numbers")
    at = {c: f"c{i}" for i, c in enumerate(own)}
    inputs = [at[c] for c in features]
    ends = bin_ends(raw, inputs, bins)
    rows, path = _written(binned_rows(raw, at[label], inputs, at[weight] if weight else None, ends), "rows")
    remove(df.sparkSession, raw_path)
    return rows, path, ends


def binned_rows(df: DataFrame, label: str, features: Sequence[str], weight: str | None, ends: list[list[float]]) -> DataFrame:
    """y, w and the bin number x0, x1, ... of each feature; a missing value is in the first bin. Rows without label or weight are left out."""

    def number(c: str, cuts: list[float]) -> Column:
        x = F.col(f"`{c}`").cast("double")
        # the number of ends below the value, by halving
        size = 1 << len(cuts).bit_length()
        steps = [size >> i for i in range(1, size.bit_length())]
        known = F.array(*[F.lit(float(e)) for e in cuts]).cast("array<double>")
        at = F.reduce(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: at + F.when(F.get(known, at + s - 1) < x, s).otherwise(0)) if cuts else F.lit(0)
        return F.coalesce(at, F.lit(0)).cast("smallint")

    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    bins = [number(c, e).alias(f"x{i}") for i, (c, e) in enumerate(zip(features, ends, strict=True))]
    return df.select(F.col(f"`{label}`").cast("double").alias("y"), w.alias("w"), *bins).where("y is not null and not isnan(y) and w > 0")


def train_huber(
    train: DataFrame,
    label: str,
    features: Sequence[str],
    weight: str | None = None,
    trees: int = 200,
    rate: float = 0.1,
    delta: float = 0.9,
    leaves: int = 60,
    min_rows: int = 50,
    depth: int | None = None,
    bins: int = 255,
    drop_rate: float = 0.1,
    skip_drop: float = 0.5,
    most_dropped: int = 50,
    seed: int = 42,
) -> Model:
    """Boosted trees on the Huber loss. `drop_rate=0` gives plain boosting; the choice of dropped trees repeats with `seed`."""
    features = list(features)
    rows, path, ends = _binned_table(train, label, features, weight, bins)
    start = rows.agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("base")).first()["base"]
    model = Model(features, float(start) if start is not None else 0.0)
    if start is None:
        return model
    spark, draw = train.sparkSession, random.Random(seed)
    rows = rows.withColumn("s", F.lit(model.base))
    for number in range(trees):
        dropped = []
        if drop_rate > 0 and draw.random() >= skip_drop:
            dropped = [i for i in range(number) if draw.random() < drop_rate]
            dropped = sorted(draw.sample(dropped, most_dropped)) if len(dropped) > most_dropped else dropped
        gone = [_binned(model.trees[i], ends) * model.scales[i] for i in dropped]
        without = reduce(lambda a, b: a - b, gone, F.col("s"))
        tree = _grow(rows, _gradient(without, delta), ends, leaves, min_rows, depth)
        k = len(dropped)
        scale = rate / (1 + k)
        # the dropped trees and the new one share what the dropped ones had
        lost = [_binned(model.trees[i], ends) * (model.scales[i] / (k + 1)) for i in dropped]
        score = reduce(lambda a, b: a - b, lost, F.col("s")) + _binned(tree, ends) * scale
        rows = rows.withColumn("s", score)
        for i in dropped:
            model.scales[i] *= k / (k + 1)
        model.trees.append(tree)
        model.scales.append(scale)
        if number + 1 < trees:
            # each level of the next tree reads the scores, so they are computed once
            older = path
            rows, path = _written(rows, "scores")
            remove(spark, older)
    return model


def first_split(train: DataFrame, label: str, features: Sequence[str], weight: str | None = None, delta: float = 0.9, min_rows: int = 50, bins: int = 255) -> DataFrame:
    """The best split of the first tree by each feature: feature, value, gain."""
    features = list(features)
    rows, _, ends = _binned_table(train, label, features, weight, bins)
    base = rows.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()[0]
    sums = _sums(rows, F.lit(0), _gradient(F.lit(base), delta), ends).get(0, {})
    found = [(i, _best({i: t}, ends, min_rows)[0]) for i, t in sorted(sums.items())]
    spark = train.sparkSession
    return spark.createDataFrame([(features[i], s.value, s.gain) for i, s in found if s.feature is not None], "feature string, value double, gain double")
