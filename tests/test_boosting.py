"""Huber boosting: first splits, growth, dropout, missing values, saved models, and its error against Spark's trees."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plotstats.operators import boosting, models
from plotstats.plans.training import FEATURES, _model_rows
from plotstats.session import scratch_path

SF = "/root/testdata/sf0.001"


def plain_tree(rows, leaves, least, delta, base):
    """rows: (y, w, x...); best-first growth over all values; returns a function of x."""

    def gradient(r):
        return max(-delta, min(delta, base - r[0])) * r[1]

    def best(members):
        g, w = sum(map(gradient, members)), sum(r[1] for r in members)
        found = (0.0, None, None)
        for f in range(2, len(members[0])):
            values = sorted({r[f] for r in members if r[f] is not None})
            # bins are those of the whole table; the last value ends none
            for v in sorted({r[f] for r in rows if r[f] is not None})[:-1]:
                left = [r for r in members if r[f] is None or r[f] <= v]
                if min(len(left), len(members) - len(left)) < least or not values:
                    continue
                lg, lw = sum(map(gradient, left)), sum(r[1] for r in left)
                gain = lg**2 / lw + (g - lg) ** 2 / (w - lw) - g**2 / w
                if gain > found[0] + 1e-9:
                    found = (gain, f, v)
        return found

    tips = [(best(rows), rows, lambda r: True)]
    while len(tips) < leaves:
        k = max(range(len(tips)), key=lambda i: tips[i][0][0])
        (gain, f, v), members, test = tips[k]
        if gain <= 0:
            break
        parts = [(lambda r, t=test, f=f, v=v: t(r) and (r[f] is None or r[f] <= v)), (lambda r, t=test, f=f, v=v: t(r) and not (r[f] is None or r[f] <= v))]
        tips[k : k + 1] = [(best(m), m, p) for p in parts for m in [[r for r in members if (r[f] is None or r[f] <= v) == (p is parts[0])]]]
    return [(test, -sum(map(gradient, m)) / sum(r[1] for r in m)) for _, m, test in tips]


@pytest.mark.parametrize("leaves", [2, 5, 9])
def test_a_tree_grows_best_leaf_first(spark, leaves):
    draw = random.Random(leaves)
    rows = []
    for _ in range(400):
        a, b, c = draw.randint(0, 12), draw.choice([None, 0.5, 1.5, 2.5]), draw.random()
        rows.append((a * 0.3 + (2.0 if (b or 0) > 1 else 0) + draw.gauss(0, 0.2) + (30 if draw.random() < 0.02 else 0), 1.0 + a % 3, a, b, round(c, 2)))
    df = spark.createDataFrame(rows, "y double, w double, a int, b double, c double")
    base = sum(y * w for y, w, *_ in rows) / sum(w for _, w, *_ in rows)
    model = boosting.train_huber(df, "y", ["a", "b", "c"], "w", trees=1, rate=1.0, delta=0.9, leaves=leaves, min_rows=10, drop_rate=0)
    want = plain_tree(rows, leaves, 10, 0.9, base)
    assert len(model.trees[0].leaves()) == len(want) == leaves
    for r in model.transform(df).collect():
        row = tuple(r)[:5]
        assert r["prediction"] == pytest.approx(base + next(v for test, v in want if test(row)))


def test_error_is_not_above_absolute_loss_trees(spark):
    train, test = _model_rows(spark, SF)
    train, test = train.cache(), test.cache()

    def error(scored):
        return scored.agg(F.avg(F.abs(F.col("prediction") - F.col("t")))).first()[0]

    # Spark's first tree counts in full whatever the step size
    spark_trees = models.train_boost(train, "t", FEATURES, maxIter=6, maxDepth=5, stepSize=0.3)
    plain = boosting.train_huber(train, "t", FEATURES, trees=10, rate=0.4, leaves=32, drop_rate=0)
    dart = boosting.train_huber(train, "t", FEATURES, trees=10, rate=0.8, leaves=32, drop_rate=0.2, skip_drop=0.0)
    assert error(plain.transform(test)) <= error(spark_trees.transform(test))
    assert error(dart.transform(test)) <= error(spark_trees.transform(test))
    # trees that were dropped share their weight with later ones
    assert min(dart.scales) < 0.41 and len(dart.trees) == 10
    path = scratch_path(spark, "model")
    dart.save(spark, path)
    again = boosting.Model.load(spark, path)
    assert error(again.transform(test)) == pytest.approx(error(dart.transform(test)))
    shares = {r["feature"]: r["importance"] for r in dart.importances(spark).collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "l_quantity"


def test_odd_rows(spark):
    rows = [(None, 1.0), (math.nan, 2.0), (1.0, None), (1.0, 5.0), (3.0, math.nan)] * 30
    df = spark.createDataFrame(rows, "y double, x double")
    model = boosting.train_huber(df, "y", ["x"], trees=3, min_rows=5)
    assert all(r["prediction"] is not None for r in model.transform(df).collect())
    empty = boosting.train_huber(df.where("y > 100"), "y", ["x"], trees=3)
    assert empty.trees == [] and empty.transform(df).count() == 150


def test_many_values_are_cut_into_bins(spark):
    df = spark.range(5000).select((F.col("id") % 977).cast("double").alias("x"), F.lit(1.5).alias("c"), F.lit(None).cast("double").alias("n"))
    ends = boosting.bin_ends(df, ["x", "c", "n"], 16)
    assert 10 <= len(ends[0]) <= 16 and ends[1] == [] and ends[2] == []
