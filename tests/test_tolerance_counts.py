"""True numbers of matches within a tolerance: regions, dense spots, copies, against all pairs."""

import random
import time

import numpy as np
import pytest

from plotstats.operators import joins


def counts(left, right):
    """left: (region, x, y), right likewise; number of agreeing right rows of the region."""
    r = np.array([p[1:] for p in right]).reshape(-1, 2)
    region = np.array([p[0] for p in right])
    tol = 1e-8 + 1e-5 * np.abs(r)
    return [int(((np.abs(np.array(p[1:]) - r) <= tol).all(axis=1) & (region == p[0])).sum()) for p in left]


def report(spark, left, right):
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "i int, region string, longitude double, latitude double")
    b = spark.createDataFrame([(i, *p) for i, p in enumerate(right)], "plot int, region string, longitude double, latitude double")
    rows = joins.tolerance_join_report(a, b, "plot", by=["region"]).collect()
    assert len(rows) == len(left)
    return [r["matches"] for r in sorted(rows, key=lambda r: r["i"])]


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_counts_by_region(spark, monkeypatch, leaf):
    monkeypatch.setattr(joins, "LEAF", leaf)
    draw = random.Random(leaf)

    def near(scale):
        x, y = draw.choice([(113.9, -22.6), (0.0, 1e-6), (-0.5, 60.0)])
        return draw.choice("ab"), x + draw.gauss(0, scale), y + draw.gauss(0, scale)

    right = [near(s) for s in (1e-3, 1e-4, 1e-7) for _ in range(120)]
    right += right[:7] * 3
    left = [near(s) for s in (1e-3, 1e-4, 1e-7) for _ in range(60)] + right[:10] + [("c", 0.0, 0.0)]
    assert report(spark, left, right) == counts(left, right)
    assert max(counts(left, right)) > 7


def test_a_dense_spot(spark):
    draw = np.random.default_rng(1)
    right = [("a", float(x), float(y)) for x, y in zip(20 + draw.normal(0, 2e-4, 100_000), 50 + draw.normal(0, 4e-4, 100_000), strict=True)]
    left = [("a", float(x), float(y)) for x, y in zip(20 + draw.normal(0, 4e-4, 300), 50 + draw.normal(0, 6e-4, 300), strict=True)]
    start = time.time()
    assert report(spark, left, right) == counts(left, right)
    # all pairs of so many points on either side would not end
    assert sum(report(spark, right, right)) > 10**9
    assert time.time() - start < 120


def test_missing_regions_and_coordinates(spark):
    left = spark.createDataFrame([(1, None, 1.0, 1.0), (2, "a", None, 1.0), (3, "a", 1.0, 1.0)], "i int, region string, longitude double, latitude double")
    right = spark.createDataFrame([(7, None, 1.0, 1.0), (8, "a", 1.0, None), (9, "a", 1.0, 1.0)], "plot int, region string, longitude double, latitude double")
    got = {r["i"]: (r["matches"], r["match_status"]) for r in joins.tolerance_join_report(left, right, "plot", by=["region"]).collect()}
    assert got == {1: (0, "none"), 2: (0, "none"), 3: (1, "one")}
    assert [(r["i"], r["plot"]) for r in joins.tolerance_join(left, right, "plot", by=["region"]).collect()] == [(3, 9)]


def test_exports_of_all_regions_in_one_job(spark):
    exports = spark.createDataFrame(
        [(str(i), r, '{"type":"Point","coordinates":[12.5000043,48.250003]}') for i, r in enumerate("ab")],
        "`system:index` string, region string, `.geo` string",
    )
    plots = spark.createDataFrame([(7, "a", 12.50000430000021, 48.250004), (8, "b", 12.5000044, 48.250004)], "plot_id int, region string, longitude double, latitude double")
    assert joins.join_exports(exports, plots).count() == 0  # two plots agree with either sample
    assert sorted((r["region_x"], r["plot_id"]) for r in joins.join_exports(exports, plots, region="region").collect()) == [("a", 7), ("b", 8)]
