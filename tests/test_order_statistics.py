"""Order statistics and modes: types, zeros, NaN, narrowing of intervals, and the plan of ordinary groups."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plotstats.operators import orderstats, sampling
from plotstats.operators.aggregates import grouped_stats
from plotstats.operators.plot_stats import plot_stats
from plotstats.plans.views import END, START, observations

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=["ordinary", "large"])
def either_way(request, spark):
    if request.param == "large":
        request.getfixturevalue("every_group_hot")


def quartile(values, quarters):
    values, n = sorted(values, key=lambda v: (math.isnan(v), v)), len(values)
    return (values[(n * quarters + 3) // 4 - 1] + values[n * quarters // 4]) / 2 if n else None


@pytest.mark.parametrize("kind,top", [("tinyint", 120), ("smallint", 30_000), ("int", 2_000_000_000), ("bigint", 9_000_000_000_000_000_000), ("float", 1e30), ("double", 1e300), ("decimal(12,2)", 4_000_000_000)])
def test_halves_do_not_overflow(spark, either_way, kind, top):
    rows = [(g, v) for g in (1, 2) for v in (top, top, top - 1 if kind not in ("float", "double") else top, top, top, None)]
    df = spark.createDataFrame([(g, None if v is None else str(v)) for g, v in rows], "g long, v string").select("g", F.col("v").cast(kind).alias("v"))
    wanted = {"m": ("median", "v"), "q": ("lower_quartile", "v"), "u": ("upper_quartile", "v"), "o": ("mode", "v")}
    for r in grouped_stats(df, ["g"], wanted).collect():
        assert r["m"] == r["u"] == r["q"] == pytest.approx(float(top)) and float(r["o"]) == pytest.approx(float(top))
    assert dict(grouped_stats(df, ["g"], wanted).dtypes) == {"g": "bigint", "m": "double", "q": "double", "u": "double", "o": kind}


def test_zeros_are_one_value(spark, either_way):
    df = spark.createDataFrame([(1, v) for v in (0.0, -0.0, 1.0, 1.0, -0.0)], "g long, v double")
    assert grouped_stats(df, ["g"], {"o": ("mode", "v")}).first()["o"] == 0.0


def test_measures_of_several_types(spark, either_way):
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, None]), draw.randint(-9, 9), draw.randint(2**60, 2**60 + 5), draw.choice([None, math.nan, 0.5, -2.5, 7.0]), draw.choice("abc")) for _ in range(60)] + [(3, None, None, None, None)]
    df = spark.createDataFrame(rows, "g long, i int, b long, d double, s string")
    wanted = {"im": ("median", "i"), "bq": ("upper_quartile", "b"), "dm": ("median", "d"), "io": ("mode", "i"), "so": ("mode", "s"), "bo": ("mode", "b"), "imin": ("min", "i"), "iavg": ("avg", "i"), "isd": ("stdev", "i")}
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r[1:])
    found = {r["g"]: r for r in grouped_stats(df, ["g"], wanted).collect()}
    assert set(found) == set(groups)

    def mode(values):
        top = Counter(values).most_common()
        return None if not top or len(top) > 1 and top[0][1] == top[1][1] else top[0][0]

    for g, members in groups.items():
        i, b, d, s = ([v for v in column if v is not None] for column in zip(*members, strict=True))
        r = found[g]
        assert (r["im"], r["bq"], r["io"], r["so"], r["bo"], r["imin"]) == (quartile(i, 2), quartile([float(x) for x in b], 3), mode(i), mode(s), mode(b), min(i, default=None))
        dm = quartile(d, 2)
        assert r["dm"] == dm or math.isnan(r["dm"]) and math.isnan(dm)


def test_intervals_are_narrowed_until_they_fit(spark, monkeypatch):
    spark.conf.set("plotstats.sort.rows", "3")
    rounds = []
    cut = orderstats._cut
    monkeypatch.setattr(orderstats, "_cut", lambda *a: rounds.append(1) or cut(*a))
    try:
        draw = random.Random(4)
        rows = [("a", draw.gauss(0, 1e6)) for _ in range(6000)] + [("b", float(i // 7)) for i in range(700)] + [("c", math.nan), ("c", 1.0), (None, 5.0)]
        counts = orderstats.tally(spark.createDataFrame(rows, "g string, v double"), ["g"], F.col("v"))
        found = orderstats.group_ranks(counts, ["g"], {"low": lambda n: F.floor((n + 3) / 4), "mid": lambda n: F.floor(n / 2) + 1, "last": lambda n: n, "beyond": lambda n: n + 1})
        got = {r["g"]: r for r in found.collect()}
    finally:
        spark.conf.unset("plotstats.sort.rows")
    assert len(rounds) > 1
    for g in ("a", "b", "c", None):
        values = sorted((v for h, v in rows if h == g), key=lambda v: (math.isnan(v), v))
        want = (values[(len(values) + 3) // 4 - 1], values[len(values) // 2], values[-1])
        assert all(x == y or math.isnan(x) and math.isnan(y) for x, y in zip((got[g]["low"], got[g]["mid"], got[g]["last"]), want, strict=True))
        assert got[g]["beyond"] is None


def test_values_that_the_sketch_cannot_tell_apart(spark):
    spark.conf.set("plotstats.sort.rows", "2")
    try:
        rows = [(2**61 + i,) for i in range(40)]
        counts = orderstats.tally(spark.createDataFrame(rows, "v long"), [], F.col("v"))
        found = {r["name"]: r["value"] for r in orderstats.global_ranks(counts, lambda n: {"first": F.lit(1), "mid": F.floor(n / 2), "beyond": n + 1}).collect()}
    finally:
        spark.conf.unset("plotstats.sort.rows")
    assert found == {"first": 2**61, "mid": 2**61 + 19}


def test_ordinary_groups_hold_no_lists(spark):
    df = plot_stats(observations(spark, SF), START, END)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in text and "ObjectHashAggregate" not in text and text.count("Exchange") == 1
    assert spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold") == "128"


def test_small_shares(spark):
    df = spark.range(20_000)
    for share in (0.0005, 0.2, 0.33333):
        train, test = sampling.train_test_split(df, "id", share)
        n = test.count()
        assert abs(n - 20_000 * share) < 4 * math.sqrt(20_000 * share) and n > 0 and train.count() == 20_000 - n


def test_stratify_in_rounds(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") < 40, "small").when(F.col("id") < 200, "even").otherwise("large").alias("c"))
    plain = {(r["k"], r["c"]) for r in sampling.stratify(df, "c", "k").collect()}
    spark.conf.set("plotstats.sort.rows", "1")
    try:
        narrow = {(r["k"], r["c"]) for r in sampling.stratify(df, "c", "k").collect()}
    finally:
        spark.conf.unset("plotstats.sort.rows")
    assert plain == narrow and Counter(c for _, c in plain) == {"small": 40, "even": 160, "large": 160}
