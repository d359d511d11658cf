"""Edge cases on small tables, and random tables against plain Python models."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plotstats.functions import strings as st
from plotstats.functions.registry import register
from plotstats.operators import aggregates, evaluate, joins, observations, orderstats, plot_stats, raster, sampling, tables
from plotstats.operators.aggregates import grouped_stats
from plotstats.operators.skew import hot_groups, lookup_join


# --- models ----------------------------------------------------------------------------

def quantile(values, quarters):
    """Values v with at least a share below-or-equal and the rest above-or-equal, averaged."""
    n = len(values)
    fit = [
        v for v in sorted(set(values))
        if 4 * sum(x <= v for x in values) >= quarters * n and 4 * sum(x >= v for x in values) >= (4 - quarters) * n
    ]
    return sum(fit) / len(fit) if fit else None


def mode(values):
    top = Counter(values).most_common()
    return top[0][0] if top and (len(top) == 1 or top[0][1] > top[1][1]) else None


def random_groups(seed):
    rng = random.Random(seed)
    rows = []
    for g in range(60):
        key = None if g == 7 else g
        for _ in range(rng.randint(1, 9 if g else 200)):
            rows.append((key, None if rng.random() < 0.1 else float(rng.randint(0, 12)) / 2))
    rows.append((100, None))
    return rows


WANTED = {f: (f, "x") for f in ("median", "lower_quartile", "upper_quartile", "mode", "stdev", "variance", "min")}


def check_grouped(spark, seed):
    rows = random_groups(seed)
    got = {r["k"]: r for r in aggregates.grouped_stats(spark.createDataFrame(rows, "k int, x double"), ["k"], WANTED).collect()}
    groups = {}
    for k, x in rows:
        groups.setdefault(k, []).append(x)
    assert set(got) == set(groups)
    for k, values in groups.items():
        values = [v for v in values if v is not None]
        for f, q in aggregates.QUARTERS.items():
            assert got[k][f] == quantile(values, q), (k, f)
        assert got[k]["mode"] == mode(values)
        n = len(values)
        var = sum((v - sum(values) / n) ** 2 for v in values) / (n - 1) if n > 1 else 0.0
        assert math.isclose(got[k]["variance"], var, abs_tol=1e-9)
        assert math.isclose(got[k]["stdev"], math.sqrt(var), abs_tol=1e-9)


@pytest.mark.parametrize("seed", [1, 2])
def test_grouped_stats(spark, seed):
    check_grouped(spark, seed)


@pytest.mark.parametrize("seed", [3, 4])
def test_grouped_stats_of_large_groups(spark, every_group_hot, seed):
    check_grouped(spark, seed)


def test_expression_builders_equal_grouped_form(spark):
    df = spark.createDataFrame(random_groups(5), "k int, x double").where("k is not null")
    built = df.groupBy("k").agg(*[aggregates.STATS[f]("x").alias(f) for f in WANTED])
    grouped = aggregates.grouped_stats(df, ["k"], WANTED)
    built, grouped = ({r["k"]: r.asDict() for r in d.collect()} for d in (built, grouped))
    assert built.keys() == grouped.keys()
    for k, row in built.items():
        for f, v in row.items():
            # sums are added up in another order, which moves their last digits; all else is equal
            assert grouped[k][f] == v or f in ("stdev", "variance") and math.isclose(grouped[k][f], v, rel_tol=1e-12)


def test_global_ranks(spark):
    rng = random.Random(6)
    values = [float(rng.choice([0, 0, 0, rng.randint(0, 900)])) for _ in range(1037)]
    df = spark.createDataFrame([(v,) for v in values], "diff double")
    got = {r["percent"]: r["abs_error"] for r in evaluate.error_deciles(df).collect()}
    assert got == {i: sorted(values)[int(len(values) * i / 100)] for i in range(0, 100, 10)}
    assert evaluate.error_deciles(df.where("diff < 0")).collect() == []


def test_number_rows(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000)
    rows = orderstats.number_rows(df.select("k"), ["k"]).collect()
    assert all(r["row_id"] == r["k"] for r in rows) and len(rows) == 1000


def test_row_slice_ends_with_the_table(spark):
    df = spark.range(0, 50, 2)
    assert [r[0] for r in tables.row_slice(df, "id", 2, 10).orderBy("id").collect()] == [40, 42, 44, 46, 48]
    assert tables.row_slice(df, "id", 3, 10).count() == 0


# --- skew helpers ----------------------------------------------------------------------

def test_hot_groups_and_lookup_join(spark):
    left = spark.createDataFrame([(1,)] * 50 + [(2,)] * 3 + [(None,)] * 40 + [(9,)], "k int").withColumn("v", F.lit(1))
    right = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, name string")
    expected = {h: sorted(map(str, left.join(right, "k", h).collect())) for h in ("left", "inner", "left_semi", "left_anti")}
    assert hot_groups(left, ["k"]) is None
    spark.conf.set("plotstats.hot.rows", "10")
    try:
        assert {r[0] for r in hot_groups(left, ["k"]).collect()} == {1, None}
        for how, rows in expected.items():
            assert sorted(map(str, lookup_join(left, right, ["k"], how).collect())) == rows
    finally:
        spark.conf.unset("plotstats.hot.rows")


def test_large_groups_keep_the_types_of_their_values(spark, every_group_hot):
    big = 1 << 53
    rows = [(1, big + 1, "b", 1.5), (1, big + 1, "b", 1.5), (1, big, "a", 2.5), (1, big, "c", 3.5), (1, big + 2, "d", None)]
    df = spark.createDataFrame(rows, "k int, x long, t string, y double")
    wanted = {"x": ("mode", "x"), "t": ("mode", "t"), "y": ("mode", "y"), "m": ("median", "y"), "q": ("upper_quartile", "x")}
    # two of three values are equally frequent only if they are told apart
    hot, cold = (grouped_stats(df, ["k"], wanted, check_skew=c).collect() for c in (True, False))
    assert hot == cold and hot[0]["x"] is None and hot[0]["t"] == "b" and hot[0]["y"] == 1.5
    hot, cold = (grouped_stats(df.where("t != 'c'"), ["k"], wanted, check_skew=c).collect() for c in (True, False))
    assert hot == cold and hot[0]["x"] == big + 1


# --- observations ----------------------------------------------------------------------

def test_cloud_flag(spark):
    df = spark.createDataFrame([(0,), (1024,), (2048,), (3072,), (None,)], "q int")
    assert [r[0] for r in df.select(observations.cloud_flag(F.col("q"))).collect()] == [False, True, True, False, False]


def test_clear_sky(spark):
    rows = [
        (False, None, None, True), (True, None, 0.0, False), (True, 0.05, 0.05, True), (False, 0.05, None, False),
        (False, 0.1, 0.0, False), (False, 0.05, 0.1, False), (None, None, None, False), (None, 0.0, 0.0, True),
    ]
    df = spark.createDataFrame(rows, "HAS_CLOUDFLAG boolean, MSK_CLDPRB double, MSK_SNWPRB double, want boolean")
    assert all(bool(r["got"]) == r["want"] for r in df.withColumn("got", observations.clear_sky()).collect())


def test_day_bounds(spark):
    day = observations.epoch("2019-02-28")
    df = spark.createDataFrame([(day - 1,), (day,), (day + 86399,), (day + 86400,)], "time long")
    assert df.where(observations.in_days("2019-02-28", "2019-02-28")).count() == 2
    assert df.where(observations.in_period("2019-02-27", "2019-02-28")).count() == 1
    assert [bool(r[0]) for r in df.select(observations.around_midnight(F.col("time"))).collect()] == [True] * 4


def test_plots_without_observations(spark):
    plots = spark.createDataFrame([(1, 0.5), (2, 0.7)], "plot_id long, tree_cover double")
    stats = spark.createDataFrame([(1, 3.0)], "id long, b4_min double")
    rows = {r["plot_id"]: r["b4_min"] for r in plot_stats.left_join_features(plots, stats).collect()}
    assert rows == {1: 3.0, 2: None}


def test_feature_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 0.5)], "id int, b8a_lower_quartile_s0 double, ndvi_min_s2 double, veg_pc_s1 double")
    assert plot_stats.wide_names(df).columns == ["id", "lower_quartile(B8A_m)_0", "min(NDVI_m)_2", "veg_pc_1"]
    assert plot_stats.improved_columns(["b1_avg_s0", "b12_avg_s0", "b1_min_s0", "b8a_min_s0", "veg_pc_s0", "ndvi_lower_quartile_s1"]) == [
        "b12_avg_s0", "b1_min_s0", "ndvi_lower_quartile_s1",
    ]


# --- joins -----------------------------------------------------------------------------

def close(a, b):
    return abs(a - b) <= 1e-8 + 1e-5 * abs(b)


@pytest.mark.parametrize("seed,spread", [(1, 3e-3), (2, 1e-4), (3, 30.0)])
def test_tolerance_matches(spark, seed, spread):
    """Sparse, dense and scattered points, also near zero and with copies, against all pairs."""
    rng = random.Random(seed)
    centres = [(113.9, -22.6), (0.0, 1e-6), (-0.5, 60.0)]

    def point(scale):
        x, y = rng.choice(centres)
        return x + rng.uniform(-scale, scale), y + rng.uniform(-scale, scale)

    sites = [point(spread) for _ in range(60)]
    sites += sites[:5]
    found = [point(spread) for _ in range(150)] + sites[:10]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(found)], "i int, longitude double, latitude double")
    right = spark.createDataFrame([(i, *p) for i, p in enumerate(sites)], "plot int, longitude double, latitude double")
    want = {}
    for i, (x, y) in enumerate(found):
        hits = [j for j, (u, v) in enumerate(sites) if close(x, u) and close(y, v)]
        want[i] = "none" if not hits else "one" if len(hits) == 1 else "many"
    got = {r["i"]: r["match_status"] for r in joins.tolerance_join_report(left, right, "plot").collect()}
    assert got == want
    joined = {r["i"]: r["plot"] for r in joins.tolerance_join(left, right, "plot").collect()}
    assert set(joined) == {i for i, s in want.items() if s == "one"}
    assert all(close(found[i][0], sites[j][0]) and close(found[i][1], sites[j][1]) for i, j in joined.items())


def test_join_exports(spark):
    exports = spark.createDataFrame(
        [("a", 5.0, '{"type":"Point","coordinates":[12.50000430000001,48.250003]}'),
         ("b", 6.0, '{"type":"Point","coordinates":[10.0,10.0]}')],
        "`system:index` string, B1 double, `.geo` string",
    )
    plots = spark.createDataFrame([(7, 12.50000430000021, 48.250004)], "plot_id int, longitude double, latitude double")
    (row,) = joins.join_exports(exports, plots).collect()
    assert row["plot_id"] == 7 and row["B1"] == 5.0 and row["longitude_y"] == 12.50000430000021
    assert row[".geo"].startswith("{")


def test_nearest_keeps_ties(spark):
    plots = spark.createDataFrame([(1, 0.0, 0.0)], "id int, longitude double, latitude double")
    pixels = spark.createDataFrame(
        [(1, 1.0, 0.0, 5.0), (1, 0.0, 1.0, 7.0), (1, 2.0, 0.0, 9.0)], "id int, longitude double, latitude double, B1 double"
    )
    assert sorted(r["B1"] for r in joins.nearest_pixels(pixels, plots, "id").collect()) == [5.0, 7.0]
    row = joins.nearest_median_sd(pixels, plots, "id", ["B1"]).first()
    assert row["B1"] == 6.0 and math.isclose(row["B1_sd"], math.sqrt(2))
    alone = joins.nearest_median_sd(pixels.where("B1 = 9"), plots, "id", ["B1"]).first()
    assert alone["B1_sd"] is None


def test_chunk_keys(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (2339,), (2340,), (2345,)], "i long")
    assert [r[0] for r in df.select(joins.chunk_key(F.col("i"), 2345)).collect()] == [9, 9, 19, 2339, 2345, 2345]


# --- texts -----------------------------------------------------------------------------

def test_text_functions(spark):
    df = spark.createDataFrame([("Robert", "Rupert"), ("", "x"), ("1 éb", None), ("Bé", "B2")], "a string, b string")
    rows = df.select(
        st.sound_code(F.col("a")).alias("s"),
        st.difference(F.col("a"), F.col("b")).alias("d"),
        st.padc(F.col("a"), F.lit(9)).alias("c"),
        st.padl(F.col("a"), F.lit(None)).alias("l"),
        st.padl(F.col("a"), F.lit(-1)).alias("neg"),
        st.proper(F.col("a")).alias("p"),
        st.charindex(F.lit(""), F.col("a")).alias("empty"),
        st.strfilter(F.col("a"), F.lit("ebR")).alias("f"),
        st.replicate(F.col("a"), F.lit(0)).alias("r"),
    ).collect()
    assert [r["s"] for r in rows] == ["R616", "?000", "B100", "B120"]
    assert [r["d"] for r in rows] == [4, 2, None, 3]
    assert rows[0]["c"] == " Robert  " and rows[0]["l"] == "Robert" and rows[0]["neg"] is None
    assert [r["p"] for r in rows] == ["Robert", "", "1 éb", "Bé"]
    assert [r["empty"] for r in rows] == [0, 0, 0, 0]
    assert [r["f"] for r in rows] == ["Rbe", "", "b", ""] and [r["r"] for r in rows] == ["", "", "", ""]


def test_registered_functions(spark):
    names = register(spark)
    assert {"padc", "proper", "sound_code", "coth", "lower_quartile_of"} <= set(names)
    row = spark.sql(
        "select ps_difference('Robert', 'Rupert') d, ps_exp(1000D) e, coth(0D) c, padr('ab', 4) p, ps_charindex('', 'a') i,"
        " upper_quartile_of(array(1D, 2D, 3D, 4D)) q, mode_of(array(1D, 2D, 2D)) m, mode_of(array(1D, 2D)) t,"
        " stdev_of(array(4D)) s, variance_of(array(1D, 3D)) v"
    ).first()
    assert (row["d"], row["e"], row["c"], row["p"], row["i"], row["q"]) == (4, None, math.inf, "ab  ", 0, 3.5)
    assert (row["m"], row["t"], row["s"], row["v"]) == (2.0, None, 0.0, 2.0)


# --- rasters ---------------------------------------------------------------------------

def shown(mode, a, long, s):
    """Source index for each target index along the short axis, by walking from the start."""
    out = [None] * long
    for direction, at in ((1, s), (-1, s - 1)):
        i = 0 if direction == 1 or mode == "mirror" else a - 1
        step = 1 if direction == 1 or mode == "mirror" else -1
        while 0 <= at < long:
            out[at] = i
            if mode == "tile":
                i = (i + step) % a
            elif a > 1:
                i += step
                if i in (0, a - 1):
                    step = 1 if i == 0 else -1
            at += direction
    return out


@pytest.mark.parametrize("mode", ["tile", "mirror"])
@pytest.mark.parametrize("height,width", [(2, 7), (7, 3), (1, 4), (4, 4), (5, 11)])
def test_tile_and_mirror(spark, mode, height, width):
    pixels = spark.createDataFrame(
        [(1, r, c, float(r * 100 + c)) for r in range(height) for c in range(width)], "image_id long, row int, col int, v double"
    )
    a, long = min(height, width), max(height, width)
    s = (long - a) // 2
    index = shown(mode, a, long, s)
    got = {(r["row"], r["col"]): r["v"] for r in raster.reshape(pixels, mode, ["v"], position="center").collect()}
    want = {
        (r, c): float(index[r] * 100 + c) if height < width else float(r * 100 + index[c])
        for r in range(long) for c in range(long)
    }
    assert got == want


def test_incomplete_images_are_left_out(spark):
    pixels = spark.createDataFrame([(1, 0, 0, 1.0), (1, 1, 1, 1.0), (2, 0, 0, 3.0)], "image_id long, row int, col int, v double")
    assert [r[0] for r in raster.incomplete_images(pixels).collect()] == [1]
    grown = raster.reshape(pixels, "interp", ["v"], (2, 3)).collect()
    assert {r["image_id"] for r in grown} == {2} and len(grown) == 6


# --- sampling --------------------------------------------------------------------------

def test_stratify_caps_every_class(spark):
    rows = [(i, 0 if i < 900 else 1 if i < 990 else 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, label int")
    sizes = {r["label"]: r["count"] for r in sampling.stratify(df, "label", "id").groupBy("label").count().collect()}
    assert sizes == {0: 40, 1: 40, 2: 10}


def test_bucket_bounds(spark):
    """0.3 lies inside bucket 2, whose upper bound is 0.30000000000000004."""
    df = spark.createDataFrame([(0.3, 0.1), (0.05, 0.2), (0.5, 0.3), (1.0, 0.1)], "y double, diff double")
    got = {r["bucket"]: r["mae"] for r in evaluate.bucket_mae(df).collect()}
    want = {}
    for y, e in ((0.3, 0.1), (0.05, 0.2), (0.5, 0.3), (1.0, 0.1)):
        for i in range(10):
            if i / 10 < y < i / 10 + 0.1:
                want.setdefault(i, []).append(e)
    assert got == {i: sum(v) / len(v) for i, v in want.items()}
