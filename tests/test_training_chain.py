"""Categories in fitted pipelines, the training chain, and the function library under its SQL names."""

import math
import random
import statistics
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plotstats.functions import math as m
from plotstats.functions.registry import ARRAY_AGGREGATES, SCALARS, register
from plotstats.operators import models, observations, prep
from plotstats.operators.raster import plot_raster
from plotstats.plans.views import END, START
from plotstats.plans.views import observations as stored
from plotstats.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_categories_of_any_number_of_levels(spark):
    df = spark.range(40_000).select((F.col("id") % 20_000).cast("string").alias("c"), (F.col("id") % 3).cast("string").alias("d"))
    from pyspark.ml import Pipeline

    model = Pipeline(stages=prep.category_stages(["c", "d"])).fit(df)
    new = spark.createDataFrame([("7", "0"), ("unseen", "2"), (None, None)], "c string, d string")
    rows = model.transform(new).collect()
    assert rows[0]["c_vector"].size == 20_000 and rows[0]["c_vector"].numNonzeros() == 1 and rows[0]["d_vector"].toArray().tolist() == [1, 0, 0]
    assert rows[1]["c_vector"].numNonzeros() == 0 and rows[1]["d_vector"].toArray().tolist() == [0, 0, 1]
    assert rows[2]["c_vector"].numNonzeros() == rows[2]["d_vector"].numNonzeros() == 0


def test_a_category_can_be_trained_on(spark):
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "Arid").when(F.col("id") % 3 == 1, "Semiarid").otherwise("Hyperarid").alias("Aridity_zone"),
        (F.col("id") % 7).cast("double").alias("x"),
    ).withColumn("y", F.when(F.col("Aridity_zone") == "Arid", 5.0).otherwise(1.0) + F.col("x") / 100)
    model = models.train_boost(df, "y", ["x"], categories=["Aridity_zone"], maxIter=3)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    scored = models.load_model(path).transform(df.withColumn("Aridity_zone", F.when(F.col("x") > 0, F.col("Aridity_zone")).otherwise("new")))
    assert scored.where("x > 0").agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 0.2
    assert scored.where("prediction is null").count() == 0
    first = models.importances(model, ["x"], df, ["Aridity_zone"]).first()
    assert first["feature"] == "Aridity_zone" and first["importance"] > 0.5


def test_rows_keep_their_key(spark):
    df = spark.createDataFrame([(1, 0.5, 2.0), (1, 0.5, 2.0), (2, None, 1.0)], "plot_id long, tree_cover double, B1 double")
    assert [tuple(r) for r in prep.load_training(df, key="plot_id").collect()] == [(1, 0.5, 2.0)]
    assert prep.load_training(df).columns == ["tree_cover", "B1"]


def test_lists_of_ids_are_joined(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    found = observations.select_ids(df, [5, 5, 7, 200])
    assert sorted(r["id"] for r in found.collect()) == [5, 7] and found.columns == df.columns
    assert observations.select_ids(df, []).count() == 0


def test_rasters_travel_once(spark):
    text = plot_raster(stored(spark, SF), START, END)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text


def test_array_functions_against_plain_ones(spark):
    register(spark)
    draw = random.Random(8)
    lists = [[draw.choice([0.0, -0.0, 1.5, 2.5, math.inf, None]) for _ in range(draw.randint(0, 9))] for _ in range(200)]
    lists += [[], [None], [3.0], [1e9 + i for i in (1.0, 2.0, 3.0)]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<double>")
    for r in df.selectExpr("i", *[f"{f}(v) as {f}" for f in ARRAY_AGGREGATES]).collect():
        known = [x + 0.0 for x in lists[r["i"]] if x is not None]
        top = Counter(known).most_common()
        assert r["mode_of"] == (top[0][0] if top and (len(top) == 1 or top[0][1] > top[1][1]) else None)
        if math.inf not in known:
            spread = statistics.variance(known) if len(known) > 1 else 0.0
            assert r["variance_of"] == pytest.approx(spread) and r["stdev_of"] == pytest.approx(math.sqrt(spread))
        if known:
            s, n = sorted(known), len(known)
            for f, q in (("lower_quartile_of", 1), ("median_of", 2), ("upper_quartile_of", 3)):
                assert r[f] == (s[(n * q + 3) // 4 - 1] + s[n * q // 4]) / 2


def test_array_functions_take_many_values(spark):
    register(spark)
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(99_999)), lambda i: i.cast("double")).alias("v"))
    start = time.time()
    row = df.selectExpr(*[f"{f}(v) as {f}" for f in ARRAY_AGGREGATES]).first()
    assert time.time() - start < 20
    assert row["mode_of"] is None and row["median_of"] == 49_999.5 and row["variance_of"] == pytest.approx(100_000 * 100_001 / 12)


def test_every_registered_name_can_be_called(spark):
    """All names at once, over columns; whole numbers agree with the column form."""
    assert set(register(spark)) == {*SCALARS, *ARRAY_AGGREGATES}
    values = {"DOUBLE": "x", "INT": "3", "BIGINT": "b", "STRING": "s"}
    calls = []
    for name, (params, _, _) in SCALARS.items():
        kinds = [p.split()[1] for p in params.split(",") if p.strip() and "DEFAULT" not in p]
        calls.append(f"{name}({', '.join(values[k] for k in kinds)}) as {name}")
    df = spark.createDataFrame([(0.5, 9007199254740993, "Dry sub"), (None, None, None), (-2.5, -3, "")], "x double, b bigint, s string")
    rows = df.selectExpr(*calls).collect()
    assert len(rows) == 3 and set(rows[0].asDict()) == set(SCALARS)
    assert (rows[0]["ps_floor_whole"], rows[0]["ps_ceil_whole"], rows[0]["square_whole"]) == (9007199254740993, 9007199254740993, None)
    columns = df.select(m.square(F.col("b")).alias("q"), m.sign_whole(F.col("b")).alias("g"), m.floor(F.col("b")).alias("f")).collect()
    assert [(r["q"], r["g"], r["f"]) for r in columns] == [(r["square_whole"], r["ps_sign_whole"], r["ps_floor_whole"]) for r in rows]
