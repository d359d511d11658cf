"""What one task is given does not grow with the table."""

import re

import pytest
from pyspark.sql import functions as F

from plotstats.operators import boosting
from plotstats.operators.aggregates import grouped_stats
from plotstats.operators.plot_stats import monthly_min_max_med, monthly_stats, pixel_runs, plot_stats, stats_of_runs
from plotstats.operators.skew import placed_by, tasks_for
from plotstats.operators.indices import SEASONAL_INDICES
from plotstats.plans import incremental, training
from plotstats.schemas import SEASONAL_STATS
from plotstats.streaming import fetch

BANDS = ["B4", "B5", "B8"]


@pytest.fixture
def few_values(spark):
    """A task sorts ten values."""
    spark.conf.set("plotstats.task.values", "10")
    yield
    spark.conf.unset("plotstats.task.values")


def observations(spark, rows=600):
    values = [F.expr(f"cast(id * {7 + i} % 101 as int)").alias(b) for i, b in enumerate(("B2", "B3", "B4", "B5", "B8"))]
    return spark.range(rows).select(
        (F.col("id") % 40).alias("id"), (F.col("id") % 3 + 0.5).alias("longitude"), F.lit(1.5).alias("latitude"),
        (F.lit(800_000_000) + F.col("id") * 86400).alias("time"), *values, (F.col("id") % 3 + 3).cast("int").alias("SCL"),
        F.lit(None).cast("double").alias("MSK_CLDPRB"), F.lit(0.0).alias("MSK_SNWPRB"), F.lit(False).alias("HAS_CLOUDFLAG"),
    )


def test_partitions_grow_with_the_values(spark, few_values):
    rows = spark.range(100)
    assert tasks_for(spark, 80) is None
    assert tasks_for(spark, 205) == 21
    assert placed_by(rows, ["id"], 205).rdd.getNumPartitions() == 21
    assert grouped_stats(rows.withColumn("x", F.col("id")), ["id"], {"m": ("median", "x")}).rdd.getNumPartitions() == 10


def parts(df):
    """Tasks of the exchange of the rows, from the plan."""
    return [int(n) for n in re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]


def test_two_levels_take_as_many_tasks_as_values_need(spark, few_values):
    obs = observations(spark)
    for df, measures in (
        (plot_stats(obs, "1990-01-01", "2030-01-01", BANDS), len(BANDS) + 1),
        (monthly_min_max_med(monthly_stats(obs, bands=["B4"])), 5),
    ):
        assert max(parts(df)) >= 600 * (measures - 1) // 10
    runs = pixel_runs(obs, BANDS, SEASONAL_INDICES, True)
    assert max(parts(stats_of_runs(runs, obs, BANDS, SEASONAL_INDICES, SEASONAL_STATS, "veg_share"))) > 100


def test_more_tasks_give_the_same_statistics(spark):
    obs = observations(spark)
    one = plot_stats(obs, "1990-01-01", "2030-01-01", BANDS).orderBy("id").collect()
    spark.conf.set("plotstats.task.values", "10")
    try:
        many = plot_stats(obs, "1990-01-01", "2030-01-01", BANDS).orderBy("id").collect()
    finally:
        spark.conf.unset("plotstats.task.values")
    assert one == many and len(one) == 40


def test_raw_files_grow_with_the_rows_and_batches_do_not(spark, monkeypatch):
    monkeypatch.setattr(incremental, "raw_observations", lambda spark, sf_dir: observations(spark).withColumns({c: F.lit(0) for c in ("QA10", "QA20", "QA60")}))
    path, schema, per_batch = incremental._raw_files(spark, "", 4)
    assert per_batch == 2
    monkeypatch.setattr(incremental, "FILE_ROWS", 100)
    path, schema, per_batch = incremental._raw_files(spark, "", 4)
    stored = spark.read.schema(schema).parquet(path)
    assert len(stored.inputFiles()) == 6 and per_batch == 3 and stored.count() == 600


def test_training_partitions_grow_with_the_rows(spark, monkeypatch, tmp_path):
    spark.range(300).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "cast(id % 7 as int) as l_linenumber", "cast(id % 50 as double) as l_quantity",
        "0.1D as l_discount", "0.2D as l_tax", "cast(id as double) as l_extendedprice",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(training, "MODEL_ROWS", 10)
    train, test = training._model_rows(spark, str(tmp_path))
    assert train.rdd.getNumPartitions() == 30
    assert train.count() + test.count() == 300


def test_boosting_computes_its_rows_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.range(400).selectExpr("cast(id % 20 as double) as `a b`", "cast(id % 20 * 2 as double) as y", "1.0D as w").mapInPandas(seen, "`a b` double, y double, w double")
    model = boosting.train_huber(df, "y", ["a b"], "w", trees=2, min_rows=5)
    assert reads.value == 400
    assert model.features == ["a b"] and len(model.trees) == 2
    assert boosting.first_split(df, "y", ["a b"], min_rows=5).first()["feature"] == "a b"


def test_very_many_points_take_a_bounded_number_of_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fetch, "CHUNK", 2)
    monkeypatch.setattr(fetch, "MOST_BATCHES", 3)
    points = spark.range(30).selectExpr("id as point", "id + 100 as id")
    raw = observations(spark).select("id", "longitude", "latitude", "time", "B4").withColumns({c: F.lit(0).cast("bigint") for c in ("QA10", "QA20", "QA60")})

    def answer(point):
        nan = float("nan")
        return [{"longitude": 1, "latitude": 2.5, "time": 1000, "B4": 3.0, "QA10": 0, "QA60": nan}, {"longitude": None, "latitude": 2.5}]

    target, log, state = (f"{tmp_path}/{n}" for n in ("observations", "log", "state"))
    fetch.fetch_points(spark, points, answer, raw.schema, target, log, state, tasks=2)
    assert spark.read.parquet(log).select("batch").distinct().count() == 3
    rows = spark.read.parquet(target).collect()
    assert len(rows) == 60 and {r["longitude"] for r in rows} == {1.0, None} and {r["B4"] for r in rows} == {3, None}
