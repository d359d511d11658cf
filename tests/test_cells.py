"""Trees on cells: the same models as Spark's trainers, whole settings in the queries, rows read once, odd rows."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from plotstats.operators import cells, models
from plotstats.plans import training
from plotstats.session import scratch_path

SF = "/root/testdata/sf0.001"
COLS = ["a", "b c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(2000).selectExpr(
        "cast(pmod(hash(id), 20) as double) as a", "cast(pmod(hash(id, 7), 11) as decimal(5, 2)) / 10 as `b c`", "cast(pmod(hash(id, 9), 7) as int) as d",
        "pmod(hash(id, 3), 1000) / 300D as e",
    )
    out = df.selectExpr("*", "a * 0.3D + if(d > 3, 2.0D, 0D) + e as y", "case when a + e < 7 then 'x' when a + d < 16 then 'y' else 'z' end as k").repartition(4).cache()
    out.count()
    return out


def predictions(model, df):
    return [r[0] for r in model.transform(df).select("prediction").collect()]


def error(model, df):
    return model.transform(df).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]


def test_boosted_trees_are_those_of_spark(spark, rows, monkeypatch):
    model = models.train_boost(rows, "y", COLS, by_cell=True, maxIter=8, maxDepth=4)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 100)
    split = models.train_boost(rows, "y", COLS, by_cell=True, maxIter=8, maxDepth=4)
    want = Pipeline(stages=[*models._inputs(COLS), models.gbt_regressor("y", maxIter=8, maxDepth=4)]).fit(rows)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    for found in (model, split, models.load_model(path)):
        assert predictions(found, rows) == pytest.approx(predictions(want, rows))
        assert found.stages[-1].featureImportances.toArray() == pytest.approx(want.stages[-1].featureImportances.toArray())


def test_classes_are_those_of_spark(spark, rows):
    model = models.train_classifier(rows, "k", COLS, maxIter=5, maxDepth=3)
    versus = OneVsRest(classifier=GBTClassifier(maxIter=5, maxDepth=3, stepSize=0.1, seed=42))
    want = Pipeline(stages=[StringIndexer(inputCol="k", outputCol="label", stringOrderType="alphabetAsc"), *models._inputs(COLS), versus]).fit(rows)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    for found in (model, models.load_model(path)):
        assert predictions(found, rows) == predictions(want, rows)


def test_search_is_that_of_spark(spark, rows):
    found = models.grid_search(rows, "y", COLS, {"maxDepth": [2, 3], "stepSize": [0.1, 0.4]}, maxIter=3)
    booster = models.gbt_regressor("y", maxIter=3)
    grid = ParamGridBuilder().addGrid(booster.maxDepth, [2, 3]).addGrid(booster.stepSize, [0.1, 0.4]).build()
    pipeline = Pipeline(stages=[*models._inputs(COLS), booster])
    want = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y", metricName="mae"), numFolds=3, seed=42).fit(rows)
    assert [{p.name: v for p, v in g.items()} for g in found.getEstimatorParamMaps()] == [{p.name: v for p, v in g.items()} for g in grid]
    assert found.avgMetrics == pytest.approx(want.avgMetrics) and found.stdMetrics == pytest.approx(want.stdMetrics)
    assert predictions(found.bestModel, rows) == pytest.approx(predictions(want.bestModel, rows))


def test_forests_draw_rows_and_features(spark, rows, monkeypatch):
    model = models.train_forest(rows, "y", COLS)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 100)
    monkeypatch.setattr(cells, "AT_ONCE", 5000)
    again = models.train_forest(rows, "y", COLS)
    want = [Pipeline(stages=[*models._inputs(COLS), RandomForestRegressor(labelCol="y", numTrees=100, seed=s)]).fit(rows) for s in (1, 2, 3)]
    assert model.stages[-1].getNumTrees == 100
    assert predictions(model, rows) == pytest.approx(predictions(again, rows))
    assert error(model, rows) == pytest.approx(np.mean([error(m, rows) for m in want]), rel=0.05)
    # each tree has about as many rows as there are, each row as often as the Poisson distribution has it
    block = (np.array([5, 9]), np.array([0, 40_000, 60_000]), np.linspace(0, 1, 60_000), np.ones(60_000, "i8"))
    n, y, q = cells._bagged(block, 3)
    assert n.sum() == pytest.approx(60_000, rel=0.02) and y.sum() == pytest.approx(30_000, rel=0.03)
    one = (np.array([5]), np.array([0, 1]), np.array([2.0]), np.array([3_000_000]))
    n, y, q = cells._bagged(one, 3)
    assert n[0] == pytest.approx(3_000_000, rel=0.003) and (y[0], q[0]) == (2 * n[0], 4 * n[0])


def test_rows_are_computed_once(spark, rows):
    for train, label in (
        (lambda df: models.grid_search(df, "y", COLS, {"maxDepth": [1, 2]}, maxIter=2), "y"),
        (lambda df: models.train_boost(df, "y", COLS, by_cell=True, maxIter=2), "y"),
        (lambda df: models.train_forest(df, "y", COLS, trees=2), "y"),
    ):
        reads = spark.sparkContext.accumulator(0)

        def seen(batches, reads=reads):
            for batch in batches:
                reads.add(len(batch))
                yield batch

        train(rows.select(*COLS, label).mapInPandas(seen, rows.select(*COLS, label).schema))
        assert reads.value == 2000


@pytest.mark.parametrize("name, function, trees", [("ml_gbt", "train_boost", 100), ("ml_forest", "train_forest", 100), ("ml_classifier", "train_classifier", 100), ("ml_grid_search", "grid_search", 100)])
def test_queries_train_whole_models(spark, monkeypatch, name, function, trees):
    """As many trees, and as deep ones, as the operators have by default."""
    trained = []
    own = getattr(models, function)
    monkeypatch.setattr(models, function, lambda *args, **more: trained.append(own(*args, **more)) or trained[-1])
    training.QUERIES[name][0](spark, SF).collect()
    last = getattr(trained[0], "bestModel", trained[0]).stages[-1]
    for model in getattr(last, "models", [last]):
        assert model.getNumTrees == trees
        if name != "ml_grid_search":
            assert model.getOrDefault("maxDepth") == 5


def test_many_values_and_missing_ones(spark):
    nan = math.nan
    data = [(float(i * 7919 % 5003), None if i % 5 == 0 else nan if i % 5 == 1 else float(i % 3), 1.0, 1e9 + float(i * 7919 % 5003 > 2500) + 0.1 * (i % 3)) for i in range(5003)]
    df = spark.createDataFrame(data, "x double, m double, c double, y double").repartition(3)
    cuts = cells.cuts_of(df.select("x", "m", "c"), 32)
    assert 28 <= len(cuts[0]) <= 32 and np.abs(np.diff(cuts[0]) - 5003 / 32).max() < 3 and cuts[1].tolist() == [0.5, 1.5] and len(cuts[2]) == 0
    model = models.train_boost(df, "y", ["x", "m", "c"], by_cell=True, maxIter=2)
    got = [(r["prediction"] - 1e9, r["x"]) for r in model.transform(df).collect()]
    assert all(0 <= p <= 1.4 for p, _ in got) and max(p for p, x in got if x < 2300) < min(p for p, x in got if x > 2700)
    # values of a task are thinned out to some that stand for as many rows each
    values, n = cells._fewer(np.arange(10_000.0), np.ones(10_000), 100)
    assert len(values) == 100 and set(n) == {100.0}


def test_labels_must_be_numbers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None)] * 60, "x double, y double")
    for train, more in ((models.train_boost, {"by_cell": True}), (models.train_forest, {})):
        with pytest.raises(Exception, match="(?i)labels must not be null"):
            train(df, "y", ["x"], **more)
        with pytest.raises(Exception):
            train(df.where("x > 5"), "y", ["x"], **more)


def test_too_many_cells_are_left_to_spark(spark, rows, monkeypatch):
    want = predictions(models.train_boost(rows, "y", COLS, by_cell=True, maxIter=2), rows)
    monkeypatch.setattr(cells, "CELLS", 100)
    assert cells.Cells.of(rows, "y", COLS, 32) is None
    assert predictions(models.train_boost(rows, "y", COLS, by_cell=True, maxIter=2), rows) == pytest.approx(want)
    # so are other parameters
    assert models.train_boost(rows, "y", COLS, by_cell=True, maxIter=2, subsamplingRate=0.5).stages[-1].getSubsamplingRate() == 0.5
