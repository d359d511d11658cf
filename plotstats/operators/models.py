"""Training and applying models with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.operators.cells import Cells, Growth, spark_model
from plotstats.operators.prep import category_stages

# Parameters that trees on cells know; with others, categories or weights Spark trains on the rows.
TREE_PARAMS = {"maxDepth", "minInstancesPerNode", "minInfoGain", "maxBins"}
BOOST_PARAMS = TREE_PARAMS | {"maxIter", "stepSize", "lossType"}


def _inputs(cols: Sequence[str], categories: Sequence[str] = ()) -> list:
    """Stages that gather the features: numbers as they are, categories as sparse vectors."""
    vectors = [f"{c}_vector" for c in categories]
    return [*category_stages(categories), VectorAssembler(inputCols=[*cols, *vectors], outputCol="features", handleInvalid="keep")]


def _cells(estimator, params, known: set[str], train: DataFrame, label: str, cols: Sequence[str], parts: int = 1) -> Cells | None:
    """The rows by cell, if an estimator with these parameters can be trained on them."""
    numbers = all(isinstance(train.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in (*cols, label))
    if not (set(params) <= known and numbers and cols):
        return None
    # Spark checks the values
    estimator._transfer_params_to_java()
    return Cells.of(train, label, cols, estimator.getMaxBins(), parts)


def _growth(trees, **more) -> Growth:
    return Growth(trees.getMaxDepth(), trees.getMinInstancesPerNode(), trees.getMinInfoGain(), **more)


def _boosting(booster: GBTRegressor, without: int | None = None) -> dict:
    return {"growth": _growth(booster), "trees": booster.getMaxIter(), "rate": booster.getStepSize(), "without": without}


def gbt_regressor(label: str, weight: str | None = None, **params) -> GBTRegressor:
    """Boosted trees on the absolute error. Defaults follow the usual configuration at small depth."""
    settings = {"lossType": "absolute", "maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "minInstancesPerNode": 50}
    settings.update(params)
    model = GBTRegressor(labelCol=label, featuresCol="features", seed=42, **settings)
    return model.setWeightCol(weight) if weight else model


def train_boost(
    train: DataFrame, label: str, cols: Sequence[str], weight: str | None = None, categories: Sequence[str] = (), by_cell: bool = False, **params
) -> PipelineModel:
    """`by_cell`: trained on cells where that can be done, with bins cut by all rows instead of Spark's sample."""
    booster = gbt_regressor(label, weight, **params)
    plain = by_cell and weight is None and not categories and booster.getLossType() == "absolute"
    cells = _cells(booster, params, BOOST_PARAMS, train, label, cols) if plain else None
    if cells is None:
        return Pipeline(stages=[*_inputs(cols, categories), booster]).fit(train)
    try:
        ((trees, _),) = cells.boost_absolute([_boosting(booster)])
    finally:
        cells.close()
    return PipelineModel([*_inputs(cols), spark_model(train.sparkSession, booster, trees, len(cols), booster.getStepSize())])


def train_forest(train: DataFrame, label: str, cols: Sequence[str], trees: int = 100, categories: Sequence[str] = (), **params) -> PipelineModel:
    forest = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, seed=42, **params)
    # a single tree has all rows and looks at all features
    cells = _cells(forest, params, TREE_PARAMS, train, label, cols) if trees > 1 and not categories else None
    if cells is None:
        return Pipeline(stages=[*_inputs(cols, categories), forest]).fit(train)
    try:
        grown = cells.forest(_growth(forest, looked_at=-(-len(cols) // 3), draw=np.random.default_rng(42)), trees)
    finally:
        cells.close()
    return PipelineModel([*_inputs(cols), spark_model(train.sparkSession, forest, grown, len(cols))])


def train_classifier(train: DataFrame, label: str, cols: Sequence[str], categories: Sequence[str] = (), **params) -> PipelineModel:
    """Boosted trees per class against the rest, for a text label such as the land use category."""
    settings = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5}
    settings.update(params)
    booster = GBTClassifier(featuresCol="features", seed=42, **settings)
    index = StringIndexer(inputCol=label, outputCol="label", handleInvalid="error", stringOrderType="alphabetAsc")
    versus = OneVsRest(classifier=booster, featuresCol="features", labelCol="label")
    if categories or not set(params) <= BOOST_PARAMS - {"lossType"}:
        return Pipeline(stages=[index, *_inputs(cols, categories), versus]).fit(train)
    indexed = index.fit(train)
    cells = _cells(booster, params, BOOST_PARAMS, indexed.transform(train), "label", cols)
    if cells is None:
        return Pipeline(stages=[indexed, *_inputs(cols), versus]).fit(train)
    try:
        classes = cells.boost_classes(_growth(booster), booster.getMaxIter(), booster.getStepSize())
    finally:
        cells.close()
    found = [spark_model(train.sparkSession, booster, trees, len(cols), booster.getStepSize()) for trees in classes]
    return PipelineModel([indexed, *_inputs(cols), versus._copyValues(OneVsRestModel(models=found))])


def grid_search(
    train: DataFrame,
    label: str,
    cols: Sequence[str],
    grid: Mapping[str, Sequence],
    folds: int = 3,
    parallelism: int = 4,
    **params,
) -> CrossValidatorModel:
    """Cross-validated search over parameters of the boosted trees, by mean absolute error."""
    booster = gbt_regressor(label, **params)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(booster.getParam(name), list(values))
    search = CrossValidator(
        estimator=Pipeline(stages=[*_inputs(cols), booster]),
        estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="mae"),
        numFolds=folds,
        parallelism=parallelism,
        seed=42,
    )
    # one table of cells serves all combinations, so their bins are the same
    plain = booster.getLossType() == "absolute" and set(grid) <= BOOST_PARAMS - {"maxBins", "lossType"}
    cells = _cells(booster, params, BOOST_PARAMS, train, label, cols, folds) if plain else None
    if cells is None:
        return search.fit(train)
    tried = [booster.copy(combination) for combination in search.getEstimatorParamMaps()]
    try:
        for one in tried:
            one._transfer_params_to_java()
        # all combinations and folds grow side by side
        fitted = cells.boost_absolute([_boosting(one, fold) for fold in range(folds) for one in tried])
        scores = cells.errors([(i // len(tried), reached) for i, (_, reached) in enumerate(fitted)])
        by_fold = [scores[i : i + len(tried)] for i in range(0, len(scores), len(tried))]
        means, spread = CrossValidator._gen_avg_and_std_metrics(by_fold)
        best = tried[int(np.argmin(means))]
        ((trees, _),) = cells.boost_absolute([_boosting(best)])
    finally:
        cells.close()
    model = PipelineModel([*_inputs(cols), spark_model(train.sparkSession, best, trees, len(cols), best.getStepSize())])
    return search._copyValues(CrossValidatorModel(model, means, None, spread))


def search_results(found: CrossValidatorModel) -> list[dict]:
    """Mean score of every tried combination."""
    return [
        {**{p.name: v for p, v in tried.items()}, "mae": score}
        for tried, score in zip(found.getEstimatorParamMaps(), found.avgMetrics)
    ]


def importances(model: PipelineModel, cols: Sequence[str], df: DataFrame, categories: Sequence[str] = ()) -> DataFrame:
    """One row per feature, most important first; a category has the sum of its levels."""
    spark = df.sparkSession
    scores = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(cols, scores)]
    at = len(cols)
    levels = {s.getInputCol(): len(s.labels) for s in model.stages if isinstance(s, StringIndexerModel)}
    for c in categories:
        rows.append((c, float(scores[at : at + levels[c]].sum())))
        at += levels[c]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
