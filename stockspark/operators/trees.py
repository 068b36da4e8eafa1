"""Pooled tree regressors: a random forest from MLlib, and boosting by histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame

from stockspark.checks import require_choice
from stockspark.operators.boosting import BoostedTrees, fit_boosted
from stockspark.session import shared_folder

# Tuned settings of the three pooled models.
FOREST = {"numTrees": 150, "maxDepth": 15, "minInstancesPerNode": 15, "featureSubsetStrategy": "0.6", "seed": 42}
BOOSTED = {"maxIter": 250, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.75, "featureRate": 0.75, "seed": 42}
# Rows remember their nodes, so that the trees are not sent with every pass; the results are the same.
FOREST_PASSES = {"maxMemoryInMB": 256, "cacheNodeIds": True}

KINDS = ("RandomForestRegressor", "GradientBoostingRegressor", "AbsoluteLossBoostingRegressor")


def fit_trees(train: DataFrame, features: Sequence[str], label: str, kind: str, **settings) -> PipelineModel | BoostedTrees:
    require_choice(kind, KINDS, "kind")
    if kind == KINDS[0]:
        shared_folder(train.sparkSession)  # for the checkpoints of the node ids
        assembler = VectorAssembler(inputCols=list(features), outputCol="features")
        columns = {"featuresCol": "features", "labelCol": label, "predictionCol": "yhat"}
        forest = RandomForestRegressor(**columns, **{**FOREST_PASSES, **FOREST, **settings})
        return Pipeline(stages=[assembler, forest]).fit(train)
    kinds = {KINDS[1]: {"loss": "squared"}, KINDS[2]: {"loss": "absolute", "minRows": 20}}
    return fit_boosted(train, features, label, **{**kinds[kind], **BOOSTED, **settings})


def predict(model: PipelineModel | BoostedTrees, rows: DataFrame) -> DataFrame:
    """``rows`` with a column yhat."""
    found = model.transform(rows)
    return found.drop("features") if isinstance(model, PipelineModel) else found
