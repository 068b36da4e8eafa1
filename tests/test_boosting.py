"""Boosting by histograms against plain loops, against MLlib, and over both kinds of passes."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from stockspark.operators import boosting
from stockspark.operators.boosting import BoostedTrees, fit_boosted

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(4)
    rows = []
    for _ in range(3000):
        a, b, c = draw.random() * 10, draw.randrange(12), draw.gauss(0, 1)
        rows.append((a, b, None if draw.random() < 0.05 else c, 3 * math.sin(a) + b * (a > 5) + (c > 0) + draw.gauss(0, 0.3)))
    return spark.createDataFrame(rows, "a double, b int, c double, y double").repartition(3).cache()


@pytest.mark.parametrize("loss", boosting.LOSSES)
def test_passes_in_a_task_and_as_jobs_grow_the_same_trees(table, loss):
    kind = {"loss": loss, "maxIter": 12 if loss == "squared" else 3, "maxDepth": 3, "subsamplingRate": 1.0, "featureRate": 1.0, "minRows": 5}
    one, many = fit_boosted(table, NAMES, "y", **kind), fit_boosted(table, NAMES, "y", cells=2000, **kind)
    assert len(one.trees) == len(many.trees) == kind["maxIter"]
    for x, y in zip(one.trees, many.trees):
        assert np.array_equal(x.feature, y.feature) and np.allclose(x.cut, y.cut) and np.allclose(x.value, y.value)


def test_first_split_is_the_best_of_all(table):
    model = fit_boosted(table, NAMES, "y", maxIter=1, maxDepth=1, subsamplingRate=1.0, featureRate=1.0, stepSize=1.0, shrink=0.0)
    rows = [tuple(r) for r in table.collect()]
    y = np.array([r[3] for r in rows])
    best = None
    for k, edges in enumerate(boosting.bin_edges(table, NAMES)):
        x = np.array([math.inf if r[k] is None else r[k] for r in rows])
        for cut in edges:
            left = x <= cut
            error = ((y[left] - y[left].mean()) ** 2).sum() + ((y[~left] - y[~left].mean()) ** 2).sum()
            best = min(best or (math.inf,), (error, k, cut, y[left].mean(), y[~left].mean()))
    tree = model.trees[0]
    assert (tree.feature[0], tree.cut[0]) == (best[1], best[2])
    assert model.start + tree.value[1] == pytest.approx(best[3]) and model.start + tree.value[2] == pytest.approx(best[4])


def test_errors_no_worse_than_mllib(table):
    held = F.pmod(F.xxhash64("a"), F.lit(4)) == 0
    train, test = table.where(~held), table.where(held)
    shared = {"maxIter": 60, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.75, "seed": 42}
    packed = VectorAssembler(inputCols=NAMES, outputCol="features", handleInvalid="keep")
    for loss, kind, error in (("squared", "squared", lambda e: F.avg(e * e)), ("absolute", "absolute", lambda e: F.avg(F.abs(e)))):
        ours = fit_boosted(train, NAMES, "y", loss=loss, featureRate=1.0, minRows=5, **shared).transform(test)
        theirs = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="yhat", lossType=kind, **shared)
        filled = lambda df: packed.transform(df.fillna(99.0, ["c"]))
        theirs = theirs.fit(filled(train)).transform(filled(test))
        mine, other = (d.agg(error(F.col("yhat") - F.col("y"))).first()[0] for d in (ours, theirs))
        assert mine <= other * 1.05


def test_median_of_a_sketch():
    draw = np.random.default_rng(2)
    for scale in (1e-3, 1.0, 1e6):
        values = draw.normal(scale / 3, scale, 5001)
        found, n = np.unique(boosting.buckets(values), return_counts=True)
        assert boosting.sketch_median(list(zip(found.tolist(), n.tolist()))) == pytest.approx(np.median(values), rel=0.006)
    assert boosting.buckets(np.array([0.0, 1e-9, -1e-9])).tolist() == [0, 0, 0]
    assert boosting.sketch_median([(0, 5), (3, 1)]) == 0.0 and boosting.sketch_median([]) == 0.0


def test_awkward_tables(spark, tmp_path):
    schema = "a double, b int, c double, y double"
    assert fit_boosted(spark.createDataFrame([], schema), NAMES, "y").transform(spark.createDataFrame([(1.0, 1, 1.0, 1.0)], schema)).first()["yhat"] == 0.0
    flat = spark.createDataFrame([(1.0, 1, None, 4.0)] * 5 + [(1.0, 1, None, None), (float("nan"), None, None, 4.0)], schema)
    model = fit_boosted(flat, NAMES, "y", maxIter=3)
    assert {r["yhat"] for r in model.transform(flat).collect()} == {4.0}
    with pytest.raises(ValueError):
        fit_boosted(flat, NAMES, "y", loss="huber")
    model = fit_boosted(spark.createDataFrame([(float(i), i, None, float(i > 3)) for i in range(9)], schema), NAMES, "y", maxIter=4, maxDepth=2)
    model.save(spark, f"{tmp_path}/model")
    again = BoostedTrees.load(spark, f"{tmp_path}/model")
    assert again.features == model.features and again.start == model.start
    assert all(np.array_equal(x.feature, y.feature) and np.array_equal(x.value, y.value) for x, y in zip(again.trees, model.trees))
