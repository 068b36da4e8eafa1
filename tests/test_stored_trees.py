"""Pooled models are stored by the comparison, found by their logged path, and score the same again."""

import datetime

import pytest
from pyspark.sql import functions as F

from stockspark.operators.trees import KINDS
from stockspark.plans.regression import compare_trees, rescore_stored

SMALL = {
    KINDS[0]: {"numTrees": 4, "maxDepth": 4, "minInstancesPerNode": 2},
    KINDS[1]: {"maxIter": 4, "maxDepth": 3},
    KINDS[2]: {"maxIter": 4, "maxDepth": 3},
}


@pytest.fixture(scope="module")
def panel(spark):
    start = datetime.date(2020, 1, 3)
    rows = [
        (store, 1, start + datetime.timedelta(weeks=w), float(100 * store + 10 * (w % 13)), "AB"[store % 2], float(w % 13))
        for store in (1, 2, 3)
        for w in range(130)
    ]
    return spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double, Type string, season double")


def test_loaded_models_score_as_logged(spark, panel, tmp_path):
    log = compare_trees(panel, SMALL, "2025-01-01 00:00:00", save_to=str(tmp_path))
    found = {r["Model"]: r for r in rescore_stored(panel, log).collect()}
    assert set(found) == set(KINDS)
    for row in found.values():
        assert row["model_path"].startswith(str(tmp_path))
        for name in ("MAE", "RMSE", "MAPE"):
            assert row[name] == pytest.approx(row[f"{name}_again"], rel=1e-9)


def test_records_without_a_path_have_no_row(spark, panel):
    log = spark.createDataFrame(
        [("t", "a", "{'maxIter': 4}", 1.0, 1.0, None), ("t", "b", "{'model_path': ' '}", 1.0, None, 1.0)],
        "Timestamp string, Model string, Parameters string, MAE double, RMSE double, MAPE double",
    )
    found = rescore_stored(panel, log)
    assert found.count() == 0 and found.columns == ["Timestamp", "Model", "model_path", "MAE", "RMSE", "MAPE", "MAE_again", "RMSE_again", "MAPE_again"]
    assert rescore_stored(panel, log.where(F.lit(False))).count() == 0
