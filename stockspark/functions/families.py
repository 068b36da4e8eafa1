"""Model family from the model name, in the two label sets in use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockspark.checks import require_choice

# Fixed values: (needles in the lower-cased name, label); the first hit wins.
PAGE_FAMILIES = (
    (("naive",), "Baseline Naive"),
    (("ets",), "ETS"),
    (("sarima",), "SARIMA"),
    (("prophet",), "Prophet"),
    (("randomforest", "random_forest"), "Random Forest"),
    (("xgboost",), "XGBoost"),
    (("lightgbm", "lgbm"), "LightGBM"),
    (("lstm",), "LSTM"),
    (("dummy",), "Dummy/Test"),
)
PAGE_OTHER, PAGE_BLANK = "Other Classical", "Unknown"

# Fixed values: (needle in the name as written, label); the first hit wins.
NOTEBOOK_FAMILIES = (
    (("Naive",), "Naive Baselines"),
    (("ETS",), "ETS"),
    (("SARIMA",), "SARIMA"),
    (("Prophet",), "Prophet"),
    (("RandomForest",), "RandomForest"),
    (("XGBoost",), "XGBoost"),
    (("LightGBM",), "LightGBM"),
    (("LSTM",), "LSTM"),
)
NOTEBOOK_OTHER = "Other"


def model_family(model: Column, mapping: str = "page") -> Column:
    require_choice(mapping, ("page", "notebook"), "mapping")
    if mapping == "page":
        rules, name, other = PAGE_FAMILIES, F.lower(model), PAGE_OTHER
        label = F.when(F.coalesce(F.trim(model), F.lit("")) == "", PAGE_BLANK)
    else:
        rules, name, other = NOTEBOOK_FAMILIES, F.coalesce(model, F.lit("")), NOTEBOOK_OTHER
        label = None
    for needles, family in rules:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | name.contains(needle)
        label = F.when(hit, family) if label is None else label.when(hit, family)
    return label.otherwise(other)
