"""The registered tree models are those of the operator."""

from stockspark.catalog import forecasting
from stockspark.operators.trees import BOOSTED, FOREST, KINDS


def test_registered_with_the_default_settings(monkeypatch):
    seen = []
    monkeypatch.setattr(forecasting.inputs, "featured", lambda *a: None)
    monkeypatch.setattr(forecasting, "compare_trees", lambda featured, configs, stamp: seen.append(configs))
    forecasting.pooled_trees(None, "")
    assert seen == [{KINDS[0]: FOREST, KINDS[1]: BOOSTED, KINDS[2]: BOOSTED}]
