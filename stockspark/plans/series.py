"""Forecast comparison over all series: regular weeks, split, forecasts, scores, log records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockspark.operators.accuracy import forecast_record, periods, python_literal, score
from stockspark.operators.changepoints import changepoint_regression
from stockspark.operators.forecasts import chosen_autoregression, naive, seasonal_naive, smoothing
from stockspark.operators.series import (
    DATE,
    KEYS,
    PERIOD,
    TARGET,
    future_dates,
    interpolate_in_time,
    regularise,
    with_minimum_history,
)
from stockspark.operators.splits import split_last_n

MINIMUM_HISTORY = 104
TEST_WEEKS = 52

MODELS: dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, object]]] = {
    "NaiveForecast": (naive, {"method": "last_value"}),
    "SeasonalNaiveForecast": (seasonal_naive, {"seasonal_period": PERIOD, "method": "last_season_value"}),
    "ETS (Best)": (smoothing, {"seasonal_periods": PERIOD, "selection": "pattern_search"}),
    "SARIMA (auto)": (
        chosen_autoregression,
        {"method": "ar_regression", "lags": [1, 2, 3, 4, PERIOD, PERIOD + 1], "selection": "aic"},
    ),
    "Prophet": (changepoint_regression, {"method": "changepoint_regression", "seasonality_mode": "multiplicative"}),
}

# Forecasters that take outside columns, and the argument that names them.
OUTSIDE = {chosen_autoregression: "exogenous", changepoint_regression: "regressors"}


def with_outside(
    models: dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, object]]], columns: Sequence[str]
) -> dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, object]]]:
    """The models, with ``columns`` passed to those that take outside columns."""
    if not columns:
        return models
    return {
        name: (partial(model, **{OUTSIDE[model]: tuple(columns)}), {**params, "exogenous": list(columns)}) if model in OUTSIDE else (model, params)
        for name, (model, params) in models.items()
    }


def weekly_series(
    panel: DataFrame,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    holiday: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Series with enough history, on every week, gaps filled linearly in time."""
    long_enough = with_minimum_history(panel.select(*keys, date, target), MINIMUM_HISTORY, keys)
    filled = interpolate_in_time(regularise(long_enough, [target], keys, date), [target], keys, date)
    return filled if holiday is None else filled.withColumn("IsHoliday", holiday(F.col(date)))


def compare_series(
    series: DataFrame,
    models: dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, object]]] | None = None,
    test_rows: int = TEST_WEEKS,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    exogenous: Sequence[str] = (),
) -> DataFrame:
    """One scored row per series and model; without a forecast, n is 0 and the scores are null.

    ``exogenous`` are columns of ``series`` for the models that take outside columns.
    """
    models = with_outside(MODELS if models is None else models, exogenous)
    split = split_last_n(series, test_rows, keys, date)
    parts = [
        forecast(split).select(*keys, F.lit(name).alias("Model"), date, F.col(target).cast("double").alias(target), "yhat")
        for name, (forecast, _) in models.items()
    ]
    forecasts = reduce(DataFrame.unionByName, parts)
    return score(forecasts, target, "yhat", [*keys, "Model"], {"n": F.count("yhat")})


def future_split(
    series: DataFrame,
    horizon: int,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    holiday: Callable[[Column], Column] | None = None,
    outside: DataFrame | None = None,
    exogenous: Sequence[str] = (),
) -> DataFrame:
    """The whole history as train rows and ``horizon`` future weeks as test rows without a target.

    Every forecaster takes the result as it takes a split. ``exogenous`` columns of future weeks come from ``outside``
    (keys, date, columns); where it has no row they are null.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("int")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(date))
    numeric = [F.col(c).cast("double").alias(c) for c in exogenous]
    known = series.select(*keys, date, F.col(target).cast("double").alias(target), F.lit(False).alias("is_test"), *numeric)
    ahead = future_dates(series, horizon, keys, date).select(
        *keys, date, F.lit(None).cast("double").alias(target), F.lit(True).alias("is_test")
    )
    if exogenous and outside is not None:
        ahead = ahead.join(outside.select(*keys, date, *numeric), [*keys, date], "left")
    elif exogenous:
        ahead = ahead.withColumns({c: F.lit(None).cast("double") for c in exogenous})
    rows = known.unionByName(ahead).withColumns({"row": place, "rows": size})
    return rows if holiday is None else rows.withColumn("IsHoliday", holiday(F.col(date)))


def forecast_ahead(
    series: DataFrame,
    horizon: int = 12,
    models: dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, object]]] | None = None,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    holiday: Callable[[Column], Column] | None = None,
    outside: DataFrame | None = None,
    exogenous: Sequence[str] = (),
) -> DataFrame:
    """Future weeks of every series from every model; ``outside`` has the ``exogenous`` columns of these weeks."""
    split = future_split(series, horizon, keys, target, date, holiday, outside, exogenous)
    parts = [
        forecast(split).select(*keys, F.lit(name).alias("Model"), date, "yhat")
        for name, (forecast, _) in with_outside(MODELS if models is None else models, exogenous).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def series_log(
    series: DataFrame,
    stamp: str,
    models: dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, object]]] | None = None,
    test_rows: int = TEST_WEEKS,
    exogenous: Sequence[str] = (),
) -> DataFrame:
    """Experiment records of ``compare_series``; models that could not be fitted have null scores."""
    models = with_outside(MODELS if models is None else models, exogenous)
    scored = compare_series(series, models, test_rows)
    spans = periods(split_last_n(series, test_rows))
    text = F.lit(None).cast("string")
    for name, (_, params) in models.items():
        text = F.when(F.col("Model") == name, python_literal(params)).otherwise(text)
    return forecast_record(scored.join(spans, list(KEYS)), F.col("Model"), text, stamp)
