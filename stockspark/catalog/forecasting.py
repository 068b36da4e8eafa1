"""Splits, errors, forecasters and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import pick, query, rounded
from stockspark.functions.calendar import is_holiday_week
from stockspark.operators.accuracy import align_forecast, align_known, periods, score
from stockspark.operators.changepoints import changepoint_regression
from stockspark.operators.forecasts import (
    ahead_naive,
    ahead_seasonal_naive,
    chosen_autoregression,
    fourier_regression,
    naive,
    seasonal_naive,
    smoothing,
)
from stockspark.operators.series import exogenous_frame
from stockspark.operators.splits import split_by_date, split_last_n, split_ratio, split_stratified
from stockspark.operators.trees import BOOSTED, FOREST, KINDS
from stockspark.plans import derived
from stockspark.plans.regression import compare_trees, rescore_stored
from stockspark.plans.series import compare_series, forecast_ahead
from stockspark.session import scratch_path

FORECAST = ("Store", "Dept", "Date", "Weekly_Sales", "yhat")
SPLIT = ("Store", "Dept", "Date", "Weekly_Sales", "is_test")


def by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(split_by_date(inputs.sales(spark, sf_dir)).select(*SPLIT))


def last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(split_last_n(inputs.sales(spark, sf_dir)).select(*SPLIT))


def by_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(split_ratio(inputs.sales(spark, sf_dir)).select(*SPLIT))


def stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each label each side gets; which rows is up to the seeded hash."""
    labelled = derived.news(spark, sf_dir).where(F.col("risk_category").isNotNull())
    split = split_stratified(labelled, "risk_category", "id")
    return split.groupBy("risk_category", "is_test").agg(F.count(F.lit(1)).alias("rows"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods(split_last_n(inputs.weekly(spark, sf_dir)))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_last_n(inputs.weekly(spark, sf_dir))


def _forecast(model):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(model(_split(spark, sf_dir)).select(*FORECAST), 2)

    return run


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecasts = seasonal_naive(_split(spark, sf_dir)).withColumn("Model", F.lit("SeasonalNaiveForecast"))
    return shown(score(forecasts, "Weekly_Sales", "yhat"), 2)


def series_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_series(inputs.weekly(spark, sf_dir), inputs.PLAIN_MODELS)
    return shown(compared.drop("n"), 2)


def series_comparison_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(compare_series(inputs.weekly(spark, sf_dir)), 2)


OUTSIDE = ["Temperature", "Fuel_Price", "CPI", "Unemployment", "MarkDown1"]


def _with_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly series with the regular weeks of the outside columns."""
    known = exogenous_frame(inputs.merged(spark, sf_dir), OUTSIDE)
    return inputs.weekly(spark, sf_dir).join(known, ["Store", "Dept", "Date"], "left")


def series_comparison_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models; autoregression and the Fourier model see the outside columns."""
    series = inputs.once(spark, sf_dir, "weekly_outside", lambda: _with_outside(spark, sf_dir))
    return shown(compare_series(series, exogenous=[c for c in OUTSIDE if c in series.columns]), 2)


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All actuals against forecasts that exist for the test weeks only; the rest count as 0."""
    forecasts = naive(_split(spark, sf_dir))
    return shown(align_forecast(inputs.weekly(spark, sf_dir), forecasts).select(*FORECAST), 2)


def aligned_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed weeks only, where a forecast exists."""
    actuals = inputs.sales(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales")
    return shown(align_known(actuals, naive(_split(spark, sf_dir)), actual="Weekly_Sales"), 2)


def future_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ahead_naive(inputs.weekly(spark, sf_dir)))


def future_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ahead_seasonal_naive(inputs.weekly(spark, sf_dir), 104))


def future_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 12 weeks of every series from all five model kinds."""
    return shown(forecast_ahead(inputs.weekly(spark, sf_dir), holiday=is_holiday_week), 2)


def future_plain_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same path with the two models that repeat known values."""
    plain = {name: inputs.PLAIN_MODELS[name] for name in ("NaiveForecast", "SeasonalNaiveForecast")}
    return shown(forecast_ahead(inputs.weekly(spark, sf_dir), 26, plain))


def pooled_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three pooled tree models with the operator's own settings, scored on the last year."""
    configs = {KINDS[0]: FOREST, KINDS[1]: BOOSTED, KINDS[2]: BOOSTED}
    return compare_trees(inputs.featured(spark, sf_dir), configs, inputs.STAMP)


def stored_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boosted model of the squared loss, stored, found by its logged path, loaded and scored again."""
    featured = inputs.featured(spark, sf_dir)
    log = compare_trees(featured, {KINDS[1]: BOOSTED}, inputs.STAMP, save_to=scratch_path(spark, "trees"))
    return shown(rescore_stored(featured, log).drop("model_path"))


# The regression of ``fourier_regression``: sums of products scaled to a unit diagonal, a ridge on all but the intercept,
# and elimination column by column. The last column of a row is the right side.
_SIZE = 9
_waves = ", ".join(f"{f}(a * {k}.0::DOUBLE)" for k in (1, 2, 3) for f in ("sin", "cos"))
_fourier = {
    "terms": f"""SELECT Store, Dept, Date, Weekly_Sales, is_test,
        [1.0::DOUBLE, y, {_waves}, CAST(IsHoliday AS DOUBLE)] AS x, CASE WHEN Weekly_Sales > 0 THEN ln(Weekly_Sales) END AS v
        FROM (SELECT *, (Date - DATE '1995-01-01') / 365.25::DOUBLE AS y, (Date - DATE '1970-01-01')::DOUBLE * 2.0 * pi() / 365.25::DOUBLE AS a FROM lastn)""",
    "sums": f"""SELECT Store, Dept, i, j, sum(list_append(x, v)[i] * list_append(x, v)[j]) AS g
        FROM terms, range(1, {_SIZE + 1}) r(i), range(1, {_SIZE + 2}) c(j) WHERE NOT is_test AND v IS NOT NULL GROUP BY ALL""",
    "norms": "SELECT Store, Dept, i, CASE WHEN g > 0 THEN sqrt(g) ELSE 1.0 END AS s FROM sums WHERE i = j",
    "cells": f"""SELECT Store, Dept, i, j, g / p.s / coalesce(q.s, 1.0) + CASE WHEN i = j AND i > 1 THEN 0.001::DOUBLE ELSE 0.0 END AS g, p.s
        FROM sums JOIN norms p USING (Store, Dept, i) LEFT JOIN (SELECT Store, Dept, i AS j, s FROM norms) q USING (Store, Dept, j)""",
    "matrices": """SELECT Store, Dept, list(line ORDER BY i) AS m, list(s ORDER BY i) AS s
        FROM (SELECT Store, Dept, i, list(g ORDER BY j) AS line, max(s) AS s FROM cells GROUP BY Store, Dept, i) GROUP BY Store, Dept""",
    "solved": f"""WITH RECURSIVE run AS (
            SELECT Store, Dept, s, 0 AS step, m FROM matrices
            UNION ALL
            SELECT Store, Dept, s, step + 1, list_transform(m, lambda line, i: list_transform(line, lambda value, j:
                CASE WHEN i = step + 1 THEN value / top[step + 1] ELSE value - line[step + 1] * top[j] / top[step + 1] END))
            FROM (SELECT *, m[step + 1] AS top FROM run WHERE step < {_SIZE}))
        SELECT Store, Dept, list_transform(m, lambda line, i: line[{_SIZE + 1}] / s[i]) AS beta FROM run WHERE step = {_SIZE}""",
    "fourier": """SELECT Store, Dept, Date, Weekly_Sales, exp(list_sum(list_transform(x, lambda value, i: value * beta[i]))) AS yhat
        FROM terms JOIN solved USING (Store, Dept) WHERE is_test""",
}

# The choice of ``chosen_autoregression``: every set of lags is a bit mask, solved by elimination of its columns; the last
# row and column belong to the target, so what is left in their corner is the residual sum.
_LAGS = (1, 2, 3, 4, 52, 53)
_WIDTH = len(_LAGS) + 2
_auto = {
    "shifted": f"""SELECT Store, Dept, Date, Weekly_Sales, is_test, n_train, rn, {', '.join(f'lag(Weekly_Sales, {k}) OVER w AS l{k}' for k in _LAGS)}
        FROM lastn WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date)""",
    "known": f"""SELECT Store, Dept, [1.0::DOUBLE, {', '.join(f'l{k}' for k in _LAGS)}, Weekly_Sales] AS z
        FROM shifted WHERE NOT is_test AND l{_LAGS[-1]} IS NOT NULL""",
    "sums": f"""SELECT Store, Dept, i, j, count(*) AS rows, sum(z[i] * z[j]) AS g
        FROM known, range(1, {_WIDTH + 1}) r(i), range(1, {_WIDTH + 1}) c(j) GROUP BY ALL""",
    "norms": f"SELECT Store, Dept, i, CASE WHEN i < {_WIDTH} AND g > 0 THEN sqrt(g) ELSE 1.0 END AS s FROM sums WHERE i = j",
    "cells": f"""SELECT Store, Dept, i, j, rows, p.s,
        g / p.s / q.s + CASE WHEN i = j AND i > 1 AND i < {_WIDTH} THEN 0.0001::DOUBLE ELSE 0.0 END AS g
        FROM sums JOIN norms p USING (Store, Dept, i) JOIN (SELECT Store, Dept, i AS j, s FROM norms) q USING (Store, Dept, j)""",
    "matrices": """SELECT Store, Dept, max(rows) AS rows, list(line ORDER BY i) AS m, list(s ORDER BY i) AS s
        FROM (SELECT Store, Dept, i, max(rows) AS rows, list(g ORDER BY j) AS line, max(s) AS s FROM cells GROUP BY Store, Dept, i) GROUP BY Store, Dept""",
    "sets": f"""WITH RECURSIVE run AS (
            SELECT Store, Dept, rows, s, mask, 0 AS step, m FROM matrices, range({2 ** len(_LAGS)}) r(mask)
            UNION ALL
            SELECT Store, Dept, rows, s, mask, step + 1, CASE WHEN NOT taken THEN m ELSE
                list_transform(m, lambda line, i: list_transform(line, lambda value, j:
                    CASE WHEN i = step + 1 THEN value / top[step + 1] ELSE value - line[step + 1] * top[j] / top[step + 1] END)) END
            FROM (SELECT *, m[step + 1] AS top, step = 0 OR (mask >> (step - 1)) & 1 = 1 AS taken FROM run WHERE step < {_WIDTH - 1}))
        SELECT Store, Dept, rows, rows * ln(m[{_WIDTH}][{_WIDTH}] / rows) + 2 * (1 + bit_count(mask)) AS aic,
            list_transform(range(1, {_WIDTH}), lambda i: CASE WHEN i = 1 OR (mask >> (i - 2)) & 1 = 1 THEN m[i][{_WIDTH}] / s[i] ELSE 0.0 END) AS beta
        FROM run WHERE step = {_WIDTH - 1}""",
    "chosen": f"SELECT Store, Dept, arg_min(beta, aic) AS beta FROM sets WHERE rows >= {_WIDTH} GROUP BY Store, Dept",
    "ahead": f"""WITH RECURSIVE run AS (
            SELECT Store, Dept, 0 AS step, beta, past FROM chosen JOIN
                (SELECT Store, Dept, list(Weekly_Sales ORDER BY Date) AS past FROM lastn WHERE NOT is_test GROUP BY Store, Dept) USING (Store, Dept)
            WHERE len(past) >= {_LAGS[-1]}
            UNION ALL
            SELECT Store, Dept, step + 1, beta,
                list_append(past, beta[1] + {' + '.join(f'beta[{at}] * past[-{k}]' for at, k in enumerate(_LAGS, start=2))})
            FROM run WHERE step < 52)
        SELECT Store, Dept, step, past[-1] AS yhat FROM run WHERE step > 0""",
    "auto": """SELECT l.Store, l.Dept, l.Date, l.Weekly_Sales, a.yhat FROM lastn l
        LEFT JOIN ahead a ON a.Store = l.Store AND a.Dept = l.Dept AND a.step = l.rn - l.n_train WHERE l.is_test""",
}

_split_pick = pick("Store Dept is_test", "Date", "Weekly_Sales")
_forecast_pick = pick("Store Dept", "Date", "Weekly_Sales yhat", 2)

ENTRIES = {
    "split_by_date": (
        by_date,
        query(f"SELECT {_split_pick} FROM (SELECT *, Date > (SELECT max(Date) - 364 FROM sales) AS is_test FROM sales)", "sales"),
    ),
    "split_last_rows": (
        last_rows,
        query(
            f"""SELECT {_split_pick} FROM (SELECT *, rn > n - 52 AS is_test FROM (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS rn,
            count(*) OVER (PARTITION BY Store, Dept) AS n FROM sales) WHERE n > 52)""",
            "sales",
        ),
    ),
    "split_by_ratio": (
        by_ratio,
        query(
            f"""SELECT {_split_pick} FROM (SELECT *, rn > n - t AS is_test FROM (SELECT *, CAST(floor(n * 0.2) AS BIGINT) AS t FROM
            (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS rn, count(*) OVER (PARTITION BY Store, Dept) AS n FROM sales))
            WHERE n - t >= 24 AND t >= 1)""",
            "sales",
        ),
    ),
    "split_stratified": (
        stratified,
        query(
            """SELECT risk_category, is_test, CASE WHEN is_test THEN t ELSE n - t END AS rows
            FROM (SELECT risk_category, count(*) AS n, CAST(ceil(0.25 * count(*)) AS BIGINT) AS t FROM news WHERE risk_category IS NOT NULL GROUP BY 1),
            (VALUES (true), (false)) s(is_test) WHERE CASE WHEN is_test THEN t ELSE n - t END > 0""",
            "news",
        ),
    ),
    "train_test_periods": (
        spans,
        query(
            """SELECT Store, Dept, CAST(train_lo AS VARCHAR) || ' to ' || CAST(train_hi AS VARCHAR) AS Train_Period,
            CAST(test_lo AS VARCHAR) || ' to ' || CAST(test_hi AS VARCHAR) AS Test_Period FROM spans""",
            "spans",
        ),
    ),
    "forecast_naive": (_forecast(naive), query(f"SELECT {_forecast_pick} FROM naive", "naive")),
    "forecast_seasonal_naive": (_forecast(seasonal_naive), query(f"SELECT {_forecast_pick} FROM snaive", "snaive")),
    "forecast_level": (_forecast(inputs.level_only), query(f"SELECT {_forecast_pick} FROM ets", "ets")),
    "forecast_trend": (_forecast(inputs.trend_only), query(f"SELECT {_forecast_pick} FROM trend", "trend")),
    "forecast_smoothing": (_forecast(smoothing), None),
    "forecast_autoregressive": (_forecast(chosen_autoregression), query(f"SELECT {_forecast_pick} FROM auto", "lastn", extra=_auto)),
    "forecast_fourier": (_forecast(fourier_regression), query(f"SELECT {_forecast_pick} FROM fourier", "lastn", extra=_fourier)),
    "forecast_changepoints": (_forecast(changepoint_regression), None),
    "forecast_errors": (
        errors,
        query(f"SELECT {pick('Store Dept Model', '', 'MAE RMSE MAPE', 2)} FROM scored WHERE Model = 'SeasonalNaiveForecast'", "scored"),
    ),
    "series_comparison": (series_comparison, query(f"SELECT {pick('Store Dept Model', '', 'MAE RMSE MAPE', 2)} FROM scored", "scored")),
    "series_comparison_full": (series_comparison_full, None),
    "series_comparison_outside": (series_comparison_outside, None),
    "aligned_forecast": (
        aligned,
        query(
            f"""SELECT {_forecast_pick} FROM (SELECT Store, Dept, Date, Weekly_Sales, CASE WHEN n > 52 AND rn > n - 52 THEN last_train ELSE 0.0 END AS yhat
            FROM (SELECT *, max(CASE WHEN rn = n - 52 THEN Weekly_Sales END) OVER (PARTITION BY Store, Dept) AS last_train FROM placed))""",
            "placed",
        ),
    ),
    "aligned_known": (
        aligned_known,
        query(
            f"""SELECT {_forecast_pick} FROM (SELECT s.Store, s.Dept, s.Date, s.Weekly_Sales, f.yhat
            FROM sales s JOIN naive f ON s.Store = f.Store AND s.Dept = f.Dept AND s.Date = f.Date)""",
            "sales", "naive",
        ),
    ),
    "future_naive": (
        future_naive,
        query(
            f"""SELECT Store, Dept, CAST(k AS INTEGER) AS step, CAST(hi + CAST(7 * k AS INTEGER) AS VARCHAR) AS Date, {rounded('y')} AS yhat
            FROM (SELECT Store, Dept, max(Date) AS hi, arg_max(Weekly_Sales, Date) AS y FROM weekly GROUP BY Store, Dept), range(1, 13) r(k)""",
            "weekly",
        ),
    ),
    "future_seasonal_naive": (
        future_seasonal,
        query(
            f"""SELECT Store, Dept, CAST(k AS INTEGER) AS step, CAST(hi + CAST(7 * k AS INTEGER) AS VARCHAR) AS Date, {rounded('y[(k - 1) % 52 + 1]')} AS yhat
            FROM (SELECT Store, Dept, hi, y, unnest(range(1, 105)) AS k FROM (
                SELECT Store, Dept, max(Date) AS hi, list(Weekly_Sales ORDER BY Date) FILTER (WHERE rn > n - 52) AS y
                FROM placed WHERE n >= 52 GROUP BY Store, Dept))""",
            "placed",
        ),
    ),
    "future_models": (future_models, None),
    "future_plain_models": (
        future_plain_models,
        query(
            f"""SELECT t.Store, t.Dept, 'NaiveForecast' AS Model, CAST(t.Date + CAST(7 * k AS INTEGER) AS VARCHAR) AS Date, {rounded('t.Weekly_Sales')} AS yhat
            FROM placed t, range(1, 27) r(k) WHERE t.rn = t.n
            UNION ALL SELECT t.Store, t.Dept, 'SeasonalNaiveForecast', CAST(t.Date + CAST(7 * k AS INTEGER) AS VARCHAR), {rounded('p.Weekly_Sales')}
            FROM placed t, range(1, 27) r(k), placed p WHERE t.rn = t.n AND p.Store = t.Store AND p.Dept = t.Dept AND p.rn = t.n - 52 + k""",
            "placed",
        ),
    ),
    "pooled_trees": (pooled_trees, None),
    "stored_trees": (stored_trees, None),
}
