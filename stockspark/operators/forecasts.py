"""Forecasters that treat every series in one plan.

Input rows come from a split: they carry ``keys``, ``Date``, the target, ``row``, ``rows`` and
``is_test``. Output rows are the test rows with a ``yhat`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockspark.operators.leastsquares import fitted, grouped_choice, grouped_ridge
from stockspark.operators.series import DATE, KEYS, PERIOD, TARGET, future_dates
from stockspark.operators.smoothing import ALPHAS, BETAS, DAMPING, GAMMAS, SMOOTHING_CONFIGS, smoothing
from stockspark.session import by_series

__all__ = [
    "ALPHAS", "BETAS", "DAMPING", "GAMMAS", "SMOOTHING_CONFIGS", "ahead_naive", "ahead_seasonal_naive", "ar_regression",
    "chosen_autoregression", "fourier_regression", "naive", "seasonal_naive", "smoothing",
]


def naive(split: DataFrame, keys: Sequence[str] = KEYS, target: str = TARGET, date: str = DATE) -> DataFrame:
    """The last train value, repeated."""
    whole = Window.partitionBy(*keys)
    last = F.max_by(F.when(~F.col("is_test"), F.col(target)), F.when(~F.col("is_test"), F.col(date))).over(whole)
    return split.withColumn("yhat", last).where(F.col("is_test"))


def seasonal_naive(
    split: DataFrame,
    period: int = PERIOD,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
) -> DataFrame:
    """The value of the same phase of the last train season, repeated for any number of test rows.

    NULL if train is shorter than a season. The last season of a series is an array of ``period``
    values that its test rows look up by phase.
    """
    whole = Window.partitionBy(*keys)
    train = F.count_if(~F.col("is_test")).over(whole)
    last = F.when(
        ~F.col("is_test") & (F.col("row") > F.col("_train") - F.lit(period)),
        F.struct(F.col("row").alias("row"), F.col(target).alias("value")),
    )
    work = split.withColumn("_train", train).withColumn("_season", F.sort_array(F.collect_list(last).over(whole)))
    phase = ((F.col("row") - F.col("_train") - 1) % F.lit(period)).cast("int")
    shown = F.when(F.col("_train") >= period, F.get(F.col("_season"), phase)["value"])
    return work.withColumn("yhat", shown).where(F.col("is_test")).drop("_train", "_season")


def ahead_naive(
    df: DataFrame, horizon: int = 12, keys: Sequence[str] = KEYS, target: str = TARGET, date: str = DATE
) -> DataFrame:
    """Future weeks with the last known value."""
    last = df.groupBy(*keys).agg(F.max_by(target, date).alias("yhat"))
    return future_dates(df, horizon, keys, date).join(last, list(keys))


def ahead_seasonal_naive(
    df: DataFrame,
    horizon: int = 12,
    period: int = PERIOD,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
) -> DataFrame:
    """Future weeks with the value of the same phase of the last season."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))
    tail = df.select(*keys, back.alias("_back"), F.col(target).alias("yhat")).where(F.col("_back") <= period)
    tail = tail.withColumn("_phase", F.lit(period) - F.col("_back"))
    full = tail.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    full = full.where(F.col("_n") == period).select(*keys, "_phase", "yhat")
    steps = future_dates(df, horizon, keys, date).withColumn("_phase", (F.col("step") - 1) % F.lit(period))
    return steps.join(full, [*keys, "_phase"]).select(*keys, "step", date, "yhat")


def ar_regression(
    split: DataFrame,
    exogenous: Sequence[str] = (),
    period: int = PERIOD,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    ridge: float = 1e-4,
    lags: Sequence[int] | None = None,
    choose: bool = False,
) -> DataFrame:
    """Autoregression on ``lags`` (1, 2 and one season if not given), with exogenous columns, per series.

    With ``choose`` each series takes the set of lags with the lowest Akaike criterion; all sets are judged on the
    train rows that have every lag. Test rows are forecast recursively: each step feeds on the forecasts before
    it. A missing outside value counts as 0. Every test row stays: ``status`` is "fitted", or "too short" where the
    train rows do not determine the coefficients or lack the longest lag; yhat and lags are null then.
    """
    order = Window.partitionBy(*keys).orderBy(date)
    lags = sorted({1, 2, period} if lags is None else set(lags))
    longest = lags[-1]
    columns = {f"_lag{k}": k for k in lags}
    known = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exogenous}
    split = split.withColumns(known) if known else split
    lagged = split.withColumns({name: F.lag(target, k).over(order) for name, k in columns.items()})
    train = lagged.where(~F.col("is_test"))
    if choose:
        models = grouped_choice(train, keys, target, exogenous, list(columns), ridge)
    else:
        models = grouped_ridge(train, keys, target, [*columns, *exogenous], ridge)
    models = models.where(F.col("n") > len(lags) + len(exogenous) + 1).select(*keys, "beta")

    # The longest lag before the first test row and the test rows: at most a few hundred per series.
    train_rows = F.count_if(~F.col("is_test")).over(Window.partitionBy(*keys))
    recent = split.withColumn("_t", train_rows).where(F.col("row") > F.col("_t") - longest)
    outside = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exogenous]).cast("array<double>")
    packed = by_series(recent, keys).groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.when(~F.col("is_test"), F.struct(F.col(date).alias("d"), F.col(target).cast("double").alias("y"))))
        ).alias("_past"),
        F.sort_array(
            F.collect_list(
                F.when(F.col("is_test"), F.struct(F.col(date).alias("d"), F.col(target).cast("double").alias("y"), outside.alias("x")))
            )
        ).alias("_ahead"),
    )
    joined = packed.join(models, list(keys), "left")
    beta = F.col("beta")

    def step(state: Column, row: Column) -> Column:
        past = state["past"]
        value = F.get(beta, F.lit(0))
        for place, lag in enumerate(lags, start=1):
            value = value + F.get(beta, F.lit(place)) * F.get(past, F.lit(longest - lag))
        for place in range(len(exogenous)):
            value = value + F.get(beta, F.lit(1 + len(lags) + place)) * F.get(row["x"], F.lit(place))
        made = F.transform(
            F.array(value),
            lambda v: F.struct(
                F.concat(F.slice(past, 2, longest - 1), F.array(v)).alias("past"),
                F.concat(state["out"], F.array(F.struct(row["d"].alias("d"), row["y"].alias("y"), v.alias("yhat")))).alias("out"),
            ),
        )
        return F.get(made, F.lit(0))

    day = split.schema[date].dataType.simpleString()
    empty = F.array().cast(f"array<struct<d:{day},y:double,yhat:double>>")
    start = F.struct(F.transform("_past", lambda p: p["y"]).alias("past"), empty.alias("out"))
    usable = beta.isNotNull() & (F.size("_past") == longest)
    out = F.when(usable, F.aggregate("_ahead", start, step, lambda state: state["out"])).otherwise(
        F.transform("_ahead", lambda r: F.struct(r["d"].alias("d"), r["y"].alias("y"), F.lit(None).cast("double").alias("yhat")))
    )
    taken = F.array_compact(F.array(*[F.when(F.get(beta, F.lit(k)) != 0, F.lit(lag)) for k, lag in enumerate(lags, start=1)]))
    status = F.when(usable, F.lit("fitted")).otherwise(F.lit("too short"))
    rows = joined.select(*keys, status.alias("status"), F.when(usable, taken).alias("lags"), F.inline(out))
    return rows.select(*keys, F.col("d").alias(date), F.col("y").alias(target), "yhat", "status", "lags")


def chosen_autoregression(split: DataFrame, exogenous: Sequence[str] = (), period: int = PERIOD, **kind) -> DataFrame:
    """``ar_regression`` with lags chosen among the last four, the season and the one before it."""
    return ar_regression(split, exogenous, period, lags=(1, 2, 3, 4, period, period + 1), choose=True, **kind)


def fourier_columns(date: str, harmonics: int) -> dict[str, Column]:
    """Yearly sine and cosine pairs by day."""
    angle = F.unix_date(F.col(date)).cast("double") * F.lit(2.0) * F.pi() / F.lit(365.25)
    columns = {}
    for k in range(1, harmonics + 1):
        columns[f"_sin{k}"] = F.sin(angle * F.lit(float(k)))
        columns[f"_cos{k}"] = F.cos(angle * F.lit(float(k)))
    return columns


def fourier_terms(
    regressors: Sequence[str], holiday: str | None, harmonics: int, target: str, date: str
) -> tuple[dict[str, Column], list[str]]:
    """The columns of the regression (years first) and their names; ``_log`` is the target's logarithm."""
    added = {"_years": (F.unix_date(F.col(date)) - F.lit(9131)).cast("double") / F.lit(365.25), **fourier_columns(date, harmonics)}
    if holiday:
        added["_holiday"] = F.coalesce(F.col(holiday).cast("double"), F.lit(0.0))
    for name in regressors:
        added[f"_x_{name}"] = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    features = list(added)
    added["_log"] = F.when(F.col(target) > 0, F.log(F.col(target).cast("double")))
    return added, features


def fourier_regression(
    split: DataFrame,
    regressors: Sequence[str] = (),
    holiday: str | None = "IsHoliday",
    harmonics: int = 3,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    ridge: float = 1e-3,
) -> DataFrame:
    """Trend, yearly season, holidays and regressors acting multiplicatively, per series.

    The logarithm of the target is regressed; train rows that are not positive are left out.
    """
    added, features = fourier_terms(regressors, holiday, harmonics, target, date)
    rows = split.withColumns(added)
    models = grouped_ridge(rows.where(~F.col("is_test")), keys, "_log", features, ridge)
    tests = rows.where(F.col("is_test")).join(models.select(*keys, "beta"), list(keys))
    return tests.select(*keys, date, target, F.exp(fitted(F.col("beta"), features)).alias("yhat"))
