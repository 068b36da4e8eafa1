"""Forecast errors, experiment records and comparisons between models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockspark.functions.families import model_family
from stockspark.operators.profile import box_stats
from stockspark.operators.series import DATE, KEYS

METRICS = ("MAE", "RMSE", "MAPE")
# Parts into which the lookup of the global models is spread.
GLOBAL_SALTS = 32


def error_measures(actual: Column, predicted: Column) -> dict[str, Column]:
    """MAE, RMSE and MAPE in percent; zero actuals are left out of MAPE only."""
    known = actual.isNotNull() & predicted.isNotNull()
    error = F.when(known, actual - predicted)
    relative = F.when(known & (actual != 0), F.abs((actual - predicted) / F.nullif(actual, F.lit(0.0))))
    return {
        "MAE": F.avg(F.abs(error)),
        "RMSE": F.sqrt(F.avg(error * error)),
        "MAPE": F.avg(relative) * F.lit(100.0),
    }


def score(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (*KEYS, "Model"), aggregates: dict[str, Column] | None = None
) -> DataFrame:
    """Error measures per group; partial sums are combined before the shuffle."""
    measures = error_measures(F.col(actual), F.col(predicted))
    extra = aggregates or {}
    return df.groupBy(*by).agg(
        *[column.alias(name) for name, column in measures.items()],
        *[column.alias(name) for name, column in extra.items()],
    )


def align_forecast(
    actuals: DataFrame, forecasts: DataFrame, keys: Sequence[str] = KEYS, date: str = DATE, predicted: str = "yhat"
) -> DataFrame:
    """Every actual with its forecast; a missing forecast counts as 0."""
    joined = actuals.join(forecasts.select(*keys, date, predicted), [*keys, date], "left")
    return joined.withColumn(predicted, F.coalesce(predicted, F.lit(0.0)))


def align_known(
    actuals: DataFrame,
    forecasts: DataFrame,
    keys: Sequence[str] = KEYS,
    date: str = DATE,
    actual: str = "y",
    predicted: str = "yhat",
) -> DataFrame:
    """Only the dates where both the actual and the forecast are known."""
    left = actuals.where(F.col(actual).isNotNull())
    right = forecasts.where(F.col(predicted).isNotNull()).select(*keys, date, predicted)
    return left.join(right, [*keys, date])


def period_label(date: str, rows: Column) -> Column:
    """``'first to last'`` over the rows where ``rows`` holds."""
    inside = F.when(rows, F.col(date))
    return F.concat(F.min(inside).cast("string"), F.lit(" to "), F.max(inside).cast("string"))


def periods(df: DataFrame, keys: Sequence[str] = KEYS, date: str = DATE) -> DataFrame:
    return df.groupBy(*keys).agg(
        period_label(date, ~F.col("is_test")).alias("Train_Period"),
        period_label(date, F.col("is_test")).alias("Test_Period"),
    )


def python_literal(params: dict[str, object]) -> Column:
    """Parameters as dict text, the form the experiment logs use."""
    return F.lit(repr(params))


def forecast_record(
    scored: DataFrame,
    model: Column,
    parameters: Column,
    stamp: str,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a forecast experiment log; the feature columns appear only where given."""
    columns = [
        F.lit(stamp).alias("Timestamp"),
        F.col("Store").cast("int"),
        F.col("Dept").cast("int"),
        model.alias("Model"),
        parameters.alias("Parameters"),
        "Train_Period",
        "Test_Period",
    ]
    if features is not None:
        columns.append(F.lit(len(features)).alias("Features_Count"))
        columns.append(F.lit(repr(list(features))).alias("Features_List_Used"))
    return scored.select(*columns, *METRICS)


def classifier_record(scores: DataFrame, model_name: str, params: dict[str, object], stamp: str) -> DataFrame:
    return scores.select(
        F.lit(stamp).alias("Timestamp"),
        F.lit("RiskCategoryClassifier").alias("Model_Type"),
        F.lit(model_name).alias("Model_Name"),
        python_literal(params).alias("Parameters"),
        F.col("accuracy").alias("Accuracy"),
        F.col("macro_precision").alias("Precision_Macro"),
        F.col("macro_recall").alias("Recall_Macro"),
        F.col("macro_f1").alias("F1_Macro"),
    )


def mean_metrics(logs: DataFrame, by: Sequence[str]) -> DataFrame:
    means = logs.groupBy(*by).agg(*[F.avg(name).alias(name) for name in METRICS])
    return means.orderBy(F.asc_nulls_last("RMSE"), *by)


def local_models(logs: DataFrame) -> DataFrame:
    """Rows that belong to one series: neither global (0) nor unknown (-1)."""
    return logs.where((F.col("Store") > 0) & (F.col("Dept") > 0))


def best_model(logs: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ("Model",)) -> DataFrame:
    """The row with the lowest RMSE of each series, the first in ``order`` on ties.

    An arg-min aggregate combines within tasks before the shuffle, unlike a ranking window.
    """
    known = logs.where(F.col("RMSE").isNotNull())
    rest = [name for name in known.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct("RMSE", *order))
    return known.groupBy(*keys).agg(first.alias("_best")).select(*keys, "_best.*")


def wins(best: DataFrame, family: str = "Model_Family") -> DataFrame:
    return best.groupBy(family).agg(F.count(F.lit(1)).alias("wins")).orderBy(F.desc("wins"), family)


def metric_spread(logs: DataFrame, metric: str = "RMSE", family: str = "Model_Family") -> DataFrame:
    """Box statistics of a metric by family, families ordered by median."""
    return box_stats(logs.where(F.col(metric).isNotNull()), metric, [family]).orderBy("median", family)


def rmse_name(base: Column, rmse: Column) -> Column:
    shown = F.coalesce(F.format_string("%.2f", rmse), F.lit("N/A"))
    return F.concat(base, F.lit(" (RMSE: "), F.when(rmse.isNotNull(), shown).otherwise("N/A"), F.lit(")"))


def with_saved_model(logs: DataFrame, path: str = "model_path") -> DataFrame:
    return logs.where(F.trim(path) != "")


def candidate_models(logs: DataFrame, series: DataFrame) -> DataFrame:
    """Models on offer for each series: its own and the global ones (Store = Dept = 0).

    Each series looks up two keys, its own and the global one, in a single equi-join. Every series
    asks for the global key, so that key is spread over GLOBAL_SALTS by a hash of the series, and the
    few global models are repeated as often.
    """
    key = lambda s, d, salt: F.struct(s.alias("_s"), d.alias("_d"), salt.cast("int").alias("_salt"))
    salts = F.when(
        (F.col("Store") == 0) & (F.col("Dept") == 0), F.sequence(F.lit(0), F.lit(GLOBAL_SALTS - 1))
    ).otherwise(F.array(F.lit(0)))
    saved = with_saved_model(logs).select(
        F.col("Store").alias("_s"), F.col("Dept").alias("_d"), F.explode(salts).alias("_salt"), "Model", "model_path", "RMSE"
    )
    own = key(F.col("Store"), F.col("Dept"), F.lit(0))
    everywhere = key(F.lit(0), F.lit(0), F.pmod(F.hash("Store", "Dept"), F.lit(GLOBAL_SALTS)))
    looked_up = series.select("Store", "Dept", F.inline(F.array(own, everywhere)))
    found = looked_up.join(saved, ["_s", "_d", "_salt"])
    base = F.when(F.col("_s") == 0, F.concat("Model", F.lit(" (Global)"))).otherwise(F.col("Model"))
    named = found.select("Store", "Dept", base.alias("base_name"), "model_path", "RMSE")
    one = named.groupBy("Store", "Dept", "base_name", "model_path").agg(F.min("RMSE").alias("RMSE"))
    return one.withColumn("display_name", rmse_name(F.col("base_name"), F.col("RMSE")))


def actuals_in_period(logs: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales rows inside each logged period: equi-join on the series with a date range.

    ``logs`` carries ``period_start`` and ``period_end``.
    """
    dated = sales.select(F.col("Store").alias("_store"), F.col("Dept").alias("_dept"), "Date", "Weekly_Sales")
    inside = (
        (F.col("Store") == F.col("_store"))
        & (F.col("Dept") == F.col("_dept"))
        & F.col("Date").between(F.col("period_start"), F.col("period_end"))
    )
    return logs.join(dated, inside).drop("_store", "_dept")


def with_family(logs: DataFrame, mapping: str = "page") -> DataFrame:
    return logs.withColumn("Model_Family", model_family(F.col("Model"), mapping))
