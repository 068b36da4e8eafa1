"""Shared inputs of the registered queries.

The weekly panel is built once per session and table folder and kept as a Parquet table in the
shared folder, the way a pipeline hands its panel from one job to the next. It is far smaller
than the line items behind it. The queries that cover the derivation itself start from the raw
tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType

from stockspark.functions.calendar import is_holiday_week
from stockspark.functions.coerce import stable_round
from stockspark.operators.forecasts import fourier_regression, naive, seasonal_naive, smoothing
from stockspark.plans import derived
from stockspark.plans.panel import clean, engineer, merge
from stockspark.plans.series import series_log, weekly_series
from stockspark.session import materialise

STAMP = "2025-01-01 00:00:00"
DIGITS = 4

_built: dict[tuple[str, str, tuple, str], DataFrame] = {}


def file_state(spark: SparkSession, sf_dir: str) -> tuple[tuple[str, int, int], ...]:
    """Name, change time and length of the table files, so that a changed table is derived anew."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in found))


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, file_state(spark, sf_dir), name)
    if key not in _built:
        _built[key] = materialise(build(), name)
    return _built[key]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "sales", lambda: derived.sales(spark, sf_dir))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        return merge(sales(spark, sf_dir), derived.stores(spark, sf_dir), derived.features(spark, sf_dir))

    return once(spark, sf_dir, "merged", build)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "cleaned", lambda: clean(merged(spark, sf_dir)))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "featured", lambda: engineer(cleaned(spark, sf_dir)))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regular, interpolated weekly series with at least two years of history."""
    return once(spark, sf_dir, "weekly", lambda: weekly_series(sales(spark, sf_dir), holiday=is_holiday_week))


def trend_only(split: DataFrame) -> DataFrame:
    return fourier_regression(split, holiday=None, harmonics=0, ridge=0.0)


def level_only(split: DataFrame) -> DataFrame:
    """The level alone, with weights from the grid, for series with enough history."""
    return smoothing(split, configs=[(None, None, False)], rounds=0).where("status = 'fitted'")


# Forecasters whose results SQL can state as well, under names of their own.
PLAIN_MODELS = {
    "NaiveForecast": (naive, {"method": "last_value"}),
    "SeasonalNaiveForecast": (seasonal_naive, {"seasonal_period": 52, "method": "last_season_value"}),
    "level_smoothing": (level_only, {"trend": None, "seasonal": None, "damped_trend": False}),
    "log_trend": (trend_only, {"yearly_seasonality": False, "holidays_df_provided_to_model": False}),
}


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The experiment log of PLAIN_MODELS on all series, as written by the comparison job."""
    return once(spark, sf_dir, "log", lambda: series_log(weekly(spark, sf_dir), STAMP, PLAIN_MODELS))


def shown(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded and dates as text, for comparison between engines."""
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            value = stable_round(value, digits)
        elif isinstance(field.dataType, DateType):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)
