"""From raw tables to the cleaned and the featured panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockspark.checks import require_columns
from stockspark.functions.calendar import calendar_parts, cyclic_parts
from stockspark.operators.cleaning import fill_by_store, zero_fill
from stockspark.operators.profile import missing_summary
from stockspark.operators.series import ALL_STATS, DATE, KEYS, LAGS, TARGET, WINDOWS, lag_columns, rolling_columns

FEATURE_KEYS = ("Store", "Date", "IsHoliday")
PREFIX = "Sales"


def merge(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Sales with store attributes and weekly features; both joins keep every sales row.

    No broadcast hints: the optimizer broadcasts a side when its size allows it.
    """
    require_columns(sales, ["Store", "Dept", *FEATURE_KEYS])
    return sales.join(stores, "Store", "left").join(features, list(FEATURE_KEYS), "left")


def load_and_merge(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """The same for files, where dates arrive as text."""
    dated = [frame.withColumn(DATE, F.to_date(DATE)) for frame in (sales, features)]
    return merge(dated[0], stores, dated[1])


def clean(panel: DataFrame) -> DataFrame:
    return fill_by_store(zero_fill(panel))


def engineer(
    panel: DataFrame,
    keys: Sequence[str] | None = None,
    target: str = TARGET,
    date: str = DATE,
    stats: Sequence[str] = ALL_STATS,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    prefix: str = PREFIX,
) -> DataFrame:
    """Calendar, lag, rolling and cyclic features and an integer holiday flag.

    Keys not in the panel are ignored; with no keys left, lags and rolling columns are skipped.
    All window columns share one exchange and one sort.
    """
    require_columns(panel, [date, target])
    keys = [name for name in (KEYS if keys is None else keys) if name in panel.columns]
    columns: dict[str, Column] = calendar_parts(F.col(date))
    if keys:
        columns |= lag_columns(keys, target, lags, date, prefix)
        columns |= rolling_columns(keys, target, windows, stats, date, prefix)
    columns |= cyclic_parts(F.col(date))
    if "IsHoliday" in panel.columns:
        columns["IsHoliday"] = F.col("IsHoliday").cast("int")
    return panel.withColumns(columns)


def feature_nulls(featured: DataFrame, source: DataFrame, top: int = 10) -> DataFrame:
    """The generated columns with the most NULLs."""
    made = [name for name in featured.columns if name not in source.columns]
    return missing_summary(featured.select(*made)).limit(top)
