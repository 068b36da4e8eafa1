"""Filling, imputing, encoding and aligning panel columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from stockspark.checks import require_columns
from stockspark.operators.profile import describe_categories, long_form
from stockspark.operators.ranks import cuts_below, exact_quantiles
from stockspark.operators.series import DATE, backward_filled, forward_filled
from stockspark.session import materialise

MARKDOWNS = ("MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5")
SLOW_COLUMNS = ("CPI", "Unemployment")
UNKNOWN = "Unknown"
LABEL_RANGES = 256  # a power of two


def zero_fill(df: DataFrame, columns: Sequence[str] = MARKDOWNS) -> DataFrame:
    return df.fillna(0.0, subset=[name for name in columns if name in df.columns])


def fill_by_store(
    df: DataFrame, columns: Sequence[str] = SLOW_COLUMNS, store: str = "Store", date: str = DATE
) -> DataFrame:
    """Forward fill, then backward fill within a store, then the overall median.

    The fill runs on one row per store and date, where the order is unambiguous and which is
    far smaller than the panel, and is joined back on that key. The panel is read several times,
    so it is written once first: whatever built it runs once.
    """
    require_columns(df, [store, date, *columns])
    df = materialise(df, "panel")
    weekly = df.groupBy(store, date).agg(
        *[F.max(name).alias(name) for name in columns], F.count(F.lit(1)).alias("_rows")
    )
    filled = weekly.withColumns({name: forward_filled(name, [store], date) for name in columns})
    filled = filled.withColumns({name: backward_filled(name, [store], date) for name in columns})
    # The medians weigh every panel row, as a median over the filled panel column would; all of
    # them come from one pass.
    long = long_form(filled, columns, ["_rows"])
    medians = exact_quantiles(long, "value", [0.5], ["column"], weight="_rows")
    middle = F.get("quantiles", F.lit(0))
    in_one_row = medians.agg(
        F.struct(*[F.max(F.when(F.col("column") == name, middle)).alias(name) for name in columns])
    ).scalar()
    filled = filled.withColumns({name: F.coalesce(F.col(name), in_one_row[name]) for name in columns}).drop("_rows")
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept).join(filled, [store, date], "left").select(*df.columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def label_codes(df: DataFrame, column: str, code: str, start: int = 0, ranges: int = LABEL_RANGES) -> DataFrame:
    """A dictionary of the distinct labels and their index in sorted order; NULL is no label.

    The labels are cut into ``ranges`` ranges at labels drawn by a hash, numbered inside each range, and moved on by
    the number of labels in the ranges before. No task holds more than a range.
    """
    labels = df.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct()
    # The labels with the smallest hashes are a uniform draw, taken in each task first; they decide balance only.
    drawn = labels.orderBy(F.xxhash64(column), column).limit(ranges - 1)
    cuts = drawn.agg(F.array_sort(F.collect_list(column))).scalar()
    placed = labels.withColumn("_cuts", cuts).select(column, cuts_below(F.col("_cuts"), F.col(column), ranges).alias("_range"))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.agg(F.collect_list(F.struct("_range", "n"))).scalar()
    before = F.aggregate(
        F.filter("_sizes", lambda s: s["_range"] < F.col("_range")), F.lit(0).cast("bigint"), lambda total, s: total + s["n"]
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) + before - F.lit(1 - start)
    return placed.withColumn("_sizes", sizes).select(column, place.cast("int").alias(code))


def encode_label(df: DataFrame, column: str, code: str, codes: DataFrame | None = None) -> DataFrame:
    """Add the index of each label; labels outside the dictionary give NULL.

    No broadcast hint: the dictionary is broadcast when its measured size allows it.
    """
    codes = label_codes(df, column, code) if codes is None else codes
    return df.join(codes, column, "left")


def fill_values(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Median of each numeric column, mode (smallest on ties) of each other.

    One job over all numeric columns and one over all others; only one value per column comes
    back to the driver.
    """
    require_columns(df, columns)
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, NumericType)]
    other = [c for c in columns if c not in numeric]
    fills: dict[str, object] = {name: 0.0 for name in numeric} | {name: UNKNOWN for name in other}
    if numeric:
        medians = exact_quantiles(long_form(df, numeric), "value", [0.5], ["column"])
        fills.update({row["column"]: row["quantiles"][0] for row in medians.collect()})
    if other:
        fills.update({row["column"]: row["top"] for row in describe_categories(df, other).collect()})
    return fills


def impute(df: DataFrame, columns: Sequence[str], reference: DataFrame | None = None) -> DataFrame:
    """Fill NULLs with the median or mode taken from ``reference`` (default: ``df`` itself)."""
    fills = fill_values(df if reference is None else reference, columns)
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(fill)) for name, fill in fills.items()})


def align_features(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """Columns in the order of ``features``; missing ones are zero."""
    return [
        F.col(name).cast("double").alias(name) if name in df.columns else F.lit(0.0).alias(name)
        for name in features
    ]


def min_max_by_series(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    is_train: Column,
) -> DataFrame:
    """Scale to 0-1 with the range of each series' train rows; constant columns give 0.

    The range is a window over the series, so no join back is needed. Adds ``<name>_scaled``,
    ``<name>_min`` and ``<name>_max``.
    """
    whole = Window.partitionBy(*keys)
    ranges = {}
    for name in columns:
        ranges[f"{name}_min"] = F.min(F.when(is_train, F.col(name))).over(whole)
        ranges[f"{name}_max"] = F.max(F.when(is_train, F.col(name))).over(whole)
    df = df.withColumns(ranges)
    return df.withColumns(
        {f"{name}_scaled": scaled(F.col(name), F.col(f"{name}_min"), F.col(f"{name}_max")) for name in columns}
    )


def scaled(value: Column, low: Column, high: Column) -> Column:
    """A constant range has width one, so its own value maps to 0."""
    return (value - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low)


def unscaled(value: Column, low: Column, high: Column) -> Column:
    return value * F.when(high == low, F.lit(1.0)).otherwise(high - low) + low
