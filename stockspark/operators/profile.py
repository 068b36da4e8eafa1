"""Column profiles, distributions and relations of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from stockspark.operators.ranks import exact_quantiles

SAMPLE_ROWS = 5000
SAMPLE_SEED = 42
MAPE_QUANTILE = 0.98
MAPE_FLOOR = 100.0
MAPE_LIMIT = 200.0
TOP_CATEGORIES = 20


def totals_by(df: DataFrame, by: Sequence[str], value: str, name: str = "total") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(name))


def top_groups(df: DataFrame, by: Sequence[str], value: str, k: int = 1) -> DataFrame:
    return totals_by(df, by, value).orderBy(F.desc("total"), *by).limit(k)


def value_counts(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Count and percent of each value. The total is a scalar over the counts, not a global window."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.round(F.lit(100.0) * F.col("count") / total, digits))


def top_categories(df: DataFrame, column: str, k: int = TOP_CATEGORIES, mean_of: str | None = None) -> DataFrame:
    """The ``k`` most frequent values, or the ``k`` with the highest mean of ``mean_of``."""
    measure = F.count(F.lit(1)) if mean_of is None else F.avg(mean_of)
    name = "count" if mean_of is None else "mean"
    grouped = df.where(F.col(column).isNotNull()).groupBy(column).agg(measure.alias(name))
    return grouped.orderBy(F.desc_nulls_last(name), F.asc(column)).limit(k)


def column_profile(df: DataFrame) -> DataFrame:
    """Non-null and null counts, null percent and type of each column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(field.name).alias("column"),
                    F.lit(field.dataType.simpleString()).alias("dtype"),
                    F.count(field.name).alias("non_null"),
                )
                for field in df.schema
            ]
        ).alias("_columns"),
    )
    long = counts.select("_rows", F.inline("_columns"))
    nulls = F.col("_rows") - F.col("non_null")
    share = F.when(F.col("_rows") > 0, F.lit(100.0) * nulls / F.col("_rows")).otherwise(0.0)
    return long.select("column", "dtype", "non_null", nulls.alias("nulls"), share.alias("null_percent"))


def missing_summary(df: DataFrame) -> DataFrame:
    found = column_profile(df).where(F.col("nulls") > 0)
    return found.orderBy(F.desc("nulls"), "column")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per row and column: ``by``, ``column``, ``value``."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*by, F.inline(F.array(*pairs)))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max of each numeric column; count 0 and NULLs for an empty one.

    All but the quartiles come from one pass that gives one row a task; only the quartiles need the values
    by column.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    long = long_form(df, columns)

    def measures(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    stats = df.agg(F.array(*[measures(c) for c in columns]).alias("_s")).select(F.inline("_s"))
    quartiles = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column"])
    return stats.join(quartiles, "column", "left").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.get("quantiles", F.lit(0)).alias("q25"),
        F.get("quantiles", F.lit(1)).alias("q50"),
        F.get("quantiles", F.lit(2)).alias("q75"),
        "max",
    )


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (smallest on ties) and its frequency."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col("value")))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best["value"].alias("top"),
        (-best["minus"]).alias("freq"),
    )


def describe_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, min, quartiles and max of date columns, in days since 1970-01-01."""
    wanted = [c for c in columns if isinstance(df.schema[c].dataType, (DateType, TimestampType, TimestampNTZType))]
    days = df.select(*[F.unix_date(F.to_date(c)).alias(c) for c in wanted])
    return describe_numeric(days, wanted).drop("std")


def skewness(value: Column) -> Column:
    """Bias-corrected sample skewness (adjusted Fisher-Pearson)."""
    n = F.count(value).cast("double")
    # A constant column has no spread: its skewness and kurtosis count as 0.
    return F.when(n > 2, F.coalesce(F.skewness(value), F.lit(0.0)) * F.sqrt(n * (n - 1)) / (n - 2))


def excess_kurtosis(value: Column) -> Column:
    """Bias-corrected sample excess kurtosis."""
    n = F.count(value).cast("double")
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6)
    return F.when(n > 3, F.coalesce(corrected, F.lit(0.0)))


def shifted_log(df: DataFrame, column: str) -> Column:
    """log(1+y), after a shift by the overall minimum where that is not positive."""
    low = df.agg(F.min(column)).scalar()
    value = F.col(column)
    return F.when(low <= 0, F.log1p(value - low + 1)).otherwise(F.log1p(value))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins from min to max; the last bin is closed. Empty bins stay."""
    value = F.col(column).cast("double")
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    width = (edges["hi"] - edges["lo"]) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((value - edges["lo"]) / width), F.lit(bins - 1))).otherwise(0)
    counts = df.where(value.isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (edges["lo"] + F.col("bin") * width).alias("left_edge"),
        (edges["lo"] + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, IQR, whiskers (1.5 IQR, clipped to the data) and outlier count per group."""
    by = list(by)
    rows = df.select(*by, F.col(column).cast("double").alias("_y")).where(F.col("_y").isNotNull())
    counted = rows.groupBy(*by, "_y").agg(F.count(F.lit(1)).alias("_n"))
    quartiles = exact_quantiles(counted, "_y", [0.25, 0.5, 0.75], by, weight="_n")
    if by:
        joined = counted.join(quartiles.withColumnRenamed("quantiles", "_q"), by)
    else:
        joined = counted.withColumn("_q", quartiles.scalar())
    q1, median, q3 = (F.get("_q", F.lit(i)) for i in range(3))
    joined = joined.select(*by, "_y", "_n", q1.alias("q1"), median.alias("median"), q3.alias("q3"))
    joined = joined.withColumn("iqr", F.col("q3") - F.col("q1"))
    reach = F.lit(1.5) * F.col("iqr")
    inside = F.col("_y").between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(*by).agg(
        F.sum("_n").alias("count"),
        *[F.max(name).alias(name) for name in ("q1", "median", "q3", "iqr")],
        F.min(F.when(inside, F.col("_y"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_y"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).cast("bigint").alias("outliers"),
    )


def negative_audit(df: DataFrame, column: str) -> DataFrame:
    negatives = F.count_if(F.col(column) < 0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        negatives.alias("negatives"),
        F.try_divide(F.lit(100.0) * negatives, F.count(F.lit(1))).alias("percent"),
    )


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation with the target and the least-squares line, per feature, in one pass."""
    rows = []
    for name in features:
        both = F.col(name).isNotNull() & F.col(target).isNotNull()
        x = F.when(both, F.col(name).cast("double"))
        y = F.when(both, F.col(target).cast("double"))
        # NULL for a column without spread.
        pearson = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        rows.append(
            F.struct(
                F.lit(name).alias("feature"),
                pearson.alias("pearson"),
                F.regr_slope(y, x).alias("slope"),
                F.regr_intercept(y, x).alias("intercept"),
            )
        )
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def seeded_sample(df: DataFrame, keys: Sequence[str], rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    """At most ``rows`` rows, chosen by a digest of the seed and the keys: the same rows on every run."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))
    return df.orderBy(order, *keys).limit(rows)


def cap_by_quantile(df: DataFrame, column: str, q: float = MAPE_QUANTILE, floor: float = MAPE_FLOOR) -> DataFrame:
    """Rows up to the larger of the ``q`` quantile and ``floor``."""
    cut = exact_quantiles(df, column, [q]).select(F.get("quantiles", F.lit(0))).scalar()
    return df.where(F.col(column) <= F.greatest(cut, F.lit(floor)))


def below_or_all(df: DataFrame, column: str, limit: float = MAPE_LIMIT) -> DataFrame:
    """Rows below ``limit``; all rows where none is."""
    some = df.agg(F.count_if(F.col(column) < limit)).scalar()
    return df.where((F.col(column) < limit) | (some == 0))


def enough_for_training(df: DataFrame, label: str, rows: int = 10, classes: int = 2) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(label).alias("classes"))
    return counted.withColumn("enough", (F.col("rows") >= rows) & (F.col("classes") >= classes))
