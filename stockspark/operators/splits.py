"""Train and test splits. Each marks rows with ``is_test`` so that one plan serves both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockspark.operators.ranks import values_at_ranks
from stockspark.operators.series import DATE, KEYS


def split_by_date(df: DataFrame, weeks: int = 52, date: str = DATE) -> DataFrame:
    """Test rows are those later than the overall last date minus ``weeks`` weeks."""
    last = df.agg(F.max(date)).scalar()
    return df.withColumn("is_test", F.col(date) > F.date_sub(last, 7 * weeks))


def _placed(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(date)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumns({"row": F.row_number().over(order), "rows": size.cast("int")})


def split_last_n(df: DataFrame, n: int = 52, keys: Sequence[str] = KEYS, date: str = DATE) -> DataFrame:
    """The last ``n`` rows of each series are its test rows; series of up to ``n`` rows are left out.

    ``row`` and ``rows`` (position and length) stay in the result for the forecasters.
    """
    placed = _placed(df, keys, date).where(F.col("rows") > n)
    return placed.withColumn("is_test", F.col("row") > F.col("rows") - n)


def split_ratio(
    df: DataFrame,
    share: float = 0.2,
    sequence_length: int = 12,
    keys: Sequence[str] = KEYS,
    date: str = DATE,
) -> DataFrame:
    """The last ``int(rows * share)`` rows are test rows; series too short for sequences are left out."""
    placed = _placed(df, keys, date).withColumn("_test", F.floor(F.col("rows") * F.lit(share)).cast("int"))
    train = F.col("rows") - F.col("_test")
    fit = placed.where((train >= 2 * sequence_length) & (F.col("_test") >= 1))
    return fit.withColumn("is_test", F.col("row") > train).drop("_test")


def split_stratified(df: DataFrame, label: str, key: str, share: float = 0.25, seed: int = 42) -> DataFrame:
    """``ceil(share * n)`` rows of each label are test rows, chosen by a digest of seed and ``key``.

    The cut is the exact rank of the digest's first 60 bits within the label, found without ordering a whole
    label in one task.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    hashed = df.withColumn("_h", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"))
    cuts = values_at_ranks(
        hashed, "_h", lambda total: F.array(F.ceil(F.lit(share) * total) - 1), by=[label]
    ).select(F.col(label).alias("_label"), F.col("value").alias("_cut"))
    marked = hashed.join(cuts, F.col(label).eqNullSafe(F.col("_label")), "left")
    return marked.withColumn("is_test", F.col("_h") <= F.col("_cut")).drop("_h", "_cut", "_label")
