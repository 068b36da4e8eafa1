"""Frequent keys found by a mergeable sketch, and a join that spreads them in proportion to their frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINE = 4
TRACKED = 10_000
MOST_TRACKED = 1_000_000


def hot_keys(facts: DataFrame, column: str, present: Column | None = None, parts: int | None = None, fine: int = FINE) -> DataFrame:
    """``column`` and ``salts`` of the values with more rows than an even share of ``fine * parts`` shares.

    Each task keeps a frequent-items sketch of bounded size; the sketches are merged, so no row is moved.
    There are at most ``fine * parts`` such values. ``salts`` is the number of even shares a value fills.
    Counts are estimates and decide the balance only, never a result. Rows without a value, or where
    ``present`` is not true, do not count; an empty table has no hot key. ``parts`` defaults to the
    number of shuffle partitions.
    """
    spark = facts.sparkSession
    shares = fine * max(1, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    # An estimate is off by at most about 3.5 / tracked of all rows, so a share must be well above that.
    tracked = min(MOST_TRACKED, max(TRACKED, 8 * shares))
    shares = min(shares, tracked // 8)
    counted = facts.select(F.when(F.lit(True) if present is None else present, F.col(column)).alias("_key"))
    found = counted.agg(F.count("_key").alias("_total"), F.expr(f"approx_top_k(_key, {shares}, {tracked})").alias("_top"))
    each = found.select("_total", F.inline("_top")).where(F.col("item").isNotNull())
    filled = F.ceil(F.col("count") * F.lit(shares) / F.col("_total")).cast("int")
    return each.where(F.col("count") * F.lit(shares) > F.col("_total")).select(F.col("item").alias(column), filled.alias("salts"))


def spread_join(facts: DataFrame, lookup: DataFrame, column: str, spread: str, hot: DataFrame) -> DataFrame:
    """Inner join of many rows with one or few rows a key; keys of ``hot`` are dealt over their salts.

    The rows of a hot key are divided by a hash of ``spread``, and its rows of ``lookup`` are repeated once
    for each salt; all other keys have one salt and are not repeated. ``hot`` is bounded by ``hot_keys``,
    whatever the size of the tables, and is broadcast.
    """
    salts = F.broadcast(hot.select(column, F.col("salts").alias("_salts")))
    count = F.coalesce(F.col("_salts"), F.lit(1))
    # The coalesce states that a salt is never NULL; a NULL check on it would be pushed below the
    # facts' own exchange and keep that from being reused.
    salt = F.coalesce(F.pmod(F.xxhash64(spread), count).cast("int"), F.lit(0))
    left = facts.join(salts, column, "left").withColumn("_salt", salt).drop("_salts")
    right = lookup.join(salts, column, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1))).drop("_salts")
    return left.join(right, [column, "_salt"]).drop("_salt")
