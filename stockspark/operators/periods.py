"""Sums over date periods by prefix sums: two look-ups a period instead of one joined row for each week in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AMOUNT = "decimal(28,6)"
WIDE = "decimal(38,6)"


def period_totals(
    logs: DataFrame, sales: DataFrame, keys: Sequence[str] = ("Store", "Dept"), value: str = "Weekly_Sales", date: str = "Date"
) -> DataFrame:
    """``logs`` with ``n_rows``, ``n_values`` and ``total`` of the sales inside period_start to period_end, both included.

    Sales and the two ends of every different period of a series meet in one exchange on ``keys``; a running
    sum over the dates of a series, which the calendar bounds, is read at both ends and subtracted. Rows
    grow with logs plus sales, not with the length of the periods.

    Sums are decimals, so no digits are lost by the subtraction. Rows without a key, a bound or a sale, and
    periods that end before they start, get 0, 0 and a NULL total; repeated rows stay and get the same
    figures; ``n_values`` leaves NULL amounts out.
    """
    keys = list(keys)
    period = [*keys, "_lo", "_hi"]
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    known = logs.select(*keys, F.col("period_start").cast("date").alias("_lo"), F.col("period_end").cast("date").alias("_hi"))
    known = known.where((F.col("_lo") <= F.col("_hi"))).distinct()
    nothing = {"_v": F.lit(None).cast(AMOUNT), "_one": F.lit(0), "_of": F.lit(None).cast("struct<lo:date,hi:date,sign:int>")}
    # On one date the start of a period comes before the sales and its end after them.
    ends = F.array(
        F.struct(F.col("_lo").alias("_at"), F.lit(0).alias("_place"), F.lit(-1).alias("sign")),
        F.struct(F.col("_hi").alias("_at"), F.lit(2).alias("_place"), F.lit(1).alias("sign")),
    )
    probes = known.select(*period, F.inline(ends)).select(
        *keys, "_at", "_place", nothing["_v"].alias("_v"), nothing["_one"].alias("_one"),
        F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "sign").alias("_of"),
    )
    rows = sales.select(
        *keys, F.col(date).cast("date").alias("_at"), F.lit(1).alias("_place"), F.col(value).cast(AMOUNT).alias("_v"),
        F.lit(1).alias("_one"), nothing["_of"].alias("_of"),
    ).where(F.col("_at").isNotNull())
    line = rows.unionByName(probes)
    for k in keys:
        line = line.where(F.col(k).isNotNull())
    upto = Window.partitionBy(*keys).orderBy("_at", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = line.select(
        *keys, "_of",
        F.sum("_one").over(upto).alias("_rows"),
        F.count("_v").over(upto).alias("_values"),
        F.coalesce(F.sum("_v").over(upto).cast(WIDE), F.lit(0).cast(WIDE)).alias("_sum"),
    ).where(F.col("_of").isNotNull())
    sign = F.col("_of.sign")
    found = sums.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_of.lo").alias("_lo"), F.col("_of.hi").alias("_hi")).agg(
        F.sum(sign * F.col("_rows")).alias("n_rows"),
        F.sum(sign * F.col("_values")).alias("n_values"),
        F.sum(F.when(sign > 0, F.col("_sum")).otherwise(-F.col("_sum"))).cast(WIDE).alias("_total"),
    )
    same = (F.col("period_start").cast("date") == F.col("_lo")) & (F.col("period_end").cast("date") == F.col("_hi"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    joined = logs.join(found, same, "left")
    return joined.select(
        *logs.columns,
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_values", F.lit(0)).alias("n_values"),
        F.when(F.col("n_values") > 0, F.col("_total")).alias("total"),
    )
