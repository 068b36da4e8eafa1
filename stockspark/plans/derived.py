"""The engine's input tables, derived from an order-processing schema.

Sales panel: line items by supplier nation (Store), part type (Dept) and week. Store and
feature tables: suppliers, orders and customers by nation. News: documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.functions.calendar import friday_on_or_after, is_holiday_week
from stockspark.operators.cleaning import MARKDOWNS, label_codes

# Order priorities behind MarkDown1 to MarkDown5.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STORE_TYPES = ("A", "B", "C")
# Risk category by (quality, toxic) label.
LABEL_CATEGORIES = {
    (1, 0): "Positive Supplier News",
    (0, 0): "Market Volatility",
    (1, 1): "Labor Dispute",
    (0, 1): "Cybersecurity Attack",
}
NEWS_START = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _units(amount: Column, scale: int) -> Column:
    """An amount as whole units, so that sums are exact in any order."""
    return F.round(amount * F.lit(float(scale))).cast("bigint")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, Dept, Date, Weekly_Sales, Units, IsHoliday: one row per series and week."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        friday_on_or_after(F.col("l_shipdate")).alias("Date"),
        (_units(F.col("l_extendedprice"), 100) * (F.lit(100) - _units(F.col("l_discount"), 100))).alias("_amount"),
        "l_quantity",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    weekly = (
        items.join(parts, items["l_partkey"] == parts["p_partkey"])
        .join(suppliers, items["l_suppkey"] == suppliers["s_suppkey"])
        .groupBy(F.col("s_nationkey").alias("Store"), "p_type", "Date")
        .agg(F.sum("_amount").alias("_amount"), F.sum("l_quantity").alias("Units"))
    )
    # Departments are numbered after the aggregation, on a few rows per series and week.
    return weekly.join(label_codes(parts, "p_type", "Dept", start=1), "p_type").select(
        "Store",
        "Dept",
        "Date",
        (F.col("_amount") / F.lit(10000.0)).alias("Weekly_Sales"),
        "Units",
        is_holiday_week(F.col("Date")).alias("IsHoliday"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, Type, Size: one row per nation."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("Store"))
    sizes = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("Store")).agg(F.count(F.lit(1)).alias("_n"))
    kind = F.get(F.array(*[F.lit(t) for t in STORE_TYPES]), F.col("Store") % len(STORE_TYPES))
    return nations.join(sizes, "Store", "left").select(
        "Store", kind.alias("Type"), F.coalesce("_n", F.lit(0)).cast("int").alias("Size")
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly columns per store from the orders of its nation; weeks without orders are absent."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderpriority",
        friday_on_or_after(F.col("o_orderdate")).alias("Date"),
        _units(F.col("o_totalprice"), 100).alias("_price"),
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("Store"), _units(F.col("c_acctbal"), 100).alias("_balance")
    )
    marked = {
        name: (F.sum(F.when(F.col("o_orderpriority") == priority, F.col("_price"))) / F.lit(100.0)).alias(name)
        for name, priority in zip(MARKDOWNS, PRIORITIES)
    }
    rows = F.count(F.lit(1))
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .groupBy("Store", "Date")
        .agg(
            rows.cast("double").alias("Temperature"),
            (F.max("_price") / F.lit(10000000.0)).alias("Fuel_Price"),
            *marked.values(),
            (F.sum("_price") / rows / F.lit(100.0)).alias("CPI"),
            (F.sum("_balance") / rows / F.lit(100.0)).alias("Unemployment"),
        )
        .withColumn("IsHoliday", is_holiday_week(F.col("Date")))
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news items, with a manual category where a label exists."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), "quality", "toxic")
    joined = documents.join(labels, documents["doc_id"] == labels["_id"], "left")
    category = F.lit(None).cast("string")
    for (quality, toxic), name in LABEL_CATEGORIES.items():
        category = F.when((F.col("quality") == quality) & (F.col("toxic") == toxic), name).otherwise(category)
    day = F.date_add(F.lit(NEWS_START).cast("date"), F.pmod("doc_id", F.lit(365)).cast("int"))
    return joined.select(
        F.col("doc_id").alias("id"),
        day.cast("string").alias("date_published"),
        "source",
        F.get(F.split("text", "\n"), F.lit(0)).alias("headline"),
        F.col("text").alias("summary"),
        F.concat_ws(",", "source", "lang").alias("keywords"),
        category.alias("risk_category"),
        F.when(F.col("quality").isNotNull(), F.pmod("n_chars", F.lit(11)).cast("string")).alias("risk_score"),
    )


def unit_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dept and the average retail price of its parts."""
    parts = table(spark, sf_dir, "part").select("p_type", _units(F.col("p_retailprice"), 100).alias("_price"))
    means = parts.groupBy("p_type").agg((F.sum("_price") / F.count(F.lit(1)) / F.lit(100.0)).alias("item_cost_per_unit"))
    return means.join(label_codes(parts, "p_type", "Dept", start=1), "p_type").select("Dept", "item_cost_per_unit")


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_type, Date and the day's mean value: short series without gaps."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.to_date("ts").alias("Date"))
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("events"))
    )
