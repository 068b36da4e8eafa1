"""Hot keys and their spread join; sums over periods by prefix sums."""

import datetime as dt
import random
from statistics import median

from pyspark.sql import functions as F

from stockspark.operators.accuracy import actuals_in_period
from stockspark.operators.heavy import hot_keys, spread_join
from stockspark.operators.periods import period_totals


def facts(spark, rows=24_000):
    """Every third row has one term; the others are spread over many."""
    return spark.range(rows, numPartitions=6).select(
        F.col("id").alias("doc"), F.when(F.col("id") % 3 == 0, F.lit("the")).otherwise(F.concat(F.lit("w"), F.hash("id") % 3000)).alias("term")
    )


def test_hot_keys_are_found_with_their_share(spark):
    hot = {r["term"]: r["salts"] for r in hot_keys(facts(spark), "term", parts=8).collect()}
    assert set(hot) == {"the"} and 10 <= hot["the"] <= 12
    assert hot_keys(facts(spark).limit(0), "term", parts=8).count() == 0
    nulls = spark.createDataFrame([(None,)] * 50 + [("a",)], "term string")
    assert [r["term"] for r in hot_keys(nulls, "term", parts=2).collect()] == ["a"]


def test_spread_join_keeps_rows_and_evens_tasks(spark):
    rows = facts(spark).unionByName(spark.createDataFrame([(None, "the"), (5, None), (6, "lonely")], "doc bigint, term string"))
    lookup = rows.select("term").distinct().where("term <> 'lonely'").withColumn("v", F.length("term"))
    lookup = lookup.unionByName(spark.createDataFrame([("the", 99)], "term string, v int"))
    joined = spread_join(rows, lookup, "term", "doc", hot_keys(rows, "term", parts=8))
    expected = sorted(map(tuple, rows.join(lookup, "term").select("doc", "term", "v").collect()), key=str)
    assert sorted(map(tuple, joined.select("doc", "term", "v").collect()), key=str) == expected

    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        again = spread_join(rows, lookup, "term", "doc", hot_keys(rows, "term", parts=8))
        sizes = [r[0] for r in again.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("v") < 99).alias("n")).select("n").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) <= 3 * median(sizes)


SALES = "Store bigint, Dept bigint, Date date, Weekly_Sales double"
LOGS = "Store bigint, Dept bigint, Model string, period_start date, period_end date"


def test_period_totals_equal_the_range_join(spark):
    draw = random.Random(5)
    day = lambda k: dt.date(2020, 1, 3) + dt.timedelta(days=k)
    sales = [(s, d, day(7 * w), draw.choice([None, round(draw.uniform(-50, 9e6), 2)])) for s in (1, 2, None) for d in (1, 2) for w in range(60)]
    sales += sales[:5] + [(1, 1, None, 4.0)]
    logs = []
    for k in range(200):
        lo = draw.choice([None, day(draw.randrange(-30, 450))])
        hi = draw.choice([None, lo, (lo or day(0)) + dt.timedelta(days=draw.randrange(-20, 300))])
        logs.append((draw.choice([1, 2, 3, None]), draw.choice([1, 2]), f"m{k % 7}", lo, hi))
    logs += logs[:10]
    s, g = spark.createDataFrame(sales, SALES), spark.createDataFrame(logs, LOGS)
    got = period_totals(g, s)
    assert got.columns == [*g.columns, "n_rows", "n_values", "total"] and got.count() == len(logs)
    for r in got.collect():
        inside = [
            v for a, b, c, v in sales
            if a is not None and (a, b) == (r["Store"], r["Dept"]) and c and r["period_start"] and r["period_end"] and r["period_start"] <= c <= r["period_end"]
        ]
        values = [v for v in inside if v is not None]
        assert (r["n_rows"], r["n_values"]) == (len(inside), len(values))
        assert r["total"] is None if not values else abs(float(r["total"]) - sum(values)) < 1e-4
    assert got.agg(F.sum("n_rows")).first()[0] == actuals_in_period(g, s).count()
    assert period_totals(g.limit(0), s).count() == 0
    assert {r["n_rows"] for r in period_totals(g, s.limit(0)).collect()} == {0}
