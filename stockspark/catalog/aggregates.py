"""Totals, profiles, distributions, correlations, sorts and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import MARKS, pick, query, rounded
from stockspark.operators.profile import (
    below_or_all,
    box_stats,
    cap_by_quantile,
    column_profile,
    correlations,
    describe_categories,
    describe_dates,
    describe_numeric,
    enough_for_training,
    excess_kurtosis,
    histogram,
    missing_summary,
    negative_audit,
    seeded_sample,
    shifted_log,
    skewness,
    top_categories,
    top_groups,
    totals_by,
    value_counts,
)
from stockspark.operators.ranks import exact_median, exact_quantiles
from stockspark.plans import derived

DRIVERS = ("Store", "Dept", "Units", "Size", "Temperature", "Fuel_Price", *MARKS, "CPI", "Unemployment")
PROFILED = ("Weekly_Sales", *DRIVERS)


def totals_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(totals_by(inputs.sales(spark, sf_dir), ["Date"], "Weekly_Sales"), 2)


def totals_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(totals_by(inputs.sales(spark, sf_dir), ["Store", "Dept"], "Weekly_Sales"), 2)


def top_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(top_groups(inputs.sales(spark, sf_dir), ["Store", "Dept"], "Weekly_Sales"), 2)


def series_of_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weeks of the best-selling series, found and filtered in one plan."""
    sales = inputs.sales(spark, sf_dir)
    best = top_groups(sales, ["Store", "Dept"], "Weekly_Sales").select(F.struct("Store", "Dept")).scalar()
    rows = sales.where((F.col("Store") == best["Store"]) & (F.col("Dept") == best["Dept"]))
    return shown(rows.drop("Units"))


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = inputs.sales(spark, sf_dir).where(F.col("Date").between("1997-01-03", "1998-12-25"))
    return shown(inside.groupBy("Store").agg(F.sum("Weekly_Sales").alias("total"), F.min("Date").alias("first"), F.max("Date").alias("last")), 2)


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances below zero: the panel itself has no negative sales."""
    return shown(negative_audit(derived.table(spark, sf_dir, "customer"), "c_acctbal"))


def counts_of_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(value_counts(inputs.merged(spark, sf_dir), "Type"))


def frequent_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_categories(derived.table(spark, sf_dir, "part"), "p_brand")


def high_mean_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(top_categories(inputs.sales(spark, sf_dir), "Store", mean_of="Weekly_Sales"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(column_profile(inputs.merged(spark, sf_dir)))


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(missing_summary(inputs.merged(spark, sf_dir)).drop("dtype"))


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(describe_numeric(inputs.merged(spark, sf_dir)))


def described_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_categories(inputs.merged(spark, sf_dir), ["Type", "IsHoliday"])


def described_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(describe_dates(inputs.merged(spark, sf_dir), ["Date"]))


def centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = inputs.sales(spark, sf_dir)
    mean = sales.agg(F.avg("Weekly_Sales").alias("mean"))
    return shown(mean.withColumn("median", exact_median(sales, "Weekly_Sales")))


def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("Weekly_Sales")
    return shown(inputs.sales(spark, sf_dir).agg(skewness(y).alias("skew"), excess_kurtosis(y).alias("kurtosis")))


def log_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances go below zero, so the shift applies; sales stay positive, so it does not."""
    customers = derived.table(spark, sf_dir, "customer").withColumn("v", F.col("c_acctbal"))
    sales = inputs.sales(spark, sf_dir)
    shifted = customers.select(F.lit("c_acctbal").alias("column"), shifted_log(customers, "c_acctbal").alias("v"))
    plain = sales.select(F.lit("Weekly_Sales").alias("column"), shifted_log(sales, "Weekly_Sales").alias("v"))
    return shown(shifted.unionByName(plain).groupBy("column").agg(skewness(F.col("v")).alias("skew")))


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(histogram(inputs.sales(spark, sf_dir), "Weekly_Sales", 100))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(box_stats(inputs.sales(spark, sf_dir), "Weekly_Sales"))


def boxes_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(box_stats(inputs.merged(spark, sf_dir), "Weekly_Sales", ["Type"]))


def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(correlations(inputs.cleaned(spark, sf_dir), DRIVERS, "Weekly_Sales"))


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seeded_sample(inputs.sales(spark, sf_dir), ["Store", "Dept", "Date"])
    return shown(rows.select("Store", "Dept", "Date", "Weekly_Sales"))


def capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cap_by_quantile(inputs.log_table(spark, sf_dir), "MAPE").select("Store", "Dept", "Model", "MAPE"), 2)


def below_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(below_or_all(inputs.log_table(spark, sf_dir), "MAPE").select("Store", "Dept", "Model", "MAPE"), 2)


def training_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = derived.news(spark, sf_dir).where(F.col("risk_category").isNotNull())
    return enough_for_training(labelled, "risk_category")


def depts_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = inputs.sales(spark, sf_dir).select("Store", "Dept").distinct()
    grouped = series.groupBy("Store").agg(F.sort_array(F.collect_list("Dept")).alias("depts"))
    return grouped.select("Store", F.array_join(F.col("depts").cast("array<string>"), ",").alias("depts"))


def distinct_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.sales(spark, sf_dir).select("Store", "Dept").distinct()


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.sales(spark, sf_dir).orderBy("Store", "Dept", "Date").limit(100)
    return shown(rows.select("Store", "Dept", "Date", "Weekly_Sales"))


def sorted_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(inputs.sales(spark, sf_dir).drop("Units").orderBy("Store", "Dept", "Date"))


def quantile_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of line prices by return flag: a few groups that hold all rows."""
    items = derived.table(spark, sf_dir, "lineitem")
    found = exact_quantiles(items, "l_extendedprice", [0.05, 0.5, 0.95, 0.98], ["l_returnflag"])
    names = ("p05", "p50", "p95", "p98")
    return shown(found.select("l_returnflag", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)]))


_describe = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {rounded(f'avg({c})')} AS mean, {rounded(f'stddev_samp({c})')} AS std,
    {rounded(f'min({c})')} AS min, {rounded(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS q25, {rounded(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS q50,
    {rounded(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS q75, {rounded(f'max({c})')} AS max FROM merged"""
    for c in PROFILED
)
_types = {
    "Store": "int", "Date": "date", "IsHoliday": "boolean", "Dept": "int", "Weekly_Sales": "double", "Units": "double",
    "Type": "string", "Size": "int", "Temperature": "double", "Fuel_Price": "double", **{m: "double" for m in MARKS},
    "CPI": "double", "Unemployment": "double",
}
_profile = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
    {rounded(f'100.0 * (count(*) - count({c})) / count(*)')} AS null_percent FROM merged"""
    for c, t in _types.items()
)
_moments = """n AS (SELECT count({y}) AS n, avg({y}) AS m FROM {t}),
c AS (SELECT avg(({y} - m) ** 2) AS m2, avg(({y} - m) ** 3) AS m3, avg(({y} - m) ** 4) AS m4 FROM {t}, n)"""


def _box(source: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    join = f"JOIN q USING ({by})" if by else ", q"
    return f"""WITH q AS (SELECT {lead}quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3 FROM {source} {group})
    SELECT {lead}count(*) AS count, {rounded('max(q1)')} AS q1, {rounded('max(median)')} AS median, {rounded('max(q3)')} AS q3,
    {rounded('max(q3 - q1)')} AS iqr, {rounded('min(y) FILTER (WHERE y >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
    {rounded('max(y) FILTER (WHERE y <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
    count(*) FILTER (WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)) AS outliers FROM {source} {join} {group}"""


ENTRIES = {
    "totals_by_date": (totals_by_date, query(f"SELECT CAST(Date AS VARCHAR) AS Date, {rounded('sum(Weekly_Sales)', 2)} AS total FROM sales GROUP BY Date", "sales")),
    "totals_by_series": (totals_by_series, query(f"SELECT Store, Dept, {rounded('sum(Weekly_Sales)', 2)} AS total FROM sales GROUP BY ALL", "sales")),
    "top_series": (
        top_series,
        query(f"SELECT Store, Dept, {rounded('s', 2)} AS total FROM (SELECT Store, Dept, sum(Weekly_Sales) AS s FROM sales GROUP BY ALL ORDER BY s DESC, Store, Dept LIMIT 1)", "sales"),
    ),
    "series_of_top": (
        series_of_top,
        query(
            f"""SELECT {pick('Store Dept IsHoliday', 'Date', 'Weekly_Sales')} FROM sales WHERE (Store, Dept) =
            (SELECT (Store, Dept) FROM sales GROUP BY Store, Dept ORDER BY sum(Weekly_Sales) DESC, Store, Dept LIMIT 1)""",
            "sales",
        ),
    ),
    "date_range": (
        date_range,
        query(
            f"""SELECT Store, {rounded('sum(Weekly_Sales)', 2)} AS total, CAST(min(Date) AS VARCHAR) AS first, CAST(max(Date) AS VARCHAR) AS last
            FROM sales WHERE Date BETWEEN DATE '1997-01-03' AND DATE '1998-12-25' GROUP BY Store""",
            "sales",
        ),
    ),
    "negative_audit": (
        negatives,
        f"""SELECT count(*) AS rows, count(*) FILTER (WHERE c_acctbal < 0) AS negatives,
        {rounded('100.0 * count(*) FILTER (WHERE c_acctbal < 0) / count(*)')} AS percent FROM customer""",
    ),
    "value_counts": (
        counts_of_values,
        query(f"SELECT Type, count(*) AS count, {rounded('round(100.0 * count(*) / sum(count(*)) OVER (), 1)')} AS percent FROM merged GROUP BY Type", "merged"),
    ),
    "frequent_categories": (
        frequent_categories,
        "SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 20",
    ),
    "high_mean_categories": (
        high_mean_categories,
        query(f"SELECT Store, {rounded('m')} AS mean FROM (SELECT Store, avg(Weekly_Sales) AS m FROM sales GROUP BY Store ORDER BY m DESC, Store LIMIT 20)", "sales"),
    ),
    "column_profile": (profile, query(_profile, "merged")),
    "missing_summary": (
        missing,
        query(f"""SELECT "column", non_null, nulls, null_percent FROM ({_profile}) WHERE nulls > 0""", "merged"),
    ),
    "describe_numeric": (described, query(_describe, "merged")),
    "describe_categories": (
        described_categories,
        query(
            """SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", arg_min(v, (-n, v)) AS top, max(n) AS freq FROM (
            SELECT 'Type' AS "column", Type AS v, count(*) AS n FROM merged WHERE Type IS NOT NULL GROUP BY Type
            UNION ALL SELECT 'IsHoliday', CAST(IsHoliday AS VARCHAR), count(*) FROM merged WHERE IsHoliday IS NOT NULL GROUP BY IsHoliday) GROUP BY "column" """,
            "merged",
        ),
    ),
    "describe_dates": (
        described_dates,
        query(
            f"""SELECT 'Date' AS "column", count(*) AS count, {rounded('avg(d)')} AS mean, {rounded('min(d)')} AS min,
            {rounded('quantile_cont(d, 0.25)')} AS q25, {rounded('quantile_cont(d, 0.5)')} AS q50, {rounded('quantile_cont(d, 0.75)')} AS q75,
            {rounded('max(d)')} AS max FROM (SELECT CAST(Date - DATE '1970-01-01' AS DOUBLE) AS d FROM merged)""",
            "merged",
        ),
    ),
    "mean_and_median": (
        centre,
        query(f"SELECT {rounded('avg(Weekly_Sales)')} AS mean, {rounded('quantile_cont(Weekly_Sales, 0.5)')} AS median FROM sales", "sales"),
    ),
    "skew_and_kurtosis": (
        shape,
        query(
            f"""SELECT {rounded('m3 / m2 ** 1.5 * sqrt(n * (n - 1.0)) / (n - 2)')} AS skew,
            {rounded('(n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1) * (m4 / (m2 * m2) - 3) + 6)')} AS kurtosis FROM c, n""",
            "sales",
            extra={
                "n": "SELECT CAST(count(*) AS DOUBLE) AS n, avg(Weekly_Sales) AS m FROM sales",
                "c": "SELECT avg((Weekly_Sales - m) ** 2) AS m2, avg((Weekly_Sales - m) ** 3) AS m3, avg((Weekly_Sales - m) ** 4) AS m4 FROM sales, n",
            },
        ),
    ),
    "log_skew": (
        log_shape,
        query(
            f"""SELECT "column", {rounded('m3 / m2 ** 1.5 * sqrt(n * (n - 1.0)) / (n - 2)')} AS skew FROM
            (SELECT "column", CAST(count(*) AS DOUBLE) AS n, avg((v - m) ** 2) AS m2, avg((v - m) ** 3) AS m3
             FROM (SELECT *, avg(v) OVER (PARTITION BY "column") AS m FROM v) GROUP BY "column")""",
            "sales",
            extra={
                "v": """SELECT 'c_acctbal' AS "column", ln(1 + (c_acctbal - (SELECT min(c_acctbal) FROM customer) + 1)) AS v FROM customer
                UNION ALL SELECT 'Weekly_Sales', ln(1 + Weekly_Sales) FROM sales"""
            },
        ),
    ),
    "histogram": (
        bins,
        query(
            f"""SELECT CAST(i AS INTEGER) AS bin, {rounded('lo + i * (hi - lo) / 100.0')} AS left_edge,
            {rounded('lo + (i + 1) * (hi - lo) / 100.0')} AS right_edge, count(y) AS count
            FROM range(100) r(i) CROSS JOIN e LEFT JOIN (SELECT Weekly_Sales AS y, least(floor((Weekly_Sales - lo) / ((hi - lo) / 100.0)), 99) AS b FROM sales, e) ON b = i
            GROUP BY i, lo, hi""",
            "sales",
            extra={"e": "SELECT min(Weekly_Sales) AS lo, max(Weekly_Sales) AS hi FROM sales"},
        ),
    ),
    "box_stats": (boxes, query(f"SELECT * FROM ({_box('s')})", "sales", extra={"s": "SELECT Weekly_Sales AS y FROM sales"})),
    "box_stats_by_type": (
        boxes_by_type,
        query(f"SELECT * FROM ({_box('s', 'Type')})", "merged", extra={"s": "SELECT Type, Weekly_Sales AS y FROM merged"}),
    ),
    "correlations": (
        correlation,
        query(
            " UNION ALL ".join(
                f"""SELECT '{x}' AS feature, {rounded(f'corr({x}, Weekly_Sales)')} AS pearson, {rounded(f'regr_slope(Weekly_Sales, {x})')} AS slope,
                {rounded(f'regr_intercept(Weekly_Sales, {x})')} AS intercept FROM cleaned"""
                for x in DRIVERS
            ),
            "cleaned",
        ),
    ),
    "seeded_sample": (
        sample,
        query(
            f"""SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM
            (SELECT * FROM sales ORDER BY md5(concat_ws(':', '42', Store, Dept, Date)), Store, Dept, Date LIMIT 5000)""",
            "sales",
        ),
    ),
    "mape_cap": (
        capped,
        query(f"SELECT {pick('Store Dept Model', '', 'MAPE', 2)} FROM logs WHERE MAPE <= greatest((SELECT quantile_cont(MAPE, 0.98) FROM logs), 100.0)", "logs"),
    ),
    "mape_limit": (
        below_limit,
        query(f"SELECT {pick('Store Dept Model', '', 'MAPE', 2)} FROM logs WHERE MAPE < 200 OR NOT EXISTS (SELECT 1 FROM logs WHERE MAPE < 200)", "logs"),
    ),
    "training_guard": (
        training_guard,
        query(
            """SELECT count(*) AS rows, count(DISTINCT risk_category) AS classes, count(*) >= 10 AND count(DISTINCT risk_category) >= 2 AS enough
            FROM news WHERE risk_category IS NOT NULL""",
            "news",
        ),
    ),
    "depts_by_store": (
        depts_by_store,
        query("SELECT Store, string_agg(CAST(Dept AS VARCHAR), ',' ORDER BY Dept) AS depts FROM (SELECT DISTINCT Store, Dept FROM sales) GROUP BY Store", "sales"),
    ),
    "distinct_series": (distinct_series, query("SELECT DISTINCT Store, Dept FROM sales", "sales")),
    "preview": (
        preview,
        query(f"SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM (SELECT * FROM sales ORDER BY Store, Dept, sales.Date LIMIT 100)", "sales"),
    ),
    "sorted_panel": (
        sorted_panel,
        query(f"SELECT {pick('Store Dept IsHoliday', 'Date', 'Weekly_Sales')} FROM sales ORDER BY Store, Dept, sales.Date", "sales"),
    ),
    "quantile_ladder": (
        quantile_ladder,
        f"""SELECT l_returnflag, {', '.join(f"{rounded(f'quantile_cont(l_extendedprice, {p})')} AS {n}" for p, n in ((0.05, 'p05'), (0.5, 'p50'), (0.95, 'p95'), (0.98, 'p98')))}
        FROM lineitem GROUP BY l_returnflag""",
    ),
}
