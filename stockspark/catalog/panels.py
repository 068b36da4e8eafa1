"""Panel assembly, cleaning, features and preparation for regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import CALENDAR, CYCLIC, MARKS, lag_list, lag_names, pick, query, roll_list, roll_names, rounded
from stockspark.functions.calendar import calendar_parts, cyclic_parts
from stockspark.operators.cleaning import (
    drop_incomplete,
    encode_label,
    impute,
    label_codes,
    min_max_by_series,
    unscaled,
    zero_fill,
)
from stockspark.operators.series import ALL_STATS, KEYS, holiday_calendar, lag_features, rolling_features
from stockspark.operators.splits import split_by_date, split_ratio
from stockspark.plans import derived
from stockspark.plans.panel import clean, engineer, feature_nulls, merge
from stockspark.plans.regression import RegressionPrep

FEATURE_NAMES = ["CPI", "Dept", "IsHoliday", "MarkDown1", "Sales_Lag_1", "Sales_Lag_52", "Size", "Type_Encoded", "Not_In_Data"]


def sales_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(derived.sales(spark, sf_dir))


def merged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from line items, orders and suppliers to the merged panel, in one plan."""
    raw = merge(derived.sales(spark, sf_dir), derived.stores(spark, sf_dir), derived.features(spark, sf_dir))
    return shown(raw)


def store_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = inputs.sales(spark, sf_dir).join(derived.stores(spark, sf_dir), "Store", "left")
    return shown(joined.groupBy("Type").agg(F.sum("Weekly_Sales").alias("total"), F.max("Size").alias("largest")), 2)


def feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = inputs.sales(spark, sf_dir).join(derived.features(spark, sf_dir), ["Store", "Date", "IsHoliday"], "left")
    return shown(joined.select("Store", "Dept", "Date", "IsHoliday", "Weekly_Sales", "Temperature", "CPI", *MARKS))


def cleaned_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(clean(inputs.merged(spark, sf_dir)))


def markdown_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(zero_fill(inputs.merged(spark, sf_dir)).select("Store", "Dept", "Date", *MARKS))


def featured_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(engineer(inputs.cleaned(spark, sf_dir)))


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(lag_features(inputs.sales(spark, sf_dir), prefix="Sales").drop("Units", "IsHoliday"))


def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = inputs.sales(spark, sf_dir).drop("Units", "IsHoliday")
    return shown(rolling_features(panel, stats=ALL_STATS, prefix="Sales"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.sales(spark, sf_dir).select("Date", "IsHoliday").distinct()
    return shown(days.withColumns({**calendar_parts(F.col("Date")), "IsHoliday": F.col("IsHoliday").cast("int")}))


def cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.sales(spark, sf_dir).select("Date").distinct()
    return shown(days.withColumns(cyclic_parts(F.col("Date"))), 6)


def nulls_in_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = feature_nulls(inputs.featured(spark, sf_dir), inputs.cleaned(spark, sf_dir))
    return shown(report.select("column", "nulls", "null_percent"))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(holiday_calendar(inputs.sales(spark, sf_dir)))


def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_incomplete(inputs.featured(spark, sf_dir), ["Weekly_Sales", "Sales_Lag_52"])
    return shown(kept.select("Store", "Dept", "Date", "Weekly_Sales", "Sales_Lag_52"))


def imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = impute(inputs.merged(spark, sf_dir), ["CPI", "MarkDown1", "Type"])
    return shown(filled.select("Store", "Dept", "Date", "CPI", "MarkDown1", "Type"))


def imputed_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text column with gaps filled by its most frequent value."""
    items = derived.news(spark, sf_dir).select("id", "risk_category")
    return impute(items, ["risk_category"])


def label_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = derived.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return encode_label(parts, "p_brand", "brand_code", label_codes(parts, "p_brand", "brand_code"))


def regression_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the train rows, applied to all: imputed, encoded, aligned to a fixed list."""
    split = split_by_date(inputs.featured(spark, sf_dir))
    prep = RegressionPrep.fit(split.where(~F.col("is_test")), features=FEATURE_NAMES)
    return shown(prep.transform(split))


def scaled_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_ratio(inputs.sales(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales"))
    done = min_max_by_series(split, ["Weekly_Sales"], KEYS, ~F.col("is_test"))
    back = unscaled(F.col("Weekly_Sales_scaled"), F.col("Weekly_Sales_min"), F.col("Weekly_Sales_max"))
    return shown(done.select("Store", "Dept", "Date", "is_test", "Weekly_Sales_scaled", back.alias("restored")))


_marks = " ".join(MARKS)
_calendar_names = "Year Month WeekOfYear DayOfYear DayOfWeek IsWeekend"
_cyclic_names = "Month_sin Month_cos WeekOfYear_sin WeekOfYear_cos"
_merged_rounds = f"Weekly_Sales Units Temperature Fuel_Price {_marks} CPI Unemployment"

ENTRIES = {
    "sales_panel": (sales_panel, query(f"SELECT {pick('Store Dept IsHoliday', 'Date', 'Weekly_Sales Units')} FROM sales", "sales")),
    "merged_panel": (
        merged_panel,
        query(f"SELECT {pick('Store Dept IsHoliday Type Size', 'Date', _merged_rounds)} FROM merged", "merged"),
    ),
    "store_join": (
        store_join,
        query(
            f"""SELECT Type, {rounded('sum(Weekly_Sales)', 2)} AS total, max(Size) AS largest
            FROM sales LEFT JOIN stores USING (Store) GROUP BY Type""",
            "sales", "stores",
        ),
    ),
    "feature_join": (
        feature_join,
        query(f"SELECT {pick('Store Dept IsHoliday', 'Date', f'Weekly_Sales Temperature CPI {_marks}')} FROM merged", "merged"),
    ),
    "cleaned_panel": (
        cleaned_panel,
        query(f"SELECT {pick('Store Dept IsHoliday Type Size', 'Date', _merged_rounds)} FROM cleaned", "cleaned"),
    ),
    "markdown_zeros": (markdown_zeros, query(f"SELECT {pick('Store Dept', 'Date', _marks)} FROM cleaned", "cleaned")),
    "featured_panel": (
        featured_panel,
        query(
            f"""SELECT {pick(f'Store Dept IsHoliday Type Size {_calendar_names}', 'Date',
            f'{_merged_rounds} {lag_names()} {roll_names()} {_cyclic_names}')} FROM featured""",
            "featured",
        ),
    ),
    "lag_features": (
        lags,
        query(
            f"""SELECT {pick('Store Dept', 'Date', f'Weekly_Sales {lag_names()}')} FROM
            (SELECT *, {lag_list()} FROM sales WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date))""",
            "sales",
        ),
    ),
    "rolling_features": (
        rolling,
        query(
            f"SELECT {pick('Store Dept', 'Date', f'Weekly_Sales {roll_names()}')} FROM (SELECT *, {roll_list()} FROM sales)",
            "sales",
        ),
    ),
    "calendar_features": (
        calendar,
        query(
            f"""SELECT {pick(f'IsHoliday {_calendar_names}', 'Date')} FROM
            (SELECT DISTINCT Date, CAST(IsHoliday AS INTEGER) AS IsHoliday, {CALENDAR} FROM sales)""",
            "sales",
        ),
    ),
    "cyclic_features": (
        cyclic,
        query(f"SELECT {pick('', 'Date', _cyclic_names, 6)} FROM (SELECT DISTINCT Date, {CYCLIC} FROM sales)", "sales"),
    ),
    "feature_nulls": (
        nulls_in_features,
        query(
            f"""SELECT column_name AS "column", nulls, {rounded('100.0 * nulls / total')} AS null_percent FROM (
            {' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS total FROM featured" for c in (lag_names() + ' ' + roll_names()).split())})
            WHERE nulls > 0 ORDER BY nulls DESC, column_name LIMIT 10""",
            "featured",
        ),
    ),
    "holiday_calendar": (holidays, query("SELECT DISTINCT CAST(Date AS VARCHAR) AS Date FROM sales WHERE IsHoliday", "sales")),
    "complete_rows": (
        complete_rows,
        query(
            f"""SELECT {pick('Store Dept', 'Date', 'Weekly_Sales Sales_Lag_52')} FROM
            (SELECT *, lag(Weekly_Sales, 52) OVER (PARTITION BY Store, Dept ORDER BY Date) AS Sales_Lag_52 FROM sales)
            WHERE Sales_Lag_52 IS NOT NULL""",
            "sales",
        ),
    ),
    "imputed": (
        imputed,
        query(
            f"""SELECT {pick('Store Dept Type', 'Date', 'CPI MarkDown1')} FROM (SELECT Store, Dept, Date, Type,
            coalesce(CPI, (SELECT quantile_cont(CPI, 0.5) FROM merged)) AS CPI,
            coalesce(MarkDown1, (SELECT quantile_cont(MarkDown1, 0.5) FROM merged)) AS MarkDown1 FROM merged)""",
            "merged",
        ),
    ),
    "imputed_mode": (
        imputed_mode,
        query(
            """SELECT id, coalesce(risk_category, (SELECT risk_category FROM news WHERE risk_category IS NOT NULL
            GROUP BY risk_category ORDER BY count(*) DESC, risk_category LIMIT 1)) AS risk_category FROM news""",
            "news",
        ),
    ),
    "label_encoded": (
        label_encoded,
        "SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS brand_code FROM part",
    ),
    "regression_matrix": (
        regression_matrix,
        query(
            f"""SELECT {pick('is_test', 'Date', 'Weekly_Sales CPI Dept IsHoliday MarkDown1 Sales_Lag_1 Sales_Lag_52 Size Type_Encoded Not_In_Data')}
            FROM (SELECT is_test, Date, Weekly_Sales, coalesce(CPI, c) AS CPI, Dept, IsHoliday, coalesce(MarkDown1, m) AS MarkDown1,
                coalesce(Sales_Lag_1, l1) AS Sales_Lag_1, coalesce(Sales_Lag_52, l52) AS Sales_Lag_52, Size,
                ascii(Type) - 65 AS Type_Encoded, 0.0 AS Not_In_Data FROM flagged, fills)""",
            "featured",
            extra={
                "flagged": "SELECT *, Date > (SELECT max(Date) - 364 FROM featured) AS is_test FROM featured",
                "fills": """SELECT quantile_cont(CPI, 0.5) AS c, quantile_cont(MarkDown1, 0.5) AS m, quantile_cont(Sales_Lag_1, 0.5) AS l1,
                    quantile_cont(Sales_Lag_52, 0.5) AS l52 FROM flagged WHERE NOT is_test""",
            },
        ),
    ),
    "scaled_series": (
        scaled_series,
        query(
            f"""SELECT {pick('Store Dept is_test', 'Date', 'Weekly_Sales_scaled restored')} FROM (
            SELECT Store, Dept, Date, is_test, (Weekly_Sales - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END AS Weekly_Sales_scaled,
                Weekly_Sales AS restored
            FROM (SELECT *, min(Weekly_Sales) FILTER (WHERE NOT is_test) OVER (PARTITION BY Store, Dept) AS lo,
                    max(Weekly_Sales) FILTER (WHERE NOT is_test) OVER (PARTITION BY Store, Dept) AS hi
                FROM (SELECT *, rn > n - t AS is_test FROM (SELECT *, CAST(floor(n * 0.2) AS INTEGER) AS t FROM
                    (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS rn,
                        count(*) OVER (PARTITION BY Store, Dept) AS n FROM sales)) WHERE n - t >= 24 AND t >= 1)))""",
            "sales",
        ),
    ),
}
