"""Sources, sinks, parsing and text conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import pick, query, rounded
from stockspark.checks import require_columns
from stockspark.functions.calendar import long_date
from stockspark.functions.coerce import (
    FEATURE_KEYS,
    date_or_null,
    id_or_unknown,
    literal_to_list,
    literal_to_map,
    number_or_null,
    period_bounds,
    score_or_zero,
    shown_parameters,
    strict_date,
)
from stockspark.functions.families import model_family
from stockspark.plans import derived
from stockspark.plans.logs import parse_logs
from stockspark.plans.panel import load_and_merge
from stockspark.session import scratch_path
from stockspark.sources.tables import (
    FEATURES,
    SALES,
    STORES,
    append_log,
    read_csv,
    read_panel,
    sales_columns,
    save_panel,
    union_logs,
)

SALES_COLUMNS = ("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday")
# Model names that exercise every family rule.
NAMES = (
    "NaiveForecast", "SeasonalNaiveForecast", "ETS (Best)", "SARIMA (auto)", "Prophet", "RandomForestRegressor",
    "random_forest_v2", "XGBoostRegressor", "LightGBMRegressor", "lgbm_small", "LSTM_S1D1", "dummy_mean",
    "LinearRegression", "  ",
)


def _csv(df: DataFrame, path: str, **options) -> None:
    writer = df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).options(**options).csv(path)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sales") + ".csv"
    _csv(inputs.sales(spark, sf_dir).select(*SALES_COLUMNS), path)
    return shown(read_csv(spark, path, SALES))


def csv_bare_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stores") + ".csv"
    _csv(derived.stores(spark, sf_dir), path, lineSep="\r")
    return read_csv(spark, path, STORES)


def csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "news") + ".csv"
    news = derived.news(spark, sf_dir).select("id", "source", F.regexp_replace("summary", "\r", "").alias("summary"))
    _csv(news, path)
    back = read_csv(spark, path, "id bigint, source string, summary string", quoted_lines=True)
    return back.select("id", "source", F.length("summary").alias("chars"), F.md5("summary").alias("digest"))


def files_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three CSV files read, dated and merged."""
    root = scratch_path(spark, "raw")
    sales = inputs.sales(spark, sf_dir).select(*SALES_COLUMNS)
    columns = [part.split()[0] for part in FEATURES.split(", ")]
    for name, df in (("train", sales), ("stores", derived.stores(spark, sf_dir)), ("features", derived.features(spark, sf_dir).select(*columns))):
        _csv(df, f"{root}/{name}.csv")
    read = [read_csv(spark, f"{root}/{n}.csv", s) for n, s in (("train", SALES), ("stores", STORES), ("features", FEATURES))]
    merged = load_and_merge(*read)
    return shown(merged.select("Store", "Dept", "Date", "IsHoliday", "Weekly_Sales", "Type", "Size", "MarkDown1", "CPI"))


def panel_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Parquet panel is absent, so the CSV beside it is read."""
    root = scratch_path(spark, "cleaned")
    _csv(inputs.sales(spark, sf_dir).select(*SALES_COLUMNS), f"{root}/panel.csv")
    return shown(read_panel(spark, f"{root}/panel.parquet", f"{root}/panel.csv", SALES))


def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs.featured(spark, sf_dir)
    return shown(sales_columns(inputs.featured(spark, sf_dir)))


def saved_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "saved")
    save_panel(inputs.sales(spark, sf_dir), path)
    return shown(read_panel(spark, path).select("Store", "Dept", "Date", "Weekly_Sales", "Units", "IsHoliday"))


def appended_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "appended")
    log = inputs.log_table(spark, sf_dir)
    for model in ("NaiveForecast", "SeasonalNaiveForecast"):
        append_log(log.where(F.col("Model") == model), path)
    return shown(spark.read.parquet(path).select("Store", "Dept", "Model", "Train_Period", "Test_Period", "MAE", "RMSE"), 2)


def union_of_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series log and a log with feature columns, by name; absent columns are NULL."""
    log = inputs.log_table(spark, sf_dir)
    series = log.where(F.col("Model") == "NaiveForecast")
    pooled = log.where(F.col("Model") == "log_trend").withColumns(
        {"Features_Count": F.lit(1), "Features_List_Used": F.lit("['Year']")}
    )
    both = union_logs({"classical_ts": series, "classical_reg": pooled})
    return shown(both.select("Log_Type_Source", "Store", "Dept", "Model", "Features_Count", "Features_List_Used", "MAE"), 2)


def checked_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = require_columns(inputs.sales(spark, sf_dir), SALES_COLUMNS)
    return panel.groupBy("Store").agg(F.count(F.lit(1)).alias("rows"))


def _order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derived.table(spark, sf_dir, "orders")
    low, bad = F.col("o_orderpriority") == "5-LOW", F.col("o_orderkey") % 7
    return orders.select(
        "o_orderkey",
        F.when(low, "n/a").otherwise(F.to_date("o_orderdate").cast("string")).alias("day"),
        F.when(low, "unknown").when(bad == 0, "Infinity").when(bad == 1, "NaN").when(bad == 2, "99999999999")
        .otherwise(F.col("o_custkey").cast("string")).alias("number"),
        F.to_date("o_orderdate").cast("string").alias("good_day"),
    )


def dates_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_text(spark, sf_dir)
    return shown(rows.groupBy(strict_date(F.col("good_day")).alias("day")).agg(F.count(F.lit(1)).alias("orders")))


def dates_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_order_text(spark, sf_dir).select("o_orderkey", date_or_null(F.col("day")).alias("day")))


def numbers_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_text(spark, sf_dir)
    return rows.select(
        "o_orderkey",
        number_or_null(F.col("number")).alias("value"),
        id_or_unknown(F.col("number")).alias("id"),
        score_or_zero(F.col("number")).alias("score"),
    )


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in NAMES])
    part = derived.table(spark, sf_dir, "part")
    model = F.get(names, (F.col("p_partkey") % len(NAMES)).cast("int"))
    named = part.select(model.alias("Model"))
    return named.groupBy(
        "Model", model_family(F.col("Model")).alias("page"), model_family(F.col("Model"), "notebook").alias("notebook")
    ).agg(F.count(F.lit(1)).alias("n"))


def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dict and list text built from parts, parsed back; bookkeeping keys dropped."""
    part = derived.table(spark, sf_dir, "part")
    text = F.concat(
        F.lit("{'brand': '"), F.col("p_brand"), F.lit("', 'size': "), F.col("p_size").cast("string"),
        F.lit(", 'damped': True, 'trend': None, 'order': (1, 0, 2), 'model_path': '/m/"), F.col("p_partkey").cast("string"), F.lit("'}"),
    )
    broken = F.when(F.col("p_partkey") % 10 == 3, "{'open: ").otherwise(text)
    listed = F.concat(F.lit("['"), F.col("p_type"), F.lit("', '"), F.col("p_brand"), F.lit("']"))
    parsed = part.select("p_partkey", literal_to_map(broken).alias("m"), literal_to_list(listed).alias("l"))
    return parsed.select(
        "p_partkey",
        F.col("m")["brand"].alias("brand"),
        F.col("m")["size"].cast("int").alias("size"),
        F.col("m")["damped"].alias("damped"),
        F.col("m")["order"].alias("order_text"),
        F.size("m").alias("keys"),
        F.size(shown_parameters(F.col("m"))).alias("shown_keys"),
        F.array_join("l", "|").alias("listed"),
    )


def features_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of each part: features in their own column, under another key of the parameters, or nowhere.

    An empty list does not count, and of several filled ones the column comes first, then the keys in their order.
    """
    part = derived.table(spark, sf_dir, "part")
    listed = F.concat(F.lit("['"), F.col("p_type"), F.lit("', '"), F.col("p_brand"), F.lit("']"))
    case = F.col("p_partkey") % (len(FEATURE_KEYS) + 3)
    own = F.when(case == 0, listed).when(case == 1, "[]")
    keyed = [F.when((case == 0) | (case == 2 + at) | (case == 2 + len(FEATURE_KEYS)), F.concat(F.lit(f"'{key}': ['k{at}', '"), F.col("p_brand"), F.lit("'], "))) for at, key in enumerate(FEATURE_KEYS)]
    text = F.concat(F.lit("{"), *[F.coalesce(k, F.lit(f"'{key}': [], ")) for k, key in zip(keyed, FEATURE_KEYS)], F.lit("'size': "), F.col("p_size").cast("string"), F.lit("}"))
    log = part.select(
        F.col("p_partkey").cast("string").alias("Store"), F.lit("1").alias("Dept"), F.lit("m").alias("Model"),
        text.alias("Parameters"), own.alias("Features_List_Used"),
    )
    parsed = parse_logs({"regression": log})
    return parsed.select(F.col("Store").alias("p_partkey"), F.array_join("Features_List", "|").alias("features"))


def periods_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derived.table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    text = F.concat(F.lit("['"), day.cast("string"), F.lit(" to "), F.date_add(day, 7).cast("string"), F.lit("']"))
    start, end = period_bounds(F.when(F.col("o_orderpriority") == "5-LOW", "none logged").otherwise(text))
    return shown(orders.select("o_orderkey", start.alias("period_start"), end.alias("period_end")))


def display_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = derived.news(spark, sf_dir)
    return news.select("id", long_date(date_or_null(F.col("date_published"))).alias("shown_date"))


_names = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
_first = "Store Dept"

ENTRIES = {
    "csv_scan": (csv_scan, query(f"SELECT {pick('Store Dept IsHoliday', 'Date', 'Weekly_Sales')} FROM sales", "sales")),
    "csv_bare_returns": (csv_bare_returns, query("SELECT Store, Type, Size FROM stores", "stores")),
    "csv_quoted": (
        csv_quoted,
        """SELECT doc_id AS id, source, CAST(length(replace(text, chr(13), '')) AS INTEGER) AS chars,
        md5(replace(text, chr(13), '')) AS digest FROM documents""",
    ),
    "files_merged": (
        files_merged,
        query(f"SELECT {pick('Store Dept IsHoliday Type Size', 'Date', 'Weekly_Sales MarkDown1 CPI')} FROM merged", "merged"),
    ),
    "panel_fallback": (panel_fallback, query(f"SELECT {pick('Store Dept IsHoliday', 'Date', 'Weekly_Sales')} FROM sales", "sales")),
    "pruned_scan": (pruned_scan, query(f"SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM sales", "sales")),
    "saved_panel": (saved_panel, query(f"SELECT {pick('Store Dept IsHoliday', 'Date', 'Weekly_Sales Units')} FROM sales", "sales")),
    "appended_log": (
        appended_log,
        query(
            f"""SELECT Store, Dept, Model, CAST(train_lo AS VARCHAR) || ' to ' || CAST(train_hi AS VARCHAR) AS Train_Period,
            CAST(test_lo AS VARCHAR) || ' to ' || CAST(test_hi AS VARCHAR) AS Test_Period, {rounded('MAE', 2)} AS MAE,
            {rounded('RMSE', 2)} AS RMSE FROM logs WHERE Model IN ('NaiveForecast', 'SeasonalNaiveForecast')""",
            "logs",
        ),
    ),
    "union_of_logs": (
        union_of_logs,
        query(
            f"""SELECT 'classical_ts' AS Log_Type_Source, Store, Dept, Model, CAST(NULL AS INTEGER) AS Features_Count,
            CAST(NULL AS VARCHAR) AS Features_List_Used, {rounded('MAE', 2)} AS MAE FROM logs WHERE Model = 'NaiveForecast'
            UNION ALL SELECT 'classical_reg', Store, Dept, Model, 1, '[''Year'']', {rounded('MAE', 2)} FROM logs WHERE Model = 'log_trend'""",
            "logs",
        ),
    ),
    "checked_columns": (checked_columns, query("SELECT Store, count(*) AS rows FROM sales GROUP BY Store", "sales")),
    "dates_strict": (
        dates_strict,
        "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS orders FROM orders GROUP BY 1",
    ),
    "dates_coerced": (
        dates_coerced,
        """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
        FROM orders""",
    ),
    "numbers_coerced": (
        numbers_coerced,
        """SELECT o_orderkey, TRY_CAST(number AS DOUBLE) AS value, CASE WHEN abs(number) <= 2147483647 THEN CAST(number AS INTEGER) ELSE -1 END AS id,
        CASE WHEN abs(number) <= 2147483647 THEN CAST(number AS INTEGER) ELSE 0 END AS score
        FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' OR o_orderkey % 7 < 2 THEN NULL WHEN o_orderkey % 7 = 2 THEN 99999999999.0
        ELSE o_custkey END AS number FROM orders)""",
    ),
    "families": (
        families,
        f"""SELECT Model, CASE WHEN trim(Model) = '' THEN 'Unknown' WHEN lower(Model) LIKE '%naive%' THEN 'Baseline Naive'
        WHEN lower(Model) LIKE '%ets%' THEN 'ETS' WHEN lower(Model) LIKE '%sarima%' THEN 'SARIMA'
        WHEN lower(Model) LIKE '%prophet%' THEN 'Prophet'
        WHEN lower(Model) LIKE '%randomforest%' OR lower(Model) LIKE '%random!_forest%' ESCAPE '!' THEN 'Random Forest'
        WHEN lower(Model) LIKE '%xgboost%' THEN 'XGBoost' WHEN lower(Model) LIKE '%lightgbm%' OR lower(Model) LIKE '%lgbm%' THEN 'LightGBM'
        WHEN lower(Model) LIKE '%lstm%' THEN 'LSTM' WHEN lower(Model) LIKE '%dummy%' THEN 'Dummy/Test' ELSE 'Other Classical' END AS page,
        CASE WHEN Model LIKE '%Naive%' THEN 'Naive Baselines' WHEN Model LIKE '%ETS%' THEN 'ETS' WHEN Model LIKE '%SARIMA%' THEN 'SARIMA'
        WHEN Model LIKE '%Prophet%' THEN 'Prophet' WHEN Model LIKE '%RandomForest%' THEN 'RandomForest' WHEN Model LIKE '%XGBoost%' THEN 'XGBoost'
        WHEN Model LIKE '%LightGBM%' THEN 'LightGBM' WHEN Model LIKE '%LSTM%' THEN 'LSTM' ELSE 'Other' END AS notebook, count(*) AS n
        FROM (SELECT {_names}[p_partkey % {len(NAMES)} + 1] AS Model FROM part) GROUP BY ALL""",
    ),
    "literals": (
        literals,
        """SELECT p_partkey, CASE WHEN ok THEN p_brand END AS brand, CASE WHEN ok THEN p_size END AS size,
        CASE WHEN ok THEN 'true' END AS damped, CASE WHEN ok THEN '[1,0,2]' END AS order_text,
        CASE WHEN ok THEN 6 ELSE 0 END AS keys, CASE WHEN ok THEN 5 ELSE 0 END AS shown_keys, p_type || '|' || p_brand AS listed
        FROM (SELECT *, p_partkey % 10 <> 3 AS ok FROM part)""",
    ),
    "features_consolidated": (
        features_consolidated,
        f"""SELECT CAST(p_partkey AS INTEGER) AS p_partkey, CASE WHEN kind = 0 THEN p_type || '|' || p_brand WHEN kind = 1 THEN ''
        WHEN kind = {2 + len(FEATURE_KEYS)} THEN 'k0|' || p_brand ELSE 'k' || (kind - 2) || '|' || p_brand END AS features
        FROM (SELECT *, p_partkey % {len(FEATURE_KEYS) + 3} AS kind FROM part)""",
    ),
    "periods_parsed": (
        periods_parsed,
        """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS period_start,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) + 7 AS VARCHAR) END AS period_end FROM orders""",
    ),
    "display_dates": (
        display_dates,
        query("SELECT id, strftime(date_published, '%B %d, %Y') AS shown_date FROM news", "news"),
    ),
}
