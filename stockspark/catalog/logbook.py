"""Experiment logs: parsing and comparison between models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import pick, query, rounded
from stockspark.operators.accuracy import (
    actuals_in_period,
    best_model,
    candidate_models,
    local_models,
    mean_metrics,
    metric_spread,
    rmse_name,
    wins,
    with_family,
    with_saved_model,
)
from stockspark.operators.inventory import period_demand_statistics
from stockspark.operators.periods import period_totals
from stockspark.plans.logs import parse_logs


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_family(inputs.log_table(spark, sf_dir))


def _saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with stored models for two families, one of them pooled under Store = Dept = 0."""
    log = inputs.log_table(spark, sf_dir)
    model = F.col("Model")
    path = F.when(model == "level_smoothing", F.concat_ws("_", F.lit("ets"), "Store", "Dept")).when(model == "log_trend", "  ")
    own = log.withColumn("model_path", path)
    pooled = log.where(model == "NaiveForecast").agg(F.avg("RMSE").alias("RMSE"))
    pooled = pooled.select(
        F.lit(0).alias("Store"), F.lit(0).alias("Dept"), F.lit("NaiveForecast").alias("Model"), "RMSE", F.lit("naive_all").alias("model_path")
    )
    return own.select("Store", "Dept", "Model", "RMSE", "model_path").unionByName(pooled)


def parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.log_table(spark, sf_dir)
    text = log.select(*[F.col(c).cast("string").alias(c) for c in log.columns])
    parsed = parse_logs({"classical_ts": text})
    return shown(
        parsed.select(
            "Log_Type_Source", "Store", "Dept", "Model", "Model_Family", "period_start", "period_end", "MAE", "RMSE", "MAPE",
            F.size("Parameters_Map").alias("parameters"),
            F.col("Parameters_Map")["method"].alias("method"),
            F.size("Features_List").alias("features"),
        ),
        2,
    )


def by_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(mean_metrics(_log(spark, sf_dir), ["Model_Family"]), 2)


def by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(mean_metrics(_log(spark, sf_dir), ["Model"]), 2)


def by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(mean_metrics(_log(spark, sf_dir), ["Store", "Dept", "Model"]), 2)


def best(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best_model(local_models(_log(spark, sf_dir)))
    return shown(found.select("Store", "Dept", "Model", "Model_Family", "RMSE", "MAE", "MAPE"), 2)


def family_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wins(best_model(local_models(_log(spark, sf_dir))))


def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(metric_spread(_log(spark, sf_dir)), 2)


def locals_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_models(_log(spark, sf_dir)).select("Store", "Dept", "Model")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names; one family has no RMSE."""
    log = inputs.log_table(spark, sf_dir)
    rmse = F.when(F.col("Model") != "log_trend", F.round("RMSE", 0))
    return log.select("Store", "Dept", rmse_name(F.col("Model"), rmse).alias("display_name"))


def saved_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_saved_model(_saved(spark, sf_dir)).select("Store", "Dept", "Model", "model_path")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = inputs.log_table(spark, sf_dir).select("Store", "Dept").distinct()
    found = candidate_models(_saved(spark, sf_dir), series)
    return shown(found.select("Store", "Dept", "base_name", "model_path", "RMSE"), 2)


def logged_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.log_table(spark, sf_dir)
    text = log.select(*[F.col(c).cast("string").alias(c) for c in log.columns])
    parsed = parse_logs({"classical_ts": text})
    return parsed.select("Store", "Dept", "Model", "RMSE", "period_start", "period_end")


def test_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = actuals_in_period(logged_periods(spark, sf_dir), inputs.sales(spark, sf_dir))
    return shown(found.select("Store", "Dept", "Model", "Date", "Weekly_Sales"))


def demand_over_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(period_demand_statistics(period_totals(logged_periods(spark, sf_dir), inputs.sales(spark, sf_dir))), 2)


def totals_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = period_totals(logged_periods(spark, sf_dir), inputs.sales(spark, sf_dir))
    return shown(found.select("Store", "Dept", "Model", "n_rows", F.col("total").cast("double").alias("total")), 2)


def _means(by: str) -> str:
    parts = ", ".join(f"{rounded(f'avg({m})', 2)} AS {m}" for m in ("MAE", "RMSE", "MAPE"))
    return query(f"SELECT {by}, {parts} FROM logs GROUP BY {by}", "logs")


_best = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY RMSE, Model) AS place FROM logs
WHERE Store > 0 AND Dept > 0 AND RMSE IS NOT NULL) WHERE place = 1"""
_saved_sql = {
    "saved": """SELECT Store, Dept, Model, RMSE, CASE Model WHEN 'level_smoothing' THEN 'ets_' || Store || '_' || Dept WHEN 'log_trend' THEN '  ' END AS model_path FROM logs
    UNION ALL SELECT 0, 0, 'NaiveForecast', avg(RMSE), 'naive_all' FROM logs WHERE Model = 'NaiveForecast'""",
}

ENTRIES = {
    "parsed_logs": (
        parsed_logs,
        query(
            f"""SELECT 'classical_ts' AS Log_Type_Source, Store, Dept, Model, Model_Family, CAST(test_lo AS VARCHAR) AS period_start,
            CAST(test_hi AS VARCHAR) AS period_end, {rounded('MAE', 2)} AS MAE, {rounded('RMSE', 2)} AS RMSE, {rounded('MAPE', 2)} AS MAPE,
            CASE Model WHEN 'NaiveForecast' THEN 1 WHEN 'level_smoothing' THEN 3 ELSE 2 END AS parameters,
            CASE Model WHEN 'NaiveForecast' THEN 'last_value' WHEN 'SeasonalNaiveForecast' THEN 'last_season_value' END AS method, 0 AS features FROM logs""",
            "logs",
        ),
    ),
    "metrics_by_family": (by_family, _means("Model_Family")),
    "metrics_by_model": (by_model, _means("Model")),
    "metrics_by_series": (by_series, _means("Store, Dept, Model")),
    "best_models": (
        best,
        query(f"SELECT {pick('Store Dept Model Model_Family', '', 'RMSE MAE MAPE', 2)} FROM ({_best})", "logs"),
    ),
    "family_wins": (family_wins, query(f"SELECT Model_Family, count(*) AS wins FROM ({_best}) GROUP BY Model_Family", "logs")),
    "metric_spread": (
        spread,
        query(
            f"""SELECT Model_Family, count(*) AS count, {rounded('max(q1)', 2)} AS q1, {rounded('max(q2)', 2)} AS median, {rounded('max(q3)', 2)} AS q3,
            {rounded('max(q3 - q1)', 2)} AS iqr, {rounded('min(RMSE) FILTER (WHERE RMSE >= q1 - 1.5 * (q3 - q1))', 2)} AS whisker_low,
            {rounded('max(RMSE) FILTER (WHERE RMSE <= q3 + 1.5 * (q3 - q1))', 2)} AS whisker_high,
            count(*) FILTER (WHERE RMSE < q1 - 1.5 * (q3 - q1) OR RMSE > q3 + 1.5 * (q3 - q1)) AS outliers
            FROM logs JOIN q USING (Model_Family) GROUP BY Model_Family""",
            "logs",
            extra={
                "q": """SELECT Model_Family, quantile_cont(RMSE, 0.25) AS q1, quantile_cont(RMSE, 0.5) AS q2, quantile_cont(RMSE, 0.75) AS q3
                FROM logs GROUP BY Model_Family"""
            },
        ),
    ),
    "local_models": (locals_only, query("SELECT Store, Dept, Model FROM logs WHERE Store > 0 AND Dept > 0", "logs")),
    "display_names": (
        names,
        query(
            """SELECT Store, Dept, Model || ' (RMSE: ' || CASE WHEN Model <> 'log_trend' THEN printf('%.2f', round(RMSE, 0)) ELSE 'N/A' END || ')' AS display_name
            FROM logs""",
            "logs",
        ),
    ),
    "saved_models": (
        saved_models,
        query("SELECT Store, Dept, Model, model_path FROM saved WHERE trim(model_path) <> ''", "logs", extra=_saved_sql),
    ),
    "candidate_models": (
        candidates,
        query(
            f"""SELECT s.Store, s.Dept, CASE WHEN m.Store = 0 THEN m.Model || ' (Global)' ELSE m.Model END AS base_name, m.model_path,
            {rounded('min(m.RMSE)', 2)} AS RMSE
            FROM (SELECT DISTINCT Store, Dept FROM logs) s JOIN saved m ON (m.Store = s.Store AND m.Dept = s.Dept) OR (m.Store = 0 AND m.Dept = 0)
            WHERE trim(m.model_path) <> '' GROUP BY ALL""",
            "logs",
            extra=_saved_sql,
        ),
    ),
    "actuals_in_test_period": (
        test_actuals,
        query(
            f"""SELECT l.Store, l.Dept, Model, CAST(s.Date AS VARCHAR) AS Date, {rounded('s.Weekly_Sales')} AS Weekly_Sales
            FROM logs l JOIN sales s ON l.Store = s.Store AND l.Dept = s.Dept AND s.Date BETWEEN test_lo AND test_hi""",
            "logs", "sales",
        ),
    ),
    "demand_over_test_period": (
        demand_over_test,
        query(
            # Half to even on whole ten-thousandths, as ties are frequent and doubles cannot state them.
            f"""SELECT Store, Dept, Model, {rounded('(q + CASE WHEN 2 * r > m OR (2 * r = m AND q % 2 = 1) THEN 1 ELSE 0 END) / 100.0::DOUBLE', 2)} AS avg_weekly_demand,
            {rounded('round_even(e, 2)', 2)} AS std_dev_weekly_demand
            FROM (SELECT *, s // m AS q, s % m AS r FROM (
              SELECT l.Store, l.Dept, Model, CAST(sum(CAST(s.Weekly_Sales * 10000 AS DECIMAL(28, 0))) AS BIGINT) AS s, 100 * count(*) AS m, max(RMSE) AS e
              FROM logs l JOIN sales s ON l.Store = s.Store AND l.Dept = s.Dept AND s.Date BETWEEN test_lo AND test_hi GROUP BY ALL))""",
            "logs", "sales",
        ),
    ),
    "totals_in_test_period": (
        totals_in_period,
        query(
            f"""SELECT l.Store, l.Dept, Model, count(s.Date) AS n_rows, {rounded('sum(s.Weekly_Sales)', 2)} AS total
            FROM (SELECT *, row_number() OVER () AS k FROM logs) l
            LEFT JOIN sales s ON l.Store = s.Store AND l.Dept = s.Dept AND s.Date BETWEEN test_lo AND test_hi GROUP BY k, l.Store, l.Dept, Model""",
            "logs", "sales",
        ),
    ),
}
