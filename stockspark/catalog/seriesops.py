"""Filling, regular weeks, decomposition, correlation in time, sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import pick, query, rounded
from stockspark.operators.series import (
    KEYS,
    autocorrelation,
    backward_filled,
    decompose,
    exogenous_frame,
    forward_filled,
    future_dates,
    interpolate_in_time,
    partial_autocorrelation,
    regularise,
    sequences,
    tiled_history,
    with_minimum_history,
)
from stockspark.plans import derived

ACF_LAGS = 60


def _sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.merged(spark, sf_dir).select("Store", "Dept", "Date", "MarkDown1")


def filled_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_sparse(spark, sf_dir).withColumn("MarkDown1", forward_filled("MarkDown1", KEYS)))


def filled_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_sparse(spark, sf_dir).withColumn("MarkDown1", backward_filled("MarkDown1", KEYS)))


def regular_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(regularise(inputs.sales(spark, sf_dir), ["Weekly_Sales"]))


def regular_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(regularise(inputs.sales(spark, sf_dir), ["Weekly_Sales"], fill="pad"))


def regular_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(regularise(inputs.sales(spark, sf_dir), ["Weekly_Sales"], fill="zero"))


def interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = regularise(inputs.sales(spark, sf_dir), ["Weekly_Sales"])
    long_enough = with_minimum_history(inputs.sales(spark, sf_dir), 104).select(*KEYS).distinct()
    return shown(interpolate_in_time(weeks, ["Weekly_Sales"]).join(long_enough, list(KEYS), "left_semi"))


def exogenous(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = inputs.merged(spark, sf_dir).withColumn("Blank", F.lit(None).cast("double"))
    return shown(exogenous_frame(empty, ["Temperature", "MarkDown1", "Size", "Blank"]))


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = with_minimum_history(inputs.sales(spark, sf_dir), 104)
    return kept.groupBy("Store", "Dept").agg(F.count(F.lit(1)).alias("weeks"))


def _decomposed(model: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(decompose(inputs.weekly(spark, sf_dir), model=model), 3)

    return run


def overall_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total over all series by week: one series, as long as the calendar."""
    totals = inputs.sales(spark, sf_dir).groupBy("Date").agg(F.sum("Weekly_Sales").alias("Weekly_Sales"))
    one = totals.withColumn("all", F.lit(0))
    weeks = interpolate_in_time(regularise(one, ["Weekly_Sales"], ["all"]), ["Weekly_Sales"], ["all"])
    return shown(decompose(weeks, keys=["all"]).drop("all"), 2)


def daily_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event values by type, with a season of seven days."""
    days = derived.daily_events(spark, sf_dir)
    return shown(decompose(days, "value", ["event_type"], period=7))


def acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = autocorrelation(inputs.weekly(spark, sf_dir), ACF_LAGS)
    return shown(found.select("Store", "Dept", F.posexplode("acf").alias("lag", "acf")), 6)


def pacf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = autocorrelation(inputs.weekly(spark, sf_dir), ACF_LAGS)
    values = partial_autocorrelation(F.col("acf"))
    return shown(found.select("Store", "Dept", F.posexplode(values).alias("lag", "pacf")), 6)


def short_acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page form: up to lag min(40, n/2 - 1) for series longer than 30 rows."""
    found = autocorrelation(inputs.sales(spark, sf_dir), 40).where(F.col("n") > 30)
    lags = found.select("Store", "Dept", "n", F.posexplode("acf").alias("lag", "acf"))
    return shown(lags.where(F.col("lag") <= F.least(F.lit(40), F.floor(F.col("n") / 2) - 1)).drop("n"), 6)


def sequence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = sequences(inputs.sales(spark, sf_dir), ["Weekly_Sales", "Units"], 12)
    flat = F.flatten("sequence")
    text = F.array_join(F.transform(flat, lambda v: F.round(v * 10000).cast("bigint").cast("string")), ",")
    return shown(built.select("Store", "Dept", "Date", F.md5(text).alias("digest"), "target", "target_date"))


def tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(tiled_history(inputs.sales(spark, sf_dir), 260, target="Units"))


def future_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(future_dates(inputs.sales(spark, sf_dir), 12))


_down = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_up = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
_part = "PARTITION BY Store, Dept ORDER BY Date"


def _lerp(name: str, day: str = "Date") -> str:
    return f"""CASE WHEN {name} IS NOT NULL THEN {name} WHEN {name}_pv IS NOT NULL AND {name}_nv IS NOT NULL
    THEN {name}_pv + ({name}_nv - {name}_pv) * (CAST({day} - {name}_pd AS DOUBLE) / ({name}_nd - {name}_pd))
    ELSE coalesce({name}_pv, {name}_nv, 0.0) END"""


def _neighbours(name: str, part: str = _part) -> str:
    return f"""last_value({name} IGNORE NULLS) OVER ({part} {_down}) AS {name}_pv, first_value({name} IGNORE NULLS) OVER ({part} {_up}) AS {name}_nv,
    last_value(CASE WHEN {name} IS NOT NULL THEN Date END IGNORE NULLS) OVER ({part} {_down}) AS {name}_pd,
    first_value(CASE WHEN {name} IS NOT NULL THEN Date END IGNORE NULLS) OVER ({part} {_up}) AS {name}_nd"""


def _decompose_sql(source: str, keys: str, model: str, digits: int) -> str:
    minus = "-" if model == "additive" else "/"
    part = f"PARTITION BY {keys}"
    rest = "observed - trend - seasonal" if model == "additive" else "observed / (trend * seasonal)"
    lead = "" if keys == "one" else f"{keys}, "
    return f"""SELECT {lead}CAST(Date AS VARCHAR) AS Date, {rounded('observed', digits)} AS observed, {rounded('trend', digits)} AS trend,
    {rounded('seasonal', digits)} AS seasonal, {rounded(rest, digits)} AS resid
    FROM (SELECT *, pm {minus} avg(CASE WHEN rn <= 52 THEN pm END) OVER ({part}) AS seasonal
    FROM (SELECT *, avg(observed {minus} trend) OVER ({part}, (rn - 1) % 52) AS pm
    FROM (SELECT *, CASE WHEN rn > 26 AND rn <= n - 26 THEN (a + b) / 2 END AS trend
    FROM (SELECT {keys}, Date, Weekly_Sales AS observed, row_number() OVER ({part} ORDER BY Date) AS rn, count(*) OVER ({part}) AS n,
        avg(Weekly_Sales) OVER ({part} ORDER BY Date ROWS BETWEEN 26 PRECEDING AND 25 FOLLOWING) AS a,
        avg(Weekly_Sales) OVER ({part} ORDER BY Date ROWS BETWEEN 25 PRECEDING AND 26 FOLLOWING) AS b
        FROM {source}) WHERE n >= 104)))"""


def _acf_parts(source: str) -> dict[str, str]:
    return {
        "c": f"""SELECT Store, Dept, Weekly_Sales - avg(Weekly_Sales) OVER (PARTITION BY Store, Dept) AS d,
        row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS rn FROM {source}""",
        "d": "SELECT *, sum(d * d) OVER (PARTITION BY Store, Dept) AS v, count(*) OVER (PARTITION BY Store, Dept) AS n FROM c",
    }


def _acf_query(source: str, lags: int, where: str = "") -> str:
    text = f"""SELECT Store, Dept, lag, {rounded('acf', 6)} AS acf FROM (
    SELECT d.Store, d.Dept, CAST(k AS INTEGER) AS lag, d.n, coalesce(sum(d.d * e.d), 0) / max(d.v) AS acf
    FROM d CROSS JOIN range({lags + 1}) r(k) LEFT JOIN d e ON d.Store = e.Store AND d.Dept = e.Dept AND e.rn = d.rn - k
    GROUP BY d.Store, d.Dept, k, d.n) {where}"""
    return query(text, source, extra=_acf_parts(source))


def _pacf_query(source: str, lags: int) -> str:
    """The recursion over lags, with the coefficients of the last lag carried as a list."""
    parts = {
        **_acf_parts(source),
        "acfs": f"""SELECT Store, Dept, list(acf ORDER BY lag) AS r FROM (
            SELECT d.Store, d.Dept, k AS lag, coalesce(sum(d.d * e.d), 0) / max(d.v) AS acf
            FROM d CROSS JOIN range({lags + 1}) r(k) LEFT JOIN d e ON d.Store = e.Store AND d.Dept = e.Dept AND e.rn = d.rn - k
            GROUP BY d.Store, d.Dept, k) GROUP BY Store, Dept""",
        "steps": f"""WITH RECURSIVE run AS (
            SELECT Store, Dept, r, 0 AS k, 1.0::DOUBLE AS a, CAST([] AS DOUBLE[]) AS phi FROM acfs
            UNION ALL
            SELECT Store, Dept, r, k + 1, b, list_concat(list_transform(phi, lambda p, j: p - b * phi[k + 1 - j]), [b])
            FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda p, j: p * r[k + 2 - j])), 0))
                    / (1 - coalesce(list_sum(list_transform(phi, lambda p, j: p * r[j + 1])), 0)) AS b FROM run WHERE k < {lags}))
        SELECT Store, Dept, k, a FROM run""",
    }
    return query(f"SELECT Store, Dept, CAST(k AS INTEGER) AS lag, {rounded('a', 6)} AS pacf FROM steps", source, extra=parts)


ENTRIES = {
    "forward_fill": (
        filled_forward,
        query(f"SELECT {pick('Store Dept', 'Date', 'MarkDown1')} FROM (SELECT Store, Dept, Date, last_value(MarkDown1 IGNORE NULLS) OVER ({_part} {_down}) AS MarkDown1 FROM merged)", "merged"),
    ),
    "backward_fill": (
        filled_backward,
        query(f"SELECT {pick('Store Dept', 'Date', 'MarkDown1')} FROM (SELECT Store, Dept, Date, first_value(MarkDown1 IGNORE NULLS) OVER ({_part} {_up}) AS MarkDown1 FROM merged)", "merged"),
    ),
    "regular_weeks": (regular_weeks, query(f"SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM regular", "regular")),
    "regular_weeks_padded": (
        regular_padded,
        query(f"SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM (SELECT Store, Dept, Date, last_value(Weekly_Sales IGNORE NULLS) OVER ({_part} {_down}) AS Weekly_Sales FROM regular)", "regular"),
    ),
    "regular_weeks_zero": (
        regular_zero,
        query(f"SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM (SELECT Store, Dept, Date, coalesce(Weekly_Sales, 0.0) AS Weekly_Sales FROM regular)", "regular"),
    ),
    "interpolated": (interpolated, query(f"SELECT {pick('Store Dept', 'Date', 'Weekly_Sales')} FROM weekly", "weekly")),
    "exogenous_frame": (
        exogenous,
        query(
            f"""SELECT Store, Dept, CAST(Date AS VARCHAR) AS Date, {', '.join(f"{rounded(_lerp(c))} AS {c}" for c in ('Temperature', 'MarkDown1', 'Size'))}
            FROM (SELECT *, {', '.join(_neighbours(c) for c in ('Temperature', 'MarkDown1', 'Size'))}
                FROM (SELECT Store, Dept, Date, Temperature, MarkDown1, CAST(Size AS DOUBLE) AS Size FROM spine LEFT JOIN merged USING (Store, Dept, Date)))""",
            "spine", "merged",
        ),
    ),
    "minimum_history": (
        long_series,
        query("SELECT Store, Dept, count(*) AS weeks FROM sales GROUP BY Store, Dept HAVING count(*) >= 104", "sales"),
    ),
    "decomposition": (_decomposed("additive"), query(_decompose_sql("weekly", "Store, Dept", "additive", 3), "weekly")),
    "decomposition_multiplicative": (
        _decomposed("multiplicative"),
        query(_decompose_sql("weekly", "Store, Dept", "multiplicative", 3), "weekly"),
    ),
    "decomposition_overall": (
        overall_decomposition,
        query(
            _decompose_sql("o", "one", "additive", 2),
            "sales",
            extra={
                "t": "SELECT Date, sum(Weekly_Sales) AS y FROM sales GROUP BY Date",
                "s": """SELECT CAST(unnest(generate_series((SELECT min(Date) FROM t), (SELECT max(Date) FROM t), INTERVAL 7 DAY)) AS DATE) AS Date""",
                "o": f"""SELECT 0 AS one, Date, {_lerp('y')} AS Weekly_Sales FROM (SELECT *, {_neighbours('y', 'ORDER BY Date')} FROM s LEFT JOIN t USING (Date))""",
            },
        ),
    ),
    "decomposition_daily": (
        daily_decomposition,
        query(
            f"""SELECT event_type, CAST(Date AS VARCHAR) AS Date, {rounded('observed')} AS observed, {rounded('trend')} AS trend,
            {rounded('seasonal')} AS seasonal, {rounded('observed - trend - seasonal')} AS resid
            FROM (SELECT *, pm - avg(CASE WHEN rn <= 7 THEN pm END) OVER (PARTITION BY event_type) AS seasonal
            FROM (SELECT *, avg(observed - trend) OVER (PARTITION BY event_type, (rn - 1) % 7) AS pm
            FROM (SELECT *, CASE WHEN rn > 3 AND rn <= n - 3 THEN a END AS trend
            FROM (SELECT event_type, Date, value AS observed, row_number() OVER (PARTITION BY event_type ORDER BY Date) AS rn,
                count(*) OVER (PARTITION BY event_type) AS n,
                avg(value) OVER (PARTITION BY event_type ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS a
                FROM events_daily) WHERE n >= 14)))""",
            "events_daily",
        ),
    ),
    "autocorrelation": (acf, _acf_query("weekly", ACF_LAGS)),
    "autocorrelation_short": (short_acf, _acf_query("sales", 40, "WHERE n > 30 AND lag <= least(40, n // 2 - 1)")),
    "partial_autocorrelation": (pacf, _pacf_query("weekly", ACF_LAGS)),
    "sequence_windows": (
        sequence_windows,
        query(
            f"""SELECT Store, Dept, CAST(Date AS VARCHAR) AS Date, md5(string_agg(v, ',' ORDER BY back DESC)) AS digest,
            {rounded('max(target)')} AS target, CAST(max(target_date) AS VARCHAR) AS target_date
            FROM (SELECT a.Store, a.Dept, a.Date, a.target, a.target_date, a.rn - b.rn AS back,
                CAST(CAST(round(b.Weekly_Sales * 10000) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round(b.Units * 10000) AS BIGINT) AS VARCHAR) AS v
                FROM s a JOIN s b ON a.Store = b.Store AND a.Dept = b.Dept AND b.rn BETWEEN a.rn - 11 AND a.rn
                WHERE a.rn >= 12 AND a.target_date IS NOT NULL) GROUP BY Store, Dept, Date""",
            "sales",
            extra={
                "s": """SELECT *, row_number() OVER w AS rn, lead(Weekly_Sales) OVER w AS target, lead(Date) OVER w AS target_date
                FROM sales WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date)"""
            },
        ),
    ),
    "tiled_history": (
        tiled,
        query(
            f"""SELECT Store, Dept, CAST(p AS INTEGER) AS period, {rounded('Units')} AS demand
            FROM (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS rn, count(*) OVER (PARTITION BY Store, Dept) AS n FROM sales)
            JOIN range(1, 261) r(p) ON rn = (p - 1) % n + 1""",
            "sales",
        ),
    ),
    "future_dates": (
        future_grid,
        query(
            """SELECT Store, Dept, CAST(k AS INTEGER) AS step, CAST(hi + CAST(7 * k AS INTEGER) AS VARCHAR) AS Date
            FROM (SELECT Store, Dept, max(Date) AS hi FROM sales GROUP BY Store, Dept), range(1, 13) r(k)""",
            "sales",
        ),
    ),
}
