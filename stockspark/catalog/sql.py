"""Building blocks of the SQL counterparts: one named subquery per derived input."""

from __future__ import annotations

HOLIDAYS = "(6, 36, 47, 52)"


def friday(column: str) -> str:
    return f"CAST({column} AS DATE) + CAST((12 - isodow({column})) % 7 AS INTEGER)"


def rounded(expression: str, digits: int = 4) -> str:
    scale = 10**digits
    return f"floor(({expression}) * {scale}.0::DOUBLE + 0.50123::DOUBLE) / {scale}.0::DOUBLE"


def pick(plain: str = "", dates: str = "", rounds: str = "", digits: int = 4) -> str:
    """A select list: columns as they are, dates as text, doubles rounded."""
    parts = plain.split()
    parts += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    parts += [f"{rounded(c, digits)} AS {c}" for c in rounds.split()]
    return ", ".join(parts)


MARKS = {
    "MarkDown1": "1-URGENT",
    "MarkDown2": "2-HIGH",
    "MarkDown3": "3-MEDIUM",
    "MarkDown4": "4-NOT SPECIFIED",
    "MarkDown5": "5-LOW",
}
LAGS = (1, 2, 3, 4, 8, 12, 26, 52)
WINDOWS = (4, 8, 12, 26)

_mark_sums = ", ".join(
    f"CAST(sum(price) FILTER (WHERE o_orderpriority = '{p}') AS DOUBLE) / 100 AS {m}" for m, p in MARKS.items()
)
_mark_zero = ", ".join(f"coalesce({m}, 0.0) AS {m}" for m in MARKS)


def lag_list(value: str = "Weekly_Sales", prefix: str = "Sales") -> str:
    return ", ".join(f"lag({value}, {k}) OVER w AS {prefix}_Lag_{k}" for k in LAGS)


def roll_list(
    value: str = "Weekly_Sales", prefix: str = "Sales", stats: tuple[str, ...] = ("mean", "std", "min", "max")
) -> str:
    call = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    return ", ".join(
        f"{call[s]}({value}) OVER (PARTITION BY Store, Dept ORDER BY Date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        f" AS {prefix}_Roll_{s.capitalize()}_{n}"
        for n in WINDOWS
        for s in stats
    )


def lag_names(prefix: str = "Sales") -> str:
    return " ".join(f"{prefix}_Lag_{k}" for k in LAGS)


def roll_names(prefix: str = "Sales", stats: tuple[str, ...] = ("mean", "std", "min", "max")) -> str:
    return " ".join(f"{prefix}_Roll_{s.capitalize()}_{n}" for n in WINDOWS for s in stats)


CALENDAR = (
    "CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month, "
    "CAST(week(Date) AS INTEGER) AS WeekOfYear, CAST(dayofyear(Date) AS INTEGER) AS DayOfYear, "
    "CAST(isodow(Date) - 1 AS INTEGER) AS DayOfWeek, CAST(isodow(Date) IN (6, 7) AS INTEGER) AS IsWeekend"
)
CYCLIC = (
    "sin(2 * pi() * month(Date) / 12) AS Month_sin, cos(2 * pi() * month(Date) / 12) AS Month_cos, "
    "sin(2 * pi() * week(Date) / 52) AS WeekOfYear_sin, cos(2 * pi() * week(Date) / 52) AS WeekOfYear_cos"
)


def _fill(name: str) -> str:
    return (
        f"coalesce({name}, "
        f"last_value({name} IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({name} IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {name}"
    )


# Each entry: name -> (subqueries it needs, text).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "depts": (
        (),
        "SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS Dept "
        "FROM (SELECT DISTINCT p_type FROM part)",
    ),
    "sales": (
        ("depts",),
        f"""SELECT s_nationkey AS Store, Dept, wk AS Date,
            CAST(sum(amount) AS DOUBLE) / 10000 AS Weekly_Sales, sum(l_quantity) AS Units,
            week(wk) IN {HOLIDAYS} AS IsHoliday
        FROM (SELECT s_nationkey, Dept, {friday('l_shipdate')} AS wk, l_quantity,
                CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS amount
              FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
              JOIN depts USING (p_type))
        GROUP BY ALL""",
    ),
    "stores": (
        (),
        """SELECT n_nationkey AS Store, substr('ABC', n_nationkey % 3 + 1, 1) AS Type,
            CAST(count(s_suppkey) AS INTEGER) AS Size
        FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""",
    ),
    "features": (
        (),
        f"""SELECT c_nationkey AS Store, wk AS Date, CAST(count(*) AS DOUBLE) AS Temperature,
            max(price) / 10000000 AS Fuel_Price, {_mark_sums},
            CAST(sum(price) AS DOUBLE) / count(*) / 100 AS CPI,
            CAST(sum(balance) AS DOUBLE) / count(*) / 100 AS Unemployment,
            week(wk) IN {HOLIDAYS} AS IsHoliday
        FROM (SELECT c_nationkey, o_orderpriority, {friday('o_orderdate')} AS wk,
                CAST(round(o_totalprice * 100) AS BIGINT) AS price, CAST(round(c_acctbal * 100) AS BIGINT) AS balance
              FROM orders JOIN customer ON o_custkey = c_custkey)
        GROUP BY c_nationkey, wk""",
    ),
    "merged": (
        ("sales", "stores", "features"),
        """SELECT * FROM sales LEFT JOIN stores USING (Store) LEFT JOIN features USING (Store, Date, IsHoliday)""",
    ),
    "slow": (
        ("merged",),
        f"""SELECT Store, Date, n, {_fill('CPI')}, {_fill('Unemployment')}
        FROM (SELECT Store, Date, max(CPI) AS CPI, max(Unemployment) AS Unemployment, count(*) AS n
              FROM merged GROUP BY Store, Date)""",
    ),
    "medians": (
        ("merged", "slow"),
        """SELECT quantile_cont(slow.CPI, 0.5) AS mc, quantile_cont(slow.Unemployment, 0.5) AS mu
        FROM merged JOIN slow USING (Store, Date)""",
    ),
    "cleaned": (
        ("merged", "slow", "medians"),
        f"""SELECT m.Store, m.Dept, m.Date, Weekly_Sales, Units, m.IsHoliday, Type, Size, Temperature, Fuel_Price,
            {_mark_zero}, coalesce(s.CPI, mc) AS CPI, coalesce(s.Unemployment, mu) AS Unemployment
        FROM merged m JOIN slow s ON m.Store = s.Store AND m.Date = s.Date, medians""",
    ),
    "featured": (
        ("cleaned",),
        f"""SELECT * EXCLUDE (IsHoliday), CAST(IsHoliday AS INTEGER) AS IsHoliday, {CALENDAR}, {lag_list()}, {roll_list()}, {CYCLIC}
        FROM cleaned WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date)""",
    ),
    "spine": (
        ("sales",),
        """SELECT Store, Dept, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS Date
        FROM (SELECT Store, Dept, min(Date) AS lo, max(Date) AS hi FROM sales GROUP BY Store, Dept)""",
    ),
    "regular": (
        ("spine", "sales"),
        "SELECT Store, Dept, Date, Weekly_Sales FROM spine LEFT JOIN sales USING (Store, Dept, Date)",
    ),
    "weekly": (
        ("regular",),
        f"""SELECT Store, Dept, Date, week(Date) IN {HOLIDAYS} AS IsHoliday,
            CASE WHEN Weekly_Sales IS NOT NULL THEN Weekly_Sales
                 WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (CAST(Date - pd AS DOUBLE) / (nd - pd))
                 ELSE coalesce(pv, nv) END AS Weekly_Sales
        FROM (SELECT *,
                last_value(Weekly_Sales IGNORE NULLS) OVER b AS pv, first_value(Weekly_Sales IGNORE NULLS) OVER a AS nv,
                last_value(CASE WHEN Weekly_Sales IS NOT NULL THEN Date END IGNORE NULLS) OVER b AS pd,
                first_value(CASE WHEN Weekly_Sales IS NOT NULL THEN Date END IGNORE NULLS) OVER a AS nd
              FROM regular JOIN (SELECT Store, Dept FROM sales GROUP BY Store, Dept HAVING count(*) >= 104) USING (Store, Dept)
              WINDOW b AS (PARTITION BY Store, Dept ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     a AS (PARTITION BY Store, Dept ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    ),
    "placed": (
        ("weekly",),
        """SELECT *, CAST(row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS INTEGER) AS rn,
            CAST(count(*) OVER (PARTITION BY Store, Dept) AS INTEGER) AS n
        FROM weekly""",
    ),
    "lastn": (
        ("placed",),
        "SELECT *, rn > n - 52 AS is_test, n - 52 AS n_train FROM placed WHERE n > 52",
    ),
    "naive": (
        ("lastn",),
        """SELECT Store, Dept, Date, Weekly_Sales, last_train AS yhat FROM
        (SELECT *, max(CASE WHEN rn = n_train THEN Weekly_Sales END) OVER (PARTITION BY Store, Dept) AS last_train FROM lastn)
        WHERE is_test""",
    ),
    "snaive": (
        ("lastn",),
        """SELECT a.Store, a.Dept, a.Date, a.Weekly_Sales, CASE WHEN a.n_train >= 52 THEN b.Weekly_Sales END AS yhat
        FROM lastn a JOIN lastn b ON a.Store = b.Store AND a.Dept = b.Dept AND b.rn = a.n_train - 52 + (a.rn - a.n_train - 1) % 52 + 1
        WHERE a.is_test""",
    ),
    "levels": (
        ("lastn",),
        # l(t) = a * y(t) + (1 - a) * l(t - 1), l(0) = y(1), for three weights.
        """WITH RECURSIVE run AS (
            SELECT Store, Dept, alpha, 0 AS rn, Weekly_Sales AS level, 0.0::DOUBLE AS sse FROM lastn, (VALUES (0.1::DOUBLE), (0.4), (0.8)) g(alpha)
            WHERE rn = 1 AND n_train >= 104
            UNION ALL
            SELECT r.Store, r.Dept, r.alpha, r.rn + 1, r.alpha * s.Weekly_Sales + (1 - r.alpha) * r.level,
                r.sse + (s.Weekly_Sales - r.level) * (s.Weekly_Sales - r.level)
            FROM run r JOIN lastn s ON s.Store = r.Store AND s.Dept = r.Dept AND s.rn = r.rn + 1 AND NOT s.is_test)
        SELECT Store, Dept, arg_min(level, (sse, alpha)) AS level
        FROM (SELECT r.* FROM run r JOIN (SELECT DISTINCT Store, Dept, n_train FROM lastn) t
              ON r.Store = t.Store AND r.Dept = t.Dept AND r.rn = t.n_train) GROUP BY Store, Dept""",
    ),
    "ets": (
        ("lastn", "levels"),
        "SELECT Store, Dept, Date, Weekly_Sales, level AS yhat FROM lastn JOIN levels USING (Store, Dept) WHERE is_test",
    ),
    "trendfit": (
        ("lastn",),
        """SELECT Store, Dept, regr_slope(ln(Weekly_Sales), x) AS b, regr_intercept(ln(Weekly_Sales), x) AS a
        FROM (SELECT *, (Date - DATE '1995-01-01') / 365.25::DOUBLE AS x FROM lastn WHERE NOT is_test AND Weekly_Sales > 0)
        GROUP BY Store, Dept""",
    ),
    "trend": (
        ("lastn", "trendfit"),
        """SELECT Store, Dept, Date, Weekly_Sales, exp(a + b * ((Date - DATE '1995-01-01') / 365.25::DOUBLE)) AS yhat
        FROM lastn JOIN trendfit USING (Store, Dept) WHERE is_test""",
    ),
    "forecasts": (
        ("naive", "snaive", "ets", "trend"),
        """SELECT 'NaiveForecast' AS Model, * FROM naive UNION ALL SELECT 'SeasonalNaiveForecast', * FROM snaive
        UNION ALL SELECT 'level_smoothing', * FROM ets UNION ALL SELECT 'log_trend', * FROM trend""",
    ),
    "scored": (
        ("forecasts",),
        """SELECT Store, Dept, Model, avg(abs(Weekly_Sales - yhat)) AS MAE,
            sqrt(avg((Weekly_Sales - yhat) * (Weekly_Sales - yhat))) AS RMSE,
            avg(CASE WHEN Weekly_Sales <> 0 THEN abs((Weekly_Sales - yhat) / Weekly_Sales) END) * 100 AS MAPE
        FROM forecasts GROUP BY Store, Dept, Model""",
    ),
    "spans": (
        ("lastn",),
        """SELECT Store, Dept, min(Date) FILTER (WHERE NOT is_test) AS train_lo, max(Date) FILTER (WHERE NOT is_test) AS train_hi,
            min(Date) FILTER (WHERE is_test) AS test_lo, max(Date) FILTER (WHERE is_test) AS test_hi
        FROM lastn GROUP BY Store, Dept""",
    ),
    "logs": (
        ("scored", "spans"),
        """SELECT *, CASE Model WHEN 'NaiveForecast' THEN 'Baseline Naive' WHEN 'SeasonalNaiveForecast' THEN 'Baseline Naive'
            ELSE 'Other Classical' END AS Model_Family
        FROM scored JOIN spans USING (Store, Dept)""",
    ),
    "costs": (
        ("depts",),
        """SELECT Dept, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS item_cost_per_unit
        FROM part JOIN depts USING (p_type) GROUP BY Dept""",
    ),
    "inputs": (
        ("sales", "costs"),
        """SELECT Store, Dept, coalesce(item_cost_per_unit, 10.0) AS item_cost_per_unit, avg_weekly_demand,
            coalesce(std_dev_weekly_demand, 20.0) AS std_dev_weekly_demand, 50.0::DOUBLE AS ordering_cost_per_order,
            20.0::DOUBLE AS annual_holding_rate_percent, 4.0::DOUBLE AS avg_lead_time_weeks,
            1.0::DOUBLE AS std_dev_lead_time_weeks, 95.0::DOUBLE AS target_service_level_percent
        FROM (SELECT Store, Dept, avg(Units) AS avg_weekly_demand, stddev_samp(Units) AS std_dev_weekly_demand
              FROM sales GROUP BY Store, Dept) LEFT JOIN costs USING (Dept)""",
    ),
    "news": (
        (),
        """SELECT d.doc_id AS id, DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS date_published, source,
            split_part(text, chr(10), 1) AS headline, text AS summary, concat_ws(',', source, lang) AS keywords,
            CASE WHEN quality = 1 AND toxic = 0 THEN 'Positive Supplier News' WHEN quality = 0 AND toxic = 0 THEN 'Market Volatility'
                 WHEN quality = 1 AND toxic = 1 THEN 'Labor Dispute' WHEN quality = 0 AND toxic = 1 THEN 'Cybersecurity Attack' END AS risk_category,
            CAST(CASE WHEN quality IS NOT NULL THEN n_chars % 11 ELSE 0 END AS INTEGER) AS manual_risk_score
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "events_daily": (
        (),
        "SELECT event_type, CAST(ts AS DATE) AS Date, avg(value) AS value, count(*) AS events FROM events GROUP BY ALL",
    ),
}


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        _ordered(BLOCKS[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def query(text: str, *blocks: str, extra: dict[str, str] | None = None) -> str:
    """``text`` behind the named blocks and what they need; ``extra`` adds blocks of its own."""
    parts = [f"{name} AS MATERIALIZED ({BLOCKS[name][1]})" for name in _ordered(blocks, [])]
    parts += [f"{name} AS MATERIALIZED ({body})" for name, body in (extra or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + text
