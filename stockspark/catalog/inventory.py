"""Inventory parameters, costs, replay and sensitivity over all series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.logbook import logged_periods
from stockspark.catalog.sql import pick, query, rounded
from stockspark.functions.normal import CENTRE_DEN, CENTRE_NUM, FAR_DEN, FAR_NUM, TAIL_DEN, TAIL_NUM, service_z
from stockspark.operators.inventory import (
    annual_costs,
    constant_demand,
    policy_parameters,
    replay,
    replay_kpis,
    sensitivity,
    stockouts,
)
from stockspark.operators.series import KEYS, tiled_history
from stockspark.plans import derived
from stockspark.plans.stocking import demand_inputs, history_replay, inventory_plan, logged_inputs

SWEPT = (
    "annual_holding_rate_percent",
    "ordering_cost_per_order",
    "target_service_level_percent",
    "avg_weekly_demand",
    "std_dev_weekly_demand",
    "avg_lead_time_weeks",
    "std_dev_lead_time_weeks",
)


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_plan(inputs.sales(spark, sf_dir), derived.unit_costs(spark, sf_dir))


def z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z for service levels spread over the parts, the limits included."""
    part = derived.table(spark, sf_dir, "part")
    level = (F.col("p_partkey") % 1001).cast("double") / 10
    return shown(part.select("p_partkey", level.alias("level"), service_z(level).alias("z")), 6)


def demand_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(demand_inputs(inputs.sales(spark, sf_dir), derived.unit_costs(spark, sf_dir)))


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_plan(spark, sf_dir).select("Store", "Dept", "EOQ", "Safety_Stock", "ROP"))


def parameters_from_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy from logged runs: demand of the test period, RMSE as its deviation."""
    plan = policy_parameters(logged_inputs(logged_periods(spark, sf_dir), inputs.sales(spark, sf_dir)))
    return shown(plan.select("Store", "Dept", "Model", "EOQ", "Safety_Stock", "ROP"))


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(annual_costs(_plan(spark, sf_dir)), 2)


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history_replay(inputs.sales(spark, sf_dir), _plan(spark, sf_dir)))


def replayed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every week of every series, not only the first year."""
    history = tiled_history(inputs.sales(spark, sf_dir), None, KEYS, "Units")
    policy = _plan(spark, sf_dir).select(*KEYS, "EOQ", "ROP", F.lit(4).alias("lead_time"))
    return shown(replay_kpis(replay(history, policy, None)))


def constant_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    demand = constant_demand(plan.select(*KEYS, "avg_weekly_demand"))
    policy = plan.select(*KEYS, "EOQ", "ROP", F.lit(4).alias("lead_time"))
    return shown(replay_kpis(replay(demand, policy)))


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(replay_kpis(history_replay(inputs.sales(spark, sf_dir), _plan(spark, sf_dir))))


def stockout_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = history_replay(inputs.sales(spark, sf_dir), _plan(spark, sf_dir))
    return shown(stockouts(trace).select("Store", "Dept", "Period", "Demand", "Stockout_Units"))


def sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = demand_inputs(inputs.sales(spark, sf_dir), derived.unit_costs(spark, sf_dir))
    return shown(sensitivity(base, SWEPT))


def _poly(coefficients: tuple[float, ...], x: str) -> str:
    text = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def _z(p: str) -> str:
    """The same published approximation as the engine uses, in SQL."""
    q = f"({p} - 0.5::DOUBLE)"
    r0 = f"(0.180625::DOUBLE - {q} * {q})"
    edge = f"sqrt(-ln(CASE WHEN {q} < 0 THEN {p} ELSE 1.0::DOUBLE - {p} END))"
    r1, r2 = f"({edge} - 1.6::DOUBLE)", f"({edge} - 5.0::DOUBLE)"
    return f"""CASE WHEN {p} > 0 AND {p} < 1 THEN CASE WHEN abs({q}) <= 0.425 THEN {q} * {_poly(CENTRE_NUM, r0)} / {_poly(CENTRE_DEN, r0)}
    ELSE (CASE WHEN {q} < 0 THEN -1 ELSE 1 END) * CASE WHEN {edge} <= 5 THEN {_poly(TAIL_NUM, r1)} / {_poly(TAIL_DEN, r1)}
    ELSE {_poly(FAR_NUM, r2)} / {_poly(FAR_DEN, r2)} END END END"""


def _policy(source: str) -> str:
    """EOQ, Safety_Stock and ROP over a table of the eight inputs."""
    return f"""SELECT *, CASE WHEN avg_weekly_demand >= 0 AND avg_lead_time_weeks >= 0 AND Safety_Stock >= 0
        THEN round_even(avg_weekly_demand * avg_lead_time_weeks + Safety_Stock, 0) END AS ROP
    FROM (SELECT *, CASE WHEN yearly > 0 AND ordering_cost_per_order >= 0 AND holding > 0
            THEN round_even(sqrt(2.0::DOUBLE * yearly * ordering_cost_per_order / holding), 0) END AS EOQ,
        round_even(greatest(z * sqrt(avg_lead_time_weeks * std_dev_weekly_demand * std_dev_weekly_demand
            + avg_weekly_demand * avg_weekly_demand * std_dev_lead_time_weeks * std_dev_lead_time_weeks), 0.0), 0) AS Safety_Stock
    FROM (SELECT *, avg_weekly_demand * 52.0::DOUBLE AS yearly, item_cost_per_unit * (annual_holding_rate_percent / 100.0::DOUBLE) AS holding,
        {_z('pz')} AS z
    FROM (SELECT *, CASE WHEN target_service_level_percent = 100 THEN 99.999::DOUBLE / 100
            WHEN target_service_level_percent > 0 AND target_service_level_percent < 100 THEN CAST(target_service_level_percent AS DOUBLE) / 100 END AS pz
        FROM {source})))"""


_replay = """WITH RECURSIVE run AS (
    SELECT d.Store, d.Dept, d.t, d.demand, p.ROP AS start, 0.0::DOUBLE AS arriving, p.EOQ, p.ROP,
        least(p.ROP, d.demand) AS sold, p.ROP - least(p.ROP, d.demand) AS ending,
        p.ROP - least(p.ROP, d.demand) <= p.ROP AS ordered,
        CASE WHEN p.ROP - least(p.ROP, d.demand) <= p.ROP THEN d.t + 4 ELSE -1 END AS due
    FROM demand d JOIN policy p ON d.Store = p.Store AND d.Dept = p.Dept WHERE d.t = 1
    UNION ALL
    SELECT Store, Dept, t, demand, start, arriving, EOQ, ROP, sold, available - sold, ordered,
        CASE WHEN ordered THEN t + 4 ELSE still END
    FROM (SELECT *, available - sold <= ROP AND still = -1 AS ordered
    FROM (SELECT *, least(available, demand) AS sold
    FROM (SELECT d.Store, d.Dept, d.t, d.demand, r.ending AS start, r.EOQ, r.ROP,
            CASE WHEN r.due = d.t THEN r.EOQ ELSE 0.0 END AS arriving,
            r.ending + CASE WHEN r.due = d.t THEN r.EOQ ELSE 0.0 END AS available,
            CASE WHEN r.due = d.t THEN -1 ELSE r.due END AS still
          FROM run r JOIN demand d ON d.Store = r.Store AND d.Dept = r.Dept AND d.t = r.t + 1))))
SELECT Store, Dept, t AS Period, demand AS Demand, start AS Inventory_Start_Period, arriving AS Order_Arriving_This_Period,
    start + arriving AS Inventory_After_Arrival, sold AS Units_Sold, greatest(demand - (start + arriving), 0.0) AS Stockout_Units,
    ending AS Inventory_End_Period, CASE WHEN ordered THEN EOQ ELSE 0.0 END AS Order_Placed_Qty,
    CASE WHEN ordered THEN CAST(t + 4 AS DOUBLE) END AS Order_Due_Start_of_Period FROM run"""
_policy_block = {"policy": f"SELECT * FROM ({_policy('inputs')}) WHERE EOQ > 0 AND ROP >= 0"}
_first_year = {
    "demand": """SELECT Store, Dept, CAST(p AS INTEGER) AS t, greatest(Units, 0.0) AS demand
    FROM (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS rn, count(*) OVER (PARTITION BY Store, Dept) AS n FROM sales)
    JOIN range(1, 53) r(p) ON rn = (p - 1) % n + 1""",
    **_policy_block,
    "trace": _replay,
}
_all_weeks = {
    "demand": """SELECT Store, Dept, CAST(row_number() OVER (PARTITION BY Store, Dept ORDER BY Date) AS INTEGER) AS t, Units AS demand FROM sales""",
    **_policy_block,
    "trace": _replay,
}
_constant = {
    "demand": "SELECT Store, Dept, CAST(p AS INTEGER) AS t, avg_weekly_demand AS demand FROM inputs, range(1, 53) r(p)",
    **_policy_block,
    "trace": _replay,
}
_kpi_text = f"""SELECT Store, Dept, {rounded('sum(Demand)')} AS total_demand, {rounded('sum(Units_Sold)')} AS total_sold,
{rounded('sum(Stockout_Units)')} AS total_stockout, {rounded('CASE WHEN sum(Demand) > 0 THEN sum(Units_Sold) / sum(Demand) * 100 END')} AS fill_rate_percent,
count(*) FILTER (WHERE Order_Placed_Qty > 0) AS orders, {rounded('avg(Inventory_End_Period)')} AS avg_ending_stock FROM trace GROUP BY Store, Dept"""
_trace_columns = (
    "Demand Inventory_Start_Period Order_Arriving_This_Period Inventory_After_Arrival Units_Sold Stockout_Units "
    "Inventory_End_Period Order_Placed_Qty Order_Due_Start_of_Period"
)
_inputs_columns = (
    "avg_weekly_demand std_dev_weekly_demand item_cost_per_unit ordering_cost_per_order annual_holding_rate_percent "
    "avg_lead_time_weeks std_dev_lead_time_weeks target_service_level_percent"
)
_ranges = {
    "annual_holding_rate_percent": ("greatest(1.0, {x} * 0.5)", "least(100.0, {x} * 1.5)"),
    "ordering_cost_per_order": ("greatest(0.0, {x} * 0.5)", "{x} * 1.5 + 1"),
    "target_service_level_percent": ("greatest(50.0, {x} - 20)", "least(99.9, {x} + 20)"),
    "avg_weekly_demand": ("greatest(1.0, {x} * 0.5)", "{x} * 1.5 + 1"),
    "std_dev_weekly_demand": ("greatest(0.0, {x} * 0.5)", "{x} * 1.5 + 1"),
    "avg_lead_time_weeks": ("greatest(0.1, {x} * 0.5)", "{x} * 1.5 + 0.1"),
    "std_dev_lead_time_weeks": ("greatest(0.0, {x} * 0.5)", "{x} * 1.5 + 0.1"),
}


def _sweep(name: str) -> str:
    low, high = (f"CAST({bound.format(x=name)} AS DOUBLE)" for bound in _ranges[name])
    value = f"{low} + k * (({high} - {low}) / 10.0::DOUBLE)"
    others = ", ".join(c for c in _inputs_columns.split() if c != name)
    return f"""SELECT Store, Dept, '{name}' AS parameter, CAST(k AS INTEGER) AS step, {value} AS "value", {value} AS {name}, {others}
    FROM inputs, range(11) r(k)"""


def _sweeps() -> str:
    names = _inputs_columns.split()
    union = " UNION ALL ".join(f"SELECT Store, Dept, parameter, step, value, {', '.join(names)} FROM ({_sweep(n)})" for n in SWEPT)
    return query(
        f"SELECT {pick('Store Dept parameter step', '', 'value EOQ Safety_Stock ROP')} FROM ({_policy('swept')})", "inputs", extra={"swept": union}
    )


def _cost_rows() -> str:
    parts = {
        "Annual Ordering Costs": "o",
        "Annual Holding Costs (Cycle Stock)": "c",
        "Annual Holding Costs (Safety Stock)": "s",
        "Total Annual Holding Costs": "c + s",
        "Total Relevant Inventory Costs": "o + c + s",
    }
    body = " UNION ALL ".join(f"SELECT Store, Dept, '{n}' AS component, {rounded(e, 2)} AS cost FROM p" for n, e in parts.items())
    return query(
        body,
        "inputs",
        extra={
            "p": f"""SELECT Store, Dept, yearly / EOQ * ordering_cost_per_order AS o, EOQ / 2 * holding AS c, Safety_Stock * holding AS s
            FROM ({_policy('inputs')}) WHERE EOQ > 0"""
        },
    )


ENTRIES = {
    "service_z": (
        z_scores,
        f"""SELECT p_partkey, {rounded('level', 6)} AS level, {rounded(_z('p'), 6)} AS z FROM
        (SELECT *, CASE WHEN level = 100 THEN 99.999::DOUBLE / 100 WHEN level > 0 THEN level / 100 END AS p
         FROM (SELECT p_partkey, CAST(p_partkey % 1001 AS DOUBLE) / 10 AS level FROM part))""",
    ),
    "demand_inputs": (demand_table, query(f"SELECT {pick('Store Dept', '', _inputs_columns)} FROM inputs", "inputs")),
    "inventory_parameters": (
        parameters,
        query(f"SELECT {pick('Store Dept', '', 'EOQ Safety_Stock ROP')} FROM ({_policy('inputs')})", "inputs"),
    ),
    "inventory_parameters_from_logs": (
        parameters_from_logs,
        query(
            f"SELECT {pick('Store Dept Model', '', 'EOQ Safety_Stock ROP')} FROM ({_policy('logged')})",
            "logs", "sales",
            extra={
                "logged": """SELECT l.Store, l.Dept, Model, round_even(avg(s.Weekly_Sales), 2) AS avg_weekly_demand,
                    round_even(max(RMSE), 2) AS std_dev_weekly_demand, 10.0::DOUBLE AS item_cost_per_unit, 50.0::DOUBLE AS ordering_cost_per_order,
                    20.0::DOUBLE AS annual_holding_rate_percent, 4.0::DOUBLE AS avg_lead_time_weeks,
                    1.0::DOUBLE AS std_dev_lead_time_weeks, 95.0::DOUBLE AS target_service_level_percent
                FROM logs l JOIN sales s ON l.Store = s.Store AND l.Dept = s.Dept AND s.Date BETWEEN test_lo AND test_hi GROUP BY l.Store, l.Dept, Model"""
            },
        ),
    ),
    "annual_costs": (costs, _cost_rows()),
    "policy_replay": (
        replayed,
        query(f"SELECT {pick('Store Dept Period', '', _trace_columns)} FROM trace", "sales", "inputs", extra=_first_year),
    ),
    "policy_replay_all_weeks": (replayed_all, query(_kpi_text, "sales", "inputs", extra=_all_weeks)),
    "policy_replay_constant": (constant_replay, query(_kpi_text, "inputs", extra=_constant)),
    "replay_kpis": (kpis, query(_kpi_text, "sales", "inputs", extra=_first_year)),
    "stockouts": (
        stockout_weeks,
        query(
            f"SELECT {pick('Store Dept Period', '', 'Demand Stockout_Units')} FROM trace WHERE Stockout_Units > 0",
            "sales", "inputs", extra=_first_year,
        ),
    ),
    "sensitivity": (sweeps, _sweeps()),
}
