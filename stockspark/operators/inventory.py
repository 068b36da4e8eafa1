"""Inventory parameters, cost breakdown, policy replay and sensitivity of many series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockspark.checks import require_choice, require_columns
from stockspark.functions.binding import bind
from stockspark.functions.stock import annual_demand, order_and_stock, reorder_point, unit_holding_cost
from stockspark.operators.series import KEYS
from stockspark.session import by_series

# Inputs used where a series has none of its own.
DEFAULTS = {
    "avg_weekly_demand": 100.0,
    "std_dev_weekly_demand": 20.0,
    "item_cost_per_unit": 10.0,
    "ordering_cost_per_order": 50.0,
    "annual_holding_rate_percent": 20.0,
    "avg_lead_time_weeks": 4.0,
    "std_dev_lead_time_weeks": 1.0,
    "target_service_level_percent": 95.0,
}
# Opening stock without a reorder point, and the weeks a replay may cover.
OPENING_STOCK = 150.0
REPLAY_WEEKS, DEFAULT_WEEKS = (4, 260), 52
SWEEP_STEPS, DEFAULT_STEPS = (3, 50), 11


def with_defaults(df: DataFrame) -> DataFrame:
    """All eight inputs, from the series where it has them and from DEFAULTS otherwise."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name).cast("double"), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in DEFAULTS.items()
        }
    )


def demand_statistics(logged: DataFrame, by: Sequence[str] = (*KEYS, "Model")) -> DataFrame:
    """Mean demand over the logged period and its deviation, for which the RMSE stands.

    ``logged`` holds one row per sale in a logged period, with the RMSE of the run.
    """
    return logged.groupBy(*by).agg(
        F.coalesce(F.bround(F.avg("Weekly_Sales"), 2), F.lit(DEFAULTS["avg_weekly_demand"])).alias("avg_weekly_demand"),
        F.coalesce(F.bround(F.max("RMSE"), 2), F.lit(DEFAULTS["std_dev_weekly_demand"])).alias("std_dev_weekly_demand"),
    )


def period_demand_statistics(totals: DataFrame, by: Sequence[str] = (*KEYS, "Model")) -> DataFrame:
    """The same as ``demand_statistics``, from the sums of ``period_totals`` over each logged run."""
    mean = F.try_divide(F.sum("total").cast("double"), F.sum("n_values"))
    return totals.where("n_rows > 0").groupBy(*by).agg(
        F.coalesce(F.bround(mean, 2), F.lit(DEFAULTS["avg_weekly_demand"])).alias("avg_weekly_demand"),
        F.coalesce(F.bround(F.max("RMSE"), 2), F.lit(DEFAULTS["std_dev_weekly_demand"])).alias("std_dev_weekly_demand"),
    )


def policy_parameters(df: DataFrame) -> DataFrame:
    """EOQ, Safety_Stock and ROP for every row of inputs."""
    require_columns(df, DEFAULTS)
    staged = df.withColumns(order_and_stock({name: F.col(name) for name in DEFAULTS}))
    point = reorder_point(F.col("avg_weekly_demand"), F.col("avg_lead_time_weeks"), F.col("Safety_Stock"))
    return staged.withColumn("ROP", point)


def annual_costs(df: DataFrame) -> DataFrame:
    """Long form: one row per series and cost component; only where EOQ is positive."""
    require_columns(df, [*DEFAULTS, "EOQ", "Safety_Stock"])
    holding = unit_holding_cost(F.col("item_cost_per_unit"), F.col("annual_holding_rate_percent"))
    ordering = annual_demand(F.col("avg_weekly_demand")) / F.col("EOQ") * F.col("ordering_cost_per_order")
    cycle = F.col("EOQ") / 2 * holding
    safety = F.col("Safety_Stock") * holding
    parts = {
        "Annual Ordering Costs": ordering,
        "Annual Holding Costs (Cycle Stock)": cycle,
        "Annual Holding Costs (Safety Stock)": safety,
        "Total Annual Holding Costs": cycle + safety,
        "Total Relevant Inventory Costs": ordering + cycle + safety,
    }
    rows = [F.struct(F.lit(name).alias("component"), value.alias("cost")) for name, value in parts.items()]
    kept = [name for name in df.columns if name not in (*DEFAULTS, "EOQ", "Safety_Stock", "ROP")]
    known = df.where((F.col("EOQ") > 0) & F.col("Safety_Stock").isNotNull())
    return known.select(*kept, F.inline(F.array(*rows)))


def constant_demand(df: DataFrame, weeks: int = DEFAULT_WEEKS, demand: str = "avg_weekly_demand") -> DataFrame:
    """The average demand of each series, repeated."""
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("period")).withColumn(
        "demand", F.col(demand)
    )


def replay(demand: DataFrame, policy: DataFrame, weeks: int | None = DEFAULT_WEEKS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Replay a reorder-point policy over the demand of every series.

    ``demand`` has ``keys``, ``period`` (1, 2, ...) and ``demand``. ``policy`` has ``keys``,
    ``EOQ``, ``ROP``, ``lead_time`` (whole weeks, at least 1) and optionally ``opening_stock``
    (default: the reorder point). Within a week: arrivals, sales, then the reorder check. At
    most one order is open at a time. Series run in parallel; inside a series the state is a
    fold over its weeks, of which there are at most a few hundred. ``weeks=None`` replays all
    periods.
    """
    if weeks is not None and not REPLAY_WEEKS[0] <= weeks <= REPLAY_WEEKS[1]:
        raise ValueError(f"weeks must be between {REPLAY_WEEKS[0]} and {REPLAY_WEEKS[1]}")
    require_columns(demand, [*keys, "period", "demand"])
    require_columns(policy, [*keys, "EOQ", "ROP", "lead_time"])
    used = demand if weeks is None else demand.where(F.col("period") <= weeks)
    packed = by_series(used, keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("period").cast("int").alias("t"), F.col("demand").cast("double").alias("d")))).alias("_weeks")
    )
    opening = F.coalesce(F.col("opening_stock").cast("double"), F.col("ROP")) if "opening_stock" in policy.columns else F.col("ROP")
    valid = (F.col("EOQ") > 0) & (F.col("ROP") >= 0) & (F.col("lead_time") >= 1) & (opening >= 0)
    settings = policy.where(valid).select(
        *keys,
        F.col("EOQ").cast("double").alias("_q"),
        F.col("ROP").cast("double").alias("_r"),
        F.col("lead_time").cast("int").alias("_lead"),
        opening.cast("double").alias("_open"),
    )
    joined = packed.join(settings, list(keys))
    quantity, point, lead = F.col("_q"), F.col("_r"), F.col("_lead")

    def week(state: Column, item: Column) -> Column:
        arriving = F.when(state["due"] == item["t"], quantity).otherwise(F.lit(0.0))
        return bind(
            F.struct(
                state["stock"].alias("start"),
                arriving.alias("arriving"),
                (state["stock"] + arriving).alias("available"),
                F.greatest(item["d"], F.lit(0.0)).alias("demand"),
                # An order that has arrived is no longer open.
                F.when(state["due"] == item["t"], F.lit(-1)).otherwise(state["due"]).alias("due"),
            ),
            lambda a: bind(
                F.struct(
                    a.alias("a"),
                    F.least(a["available"], a["demand"]).alias("sold"),
                    ((a["available"] - F.least(a["available"], a["demand"]) <= point) & (a["due"] == -1)).alias("order"),
                ),
                lambda b: F.struct(
                    (b["a"]["available"] - b["sold"]).alias("stock"),
                    F.when(b["order"], item["t"] + lead).otherwise(b["a"]["due"]).alias("due"),
                    F.concat(
                        state["trace"],
                        F.array(
                            F.struct(
                                item["t"].alias("Period"),
                                b["a"]["demand"].alias("Demand"),
                                b["a"]["start"].alias("Inventory_Start_Period"),
                                b["a"]["arriving"].alias("Order_Arriving_This_Period"),
                                b["a"]["available"].alias("Inventory_After_Arrival"),
                                b["sold"].alias("Units_Sold"),
                                F.greatest(b["a"]["demand"] - b["a"]["available"], F.lit(0.0)).alias("Stockout_Units"),
                                (b["a"]["available"] - b["sold"]).alias("Inventory_End_Period"),
                                F.when(b["order"], quantity).otherwise(F.lit(0.0)).alias("Order_Placed_Qty"),
                                F.when(b["order"], (item["t"] + lead).cast("double")).alias("Order_Due_Start_of_Period"),
                            )
                        ),
                    ).alias("trace"),
                ),
            ),
        )

    trace = (
        "array<struct<Period:int,Demand:double,Inventory_Start_Period:double,"
        "Order_Arriving_This_Period:double,Inventory_After_Arrival:double,Units_Sold:double,"
        "Stockout_Units:double,Inventory_End_Period:double,Order_Placed_Qty:double,"
        "Order_Due_Start_of_Period:double>>"
    )
    start = F.struct(F.col("_open").alias("stock"), F.lit(-1).alias("due"), F.array().cast(trace).alias("trace"))
    folded = F.aggregate("_weeks", start, week, lambda state: state["trace"])
    return joined.select(*keys, F.inline(folded))


def replay_kpis(trace: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    demand, sold = F.sum("Demand"), F.sum("Units_Sold")
    return trace.groupBy(*keys).agg(
        demand.alias("total_demand"),
        sold.alias("total_sold"),
        F.sum("Stockout_Units").alias("total_stockout"),
        F.when(demand > 0, sold / demand * F.lit(100.0)).alias("fill_rate_percent"),
        F.count_if(F.col("Order_Placed_Qty") > 0).alias("orders"),
        F.avg("Inventory_End_Period").alias("avg_ending_stock"),
    )


def stockouts(trace: DataFrame) -> DataFrame:
    return trace.where(F.col("Stockout_Units") > 0)


def sweep_range(parameter: str, base: Column) -> tuple[Column, Column]:
    """Default lower and upper bound of a swept input around its value."""
    lower, upper = base * F.lit(0.5), base * F.lit(1.5)
    ranges = {
        "annual_holding_rate_percent": (F.greatest(F.lit(1.0), lower), F.least(F.lit(100.0), upper)),
        "ordering_cost_per_order": (F.greatest(F.lit(0.0), lower), upper + 1),
        "target_service_level_percent": (F.greatest(F.lit(50.0), base - 20), F.least(F.lit(99.9), base + 20)),
        "avg_weekly_demand": (F.greatest(F.lit(1.0), lower), upper + 1),
        "std_dev_weekly_demand": (F.greatest(F.lit(0.0), lower), upper + 1),
        "avg_lead_time_weeks": (F.greatest(F.lit(0.1), lower), upper + 0.1),
        "std_dev_lead_time_weeks": (F.greatest(F.lit(0.0), lower), upper + 0.1),
    }
    require_choice(parameter, ranges, "parameter")
    return ranges[parameter]


def sensitivity(
    df: DataFrame,
    parameters: str | Sequence[str],
    low: float | None = None,
    high: float | None = None,
    steps: int = DEFAULT_STEPS,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """EOQ, safety stock and reorder point as one input moves from ``low`` to ``high``.

    With several parameters, each is moved in turn while the others stay. Each row of inputs is
    stretched in place; nothing is joined or shuffled.
    """
    parameters = [parameters] if isinstance(parameters, str) else list(parameters)
    if not SWEEP_STEPS[0] <= steps <= SWEEP_STEPS[1]:
        raise ValueError(f"steps must be between {SWEEP_STEPS[0]} and {SWEEP_STEPS[1]}")
    if low is not None and high is not None and low >= high:
        raise ValueError("low must be below high")
    require_columns(df, [*keys, *DEFAULTS])
    plans = []
    for name in parameters:
        first, last = sweep_range(name, F.col(name))
        first = first if low is None else F.lit(float(low))
        last = last if high is None else F.lit(float(high))
        width = (last - first) / F.lit(float(steps - 1))
        plans.append(F.struct(F.lit(name).alias("parameter"), first.alias("_first"), width.alias("_width")))
    moved = df.select(*keys, *DEFAULTS, F.inline(F.array(*plans)))
    moved = moved.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    moved = moved.withColumn("value", F.col("_first") + F.col("step") * F.col("_width"))
    varied = {n: F.when(F.col("parameter") == n, F.col("value")).otherwise(F.col(n)) for n in parameters}
    swept = policy_parameters(moved.withColumns(varied))
    return swept.select(*keys, "parameter", "step", "value", "EOQ", "Safety_Stock", "ROP")
