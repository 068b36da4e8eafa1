"""Inventory plan of every series from its demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockspark.operators.inventory import period_demand_statistics, policy_parameters, replay, with_defaults
from stockspark.operators.periods import period_totals
from stockspark.operators.series import KEYS, tiled_history


def demand_inputs(sales: DataFrame, costs: DataFrame, demand: str = "Units") -> DataFrame:
    """Mean and deviation of weekly demand and the item cost of each series; defaults for the rest."""
    means = sales.groupBy(*KEYS).agg(
        F.avg(demand).alias("avg_weekly_demand"), F.stddev_samp(demand).alias("std_dev_weekly_demand")
    )
    return with_defaults(means.join(costs, "Dept", "left"))


def logged_inputs(logs: DataFrame, sales: DataFrame) -> DataFrame:
    """Inputs from logged runs: demand over the test period, RMSE as its deviation."""
    usable = logs.where(F.col("RMSE").isNotNull() & F.col("period_start").isNotNull())
    logged = period_totals(usable.select(*KEYS, "Model", "RMSE", "period_start", "period_end"), sales)
    return with_defaults(period_demand_statistics(logged))


def inventory_plan(sales: DataFrame, costs: DataFrame, demand: str = "Units") -> DataFrame:
    return policy_parameters(demand_inputs(sales, costs, demand))


def history_replay(sales: DataFrame, plan: DataFrame, weeks: int = 52, demand: str = "Units") -> DataFrame:
    """Replay of each series' policy over its own first weeks of demand."""
    history = tiled_history(sales, weeks, KEYS, demand)
    policy = plan.select(*KEYS, "EOQ", "ROP", F.bround("avg_lead_time_weeks").cast("int").alias("lead_time"))
    return replay(history, policy, weeks)
