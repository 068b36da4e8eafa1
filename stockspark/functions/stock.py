"""Order quantity, safety stock, reorder point and cost formulas as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockspark.functions.binding import bind
from stockspark.functions.calendar import WEEKS_PER_YEAR
from stockspark.functions.normal import service_z


def _whole(value: Column) -> Column:
    return F.bround(value, 0)


def economic_order_quantity(annual_demand: Column, order_cost: Column, unit_holding_cost: Column) -> Column:
    valid = (annual_demand >= 0) & (order_cost >= 0) & (unit_holding_cost > 0)
    return F.when(valid, _whole(F.sqrt(F.lit(2.0) * annual_demand * order_cost / unit_holding_cost)))


def safety_stock(
    demand: Column, demand_sd: Column, lead_time: Column, lead_time_sd: Column, service_level: Column
) -> Column:
    valid = (demand >= 0) & (demand_sd >= 0) & (lead_time >= 0) & (lead_time_sd >= 0)
    spread = F.sqrt(lead_time * demand_sd * demand_sd + demand * demand * lead_time_sd * lead_time_sd)
    # NULL where the service level has no z; below 50 % z is negative and the stock is 0.
    return bind(
        service_z(service_level) * spread,
        lambda raw: F.when(valid & raw.isNotNull(), _whole(F.greatest(raw, F.lit(0.0)))),
    )


def reorder_point(demand: Column, lead_time: Column, stock: Column) -> Column:
    valid = (demand >= 0) & (lead_time >= 0) & (stock >= 0)
    return F.when(valid, _whole(demand * lead_time + stock))


def annual_demand(weekly: Column) -> Column:
    return weekly * F.lit(float(WEEKS_PER_YEAR))


def unit_holding_cost(item_cost: Column, rate_percent: Column) -> Column:
    return item_cost * (rate_percent / F.lit(100.0))


def order_and_stock(params: dict[str, Column]) -> dict[str, Column]:
    """EOQ and safety stock from the eight named inputs."""
    yearly = annual_demand(params["avg_weekly_demand"])
    holding = unit_holding_cost(params["item_cost_per_unit"], params["annual_holding_rate_percent"])
    order_cost = params["ordering_cost_per_order"]
    usable = (yearly > 0) & (order_cost >= 0) & (holding > 0)
    return {
        "EOQ": F.when(usable, economic_order_quantity(yearly, order_cost, holding)),
        "Safety_Stock": safety_stock(
            params["avg_weekly_demand"],
            params["std_dev_weekly_demand"],
            params["avg_lead_time_weeks"],
            params["std_dev_lead_time_weeks"],
            params["target_service_level_percent"],
        ),
    }
