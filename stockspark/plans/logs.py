"""Experiment logs: parsing, and the log of the engine's own series forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockspark.checks import require_columns
from stockspark.functions.coerce import (
    consolidated_features,
    id_or_unknown,
    literal_to_list,
    literal_to_map,
    number_or_null,
    period_bounds,
    period_text,
)
from stockspark.operators.accuracy import METRICS, with_family
from stockspark.sources.tables import union_logs


def parse_logs(logs: dict[str, DataFrame], mapping: str = "page") -> DataFrame:
    """Combined logs with parsed parameters, features, periods, numbers and model families."""
    combined = union_logs(logs)
    require_columns(combined, ["Model", "Parameters"])
    for name in ("Store", "Dept", "Test_Period", "Features_List_Used", *METRICS):
        if name not in combined.columns:
            combined = combined.withColumn(name, F.lit(None).cast("string"))
    params = F.col("Parameters_Map")
    parsed = combined.withColumn("Parameters_Map", literal_to_map(F.col("Parameters")))
    parsed = parsed.withColumns(
        {
            "Store": id_or_unknown(F.col("Store")),
            "Dept": id_or_unknown(F.col("Dept")),
            **{name: number_or_null(F.col(name)) for name in METRICS},
            "model_path": params.getItem("model_path"),
            "Features_List": consolidated_features(literal_to_list(F.col("Features_List_Used")), params),
        }
    )
    start, end = period_bounds(period_text(F.col("Test_Period"), params))
    return with_family(parsed.withColumns({"period_start": start, "period_end": end}), mapping)
