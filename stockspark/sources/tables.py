"""Readers and writers for panels, dimension tables, news and experiment logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from stockspark.operators.boosting import BoostedTrees
from stockspark.checks import require_columns
from stockspark.functions.coerce import nan_to_null

SALES = "Store int, Dept int, Date string, Weekly_Sales double, IsHoliday boolean"
STORES = "Store int, Type string, Size int"
FEATURES = (
    "Store int, Date string, Temperature double, Fuel_Price double, MarkDown1 double, MarkDown2 double, "
    "MarkDown3 double, MarkDown4 double, MarkDown5 double, CPI double, Unemployment double, IsHoliday boolean"
)
NEWS = (
    "id int, date_published string, source string, headline string, summary string, keywords string, "
    "risk_category string, risk_score string"
)
FORECAST_LOG = (
    "Timestamp string, Store string, Dept string, Model string, Parameters string, Train_Period string, "
    "Test_Period string, MAE string, RMSE string, MAPE string"
)
FEATURE_LOG = (
    "Timestamp string, Store string, Dept string, Model string, Parameters string, Train_Period string, "
    "Test_Period string, Features_Count string, Features_List_Used string, MAE string, RMSE string, MAPE string"
)
PANEL_COLUMNS = ("Date", "Store", "Dept", "Weekly_Sales")
# How CSV files mark a missing value.
MISSING = "NA"


def read_csv(spark: SparkSession, path: str, schema: str | StructType, quoted_lines: bool = False) -> DataFrame:
    """A CSV file with a header, an explicit schema and no inference pass; NaN is read as missing.

    Quotes inside quoted fields are doubled. ``quoted_lines`` allows line breaks inside quotes,
    which makes each file a single split; leave it off for large plain files.
    """
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    reader = reader.option("nullValue", MISSING).option("enforceSchema", False)
    if quoted_lines:
        reader = reader.option("multiLine", True)
    rows = reader.csv(path)
    real = {f.name: nan_to_null(F.col(f.name)) for f in rows.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return rows.withColumns(real) if real else rows


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_panel(
    spark: SparkSession, path: str, fallback: str | None = None, schema: str | StructType | None = None
) -> DataFrame:
    """Parquet or CSV by extension; ``fallback`` is read where ``path`` does not exist."""
    chosen = path
    if not path_exists(spark, path):
        if fallback is None or not path_exists(spark, fallback):
            raise FileNotFoundError(path)
        chosen = fallback
    if chosen.rstrip("/").lower().endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV panel needs a schema")
        return read_csv(spark, chosen, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(chosen)


def sales_columns(panel: DataFrame) -> DataFrame:
    """Only the four columns of a sales history; the Parquet scan reads no others."""
    return require_columns(panel, PANEL_COLUMNS).select(*PANEL_COLUMNS)


def save_panel(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("Store",),
    sort_by: Sequence[str] = ("Store", "Dept", "Date"),
) -> None:
    """Write Parquet partitioned by store, or CSV where the path says so.

    Rows are spread by store and a hash of the rest of the sort key before the write, so a large
    store is written by many tasks, and sorted inside each file.
    """
    sort_by = [name for name in sort_by if name in df.columns]
    if path.rstrip("/").lower().endswith(".csv"):
        df.sortWithinPartitions(*sort_by).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return
    spread = [name for name in ("Store", "Dept") if name in df.columns]
    writer = df.repartition(*spread) if spread else df
    writer.sortWithinPartitions(*sort_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Add records to an experiment log table."""
    df.write.mode("append").parquet(path)


def union_logs(logs: dict[str, DataFrame]) -> DataFrame:
    """All logs by column name, with their source; columns a log lacks are NULL."""
    combined = None
    for source, log in logs.items():
        tagged = log.withColumn("Log_Type_Source", F.lit(source))
        combined = tagged if combined is None else combined.unionByName(tagged, allowMissingColumns=True)
    if combined is None:
        raise ValueError("no logs given")
    return combined


def latest_artifact(spark: SparkSession, folder: str, prefix: str) -> str | None:
    """The entry of ``folder`` with ``prefix`` whose name sorts last."""
    if not path_exists(spark, folder):
        return None
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    entries = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = [e.getPath().getName() for e in entries if e.getPath().getName().startswith(prefix)]
    return f"{folder.rstrip('/')}/{max(names)}" if names else None


def save_model(model: PipelineModel | BoostedTrees, path: str, spark: SparkSession | None = None) -> None:
    """Store ``model``; threads of their own have no active session and pass ``spark``."""
    if isinstance(model, BoostedTrees):
        model.save(spark or SparkSession.getActiveSession(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str, spark: SparkSession | None = None) -> PipelineModel | BoostedTrees:
    """The model stored at ``path``; MLlib's have a folder of stages, boosted trees a table."""
    spark = spark or SparkSession.getActiveSession()
    if path_exists(spark, f"{path.rstrip('/')}/stages"):
        return PipelineModel.load(path)
    return BoostedTrees.load(spark, path)
