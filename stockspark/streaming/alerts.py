"""The alert plan on a stream of news files.

Scoring an item needs no other item, so the batch plan runs unchanged: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stockspark.operators.alerts import filter_alerts
from stockspark.plans.risk import enrich
from stockspark.session import scratch_path


def news_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def write_alerts(stream: DataFrame, path: str, low: int = 0, checkpoint: str | None = None) -> StreamingQuery:
    """Append scored items from ``low`` up to ``path``; stops when the waiting files are done."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "alerts-checkpoint")
    scored = filter_alerts(enrich(stream), low=low)
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)
