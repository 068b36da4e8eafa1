"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "stockspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win where given.

    Adaptive execution picks the number of shuffle partitions, turns a sort-merge join into a
    broadcast join once the measured size allows it, and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the setting is absent, a folder of the default file system is taken, and a temporary
    folder of this machine only in local mode. A folder of one machine is refused on a cluster, as
    every executor would write to its own disk.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        active = context._jsc.sc().getCheckpointDir()
        if active.isDefined():
            return active.get()
        configured = default_folder(context.master, spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(configured)
        return context._jsc.sc().getCheckpointDir().get()
    return configured


def default_folder(master: str, default_fs: str) -> str:
    """Where intermediate tables go without ``spark.checkpoint.dir``."""
    if not default_fs.startswith("file:"):
        return f"{default_fs.rstrip('/')}/tmp/stockspark"
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="stockspark-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for this application under the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/stockspark/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote with ``materialise``, once nothing reads them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def materialise(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Used where several jobs read the same result (model fits). The written table also cuts the
    lineage, and it outlives lost executors, unlike cached blocks. With ``drop_shuffles`` the
    shuffle files of the write go with it, as nothing reads them again; else Spark keeps them
    until the driver collects garbage.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    if drop_shuffles:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def by_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partition by series for work that is heavy per row.

    Adaptive execution merges small partitions by their bytes, which would leave costly folds to
    a few tasks. An explicit number of partitions stays as it is, and later groupings and
    windows on ``keys`` reuse it.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)
