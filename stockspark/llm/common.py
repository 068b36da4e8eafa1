"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Few rows an Arrow batch: texts may be long, and a batch must fit a worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has the name, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def map_rows(df: DataFrame, columns: list[str], function: Callable[[list[list]], list[list]], added: StructType) -> DataFrame:
    """Rows of ``df`` with columns computed batch by batch; nothing is shuffled.

    ``function`` gets the values of ``columns`` as lists and returns one list for each added column. A
    column of ``df`` that has the name of an added one is replaced by it.
    """
    small_batches(df.sparkSession)
    names = {f.name.lower() for f in added.fields}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in names]
    schema = StructType([*[df.schema.fields[i] for i in kept], *added.fields])
    places = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            made = function([batch.column(i).to_pylist() for i in places])
            arrays = [batch.column(i).cast(out.field(k).type) for k, i in enumerate(kept)]
            arrays += [pa.array(v, type=out.field(len(kept) + i).type) for i, v in enumerate(made or [[]] * len(added))]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(run, schema)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The digest of the text and the id as one text: rows of one id (or none) with other texts differ."""
    return F.concat_ws(":", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.col(doc_id).cast("string"))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of a splittable generator)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit_hash(*columns: Column) -> Column:
    """A repeatable draw in [0, 1) from the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))
