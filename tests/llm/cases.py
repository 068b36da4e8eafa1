"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"

AWKWARD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "12345 !!"), (4, "word"), (4, "word"), (None, "no id here"), (5, "ünïcödé 文字 тест"),
    (6, "a" * 5000), (7, "the cat sat on the mat and looked at the dog " * 400), (8, "the cat sat on the mat and looked at the dog " * 400),
    (-3, "x y z"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def real_rows(limit: int = 200) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT {limit}").fetchall()


def frame(spark, rows, clash=()):
    """Documents from (doc_id, text) rows, with extra columns of clashing names."""
    full = [(i, t, "en" if k % 2 else None, None if k % 3 else "s", len(t or "")) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("extra") for c in clash})


def written(spark, folder, name, df):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
