"""A training-corpus pipeline: five stages over documents, each written as Parquet and read by the next.

Language identification drops documents without a language, near-duplicates leave one document of each
class, decontamination drops documents that hold benchmark passages, personal data is masked in place,
and mixing samples documents to target weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.llm import contamination, language, mixing, neardup, pii
from stockspark.llm.common import free_name, table
from stockspark.session import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; null texts and texts without letters go."""
    model = language.fit(language.training_rows(docs.select("doc_id", "text", "lang")))
    name, score = free_name(docs, "__language"), free_name(docs, "__score")
    return language.identify(docs, model, language=name, score=score).where(F.col(name) != language.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the lowest id."""
    return neardup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by marks."""
    return pii.mask(docs, pii.fit(docs.select("doc_id", "text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with calibrated probabilities, with their topic and weight.

    A column of the documents that has the name of an added one stays as it is.
    """
    # Columns with a name that mixing uses wait under another one.
    used = {f"__{name}" for name in mixing.ADDED}
    aside = {c: free_name(docs, f"{c}_kept") for c in docs.columns if c.lower() in used}
    found = mixing.mix(docs.withColumnsRenamed(aside)).where("__sampled")
    added = {"topic": "__topic", "weight": "__weight", "probability": "__probability"}
    taken = {c.lower() for c in docs.columns}
    return found.select(
        *[F.col(aside.get(c, c)).alias(c) for c in docs.columns], *[F.col(c).alias(n) for n, c in added.items() if n not in taken]
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
]

# Trained models and classes of near-duplicates are beyond SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
