"""Term weights over a corpus, and a multinomial naive Bayes classifier on top of them.

Weights and model are DataFrames, so none of them has to fit a driver; only the classes pass through it. Terms meet
their documents in blocks (``termblocks``). Each row is a document of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockspark.operators.termblocks import blocks_of, buckets_for, documents_in, label_masses, label_scores, weighted_terms
from stockspark.session import materialise

MIN_DOCS, MAX_SHARE, ALPHA = 2, 0.95, 0.1
SALTS = 8
ROLES = ("model_terms", "model_classes")


def salted_join(facts: DataFrame, lookup: DataFrame, column: str, spread: str, salts: int = SALTS) -> DataFrame:
    """Join many rows to one or few rows per key, with hot keys spread over ``salts`` tasks.

    A term can occur in a third of all documents; its rows are divided by a hash of ``spread``
    while the small side is repeated once per salt.
    """
    # The coalesce states that a salt is never NULL; a NULL check on it would be pushed below the
    # facts' own exchange and keep that from being reused.
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"), F.lit(0))
    left = facts.withColumn("_salt", salt)
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [column, "_salt"]).drop("_salt")


def tf_idf(docs: DataFrame, key: str, words: str, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Sublinear term weights of unit length per document: ``key``, ``term``, ``weight``. ``docs`` is read once."""
    return weighted_terms(docs, key, words, min_docs, max_share)


class NaiveBayes:
    """Multinomial naive Bayes on term weights, with the model held in two written tables.

    ``terms``: term, idf, gains (log of smoothed over bare smoothing, for each class). ``classes``: place, label,
    prior, floor (log weight of a term the class never shows).
    """

    def __init__(self, terms: DataFrame, classes: DataFrame) -> None:
        self.terms, self.classes = terms, classes

    @classmethod
    def fit(
        cls, docs: DataFrame, key: str, words: str, label: str, alpha: float = ALPHA, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE
    ) -> NaiveBayes:
        """``docs`` is read once; documents without a label count for the vocabulary only."""
        blocks = blocks_of(docs, key, words, label)
        documents = documents_in(blocks)
        sizes = blocks.select(F.explode("labels").alias("label")).where("label is not null").groupBy("label").count()
        found = {r["label"]: r["count"] for r in sizes.collect()}
        labels = sorted(found)
        mass = materialise(label_masses(blocks, buckets_for(blocks), labels, documents, min_docs, max_share), "term_mass", drop_shuffles=True)
        terms = mass.select("term", "idf", F.transform("mass", lambda m: F.log((m + alpha) / F.lit(alpha))).alias("gains"))

        distinct_terms = mass.agg(F.count(F.lit(1))).scalar()
        rows = docs.sparkSession.createDataFrame([(k, x, found[x] / documents) for k, x in enumerate(labels)], "place int, label string, share double")
        totals = mass.select(F.posexplode("mass").alias("place", "mass")).groupBy("place").agg(F.sum("mass").alias("total"))
        bottom = F.coalesce(F.col("total"), F.lit(0.0)) + F.lit(alpha) * distinct_terms
        classes = rows.join(totals, "place", "left").select(
            "place",
            F.col("label").cast(docs.schema[label].dataType).alias("label"),
            F.log("share").alias("prior"),
            (F.log(F.lit(alpha)) - F.log(bottom)).alias("floor"),
        )
        return cls(terms, materialise(classes, "classes"))

    def save(self, path: str) -> None:
        for table, name in zip((self.terms, self.classes), ROLES):
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark, path: str) -> NaiveBayes:
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ROLES])

    def scores(self, docs: DataFrame, key: str, words: str) -> DataFrame:
        """Joint log score of each document and class: ``key``, ``label``, ``score``. ``docs`` is read once."""
        classes = self.classes.orderBy("place").collect()
        label = F.get(F.array(*[F.lit(r["label"]) for r in classes]), F.col("place"))
        scored = label_scores(blocks_of(docs, key, words), key, self.terms, [r["prior"] for r in classes], [r["floor"] for r in classes])
        return scored.select(key, label.alias("label"), "score")

    def predict(self, docs: DataFrame, key: str, words: str) -> DataFrame:
        """The class with the highest score, the first in sorted order on ties."""
        best = F.min_by("label", F.struct((-F.col("score")).alias("minus"), F.col("label")))
        return self.scores(docs, key, words).groupBy(key).agg(best.alias("predicted"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, actual: str, predicted: str, labels: DataFrame | None = None) -> DataFrame:
    """Precision, recall, F1 and support per label; a zero denominator gives 0.

    ``labels`` (one ``label`` column) fixes the label set; by default it is all labels seen.
    """
    table = confusion(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    shares = table.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), hit.alias("tp"), F.lit(0).cast("bigint").alias("claimed"), F.col("n").alias("held")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("held")),
            )
        )
    )
    sums = shares.where(F.col("label").isNotNull()).groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("claimed").alias("claimed"), F.sum("held").alias("held")
    )
    if labels is not None:
        sums = labels.select("label").distinct().join(sums, "label", "left").fillna(0)
    precision = F.coalesce(F.try_divide("tp", "claimed"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "held"), F.lit(0.0))
    report = sums.select("label", precision.alias("precision"), recall.alias("recall"), F.col("held").alias("support"))
    f1 = F.coalesce(
        F.try_divide(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    return report.select("label", "precision", "recall", f1.alias("f1"), "support")


def report_summary(df: DataFrame, actual: str, predicted: str, labels: DataFrame | None = None) -> DataFrame:
    """Accuracy, and macro and weighted averages of the class report, in one row."""
    report = class_report(df, actual, predicted, labels)
    accuracy = df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double"))).scalar()
    measures = ("precision", "recall", "f1")
    weighted = {
        f"weighted_{m}": F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")), F.lit(0.0))
        for m in measures
    }
    return report.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[c.alias(name) for name, c in weighted.items()],
    ).withColumn("accuracy", accuracy)
