"""News to ordered alerts in one plan, and the training job behind the category model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockspark.functions.text import content_words
from stockspark.operators.accuracy import classifier_record
from stockspark.operators.alerts import (
    ALL,
    analyse_news,
    filter_alerts,
    order_alerts,
    predict_category,
    score_risk,
    search,
)
from stockspark.operators.profile import enough_for_training
from stockspark.operators.splits import split_stratified
from stockspark.operators.terms import ALPHA, MAX_SHARE, MIN_DOCS, NaiveBayes, report_summary
from stockspark.session import materialise

MODEL_NAME = "MultinomialNB_TFIDF_tuned"
ARTIFACT_PREFIX = "risk_category_classifier_"


def enrich(news: DataFrame, model: NaiveBayes | None = None) -> DataFrame:
    """Sentiment, category, risk score and band; without a model also valid on a stream."""
    return score_risk(predict_category(analyse_news(news), model))


def risk_alerts(
    news: DataFrame,
    model: NaiveBayes | None = None,
    term: str = "",
    category: str = ALL,
    sentiment: str = ALL,
    low: int = 0,
    high: int = 10,
    ordering: str = "recent_risk",
) -> DataFrame:
    found = search(enrich(news, model), term)
    return order_alerts(filter_alerts(found, category, sentiment, low, high), ordering)


def training_rows(news: DataFrame) -> DataFrame:
    """Labelled items with at least one content word, marked for training or test."""
    labelled = news.where(F.col("summary").isNotNull() & F.col("risk_category").isNotNull())
    worded = labelled.select("id", "risk_category", content_words(F.col("summary")).alias("words"))
    return split_stratified(worded.where(F.size("words") > 0), "risk_category", "id")


def train_classifier(news: DataFrame, stamp: str, save_to: str | None = None) -> tuple[NaiveBayes, DataFrame]:
    """Fit on the train rows, score on the test rows: the model and its log record."""
    rows = materialise(training_rows(news), "training")
    check = enough_for_training(rows, "risk_category").first()
    if not check["enough"]:
        raise ValueError(f"{check['rows']} rows and {check['classes']} classes are too few to train")
    model = NaiveBayes.fit(rows.where(~F.col("is_test")), "id", "words", "risk_category")
    params = {
        "tfidf_max_df": MAX_SHARE,
        "tfidf_min_df": MIN_DOCS,
        "tfidf_ngram_range": (1, 2),
        "tfidf_sublinear_tf": True,
        "clf_alpha": ALPHA,
    }
    if save_to:
        digits = "".join(c for c in stamp if c.isdigit())
        params["model_path"] = f"{save_to.rstrip('/')}/{ARTIFACT_PREFIX}{MODEL_NAME}_{digits}"
        model.save(params["model_path"])
    test = rows.where(F.col("is_test"))
    judged = test.join(model.predict(test, "id", "words"), "id")
    labels = rows.select(F.col("risk_category").alias("label"))
    summary = report_summary(judged, "risk_category", "predicted", labels)
    return model, classifier_record(summary, MODEL_NAME, params, stamp)
