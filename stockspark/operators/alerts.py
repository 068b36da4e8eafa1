"""News items to risk alerts: sentiment, category, score, filters and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockspark.checks import require_choice, require_columns
from stockspark.functions.coerce import date_or_null, score_or_zero
from stockspark.functions.riskscore import risk_band, risk_score
from stockspark.functions.text import content_words, sentiment_label, sentiment_score, text_choice
from stockspark.operators.terms import NaiveBayes

NO_MODEL, NO_INPUT, NO_TEXT = "Model N/A", "N/A (No Input Text)", "N/A (No Processable Text)"
ERROR = "Error Predicting Category"
SEARCHED = ("headline", "summary", "keywords")
ALL = "All"

# The orderings on offer, as (column, descending) pairs.
ORDERINGS = {
    "recent_risk": (("date_published", True), ("ai_risk_score", True)),
    "risk": (("ai_risk_score", True),),
    "recent": (("date_published", True),),
    "manual": (("manual_risk_score", True),),
    "category": (("ai_predicted_category", False),),
}


def analyse_news(news: DataFrame) -> DataFrame:
    """Parsed dates and manual scores, the chosen text, and its sentiment."""
    require_columns(news, ["id", "summary", "headline"])
    steps = {"text": text_choice(F.col("summary"), F.col("headline"))}
    if "date_published" in news.columns:
        steps["date_published"] = date_or_null(F.col("date_published"))
    steps["manual_risk_score"] = score_or_zero(F.col("risk_score")) if "risk_score" in news.columns else F.lit(0)
    # The score comes out of a generator, so filters on it are not pushed down as copies of the
    # whole expression: each text is scored once.
    once = F.explode(F.array(sentiment_score(F.col("text")))).alias("sentiment_score")
    scored = news.withColumns(steps).select("*", once)
    return scored.withColumn("predicted_sentiment", sentiment_label(F.col("sentiment_score")))


def predict_category(news: DataFrame, model: NaiveBayes | None) -> DataFrame:
    """Category of each item, with a stated reason where there is none to predict.

    With a model, only ids and labels are joined back, not texts. An item that the model gives no class gets ERROR.
    """
    if model is None:
        label = F.when(F.col("text") == "", NO_INPUT).otherwise(NO_MODEL)
        return news.withColumn("ai_predicted_category", label)
    words = content_words(F.col("text"))
    predicted = model.predict(news.select("id", words.alias("_words")).where(F.size("_words") > 0), "id", "_words")
    # The reason is found below the join, so that no text has to pass it.
    reason = F.when(F.col("text") == "", NO_INPUT).when(F.size(words) == 0, NO_TEXT)
    joined = news.withColumn("_reason", reason).join(predicted, "id", "left")
    return joined.withColumn("ai_predicted_category", F.coalesce("_reason", "predicted", F.lit(ERROR))).drop("_reason", "predicted")


def score_risk(news: DataFrame) -> DataFrame:
    score = risk_score(F.col("ai_predicted_category"), F.col("predicted_sentiment"))
    return news.withColumn("ai_risk_score", score).withColumn("risk_band", risk_band(F.col("ai_risk_score")))


def search(news: DataFrame, term: str) -> DataFrame:
    """Items whose headline, summary or keywords hold ``term``, in any case."""
    if not term:
        return news
    hit = F.lit(False)
    for name in SEARCHED:
        if name in news.columns:
            hit = hit | F.lower(F.coalesce(name, F.lit(""))).contains(term.lower())
    return news.where(hit)


def filter_alerts(
    news: DataFrame,
    category: str = ALL,
    sentiment: str = ALL,
    low: int = 0,
    high: int = 10,
    category_column: str = "ai_predicted_category",
) -> DataFrame:
    if category != ALL:
        news = news.where(F.col(category_column) == category)
    if sentiment != ALL:
        news = news.where(F.col("predicted_sentiment") == sentiment)
    return news.where(F.col("ai_risk_score").between(low, high))


def category_filter_column(news: DataFrame) -> DataFrame:
    """``filter_category``: the predicted category, or the manual one where the prediction is uniform."""
    kinds = news.agg(F.count_distinct("ai_predicted_category")).scalar()
    chosen = F.when(kinds >= 2, F.col("ai_predicted_category")).otherwise(F.col("risk_category"))
    return news.withColumn("filter_category", chosen)


def order_alerts(news: DataFrame, ordering: str = "recent_risk") -> DataFrame:
    """One of ORDERINGS; missing values last, ``id`` on ties."""
    require_choice(ordering, ORDERINGS, "ordering")
    parts = [
        F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()
        for name, descending in ORDERINGS[ordering]
    ]
    return news.orderBy(*parts, "id")
