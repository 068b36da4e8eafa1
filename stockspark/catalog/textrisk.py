"""Text clean-up, sentiment, term weights, classification and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.catalog import inputs
from stockspark.catalog.inputs import shown
from stockspark.catalog.sql import pick, query, rounded
from stockspark.functions.riskscore import CATEGORY_SEVERITY, risk_band, risk_score
from stockspark.functions.text import (
    BOOST,
    BOOST_BY_DISTANCE,
    LEXICON,
    NEGATION_FACTOR,
    NEGATIONS,
    STOPWORDS,
    STRENGTHEN,
    WEAKEN,
    content_words,
    normalise,
    sentiment_label,
    sentiment_score,
    text_choice,
)
from stockspark.operators.alerts import (
    NO_INPUT,
    NO_MODEL,
    analyse_news,
    category_filter_column,
    filter_alerts,
    order_alerts,
    search,
)
from stockspark.operators.terms import NaiveBayes, class_report, confusion, report_summary, tf_idf
from stockspark.operators.valence import induced_lexicon, lexicon_score, seed_valence
from stockspark.plans import derived
from stockspark.plans.risk import ARTIFACT_PREFIX, MODEL_NAME, enrich, risk_alerts, train_classifier, training_rows
from stockspark.session import scratch_path
from stockspark.sources.tables import latest_artifact

# The categories that count as negative.
HOSTILE = ("Labor Dispute", "Cybersecurity Attack")


def _worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items with their content words, written once: several passes follow."""
    return inputs.once(spark, sf_dir, "worded", lambda: _unwritten(spark, sf_dir))


def _unwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, not written: for operators that read their documents once."""
    return derived.news(spark, sf_dir).select("id", "risk_category", content_words(F.col("summary")).alias("words"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.once(spark, sf_dir, "enriched", lambda: enrich(derived.news(spark, sf_dir)))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual category against the predicted one, for all items that have a category."""
    labelled = derived.news(spark, sf_dir).where(F.col("risk_category").isNotNull()).select("id", "risk_category")
    return labelled.join(bayes_predictions(spark, sf_dir), "id")


def _valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items with their content words and a label: 1 for the calm categories, 0 for the hostile ones."""
    label = F.when(F.col("risk_category").isin(*HOSTILE), 0).when(F.col("risk_category").isNotNull(), 1)
    return _worded(spark, sf_dir).select("id", "words", label.alias("label"))


def valence_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(seed_valence(_valued(spark, sf_dir), "words", "label"), 6)


def induced_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items by a lexicon that two thirds of the labels taught."""
    held_out = F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1
    valued = _valued(spark, sf_dir).withColumn("held_out", held_out)
    taught = valued.withColumn("label", F.when(~F.col("held_out"), F.col("label")))
    scored = lexicon_score(valued, "words", induced_lexicon(taught, "words", "label"))
    return shown(scored.select("id", "held_out", "score", sentiment_label(F.col("score")).alias("mood")))


def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = derived.news(spark, sf_dir)
    clean = normalise(F.col("summary"))
    return news.select("id", F.length(clean).alias("chars"), F.md5(clean).alias("digest"))


def chosen_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third item loses its summary and every sixth its headline too."""
    news = derived.news(spark, sf_dir)
    summary = F.when(F.col("id") % 3 != 0, F.col("summary"))
    headline = F.when(F.col("id") % 6 != 0, F.col("headline"))
    return news.select("id", F.md5(text_choice(summary, headline)).alias("digest"))


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = derived.news(spark, sf_dir)
    scored = news.select("id", sentiment_score(text_choice(F.col("summary"), F.col("headline"))).alias("score"))
    return scored.select("id", F.round("score", 3).alias("score"), sentiment_label(F.col("score")).alias("label"))


def term_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(tf_idf(_unwritten(spark, sf_dir), "id", "words"), 6)


def _model(spark: SparkSession, sf_dir: str) -> NaiveBayes:
    return NaiveBayes.fit(_unwritten(spark, sf_dir).where("risk_category is not null"), "id", "words", "risk_category")


def bayes_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_model(spark, sf_dir).scores(_unwritten(spark, sf_dir), "id", "words"), 4)


def bayes_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category of every item; fitted and predicted once, as reports read it too."""
    return inputs.once(spark, sf_dir, "predicted", lambda: _model(spark, sf_dir).predict(_unwritten(spark, sf_dir), "id", "words"))


def stored_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved under two names; the one whose name sorts last is loaded and used."""
    folder = scratch_path(spark, "classifiers")
    model = _model(spark, sf_dir)
    for stamp in ("20250101", "20250102"):
        model.save(f"{folder}/{ARTIFACT_PREFIX}{stamp}")
    loaded = NaiveBayes.load(spark, latest_artifact(spark, folder, ARTIFACT_PREFIX))
    return loaded.predict(_unwritten(spark, sf_dir), "id", "words")


def classifier_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training job: split, fit, save, score, log record."""
    folder = scratch_path(spark, "models")
    _, record = train_classifier(derived.news(spark, sf_dir), inputs.STAMP, folder)
    return shown(record.drop("Parameters"))


def training_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(derived.news(spark, sf_dir)).select("id", "risk_category", "is_test")


def confusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_judged(spark, sf_dir), "risk_category", "predicted")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(class_report(_judged(spark, sf_dir), "risk_category", "predicted"))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(report_summary(_judged(spark, sf_dir), "risk_category", "predicted"))


def scores_of_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All categories, unmapped and missing ones included, against all sentiments."""
    names = [*CATEGORY_SEVERITY, "Logistics", ""]
    docs = derived.table(spark, sf_dir, "documents")
    category = F.get(F.array(*[F.lit(n) for n in names]), (F.col("doc_id") % (len(names) + 1)).cast("int"))
    mood = F.get(F.array(*[F.lit(m) for m in ("Positive", "Negative", "Neutral")]), F.pmod("n_chars", F.lit(3)).cast("int"))
    rows = docs.select("doc_id", category.alias("category"), mood.alias("sentiment"))
    scored = rows.withColumn("score", risk_score(F.col("category"), F.col("sentiment")))
    return scored.withColumn("band", risk_band(F.col("score")))


def manual_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyse_news(derived.news(spark, sf_dir)).select("id", "manual_risk_score")


def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(derived.news(spark, sf_dir), "TRASH").select("id", "source")


def enriched_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enrich(derived.news(spark, sf_dir))
    return found.select("id", "predicted_sentiment", "ai_predicted_category", "ai_risk_score", "risk_band", "manual_risk_score")


def filtered_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_alerts(
        _enriched(spark, sf_dir), "Positive Supplier News", "Negative", 2, 10, category_column="risk_category"
    )
    return found.select("id", "risk_category", "ai_risk_score")


def filter_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a model the predictions are uniform, so the manual category is offered."""
    return category_filter_column(_enriched(spark, sf_dir)).select("id", "filter_category")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from documents to ordered alerts, in one plan."""
    found = risk_alerts(derived.news(spark, sf_dir), term="the", low=1)
    return found.select("id", "date_published", "predicted_sentiment", "ai_risk_score").withColumn(
        "date_published", F.col("date_published").cast("string")
    )


def _ordered(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = order_alerts(_enriched(spark, sf_dir), name)
        return shown(rows.select("id", "date_published", "ai_risk_score", "manual_risk_score", "ai_predicted_category"))

    return run


def classified_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk_alerts(derived.news(spark, sf_dir), _model(spark, sf_dir))
    return shown(found.select("id", "date_published", "predicted_sentiment", "ai_predicted_category", "ai_risk_score", "risk_band"))


_space = r"[\s\p{Z}\x0B\x1c-\x1f\x{85}]"
_keep = r"[^\p{L}\p{N}_\s\p{Z}\x0B\x1c-\x1f\x{85}]"


def _quoted(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _tokens(text: str) -> str:
    return f"""list_filter(regexp_split_to_array(regexp_replace(lower({text}), '{_keep}', '', 'g'), '{_space}+'), lambda w: w <> '')"""


_stop = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
_content = {
    "tokens": f"SELECT id, {_tokens('summary')} AS w FROM news",
    "content": f"""SELECT id, list_filter(w, lambda x: regexp_full_match(x, '\\p{{L}}+') AND NOT list_contains({_stop}, x)) AS w FROM tokens""",
}
_case_valence = "CASE " + " ".join(f"WHEN w = '{k}' THEN {v}" for k, v in LEXICON.items()) + " END"


def _shift(column: str, weight: float) -> str:
    return f"""CASE WHEN {column} IN {_quoted(STRENGTHEN)} THEN {BOOST * weight!r}::DOUBLE
    WHEN {column} IN {_quoted(WEAKEN)} THEN {-BOOST * weight!r}::DOUBLE ELSE 0.0::DOUBLE END"""


_mood = {
    "tokens": f"SELECT id, {_tokens('summary')} AS w FROM news",
    "words": """SELECT *, lag(w, 1) OVER o AS b1, lag(w, 2) OVER o AS b2, lag(w, 3) OVER o AS b3
    FROM (SELECT id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM tokens) WINDOW o AS (PARTITION BY id ORDER BY i)""",
    "hits": f"""SELECT *, CASE WHEN v > 0 THEN v + shift ELSE v - shift END * CASE WHEN negated THEN {NEGATION_FACTOR!r}::DOUBLE ELSE 1.0 END AS s
    FROM (SELECT *, CAST({_case_valence} AS DOUBLE) AS v, {' + '.join(_shift(f'b{d}', w) for d, w in enumerate(BOOST_BY_DISTANCE, 1))} AS shift,
        coalesce(b1 IN {_quoted(NEGATIONS)}, false) OR coalesce(b2 IN {_quoted(NEGATIONS)}, false) OR coalesce(b3 IN {_quoted(NEGATIONS)}, false) AS negated
        FROM words WHERE w IN {_quoted(LEXICON)})""",
    "mood": """SELECT news.id, round(coalesce(t / sqrt(t * t + 15.0), 0.0), 4) AS score
    FROM news LEFT JOIN (SELECT id, sum(s) AS t FROM hits GROUP BY id) h ON news.id = h.id""",
    "felt": """SELECT *, CASE WHEN score >= 0.05 THEN 'Positive' WHEN score <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS label FROM mood""",
    "scored_news": f"""SELECT n.*, label AS predicted_sentiment, CASE WHEN trim(summary) = '' THEN '{NO_INPUT}' ELSE '{NO_MODEL}' END AS ai_predicted_category,
        CASE WHEN trim(summary) = '' THEN (CASE label WHEN 'Negative' THEN 5 ELSE 3 END) ELSE (CASE label WHEN 'Negative' THEN 2 ELSE 0 END) END AS ai_risk_score
    FROM news n JOIN felt f ON n.id = f.id""",
}
_grams = {
    **_content,
    "docs": "SELECT c.id, risk_category, list_filter(w, lambda x: length(x) >= 2) AS w FROM content c JOIN news n ON c.id = n.id",
    "uni": "SELECT id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM docs",
    "tf": """SELECT id, t AS term, count(*) AS tf FROM (SELECT id, t FROM uni UNION ALL
        SELECT id, t || ' ' || nxt FROM (SELECT id, t, lead(t) OVER (PARTITION BY id ORDER BY i) AS nxt FROM uni) WHERE nxt IS NOT NULL) GROUP BY id, t""",
    "size": "SELECT count(*) AS n FROM docs",
    "vocab": """SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size
        WHERE df >= 2 AND df <= 0.95 * n""",
    "weights": """SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight
        FROM (SELECT id, term, (1 + ln(tf::DOUBLE)) * idf AS raw FROM tf JOIN vocab USING (term))""",
}
_bayes = {
    **{name: _grams[name] for name in (*_content, "docs", "uni", "tf")},
    # The vocabulary, its weights and the classes come from labelled items, the scores go to all.
    "known": "SELECT id, risk_category FROM docs WHERE risk_category IS NOT NULL",
    "size": "SELECT count(*) AS n FROM known",
    "vocab": """SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf
        FROM (SELECT term, count(*) AS df FROM tf JOIN known USING (id) GROUP BY term), size WHERE df >= 2 AND df <= 0.95 * n""",
    "weights": _grams["weights"],
    "mass": "SELECT term, risk_category AS label, sum(weight) AS m FROM weights JOIN known USING (id) GROUP BY ALL",
    "classes": """SELECT risk_category AS label, ln(count(*)::DOUBLE / (SELECT n FROM size)) AS prior,
        ln(0.1::DOUBLE) - ln(coalesce((SELECT sum(m) FROM mass WHERE label = risk_category), 0) + 0.1::DOUBLE * (SELECT count(*) FROM vocab)) AS floor
        FROM known GROUP BY risk_category""",
    "gained": "SELECT id, label, sum(weight * ln((m + 0.1::DOUBLE) / 0.1::DOUBLE)) AS g FROM weights JOIN mass USING (term) GROUP BY ALL",
    "total": "SELECT id, sum(weight) AS w FROM weights GROUP BY id",
    "final": """SELECT d.id, c.label, c.prior + coalesce(t.w, 0) * c.floor + coalesce(g.g, 0) AS score
        FROM docs d CROSS JOIN classes c LEFT JOIN total t ON t.id = d.id LEFT JOIN gained g ON g.id = d.id AND g.label = c.label""",
}
_judged_sql = {
    **_bayes,
    "judged": """SELECT id, risk_category AS a, p
    FROM known JOIN (SELECT id, arg_min(label, (-score, label)) AS p FROM final GROUP BY id) USING (id)""",
    "per": """SELECT label, coalesce(tp / nullif(claimed, 0), 0.0) AS precision, coalesce(tp / nullif(held, 0), 0.0) AS recall, held AS support FROM (
        SELECT label, count(*) FILTER (WHERE a = p AND a = label) AS tp, count(*) FILTER (WHERE p = label) AS claimed, count(*) FILTER (WHERE a = label) AS held
        FROM judged, (SELECT a AS label FROM judged UNION SELECT p FROM judged) GROUP BY label)""",
    "rep": """SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM per""",
}
# The training job: the same model from the train rows alone, judged on the test rows over all labels.
_split_rows = """SELECT id, risk_category, row_number() OVER (PARTITION BY risk_category ORDER BY substr(md5(concat_ws(':', '42', id)), 1, 15))
    <= ceil(0.25 * count(*) OVER (PARTITION BY risk_category)) AS is_test
    FROM content JOIN news USING (id) WHERE risk_category IS NOT NULL AND summary IS NOT NULL AND len(w) > 0"""
_training = {
    **_content,
    "parts": _split_rows,
    **{name: text for name, text in _bayes.items() if name not in _content},
    "known": "SELECT id, risk_category FROM parts WHERE NOT is_test",
    "judged": """SELECT id, risk_category AS a, p
    FROM parts JOIN (SELECT id, arg_min(label, (-score, label)) AS p FROM final GROUP BY id) USING (id) WHERE is_test""",
    "per": _judged_sql["per"].replace("(SELECT a AS label FROM judged UNION SELECT p FROM judged)", "(SELECT DISTINCT risk_category AS label FROM parts)"),
    "rep": _judged_sql["rep"],
}
_names = [*CATEGORY_SEVERITY, "Logistics", ""]
_severity = "CASE WHEN category IS NULL OR category = '' THEN 0 " + " ".join(f"WHEN category = '{n}' THEN {s}" for n, s in CATEGORY_SEVERITY.items()) + " ELSE 3 END"
_orders = {
    "recent_risk": "date_published DESC, ai_risk_score DESC",
    "risk": "ai_risk_score DESC",
    "recent": "date_published DESC",
    "manual": "manual_risk_score DESC",
    "category": "ai_predicted_category",
}

ENTRIES = {
    "normalised_text": (
        normalised_text,
        query(
            "SELECT id, CAST(length(t) AS INTEGER) AS chars, md5(t) AS digest FROM (SELECT id, array_to_string(w, ' ') AS t FROM content)",
            "news", extra=_content,
        ),
    ),
    "chosen_text": (
        chosen_text,
        query(
            """SELECT id, md5(trim(CASE WHEN id % 3 <> 0 AND trim(summary) <> '' THEN summary WHEN id % 6 <> 0 THEN headline ELSE '' END)) AS digest FROM news""",
            "news",
        ),
    ),
    "sentiment": (sentiment, query("SELECT id, round(score, 3) AS score, label FROM felt", "news", extra=_mood)),
    "valence_seeds": (
        valence_seeds,
        query(
            f"""SELECT word, positive, negative, {rounded('valence', 6)} AS valence FROM (
            SELECT *, (ln((positive + 0.5) / (p - positive + 0.5)) - ln((negative + 0.5) / (n - negative + 0.5)))
                * ((positive + negative) / (positive + negative + 10.0)) AS valence
            FROM counted, sides WHERE positive + negative >= 5
            AND abs(ln((positive + 0.5) / (p - positive + 0.5)) - ln((negative + 0.5) / (n - negative + 0.5))) >= 3.0 * sqrt(
                1 / (positive + 0.5) + 1 / (p - positive + 0.5) + 1 / (negative + 0.5) + 1 / (n - negative + 0.5)))""",
            "news",
            extra={
                **_content,
                "valued": """SELECT c.id, w, CASE WHEN risk_category IN ('Labor Dispute', 'Cybersecurity Attack') THEN 0 ELSE 1 END AS label
                FROM content c JOIN news n ON c.id = n.id WHERE risk_category IS NOT NULL""",
                "sides": """SELECT CAST(count(*) FILTER (label = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (label = 0) AS DOUBLE) AS n FROM valued""",
                "counted": """SELECT word, count(*) FILTER (label = 1) AS positive, count(*) FILTER (label = 0) AS negative
                FROM (SELECT label, unnest(list_distinct(w)) AS word FROM valued) GROUP BY word""",
            },
        ),
    ),
    "induced_sentiment": (induced_sentiment, None),
    "term_weights": (term_weights, query(f"SELECT id, term, {rounded('weight', 6)} AS weight FROM weights", "news", extra=_grams)),
    "bayes_scores": (bayes_scores, query(f"SELECT id, label, {rounded('score')} AS score FROM final", "news", extra=_bayes)),
    "bayes_predictions": (
        bayes_predictions,
        query("SELECT id, arg_min(label, (-score, label)) AS predicted FROM final GROUP BY id", "news", extra=_bayes),
    ),
    "stored_classifier": (
        stored_classifier,
        query("SELECT id, arg_min(label, (-score, label)) AS predicted FROM final GROUP BY id", "news", extra=_bayes),
    ),
    "classifier_training": (
        classifier_training,
        query(
            f"""SELECT '{inputs.STAMP}' AS Timestamp, 'RiskCategoryClassifier' AS Model_Type, '{MODEL_NAME}' AS Model_Name,
            {rounded('(SELECT avg(CAST(a = p AS DOUBLE)) FROM judged)')} AS Accuracy,
            {rounded('avg(precision)')} AS Precision_Macro, {rounded('avg(recall)')} AS Recall_Macro, {rounded('avg(f1)')} AS F1_Macro FROM rep""",
            "news", extra=_training,
        ),
    ),
    "training_split": (
        training_split,
        query(_split_rows, "news", extra=_content),
    ),
    "confusion": (
        confusion_table,
        query("SELECT a AS actual, p AS predicted, count(*) AS n FROM judged GROUP BY ALL", "news", extra=_judged_sql),
    ),
    "class_report": (
        report,
        query(f"SELECT {pick('label support', '', 'precision recall f1')} FROM rep", "news", extra=_judged_sql),
    ),
    "report_summary": (
        summary,
        query(
            f"""SELECT {', '.join(f"{rounded(f'avg({m})')} AS macro_{m}" for m in ('precision', 'recall', 'f1'))},
            {', '.join(f"{rounded(f'sum({m} * support) / sum(support)')} AS weighted_{m}" for m in ('precision', 'recall', 'f1'))},
            {rounded('(SELECT avg(CAST(a = p AS DOUBLE)) FROM judged)')} AS accuracy FROM rep""",
            "news", extra=_judged_sql,
        ),
    ),
    "risk_scores": (
        scores_of_risk,
        f"""SELECT *, CASE WHEN score >= 8 THEN 'High Risk' WHEN score >= 5 THEN 'Medium Risk' WHEN score >= 1 THEN 'Low Risk' ELSE 'Minimal/No Risk' END AS band
        FROM (SELECT doc_id, category, sentiment, CAST(greatest(0, least(10, CASE WHEN sentiment = 'Negative' THEN base + 2
            WHEN sentiment = 'Positive' AND base > 3 AND coalesce(category, '') NOT IN ('Positive Supplier News', 'Labor Dispute (Resolved)') THEN base - 1
            WHEN sentiment = 'Positive' AND category = 'Positive Supplier News' THEN 1 ELSE base END)) AS INTEGER) AS score
        FROM (SELECT *, {_severity} AS base FROM (SELECT doc_id, [{', '.join(f"'{n}'" for n in _names)}][doc_id % {len(_names) + 1} + 1] AS category,
            ['Positive', 'Negative', 'Neutral'][n_chars % 3 + 1] AS sentiment FROM documents)))""",
    ),
    "manual_scores": (manual_scores, query("SELECT id, manual_risk_score FROM news", "news")),
    "keyword_search": (
        keyword_search,
        query(
            """SELECT id, source FROM news WHERE contains(lower(headline), 'trash') OR contains(lower(summary), 'trash') OR contains(lower(keywords), 'trash')""",
            "news",
        ),
    ),
    "enriched_news": (
        enriched_news,
        query(
            """SELECT id, predicted_sentiment, ai_predicted_category, ai_risk_score,
            CASE WHEN ai_risk_score >= 8 THEN 'High Risk' WHEN ai_risk_score >= 5 THEN 'Medium Risk' WHEN ai_risk_score >= 1 THEN 'Low Risk' ELSE 'Minimal/No Risk' END AS risk_band,
            manual_risk_score FROM scored_news""",
            "news", extra=_mood,
        ),
    ),
    "filtered_alerts": (
        filtered_alerts,
        query(
            """SELECT id, risk_category, ai_risk_score FROM scored_news WHERE risk_category = 'Positive Supplier News'
            AND predicted_sentiment = 'Negative' AND ai_risk_score BETWEEN 2 AND 10""",
            "news", extra=_mood,
        ),
    ),
    "filter_categories": (
        filter_categories,
        query(
            """SELECT id, CASE WHEN (SELECT count(DISTINCT ai_predicted_category) FROM scored_news) >= 2 THEN ai_predicted_category ELSE risk_category END AS filter_category
            FROM scored_news""",
            "news", extra=_mood,
        ),
    ),
    "risk_alerts": (
        alerts,
        query(
            """SELECT id, CAST(date_published AS VARCHAR) AS date_published, predicted_sentiment, ai_risk_score FROM scored_news
            WHERE ai_risk_score BETWEEN 1 AND 10 AND (contains(lower(headline), 'the') OR contains(lower(summary), 'the') OR contains(lower(keywords), 'the'))
            ORDER BY scored_news.date_published DESC, ai_risk_score DESC, id""",
            "news", extra=_mood,
        ),
    ),
    **{
        f"alerts_by_{name}": (
            _ordered(name),
            query(
                f"""SELECT id, CAST(date_published AS VARCHAR) AS date_published, ai_risk_score, manual_risk_score, ai_predicted_category
                FROM (SELECT * FROM scored_news ORDER BY {order}, id)""",
                "news", extra=_mood,
            ),
        )
        for name, order in _orders.items()
    },
    "classified_alerts": (
        classified_alerts,
        query(
            """SELECT id, CAST(date_published AS VARCHAR) AS date_published, predicted_sentiment, ai_predicted_category, ai_risk_score,
            CASE WHEN ai_risk_score >= 8 THEN 'High Risk' WHEN ai_risk_score >= 5 THEN 'Medium Risk' WHEN ai_risk_score >= 1 THEN 'Low Risk'
                ELSE 'Minimal/No Risk' END AS risk_band
            FROM (SELECT *, CAST(greatest(0, least(10, CASE WHEN predicted_sentiment = 'Negative' THEN base + 2
                WHEN predicted_sentiment = 'Positive' AND base > 3 AND ai_predicted_category <> 'Positive Supplier News' THEN base - 1
                ELSE base END)) AS INTEGER) AS ai_risk_score FROM priced) WHERE ai_risk_score BETWEEN 0 AND 10""",
            "news",
            extra={
                **_bayes,
                **{name: _mood[name] for name in ("words", "hits", "mood", "felt")},
                "guess": "SELECT id, arg_min(label, (-score, label)) AS predicted FROM final GROUP BY id",
                # The severities of the four categories of the labels, and of the reasons for having none.
                "priced": f"""SELECT *, CASE ai_predicted_category WHEN 'Cybersecurity Attack' THEN 7 WHEN 'Labor Dispute' THEN 6
                    WHEN 'Market Volatility' THEN 4 WHEN 'Positive Supplier News' THEN 1 ELSE 3 END AS base FROM
                    (SELECT n.id, n.date_published, f.label AS predicted_sentiment, CASE WHEN trim(coalesce(nullif(trim(summary), ''), headline, '')) = '' THEN '{NO_INPUT}'
                        WHEN len(c.w) = 0 THEN 'N/A (No Processable Text)' ELSE predicted END AS ai_predicted_category
                    FROM news n JOIN felt f USING (id) JOIN content c USING (id) LEFT JOIN guess USING (id))""",
            },
        ),
    ),
}
