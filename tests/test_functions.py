import datetime
import os
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from stockspark.functions import coerce
from stockspark.functions.families import model_family
from stockspark.functions.normal import inverse_normal, service_z
from stockspark.functions.riskscore import risk_band, risk_score
from stockspark.functions.stock import economic_order_quantity, reorder_point, safety_stock
from stockspark.functions.text import content_words, normalise, sentiment_label, sentiment_score, text_choice


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def lits(*values):
    return [F.lit(v).cast("double") if v is not None else F.lit(None).cast("double") for v in values]


def test_order_quantity_worked_example(spark):
    row = one(
        spark,
        economic_order_quantity(*lits(10000, 50, 2.5)),
        economic_order_quantity(*lits(-1, 50, 2.5)),
        economic_order_quantity(*lits(100, 50, 0)),
        safety_stock(*lits(100, 20, 4, 1, 95)),
        reorder_point(*lits(100, 4, 177)),
        safety_stock(*lits(100, 20, 4, 1, 30)),
        safety_stock(*lits(100, 20, 4, 1, 0)),
        safety_stock(*lits(100, -1, 4, 1, 95)),
    )
    assert list(row) == [632.0, None, None, 177.0, 577.0, 0.0, None, None]


def test_inverse_normal_matches_the_standard_library(spark):
    levels = [i / 1000 for i in range(1, 1000)] + [1e-7, 1e-12, 1e-20, 0.99999, 0.9999999]
    rows = spark.createDataFrame([(p,) for p in levels], "p double").select("p", inverse_normal(F.col("p")).alias("z")).collect()
    for row in rows:
        assert row["z"] == pytest.approx(NormalDist().inv_cdf(row["p"]), rel=1e-11, abs=1e-11)


def test_service_level_limits(spark):
    row = one(spark, *[service_z(F.lit(v)) for v in (100.0, 50.0, 0.0, 101.0)])
    assert row[0] == pytest.approx(NormalDist().inv_cdf(0.99999), rel=1e-9)
    assert list(row)[1:] == [0.0, None, None]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("This is a great success.", "Positive"),
        ("A severe disruption and a loss.", "Negative"),
        ("The truck drove to the port.", "Neutral"),
        ("   ", "Neutral"),
        (None, "Neutral"),
        ("This is not good.", "Negative"),
    ],
)
def test_sentiment(spark, text, expected):
    score = sentiment_score(F.lit(text).cast("string"))
    assert one(spark, sentiment_label(score))[0] == expected


def test_sentiment_by_hand(spark):
    row = one(spark, sentiment_score(F.lit("really not good but very bad")), sentiment_score(F.lit("")))
    # good: 1.9 + 0.293 * 0.95, flipped; bad: -2.5 - 0.293. "not" is five words before "bad".
    total = (1.9 + 0.293 * 0.95) * -0.74 + (-2.5 - 0.293)
    assert row[0] == pytest.approx(round(total / (total * total + 15) ** 0.5, 4))
    assert row[1] == 0.0


def test_clean_words(spark):
    row = one(
        spark,
        normalise(F.lit("This is a sample sentence, showing off the stop-words filtration 123!")),
        F.array_join(content_words(F.lit("Größe  ÉTÉ a1 the_x")), "|"),
        normalise(F.lit(None).cast("string")),
    )
    assert list(row) == ["sample sentence showing stopwords filtration", "größe|été", ""]


def test_text_choice(spark):
    row = one(spark, text_choice(F.lit(None).cast("string"), F.lit(" head ")), text_choice(F.lit("  "), F.lit("h")), text_choice(F.lit(" s"), F.lit("h")))
    assert list(row) == ["head", "h", "s"]


def test_risk_rules(spark):
    def score(category, mood):
        return risk_score(F.lit(category).cast("string"), F.lit(mood))

    row = one(
        spark,
        score("Pandemic", "Negative"),
        score("Pandemic", "Positive"),
        score("Market Volatility", "Positive"),
        score("Labor Dispute (Resolved)", "Positive"),
        score("Logistics", "Neutral"),
        score(None, "Neutral"),
        score("Positive Supplier News", "Positive"),
        risk_band(F.lit(8)),
        risk_band(F.lit(0)),
    )
    assert list(row) == [10, 8, 3, 2, 3, 0, 1, "High Risk", "Minimal/No Risk"]


def test_literals(spark):
    text = (
        "{'method': 'last_value', 'order': (1, 1, 2), 'damped': False, 'trend': None, 'rate': 0.05, "
        "'features_used': ['CPI', 'Dept'], 'ngram': '(1,2)', 'error': \"can't fit\", 'model_path': '/a/b_1.joblib'}"
    )
    parsed = coerce.literal_to_map(F.lit(text))
    row = one(
        spark,
        parsed,
        coerce.literal_to_map(F.lit("{'open")),
        coerce.literal_to_list(F.lit("['CPI', 'Dept']")),
        coerce.literal_to_list(F.lit(None).cast("string")),
        coerce.consolidated_features(coerce.literal_to_list(F.lit("[]")), parsed),
        F.map_keys(coerce.shown_parameters(parsed)),
    )
    assert row[0]["method"] == "last_value" and row[0]["order"] == "[1,1,2]" and row[0]["damped"] == "false"
    assert row[0]["trend"] is None and row[0]["rate"] == "0.05" and row[0]["error"] == "can't fit"
    assert row[0]["ngram"] == "(1,2)" and row[0]["model_path"] == "/a/b_1.joblib"
    assert row[1] == {} and row[2] == ["CPI", "Dept"] and row[3] == [] and row[4] == ["CPI", "Dept"]
    assert "model_path" not in row[5] and "error" not in row[5] and "method" in row[5]


def test_periods(spark):
    good = coerce.period_bounds(F.lit(" '2011-11-04 to 2012-10-26' "))
    bad = coerce.period_bounds(F.lit("Error: Data split"))
    half = coerce.period_bounds(F.lit("2011-11-04 to later"))
    row = one(spark, *good, *bad, *half)
    assert list(row) == [datetime.date(2011, 11, 4), datetime.date(2012, 10, 26), None, None, None, None]


def test_coercion(spark):
    values = [F.lit(v) for v in (" 12.5 ", "nan", "", "x")]
    row = one(spark, *[coerce.number_or_null(v) for v in values], coerce.id_or_unknown(F.lit("7.0")), coerce.id_or_unknown(F.lit("?")))
    assert list(row) == [12.5, None, None, None, 7, -1]


def test_family_of_nothing(spark):
    row = one(spark, model_family(F.lit(None).cast("string")), model_family(F.lit("ets"), "notebook"))
    assert list(row) == ["Unknown", "Other"]
    with pytest.raises(ValueError):
        model_family(F.lit("x"), "other")


def test_intermediate_tables_never_go_to_one_machine_of_a_cluster(tmp_path):
    from stockspark.session import default_folder

    assert default_folder("yarn", "hdfs://name:8020/") == "hdfs://name:8020/tmp/stockspark"
    assert os.path.isdir(default_folder("local[4]", "file:///"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(ValueError):
            default_folder(master, "file:///")


def test_bad_numbers_end_no_job(spark):
    texts = ["7", "7.9", "Infinity", "-Infinity", "NaN", "99999999999", "-99999999999", "x", " ", None]
    rows = [one(spark, coerce.number_or_null(F.lit(t)), coerce.id_or_unknown(F.lit(t)), coerce.score_or_zero(F.lit(t))) for t in texts]
    assert [r[0] for r in rows] == [7.0, 7.9, None, None, None, 99999999999.0, -99999999999.0, None, None, None]
    assert [r[1] for r in rows] == [7, 7, -1, -1, -1, -1, -1, -1, -1, -1]
    assert [r[2] for r in rows] == [7, 7, 0, 0, 0, 0, 0, 0, 0, 0]
