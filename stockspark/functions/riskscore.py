"""Risk score from category and sentiment, and its band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity of each risk category, 0 to 10.
CATEGORY_SEVERITY = {
    "Natural Disaster": 8,
    "Pandemic": 9,
    "Supplier Financial Instability": 8,
    "Cybersecurity Attack": 7,
    "Industrial Accident": 7,
    "Geopolitical Conflict": 7,
    "Port Congestion": 6,
    "Logistics Disruption": 6,
    "Labor Dispute": 6,
    "Material Shortage": 6,
    "Supplier Quality Issue": 6,
    "Regulatory Change": 5,
    "Market Volatility": 4,
    "Labor Dispute (Resolved)": 2,
    "Positive Supplier News": 1,
    "General News/Neutral": 1,
    "Error Predicting Category": 3,
    "N/A (No text/Error)": 0,
    "Model N/A": 0,
}
UNMAPPED_SEVERITY = 3
GOOD_NEWS = ("Positive Supplier News", "Labor Dispute (Resolved)")


def category_severity(category: Column) -> Column:
    score = F.when(F.coalesce(category, F.lit("")) == "", 0)
    for name, severity in CATEGORY_SEVERITY.items():
        score = score.when(category == name, severity)
    return score.otherwise(UNMAPPED_SEVERITY)


def risk_score(category: Column, sentiment: Column) -> Column:
    """0 to 10: negative news adds 2, positive news takes 1 off a severe category."""
    base = category_severity(category)
    resolved = F.coalesce(category.isin(*GOOD_NEWS), F.lit(False))
    moved = (
        F.when(sentiment == "Negative", base + 2)
        .when((sentiment == "Positive") & (base > 3) & ~resolved, base - 1)
        .when((sentiment == "Positive") & (category == GOOD_NEWS[0]), 1)
        .otherwise(base)
    )
    return F.greatest(F.lit(0), F.least(F.lit(10), moved)).cast("int")


def risk_band(score: Column) -> Column:
    return (
        F.when(score >= 8, "High Risk")
        .when(score >= 5, "Medium Risk")
        .when(score >= 1, "Low Risk")
        .otherwise("Minimal/No Risk")
    )
