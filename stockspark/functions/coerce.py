"""Conversions that turn bad input into NULL or a sentinel, and parsers for logged text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_ID = -1

# Keys that may hold the feature list of a run, in order of preference.
FEATURE_KEYS = (
    "features_used_list_in_params",
    "features_used_for_lstm_input",
    "features_used_for_regression",
    "sarima_exog_features_actually_used_by_model",
    "prophet_regressors_used",
    "features_used_list",
    "features_used",
    "exog_features",
    "regressors",
)

# Bookkeeping keys left out of the parameters shown to a reader.
BOOKKEEPING_KEYS = (
    "model_path",
    "feature_scaler_path",
    "target_scaler_path",
    "input_shape_str",
    "error",
    "train_period_in_params",
    "test_period_in_params",
    "features_used_list_in_params",
    "train_period_logged_in_params",
    "test_period_logged_in_params",
    "features_used_logged_in_params",
)
BOOKKEEPING_PREFIX = "sarima_exog_features_"

# Parameter keys that may hold the test period.
PERIOD_KEYS = ("test_period_in_params", "test_period")


def stable_round(value: Column, digits: int = 4) -> Column:
    """Half-up rounding with a small tolerance.

    A sum of doubles depends on the order of its terms in the last bit. The tolerance keeps
    values that sit on a rounding boundary from flipping a digit between two runs.
    """
    scale = 10.0 ** digits
    return F.floor(value * F.lit(scale) + F.lit(0.50123)) / F.lit(scale)


def strict_date(text: Column) -> Column:
    return F.to_date(text)


def date_or_null(text: Column) -> Column:
    return F.try_to_timestamp(text).cast("date")


def number_or_null(text: Column) -> Column:
    """A finite-or-null double: bad text, blanks, NaN and infinities all become NULL."""
    number = F.trim(text.cast("string")).try_cast("double")
    # NaN sorts above every number, so the comparison leaves it out as well.
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def id_or_unknown(text: Column) -> Column:
    """A whole number; what is none, or does not fit, is UNKNOWN_ID."""
    return F.coalesce(number_or_null(text).try_cast("int"), F.lit(UNKNOWN_ID))


def score_or_zero(text: Column) -> Column:
    """A whole number; what is none, or does not fit, is 0."""
    return F.coalesce(number_or_null(text).try_cast("int"), F.lit(0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def literal_to_json(text: Column) -> Column:
    """Rewrite a Python literal (dict or list as text) as JSON.

    Single quotes become double quotes, tuples become arrays, and the bare words for true,
    false and nothing become their JSON forms. Text that already uses double quotes around a
    string keeps them.
    """
    step = F.regexp_replace(text, r"\\", r"\\\\")
    step = F.regexp_replace(step, r"(?<=[\[{(,:]|[,:] )\s*'((?:[^'\"])*)'", '"$1"')
    step = F.regexp_replace(step, r"(?<=[\s:,\[({])True(?=[\s,\])}])", "true")
    step = F.regexp_replace(step, r"(?<=[\s:,\[({])False(?=[\s,\])}])", "false")
    step = F.regexp_replace(step, r"(?<=[\s:,\[({])(?:None|nan)(?=[\s,\])}])", "null")
    # A tuple sits outside quotes: it follows a colon, comma or opening bracket directly.
    step = F.regexp_replace(step, r"(?<=[:,\[] ?)\(([^()\"]*?),?\)", "[$1]")
    return step


def literal_to_map(text: Column) -> Column:
    """Python dict text as ``map<string,string>``; bad text gives an empty map."""
    parsed = F.from_json(literal_to_json(text), "map<string,string>")
    return F.coalesce(parsed, F.from_json(F.lit("{}"), "map<string,string>"))


def literal_to_list(text: Column) -> Column:
    """Python list text as ``array<string>``; bad text gives an empty array."""
    parsed = F.from_json(literal_to_json(text), "array<string>")
    return F.coalesce(parsed, F.from_json(F.lit("[]"), "array<string>"))


def consolidated_features(feature_list: Column, params: Column) -> Column:
    """The list column if filled, else the first filled list under one of FEATURE_KEYS."""
    def filled(items: Column) -> Column:
        return F.when(F.size(items) > 0, items)

    candidates = [filled(feature_list)]
    for key in FEATURE_KEYS:
        candidates.append(filled(F.from_json(params.getItem(key), "array<string>")))
    return F.coalesce(*candidates, F.from_json(F.lit("[]"), "array<string>"))


def shown_parameters(params: Column) -> Column:
    return F.map_filter(
        params,
        lambda key, _: ~key.isin(*BOOKKEEPING_KEYS) & ~key.startswith(BOOKKEEPING_PREFIX),
    )


def period_text(period: Column, params: Column | None = None) -> Column:
    """The period column, or the first of PERIOD_KEYS found in the parameters."""
    if params is None:
        return period
    return F.coalesce(period, *[params.getItem(key) for key in PERIOD_KEYS])


def period_bounds(period: Column) -> tuple[Column, Column]:
    """``'a to b'`` as two dates; both NULL unless both parse.

    Symbols before and after the dates (quotes, brackets) are trimmed first.
    """
    edge = r"[^\w\s:\-]+"
    cleaned = F.regexp_replace(F.trim(period), f"^{edge}|{edge}$", "")
    pieces = F.split(cleaned, " to ")
    start = F.trim(F.try_element_at(pieces, F.lit(1))).try_cast("date")
    end = F.trim(F.try_element_at(pieces, F.lit(2))).try_cast("date")
    good = (F.size(pieces) == 2) & start.isNotNull() & end.isNotNull()
    return F.when(good, start), F.when(good, end)
