"""Input checks that run on the schema, before any job starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming the missing columns."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_choice(value: str, allowed: Iterable[str], what: str) -> str:
    allowed = list(allowed)
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")
    return value
