"""A yearly season on a trend that may bend: sparse changepoints from sums of products.

The model is that of ``fourier_regression`` with one more column for each place where the trend may bend: the time since
then, 0 before. A series is reduced to one matrix of sums of products. The columns that are always there are
taken out of it first, so that the search for bends works on a matrix of the bends alone: coordinate descent with
an absolute penalty, for a falling series of penalties and for all series of a block at once, gives ever more bends; each
set is refitted without the penalty by sweeping its columns into the matrix, and the set with the lowest
Bayesian criterion stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from stockspark.operators.forecasts import fourier_terms
from stockspark.operators.leastsquares import sweep
from stockspark.operators.series import DATE, KEYS, TARGET
from stockspark.session import by_series

SERIES_IN_A_BLOCK = 64
PENALTIES = 24
ROUNDS = 200


def bends(years: np.ndarray, count: int, span: float) -> np.ndarray:
    """Up to ``count`` places for bends, evenly over the first ``span`` of the train rows, without the very first."""
    within = max(1, math.floor(len(years) * span))
    places = np.unique(np.round(np.linspace(0, within - 1, min(count, within - 1) + 1)).astype(int))[1:]
    return years[places]


def descend(matrix: np.ndarray, right: np.ndarray, penalty: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Coordinate descent of x'Mx / 2 - r'x + penalty * |x| for all groups; columns without a diagonal stay 0."""
    x = start.copy()
    size = matrix.shape[1]
    diagonal = np.einsum("nii->ni", matrix)
    usable = diagonal > 1e-9
    divide = np.where(usable, diagonal, 1.0)
    gradient = right - np.einsum("nij,nj->ni", matrix, x)
    for _ in range(ROUNDS):
        moved = 0.0
        for k in range(size):
            rest = gradient[:, k] + diagonal[:, k] * x[:, k]
            fresh = np.where(usable[:, k], np.sign(rest) * np.maximum(np.abs(rest) - penalty, 0.0) / divide[:, k], 0.0)
            change = fresh - x[:, k]
            gradient -= matrix[:, :, k] * change[:, None]
            x[:, k] = fresh
            moved = max(moved, float(np.abs(change).max(initial=0.0)))
        if moved < 1e-7 * (1.0 + float(np.abs(x).max(initial=0.0))):
            break
    return x


def refitted(matrix: np.ndarray, right: np.ndarray, squares: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the active columns without a penalty, and the sums of squares left."""
    size = matrix.shape[1]
    work = np.zeros((len(matrix), size + 1, size + 1))
    work[:, :size, :size], work[:, :size, size], work[:, size, :size], work[:, size, size] = matrix, right, right, squares
    inside = np.zeros((len(matrix), size), bool)
    for k in range(size):
        rows = np.flatnonzero(active[:, k])
        if len(rows):
            some, flags = work[rows], np.zeros(len(rows), bool)
            sweep(some, k, flags, 1e-8)
            work[rows], inside[rows, k] = some, flags
    return np.where(inside, work[:, :size, size], 0.0), work[:, size, size]


def chosen_bends(matrix: np.ndarray, right: np.ndarray, squares: np.ndarray, rows: np.ndarray, penalty: float | None) -> np.ndarray:
    """Coefficients of the bends of each group: of the set with the lowest criterion, or for one given penalty.

    ``penalty`` is a share of the smallest penalty without any bend; from 1 on there is none.
    """
    none = np.zeros_like(right)
    if not right.shape[1] or penalty is not None and penalty >= 1:
        return none
    most = np.abs(right).max(axis=1)
    if penalty is not None:
        return descend(matrix, right, penalty * most, none)
    best, found, x = rows * np.log(np.maximum(squares, 1e-300) / rows), none.copy(), none
    seen = np.zeros(right.shape, bool)
    for share in np.geomspace(0.9, 1e-3, PENALTIES):
        x = descend(matrix, right, share * most, x)
        active = x != 0
        if np.array_equal(active, seen):
            continue
        seen = active
        beta, left = refitted(matrix, right, squares, active)
        floor = np.maximum(left, 1e-12 * np.maximum(squares, 1e-300))
        value = rows * np.log(floor / rows) + 2 * np.log(rows) * (beta != 0).sum(axis=1)
        better = value < best - 1e-9
        best[better], found[better] = value[better], beta[better]
    return found


def changepoint_regression(
    split: DataFrame,
    regressors: Sequence[str] = (),
    holiday: str | None = "IsHoliday",
    harmonics: int = 3,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    ridge: float = 1e-3,
    count: int = 25,
    span: float = 0.8,
    penalty: float | None = None,
) -> DataFrame:
    """``fourier_regression`` with a trend that may bend at ``count`` places in the first ``span`` of train.

    The bends are chosen by the criterion, or by a given ``penalty``: a share of the smallest one at which there is no bend,
    so that from 1 on the result is that of ``fourier_regression``. A bend counts as two parameters, its place and
    its slope. Every test row stays: ``status`` is "fitted", or "not fitted" for a series without a positive train
    value, whose yhat is null. ``changepoints`` are the dates at which the trend bends.
    """
    added, features = fourier_terms(regressors, holiday, harmonics, target, date)
    rows = split.withColumns(added).select(*keys, date, F.col(target).cast("double").alias(target), "is_test", *features, "_log")
    packed = by_series(rows, keys).groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(
                F.struct(F.col(date).alias("d"), F.col("is_test").alias("t"), F.col(target).alias("y"), F.col("_log").alias("l"), F.array(*features).alias("x"))
            )
        ).alias("rows")
    )
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = StructType(
        [StructField(c, kinds[c]) for c in (*keys, date, target)]
        + [StructField("yhat", DoubleType()), StructField("status", StringType()), StructField("changepoints", ArrayType(kinds[date]))]
    )
    base = 1 + len(features)

    def solved(held: list[tuple]) -> list[tuple]:
        """(coefficients, places of bends) of each series, None where it has no train row to learn from."""
        fits: list = [None] * len(held)
        parts = []
        for number, (_, rows) in enumerate(held):
            train = [r for r in rows if not r["t"]]
            known = [r for r in train if r["l"] is not None]
            if not known:
                continue
            x = np.column_stack([np.ones(len(known)), np.array([r["x"] for r in known])])
            places = bends(np.array([r["x"][0] for r in train]), count, span)
            hinges = np.maximum(x[:, 1][:, None] - places[None, :], 0.0)
            parts.append((number, x, hinges, np.array([r["l"] for r in known]), places))
        if not parts:
            return fits
        width = max(p[2].shape[1] for p in parts)
        matrix, right = np.zeros((len(parts), width, width)), np.zeros((len(parts), width))
        squares, sizes, kept = np.zeros(len(parts)), np.zeros(len(parts)), []
        for k, (_, x, hinges, y, _) in enumerate(parts):
            m = hinges.shape[1]
            scale, high = (np.sqrt((c * c).sum(axis=0)) for c in (x, hinges))
            scale[scale == 0], high[high == 0] = 1.0, 1.0
            x, hinges = x / scale, hinges / high
            left = x.T @ x + np.diag([0.0, *[ridge] * (base - 1)])
            cross, along = x.T @ hinges, x.T @ y
            solution = np.linalg.lstsq(left, np.column_stack([cross, along]), rcond=None)[0]
            matrix[k, :m, :m] = hinges.T @ hinges - cross.T @ solution[:, :m]
            right[k, :m] = hinges.T @ y - cross.T @ solution[:, m]
            squares[k], sizes[k] = max(y @ y - along @ solution[:, m], 0.0), len(y)
            kept.append((solution, scale, high, m))
        delta = chosen_bends(matrix, right, squares, sizes, penalty)
        for k, (number, _, _, _, places) in enumerate(parts):
            solution, scale, high, m = kept[k]
            beta = (solution[:, m] - solution[:, :m] @ delta[k, :m]) / scale
            fits[number] = (beta, places, delta[k, :m] / high)
        return fits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)

        def block(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            made: list[tuple] = []
            for (key, rows), fit in zip(held, solved(held)):
                for_date = {r["x"][0]: r["d"] for r in rows if not r["t"]}
                for r in rows:
                    if not r["t"]:
                        continue
                    if fit is None:
                        made.append((*key, r["d"], r["y"], None, "not fitted", None))
                        continue
                    beta, places, slopes = fit
                    value = beta[0] + beta[1:] @ np.array(r["x"]) + np.maximum(r["x"][0] - places, 0.0) @ slopes
                    bent = [for_date[p] for p, s in zip(places.tolist(), slopes) if s]
                    made.append((*key, r["d"], r["y"], math.exp(min(value, 700.0)), "fitted", bent))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), out)], schema=out)

        held: list[tuple] = []
        for batch in batches:
            for *key, rows in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((key, rows))
                if len(held) == SERIES_IN_A_BLOCK:
                    yield from block(held)
                    held = []
        yield from block(held)

    return packed.select(*keys, "rows").mapInArrow(run, schema)
