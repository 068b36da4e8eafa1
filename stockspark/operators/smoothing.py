"""Exponential smoothing of many series at once, with weights from an optimiser.

A block of series is one set of lanes: a lane is a series under one configuration and one choice of weights. All
lanes advance together through the recursion, a week a step. A coarse grid gives each series and configuration
its first weights; from there on a pattern search moves one weight at a time, up and down, takes the best of
these moves if it lowers the train error, and halves the step otherwise. So the train error never exceeds the grid's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from stockspark.functions.coerce import nan_to_null
from stockspark.operators.series import DATE, KEYS, PERIOD, TARGET
from stockspark.session import by_series

# The smoothing configurations tried (trend, seasonal, damped).
SMOOTHING_CONFIGS = (
    ("add", "add", False),
    ("add", "add", True),
    ("add", "mul", False),
    ("add", "mul", True),
    ("add", None, False),
    ("add", None, True),
    ("mul", "mul", False),
    ("mul", "mul", True),
    (None, "add", False),
    (None, "mul", False),
    (None, None, False),
)
ALPHAS, BETAS, GAMMAS, DAMPING = (0.1, 0.4, 0.8), (0.01, 0.1, 0.3), (0.05, 0.2, 0.5), 0.95
MINIMUM_ROWS = 20
SERIES_IN_A_BLOCK = 32
LOWEST, HIGHEST = np.array([1e-4, 1e-4, 1e-4, 0.8]), np.array([0.9999, 0.9999, 0.9999, 0.995])
FIRST_STEP = np.array([0.15, 0.08, 0.12, 0.04])


@dataclass
class Block:
    """Train values of some series, one a row, padded to one length, and how many each has."""

    values: np.ndarray
    sizes: np.ndarray
    period: int

    @classmethod
    def of(cls, series: list[np.ndarray], period: int) -> Block:
        sizes = np.array([len(s) for s in series])
        values = np.full((len(series), sizes.max()), np.nan)
        for row, s in zip(values, series):
            row[: len(s)] = s
        return cls(values, sizes, period)


@dataclass
class Lanes:
    """What is smoothed how: the series of each lane, its kinds of trend and season, its four weights."""

    series: np.ndarray
    place: np.ndarray
    trend: np.ndarray
    season: np.ndarray
    weights: np.ndarray

    def take(self, rows: np.ndarray) -> Lanes:
        return Lanes(self.series[rows], self.place[rows], self.trend[rows], self.season[rows], self.weights[rows])


def grid(series: int, configs: Sequence[tuple]) -> Lanes:
    """All lanes of the grid for each series."""
    rows = [
        (place, trend or "", season or "", alpha, beta, gamma, DAMPING if damped else 1.0)
        for place, (trend, season, damped) in enumerate(configs)
        for alpha in ALPHAS
        for beta in (BETAS if trend else (0.0,))
        for gamma in (GAMMAS if season else (0.0,))
    ]
    place, trend, season = (np.array([r[k] for r in rows]) for k in range(3))
    weights = np.array([r[3:] for r in rows])
    many = np.repeat(np.arange(series), len(rows))
    return Lanes(many, *(np.tile(c, series) for c in (place, trend, season)), np.tile(weights, (series, 1)))


def smoothed(block: Block, lanes: Lanes, horizon: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The sum of squared one-step errors of each lane, and its next ``horizon`` values.

    Lanes whose multiplicative parts meet a value that is not positive have an infinite error.
    """
    period, sizes = block.period, block.sizes[lanes.series]
    y = block.values[lanes.series]
    alpha, beta, gamma, phi = lanes.weights.T
    mul_t, add_t, mul_s, add_s = lanes.trend == "mul", lanes.trend == "add", lanes.season == "mul", lanes.season == "add"
    seasonal = mul_s | add_s
    with np.errstate(all="ignore"):
        first, second = y[:, :period].mean(axis=1), y[:, period : 2 * period].mean(axis=1)
        level = np.where(seasonal, first, y[:, 0])
        growth = np.where(second / first > 0, second / first, 1.0) ** (1 / period)
        slope = np.where(mul_t, growth, np.where(add_t, (second - first) / period, 0.0))
        whole = np.where(first == 0, 1.0, first)[:, None]
        season = np.where(mul_s[:, None], y[:, :period] / whole, np.where(add_s[:, None], y[:, :period] - first[:, None], 0.0)).T.copy()
        squared = np.zeros(len(alpha))
        for t in range(y.shape[1]):
            on, value, s = t < sizes, y[:, t], season[t % period]
            base = np.where(mul_t, level * slope**phi, level + phi * slope)
            error = value - np.where(mul_s, base * s, base + s)
            squared += np.where(on, error * error, 0.0)
            fresh = alpha * np.where(mul_s, value / s, value - s) + (1 - alpha) * base
            moved = np.where(mul_t, beta * fresh / level + (1 - beta) * slope**phi,
                             np.where(add_t, beta * (fresh - level) + (1 - beta) * phi * slope, 0.0))
            turned = np.where(seasonal, gamma * np.where(mul_s, value / base, value - base) + (1 - gamma) * s, s)
            season[t % period] = np.where(on, turned, s)
            slope, level = np.where(on, moved, slope), np.where(on, fresh, level)
        positive = np.array([(v[:n] > 0).all() for v, n in zip(block.values, block.sizes)])[lanes.series]
        squared[~np.isfinite(squared) | ((mul_t | mul_s) & ~positive)] = np.inf
        steps = np.arange(1, horizon + 1)
        reach = np.cumsum(phi[:, None] ** steps[None, :], axis=1)
        ahead = np.where(mul_t[:, None], level[:, None] * slope[:, None] ** reach, level[:, None] + reach * slope[:, None])
        phase = season[(sizes[:, None] + steps[None, :] - 1) % period, np.arange(len(alpha))[:, None]]
        ahead = np.where(mul_s[:, None], ahead * phase, ahead + phase)
    return squared, ahead


def lowest(groups: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The place of the first smallest value of each group, in the order of the groups."""
    order = np.lexsort((np.arange(len(values)), values, groups))
    ranked = groups[order]
    return order[np.concatenate(([True], ranked[1:] != ranked[:-1]))]


def optimised(block: Block, configs: Sequence[tuple], rounds: int) -> tuple[Lanes, np.ndarray]:
    """One lane for each series and configuration, with the weights found, and the squared errors."""
    lanes = grid(len(block.sizes), configs)
    squared, _ = smoothed(block, lanes)
    best = lowest(lanes.series * len(configs) + lanes.place, squared)
    lanes, squared = lanes.take(best), squared[best]
    damped = np.array([bool(c[2]) for c in configs])[lanes.place]
    free = np.stack([np.ones(len(best), bool), lanes.trend != "", lanes.season != "", damped], axis=1)
    step = np.ones(len(best))
    moves = np.concatenate([np.diag(FIRST_STEP), -np.diag(FIRST_STEP)])
    for _ in range(rounds):
        lane, move = np.nonzero(np.tile(free, 2) & np.isfinite(squared)[:, None])
        if not len(lane):
            break
        tried = lanes.take(lane)
        shifted = tried.weights + step[lane, None] * moves[move]
        tried.weights = np.where(free[lane], np.clip(shifted, LOWEST, HIGHEST), tried.weights)
        found, _ = smoothed(block, tried)
        place = lowest(lane, found)
        better = place[found[place] < squared[lane[place]]]
        lanes.weights[lane[better]], squared[lane[better]] = tried.weights[better], found[better]
        stays = np.ones(len(best), bool)
        stays[lane[better]] = False
        step[stays] /= 2
    return lanes, squared


def smoothing(
    split: DataFrame,
    period: int = PERIOD,
    configs: Sequence[tuple] = SMOOTHING_CONFIGS,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
    rounds: int = 24,
) -> DataFrame:
    """Exponential smoothing: the best of ``configs`` by test RMSE (train RMSE for future weeks).

    The weights of each configuration minimise the train error, by ``rounds`` rounds of a pattern search from the
    best point of a grid (0: the grid alone). Multiplicative parts are skipped where a train value is not
    positive. Every test row stays: ``status`` is "fitted", "too short" (under two seasons, or 20 rows, of train) or
    "not fitted" (no configuration gives a value); for these two yhat, weights and train_rmse are null, and
    ``config`` repeats the status.
    """
    labels = [f"{t or 'none'}/{s or 'none'}/{'damped' if d else 'plain'}" for t, s, d in configs]
    least = max(2 * period, MINIMUM_ROWS)
    rows = split.select(*keys, date, F.col(target).cast("double").alias(target), "is_test")
    kinds = {f.name: f for f in rows.schema}
    packed = by_series(rows, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col("is_test").alias("t"), F.col(target).alias("y")))).alias("rows")
    )
    added = [
        StructField("yhat", DoubleType()), StructField("config", StringType()), StructField("status", StringType()),
        StructField("weights", ArrayType(DoubleType())), StructField("train_rmse", DoubleType()),
    ]
    schema = StructType([*(StructField(k, kinds[k].dataType) for k in (*keys, date, target)), StructField("is_test", BooleanType()), *added])

    def fitted(series: list[tuple]) -> dict[int, tuple]:
        """(forecast, label, weights, train error) of each series that has one."""
        block = Block.of([s[1] for s in series], period)
        lanes, squared = optimised(block, configs, rounds)
        _, ahead = smoothed(block, lanes, max(len(s[2]) for s in series))
        found: dict[int, tuple] = {}
        for lane in range(len(squared)):
            number = int(lanes.series[lane])
            _, y, truth = series[number]
            values = ahead[lane, : len(truth)]
            known = ~np.isnan(truth)
            train = np.sqrt(squared[lane] / len(y))
            with np.errstate(all="ignore"):
                error = np.sqrt(np.mean((values[known] - truth[known]) ** 2)) if known.any() else train
            if np.isfinite(error) and np.isfinite(train) and (number not in found or error < found[number][0]):
                found[number] = (error, values, labels[int(lanes.place[lane])], lanes.weights[lane].tolist(), float(train))
        return {n: f[1:] for n, f in found.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)

        def solved(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            long = [s for s in held if len(s[1]) >= least]
            models = fitted(long) if long else {}
            made: list[tuple] = []
            numbers = {id(s): k for k, s in enumerate(long)}
            for s in held:
                (key, days), y, truth = s
                values, label, weights, error = models.get(numbers.get(id(s), -1), (np.full(len(truth), np.nan), None, None, None))
                status = "fitted" if label else "too short" if len(y) < least else "not fitted"
                for day, true, value in zip(days, truth.tolist(), values.tolist()):
                    made.append((*key, day, None if true != true else true, True, value, label or status, status, weights, error))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), out)], schema=out)

        held: list[tuple] = []
        for batch in batches:
            for *key, rows in zip(*(c.to_pylist() for c in batch.columns)):
                y = np.array([np.nan if r["y"] is None else r["y"] for r in rows])
                test = np.array([bool(r["t"]) for r in rows])
                held.append(((key, [r["d"] for r in rows if r["t"]]), y[~test], y[test]))
                if len(held) == SERIES_IN_A_BLOCK:
                    yield from solved(held)
                    held = []
        if held:
            yield from solved(held)

    return packed.select(*keys, "rows").mapInArrow(run, schema).withColumn("yhat", nan_to_null(F.col("yhat")))
