"""Least squares for many series at once, with fixed or chosen columns.

Each series is reduced to sums of products (combined within tasks before the shuffle), so no
series is ever gathered in one place; the small systems are then solved in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _solver(size: int, ridge: float):
    @F.pandas_udf("array<double>")
    def solve(left: pd.Series, right: pd.Series) -> pd.Series:
        rows = len(left)
        upper = np.triu_indices(size)
        matrix = np.zeros((rows, size, size))
        matrix[:, upper[0], upper[1]] = np.stack(left.to_numpy())
        matrix[:, upper[1], upper[0]] = matrix[:, upper[0], upper[1]]
        vector = np.stack(right.to_numpy())
        # Scale to a unit diagonal, then add the ridge to all but the intercept.
        scale = np.sqrt(np.einsum("nii->ni", matrix))
        scale[scale == 0.0] = 1.0
        matrix = matrix / scale[:, :, None] / scale[:, None, :]
        penalty = np.full(size, ridge)
        penalty[0] = 0.0
        matrix = matrix + np.diag(penalty)
        solved = np.linalg.solve(matrix, (vector / scale)[:, :, None])[:, :, 0] / scale
        return pd.Series(list(solved))

    return solve


def grouped_ridge(
    df: DataFrame,
    keys: Sequence[str],
    target: str,
    features: Sequence[str],
    ridge: float = 1e-6,
) -> DataFrame:
    """``beta`` (intercept first, then ``features``) and ``n`` per group; rows with NULLs are skipped."""
    x = [F.lit(1.0), *[F.col(name).cast("double") for name in features]]
    y = F.col(target).cast("double")
    size = len(x)
    known = df.dropna(subset=[target, *features])
    sums = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(size) for j in range(i, size)]).alias("_left"),
        F.array(*[F.sum(x[i] * y) for i in range(size)]).alias("_right"),
    )
    return sums.select(*keys, "n", _solver(size, ridge)("_left", "_right").alias("beta"))


def fitted(beta: Column, features: Sequence[str]) -> Column:
    """Intercept plus the weighted sum of ``features``."""
    value = F.get(beta, F.lit(0))
    for place, name in enumerate(features, start=1):
        value = value + F.get(beta, F.lit(place)) * F.col(name).cast("double")
    return value


def sweep(matrices: np.ndarray, pivot: int, swept: np.ndarray, least: float = 1e-10) -> None:
    """Bring column ``pivot`` into the regression of each matrix, or take it out again where it is in.

    ``matrices`` (group, column, column) are sums of products; ``swept`` (group) says where the column is in. The
    sweep operator turns them into coefficients, residual sums and inverses step by step, so a column more or less
    costs one update and no new solution. A column that the others explain but for ``least`` stays out.
    """
    d = matrices[:, pivot, pivot].copy()
    todo = swept | (d > least)
    safe = np.where(todo, d, 1.0)
    column = matrices[:, :, pivot].copy()
    update = matrices - column[:, :, None] * column[:, None, :] / safe[:, None, None]
    side = np.where(swept[:, None], -1.0, 1.0) * column / safe[:, None]
    update[:, :, pivot], update[:, pivot, :] = side, side
    update[:, pivot, pivot] = -1.0 / safe
    matrices[todo] = update[todo]
    swept[:] = todo & ~swept


def chosen_columns(matrices: np.ndarray, rows: np.ndarray, always: Sequence[int], optional: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (0 for columns left out) and criterion of the best set of ``optional`` columns for each group.

    The last column of the sums of products is the target. All sets are passed in an order in which neighbours
    differ by one column. The criterion is Akaike's, n log(RSS / n) + 2 k; of equal sets the first one counts.
    """
    work = matrices.copy()
    size, groups = work.shape[1] - 1, len(work)
    inside = np.zeros((groups, size), bool)

    def turn(column: int) -> None:
        flags = inside[:, column].copy()
        sweep(work, column, flags)
        inside[:, column] = flags

    for column in always:
        turn(column)
    best = np.full(groups, np.inf)
    beta = np.zeros((groups, size))
    for step in range(1 << len(optional)):
        if step:
            turn(optional[(step & -step).bit_length() - 1])
        left = np.maximum(work[:, -1, -1], 1e-12 * np.maximum(matrices[:, -1, -1], 1e-300))
        value = rows * np.log(left / rows) + 2 * inside.sum(axis=1)
        better = value < best - 1e-9
        best[better] = value[better]
        beta[better] = np.where(inside[better], work[better, :-1, -1], 0.0)
    return beta, best


def grouped_choice(
    df: DataFrame, keys: Sequence[str], target: str, always: Sequence[str], optional: Sequence[str], ridge: float = 1e-6
) -> DataFrame:
    """``beta`` (intercept, ``optional``, ``always``), ``n`` and ``aic`` per group, with the best of the optional columns.

    Each group is reduced to one matrix of sums of products; every set of columns is judged on the same rows, those
    without NULLs. A column that is left out has the coefficient 0.
    """
    names = [*optional, *always]
    x = [F.lit(1.0), *[F.col(name).cast("double") for name in names], F.col(target).cast("double")]
    size = len(x)
    known = df.dropna(subset=[target, *names])
    sums = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(x[i] * x[j]) for i in range(size) for j in range(i, size)]).alias("_sums")
    )
    fixed, free = [0, *range(1 + len(optional), size - 1)], list(range(1, 1 + len(optional)))

    @F.pandas_udf("struct<beta: array<double>, aic: double>")
    def solve(sums: pd.Series, rows: pd.Series) -> pd.DataFrame:
        upper = np.triu_indices(size)
        matrices = np.zeros((len(sums), size, size))
        matrices[:, upper[0], upper[1]] = np.stack(sums.to_numpy())
        matrices[:, upper[1], upper[0]] = matrices[:, upper[0], upper[1]]
        # Scale to a unit diagonal, but for the target, then add the ridge to all but the intercept.
        scale = np.sqrt(np.einsum("nii->ni", matrices))
        scale[scale == 0.0] = 1.0
        scale[:, -1] = 1.0
        matrices = matrices / scale[:, :, None] / scale[:, None, :]
        matrices += np.diag([0.0, *[ridge] * len(names), 0.0])
        beta, aic = chosen_columns(matrices, rows.to_numpy(dtype=float), fixed, free)
        return pd.DataFrame({"beta": list(beta / scale[:, :-1]), "aic": aic})

    solved = sums.withColumn("_solved", solve("_sums", "n"))
    return solved.select(*keys, "n", F.col("_solved.beta").alias("beta"), F.col("_solved.aic").alias("aic"))
