"""Window operators over weekly series.

A series is the set of rows that share ``keys``; it holds one row per date. The calendar bounds
its length (52 rows a year), so a series fits a task whatever the size of the raw data, and
each operator below needs one exchange on ``keys``; operators that follow one another share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockspark.checks import require_choice, require_columns
from stockspark.functions.calendar import friday_on_or_after

KEYS = ("Store", "Dept")
DATE = "Date"
TARGET = "Weekly_Sales"
LAGS = (1, 2, 3, 4, 8, 12, 26, 52)
WINDOWS = (4, 8, 12, 26)
STATS = ("mean", "std")
ALL_STATS = ("mean", "std", "min", "max")
PERIOD = 52


def _order(keys: Sequence[str], date: str):
    return Window.partitionBy(*keys).orderBy(date)


def lag_columns(
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    lags: Sequence[int] = LAGS,
    date: str = DATE,
    prefix: str | None = None,
) -> dict[str, Column]:
    prefix = target if prefix is None else prefix
    return {f"{prefix}_Lag_{k}": F.lag(target, k).over(_order(keys, date)) for k in lags}


def rolling_columns(
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    windows: Sequence[int] = WINDOWS,
    stats: Sequence[str] = STATS,
    date: str = DATE,
    prefix: str | None = None,
) -> dict[str, Column]:
    """Statistics of the rows before the current one; at least one row is needed."""
    functions = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    prefix = target if prefix is None else prefix
    columns = {}
    for width in windows:
        frame = _order(keys, date).rowsBetween(-width, -1)
        for stat in stats:
            require_choice(stat, functions, "stat")
            value = functions[stat](target).over(frame)
            columns[f"{prefix}_Roll_{stat.capitalize()}_{width}"] = value
    return columns


def lag_features(df: DataFrame, **options) -> DataFrame:
    return df.withColumns(lag_columns(**options))


def rolling_features(df: DataFrame, **options) -> DataFrame:
    return df.withColumns(rolling_columns(**options))


def forward_filled(column: str, keys: Sequence[str], date: str = DATE) -> Column:
    frame = _order(keys, date).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(column, ignorenulls=True).over(frame)


def backward_filled(column: str, keys: Sequence[str], date: str = DATE) -> Column:
    frame = _order(keys, date).rowsBetween(0, Window.unboundedFollowing)
    return F.first(column, ignorenulls=True).over(frame)


def regularise(
    df: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = KEYS,
    date: str = DATE,
    fill: str = "null",
) -> DataFrame:
    """One row per week from the first to the last week of each series.

    Dates are moved to the Friday on or after them; of several rows in a week the last one counts.
    Each row is stretched to just before its successor, so the gaps appear without building a
    separate calendar and joining to it. ``fill`` is ``null``, ``zero`` or ``pad``. ``pad``
    repeats the row before the gap, and leaves values that were NULL in the data as they are.
    """
    require_choice(fill, ("null", "zero", "pad"), "fill")
    require_columns(df, [*keys, date, *values])
    friday = friday_on_or_after(F.col(date))
    following = F.lead("_own").over(Window.partitionBy(*keys).orderBy("_own", "_day"))
    framed = df.select(*keys, *values, friday.alias("_own"), F.col(date).alias("_day"))
    framed = framed.withColumn("_following", following).where(F.col("_following").isNull() | (F.col("_following") > F.col("_own")))
    last_day = F.coalesce(F.date_sub("_following", 7), F.col("_own"))
    weeks = F.sequence(F.col("_own"), last_day, F.expr("interval 7 days"))
    stretched = framed.select(*keys, *values, "_own", F.explode(weeks).alias(date))
    own = F.col(date) == F.col("_own")

    def kept(name: str) -> Column:
        if fill == "pad":
            return F.col(name)
        value = F.when(own, F.col(name))
        return (F.coalesce(value, F.lit(0.0)) if fill == "zero" else value).alias(name)

    return stretched.select(*keys, date, *[kept(name) for name in values])


def interpolate_in_time(
    df: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS, date: str = DATE
) -> DataFrame:
    """Linear in days between known values; the ends repeat the nearest known value."""
    before = _order(keys, date).rowsBetween(Window.unboundedPreceding, 0)
    after = _order(keys, date).rowsBetween(0, Window.unboundedFollowing)
    work, result = {}, {}
    for name in values:
        point = F.when(F.col(name).isNotNull(), F.struct(F.col(date).alias("d"), F.col(name).alias("v")))
        work[f"_prev_{name}"] = F.last(point, ignorenulls=True).over(before)
        work[f"_next_{name}"] = F.first(point, ignorenulls=True).over(after)
        prev, following = F.col(f"_prev_{name}"), F.col(f"_next_{name}")
        share = F.datediff(F.col(date), prev["d"]) / F.datediff(following["d"], prev["d"])
        between = prev["v"] + (following["v"] - prev["v"]) * share
        result[name] = (
            F.when(F.col(name).isNotNull(), F.col(name))
            .when(prev.isNotNull() & following.isNotNull(), between)
            .otherwise(F.coalesce(prev["v"], following["v"]))
        )
    return df.withColumns(work).withColumns(result).drop(*work)


def exogenous_frame(
    df: DataFrame, values: Sequence[str], keys: Sequence[str] = KEYS, date: str = DATE
) -> DataFrame:
    """Weekly, interpolated exogenous columns; all-NULL columns dropped, the rest NULL -> 0."""
    require_columns(df, [*keys, date, *values])
    counts = df.agg(*[F.count(name).alias(name) for name in values]).first()
    kept = [name for name in values if counts[name] > 0]
    numeric = df.select(*keys, date, *[F.col(name).cast("double").alias(name) for name in kept])
    filled = interpolate_in_time(regularise(numeric, kept, keys, date), kept, keys, date)
    return filled.fillna(0.0, subset=kept)


def with_minimum_history(df: DataFrame, rows: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Only the series with at least ``rows`` rows."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_rows", size).where(F.col("_rows") >= rows).drop("_rows")


def sequences(
    df: DataFrame,
    features: Sequence[str],
    length: int,
    future_steps: int = 1,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
) -> DataFrame:
    """Sliding windows: ``length`` rows of features, and the target ``future_steps`` rows later."""
    require_columns(df, [*keys, date, target, *features])
    order = _order(keys, date)
    row = F.array(*[F.col(name).cast("double") for name in features])
    window = F.collect_list(row).over(order.rowsBetween(1 - length, 0))
    built = df.select(
        *keys,
        date,
        window.alias("sequence"),
        F.lead(target, future_steps).over(order).alias("target"),
        F.lead(date, future_steps).over(order).alias("target_date"),
    )
    return built.where((F.size("sequence") == length) & F.col("target_date").isNotNull())


def tiled_history(
    df: DataFrame,
    periods: int | None,
    keys: Sequence[str] = KEYS,
    target: str = TARGET,
    date: str = DATE,
) -> DataFrame:
    """The first ``periods`` rows of each series, repeated where the series is shorter.

    ``periods=None`` takes every row once.
    """
    order = _order(keys, date)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    placed = df.select(
        *keys,
        F.col(target).alias("demand"),
        F.row_number().over(order).alias("_rn"),
        size.cast("int").alias("_n"),
    )
    if periods is None:
        return placed.select(*keys, F.col("_rn").alias("period"), "demand")
    placed = placed.where(F.col("_rn") <= periods)
    repeats = F.sequence(F.col("_rn"), F.lit(periods), F.least(F.col("_n"), F.lit(periods)))
    return placed.select(*keys, F.explode(repeats).alias("period"), "demand")


def future_dates(
    df: DataFrame, horizon: int = 12, keys: Sequence[str] = KEYS, date: str = DATE
) -> DataFrame:
    """``horizon`` weekly dates after the last date of each series."""
    if not 1 <= horizon <= 104:
        raise ValueError("horizon must be between 1 and 104 weeks")
    last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return last.select(*keys, F.explode(steps).alias("step"), "_last").select(
        *keys, "step", F.expr("date_add(_last, 7 * step)").alias(date)
    )


def holiday_calendar(df: DataFrame, date: str = DATE, flag: str = "IsHoliday") -> DataFrame:
    return df.where(F.col(flag).cast("int") == 1).select(date).distinct()


def decompose(
    df: DataFrame,
    target: str = TARGET,
    keys: Sequence[str] = KEYS,
    date: str = DATE,
    period: int = PERIOD,
    model: str = "additive",
) -> DataFrame:
    """Trend, seasonal and residual parts of every regular, gap-free series.

    Trend is the centred moving average over one period (NULL at the ends), the seasonal part
    is the mean of the detrended values by phase, centred. Series with fewer than two periods
    are left out. All windows share the exchange on ``keys``.
    """
    require_choice(model, ("additive", "multiplicative"), "model")
    half = period // 2
    order = _order(keys, date)
    rn = F.row_number().over(order)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    base = df.select(*keys, date, F.col(target).alias("observed"), rn.alias("_rn"), size.alias("_n"))
    base = base.where(F.col("_n") >= 2 * period)

    if period % 2 == 0:
        left = F.avg("observed").over(order.rowsBetween(-half, half - 1))
        right = F.avg("observed").over(order.rowsBetween(1 - half, half))
        smooth = (left + right) / F.lit(2.0)
    else:
        smooth = F.avg("observed").over(order.rowsBetween(-half, half))
    full = (F.col("_rn") > half) & (F.col("_rn") <= F.col("_n") - half)
    additive = model == "additive"

    def apart(a: Column, b: Column) -> Column:
        return a - b if additive else F.try_divide(a, b)

    base = base.withColumn("trend", F.when(full, smooth))
    base = base.withColumn("_phase", (F.col("_rn") - 1) % F.lit(period))
    base = base.withColumn("_free", apart(F.col("observed"), F.col("trend")))
    base = base.withColumn("_phase_mean", F.avg("_free").over(Window.partitionBy(*keys, "_phase")))
    one_per_phase = F.when(F.col("_rn") <= period, F.col("_phase_mean"))
    base = base.withColumn("_centre", F.avg(one_per_phase).over(Window.partitionBy(*keys)))
    base = base.withColumn("seasonal", apart(F.col("_phase_mean"), F.col("_centre")))
    rest = (
        F.col("observed") - F.col("trend") - F.col("seasonal")
        if additive
        else F.try_divide(F.col("observed"), F.col("trend") * F.col("seasonal"))
    )
    return base.select(*keys, date, "observed", "trend", "seasonal", rest.alias("resid"))


def autocorrelation(
    df: DataFrame,
    lags: int,
    target: str = TARGET,
    keys: Sequence[str] = KEYS,
    date: str = DATE,
) -> DataFrame:
    """Autocorrelation at lags 0 to ``lags`` as an array per series (biased, as usual)."""
    mean = F.avg(target).over(Window.partitionBy(*keys))
    centred = df.select(*keys, date, (F.col(target) - mean).alias("_d"))
    order = _order(keys, date)
    shifted = centred.select(
        *keys, "_d", *[F.lag("_d", k).over(order).alias(f"_l{k}") for k in range(1, lags + 1)]
    )
    sums = shifted.groupBy(*keys).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_v"),
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("_d") * F.col(f"_l{k}")) for k in range(1, lags + 1)]).alias("_c"),
    )
    acf = F.concat(
        F.array(F.lit(1.0)),
        F.transform("_c", lambda c: F.when(F.col("_v") > 0, F.coalesce(c, F.lit(0.0)) / F.col("_v"))),
    )
    return sums.select(*keys, "n", acf.alias("acf"))


def partial_autocorrelation(acf: Column) -> Column:
    """Partial autocorrelations from an autocorrelation array, by the Durbin-Levinson recursion."""
    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.array(F.lit(1.0)).alias("out"))

    def dot(state: Column, k: Column, offset: Column | None) -> Column:
        # sum over j of phi[j] * rho[k-1-j] (reversed) or phi[j] * rho[j+1]
        terms = F.transform(
            state["phi"],
            lambda p, j: p * F.get(acf, (k - F.lit(1) - j) if offset is None else (j + offset)),
        )
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)

    def step(state: Column, k: Column) -> Column:
        reflection = (F.get(acf, k) - dot(state, k, None)) / (F.lit(1.0) - dot(state, k, F.lit(1)))
        updated = F.transform(
            F.array(reflection),
            lambda a: F.struct(
                F.concat(
                    F.transform(state["phi"], lambda p, j: p - a * F.get(state["phi"], k - F.lit(2) - j)),
                    F.array(a),
                ).alias("phi"),
                F.concat(state["out"], F.array(a)).alias("out"),
            ),
        )
        return F.get(updated, F.lit(0))

    return F.aggregate(
        F.sequence(F.lit(1), F.size(acf) - F.lit(1)), start, step, lambda state: state["out"]
    )
