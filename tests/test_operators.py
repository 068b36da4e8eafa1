import math
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockspark.checks import require_columns
from stockspark.operators import forecasts, leastsquares
from stockspark.operators.accuracy import best_model, score
from stockspark.operators.alerts import category_filter_column, order_alerts
from stockspark.operators.changepoints import changepoint_regression, descend
from stockspark.operators.cleaning import fill_by_store, label_codes
from stockspark.operators.inventory import replay, sensitivity, with_defaults
from stockspark.operators.leastsquares import grouped_ridge
from stockspark.operators.profile import excess_kurtosis, seeded_sample, skewness
from stockspark.operators.ranks import exact_quantiles, values_at_ranks
from stockspark.operators.series import (
    autocorrelation,
    interpolate_in_time,
    partial_autocorrelation,
    regularise,
    rolling_features,
)
from stockspark.operators.splits import split_last_n, split_stratified
from stockspark.operators.terms import NaiveBayes
from stockspark.operators.trees import KINDS, fit_trees, predict
from stockspark.plans import series as series_plans
from stockspark.plans.panel import engineer
from stockspark.plans.risk import enrich, train_classifier
from stockspark.plans.series import compare_series, forecast_ahead
from stockspark.session import scratch_path
from stockspark.sources.tables import latest_artifact, load_model, read_panel, save_model, save_panel
from stockspark.streaming.alerts import news_stream, write_alerts

FRIDAY = date(2010, 2, 5)


def weeks(n, skip=()):
    return [FRIDAY + timedelta(weeks=i) for i in range(n) if i not in skip]


def series_frame(spark, data):
    """{(store, dept): [values]} as a panel; None leaves the week out."""
    rows = [
        (s, d, FRIDAY + timedelta(weeks=i), None if v is None else float(v))
        for (s, d), values in data.items()
        for i, v in enumerate(values)
        if v is not None
    ]
    return spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double")


def wave(n, seed):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return list(np.round(100 + 0.3 * t + 20 * np.sin(2 * np.pi * t / 52) + rng.normal(0, 3, n), 4))


def test_quantiles_of_skewed_groups(spark):
    rng = np.random.default_rng(1)
    values = {"hot": np.concatenate([np.full(4000, 7.0), rng.normal(0, 50, 8000)]), "one": np.array([3.5]), None: rng.random(99)}
    rows = [(k, float(v)) for k, group in values.items() for v in group] + [("hot", None)] * 5
    df = spark.createDataFrame(rows, "k string, v double")
    probabilities = [0.0, 0.25, 0.5, 0.98, 1.0]
    found = {r["k"]: r["quantiles"] for r in exact_quantiles(df, "v", probabilities, ["k"]).collect()}
    assert set(found) == set(values)
    for key, group in values.items():
        assert found[key] == pytest.approx(list(np.quantile(group, probabilities)))
    whole = exact_quantiles(df, "v", probabilities).first()["quantiles"]
    assert whole == pytest.approx(list(np.quantile(np.concatenate(list(values.values())), probabilities)))


def test_weighted_ranks_with_few_buckets(spark):
    df = spark.createDataFrame([(i % 37, 1 + i % 3) for i in range(500)], "v int, w int")
    expanded = np.sort(np.concatenate([np.full(1 + i % 3, i % 37) for i in range(500)]))
    ranks = [0, 10, len(expanded) - 1]
    rows = values_at_ranks(df, "v", lambda n: F.array(*[F.lit(r).cast("bigint") for r in ranks]), weight="w", buckets=4).collect()
    assert {r["slot"]: r["value"] for r in rows} == {i: expanded[r] for i, r in enumerate(ranks)}


def test_moments_match_pandas(spark):
    values = pd.Series([1.0, 2.0, 4.0, 9.0, 30.0])
    row = spark.createDataFrame([(v,) for v in values], "v double").agg(skewness(F.col("v")), excess_kurtosis(F.col("v"))).first()
    assert list(row) == pytest.approx([values.skew(), values.kurt()])
    flat = spark.createDataFrame([(5.0,)] * 6, "v double").agg(skewness(F.col("v")), excess_kurtosis(F.col("v"))).first()
    assert list(flat) == [0.0, 0.0]


def test_rolling_does_not_cross_series(spark):
    df = series_frame(spark, {(1, 1): [1, 2, 3, 4, 5], (1, 2): [10, 20, 30, 40]})
    got = rolling_features(df, windows=(3,), stats=("mean", "std", "min", "max")).toPandas().sort_values(["Dept", "Date"])
    for _, part in got.groupby("Dept"):
        shifted = part["Weekly_Sales"].shift(1).rolling(3, min_periods=1)
        for name, expected in (("Mean", shifted.mean()), ("Std", shifted.std()), ("Min", shifted.min()), ("Max", shifted.max())):
            np.testing.assert_allclose(part[f"Weekly_Sales_Roll_{name}_3"].astype(float), expected)


def test_features_without_keys_skip_lags(spark):
    df = series_frame(spark, {(1, 1): [1, 2, 3]})
    assert not [c for c in engineer(df, keys=["Nothing"]).columns if "Lag" in c]
    assert len([c for c in engineer(df).columns if "Lag" in c or "Roll" in c]) == 24


def test_interpolation_matches_pandas(spark):
    values = [None, 5.0, None, None, 11.0, 12.0, None, 3.0, None, None, None, 9.0]
    df = series_frame(spark, {(1, 1): values})
    got = interpolate_in_time(regularise(df, ["Weekly_Sales"]), ["Weekly_Sales"]).toPandas().sort_values("Date")
    expected = pd.Series(values[1:], dtype=float).interpolate()
    np.testing.assert_allclose(got["Weekly_Sales"], expected)
    assert regularise(df, ["Weekly_Sales"], fill="zero").where("Weekly_Sales = 0").count() == 6


def test_interpolation_of_ends(spark):
    rows = [(1, 1, d, v) for d, v in zip(weeks(5), [None, 2.0, None, 4.0, None])]
    df = spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double")
    got = [r[0] for r in interpolate_in_time(df, ["Weekly_Sales"]).orderBy("Date").select("Weekly_Sales").collect()]
    assert got == [2.0, 2.0, 3.0, 4.0, 4.0]


def test_fill_by_store(spark):
    rows = [
        (store, dept, day, v, None if store == 3 else v)
        for store, values in {1: [None, 4.0, None], 2: [8.0, None, 10.0], 3: [None, None, None]}.items()
        for day, v in zip(weeks(3), values)
        for dept in (1, 2)
    ]
    df = spark.createDataFrame(rows, "Store int, Dept int, Date date, CPI double, Unemployment double")
    got = fill_by_store(df).where("Dept = 1").orderBy("Store", "Date").select("CPI").collect()
    # Store 3 has nothing: median of the filled rows 4 4 4 8 8 10 (twice each) is 6.
    assert [r[0] for r in got] == [4.0, 4.0, 4.0, 8.0, 8.0, 10.0, 6.0, 6.0, 6.0]
    assert fill_by_store(fill_by_store(df)).exceptAll(fill_by_store(df)).count() == 0


def test_partial_autocorrelation_solves_yule_walker(spark):
    y = np.array(wave(120, 3))
    df = series_frame(spark, {(1, 1): y})
    row = autocorrelation(df, 20).select("acf", partial_autocorrelation(F.col("acf")).alias("pacf")).first()
    d = y - y.mean()
    acf = [1.0] + [float((d[k:] * d[:-k]).sum() / (d * d).sum()) for k in range(1, 21)]
    assert row["acf"] == pytest.approx(acf)
    for k in range(1, 21):
        matrix = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert row["pacf"][k] == pytest.approx(np.linalg.solve(matrix, np.array(acf[1 : k + 1]))[-1], abs=1e-9)


def plain_smoothing(y, h, m, trend, seasonal, phi, a, b, g):
    first, second = np.mean(y[:m]), np.mean(y[m : 2 * m])
    level = first if seasonal else y[0]
    slope = {"add": (second - first) / m, "mul": (second / first) ** (1 / m), None: 0.0}[trend]
    s = [v - first if seasonal == "add" else v / first if seasonal == "mul" else 0.0 for v in y[:m]]
    sse = 0.0

    def base(level, slope, reach):
        return level * slope**reach if trend == "mul" else level + reach * slope

    for t, v in enumerate(y):
        e, b0 = s[t % m], base(level, slope, phi)
        sse += (v - (b0 * e if seasonal == "mul" else b0 + e)) ** 2
        new = a * (v / e if seasonal == "mul" else v - e) + (1 - a) * b0
        if trend == "add":
            slope = b * (new - level) + (1 - b) * phi * slope
        elif trend == "mul":
            slope = b * new / level + (1 - b) * slope**phi
        if seasonal:
            s[t % m] = g * (v / b0 if seasonal == "mul" else v - b0) + (1 - g) * e
        level = new
    out = []
    for i in range(1, h + 1):
        b0, e = base(level, slope, sum(phi**j for j in range(1, i + 1))), s[(len(y) + i - 1) % m]
        out.append(b0 * e if seasonal == "mul" else b0 + e)
    return sse, out


def test_smoothing_matches_a_plain_loop(spark):
    y = wave(60, 5)
    df = split_last_n(series_frame(spark, {(1, 1): y, (1, 2): [0.0] + y[1:]}), 12)
    for dept, values in ((1, y), (2, [0.0] + y[1:])):
        best = None
        for trend, seasonal, damped in forecasts.SMOOTHING_CONFIGS:
            if min(values[:48]) <= 0 and "mul" in (trend, seasonal):
                continue
            runs = [
                plain_smoothing(values[:48], 12, 12, trend, seasonal, forecasts.DAMPING if damped else 1.0, a, b, g)
                for a in forecasts.ALPHAS
                for b in (forecasts.BETAS if trend else (0.0,))
                for g in (forecasts.GAMMAS if seasonal else (0.0,))
            ]
            ahead = min(runs, key=lambda r: r[0])[1]
            rmse = math.sqrt(np.mean((np.array(ahead) - values[48:]) ** 2))
            if best is None or rmse < best[0]:
                best = (rmse, ahead)
        got = forecasts.smoothing(df, period=12, rounds=0).where(F.col("Dept") == dept).orderBy("Date").select("yhat").collect()
        assert [r[0] for r in got] == pytest.approx(best[1])


def test_smoothing_weights_beat_the_grid_for_every_series(spark):
    series = {(1, k): wave(60 + k, k) for k in range(1, 7)} | {(2, 1): [0.0] + wave(59, 3), (2, 2): wave(20, 1), (2, 3): [7.0] * 60}
    df = split_last_n(series_frame(spark, series), 12)
    for trend, seasonal, damped in forecasts.SMOOTHING_CONFIGS:
        kind = {"period": 12, "configs": [(trend, seasonal, damped)]}
        rough = {(r["Store"], r["Dept"]): r for r in forecasts.smoothing(df, rounds=0, **kind).collect()}
        found = forecasts.smoothing(df, **kind).orderBy("Date").collect()
        fine = {(r["Store"], r["Dept"]): r for r in found}
        assert set(rough) == set(fine) == set(series)  # a row for each series
        for key, r in fine.items():
            assert r["status"] == rough[key]["status"] == ("too short" if key == (2, 2) else "not fitted" if key == (2, 1) and "mul" in (trend, seasonal) else "fitted")
            if r["status"] != "fitted":
                assert r["yhat"] is None and r["train_rmse"] is None
                continue
            assert r["train_rmse"] <= rough[key]["train_rmse"] * (1 + 1e-12)
            alpha, beta, gamma, phi = r["weights"]
            values = series[key]
            sse, ahead = plain_smoothing(values[:-12], 12, 12, trend, seasonal, phi, alpha, beta, gamma)
            assert r["train_rmse"] == pytest.approx(math.sqrt(sse / (len(values) - 12)), abs=1e-9)
            assert [x["yhat"] for x in found if (x["Store"], x["Dept"]) == key] == pytest.approx(ahead)


def test_smoothing_finds_the_weights_of_a_level(spark):
    """Train error at the optimiser's weight against a fine search over the one weight there is."""
    values = np.cumsum(np.random.default_rng(1).normal(0, 1, 150)) + np.random.default_rng(2).normal(0, 2, 150) + 100
    df = split_last_n(series_frame(spark, {(1, 1): values.tolist()}), 10)
    r = forecasts.smoothing(df, period=12, configs=[(None, None, False)]).first()
    best = min(plain_smoothing(values[:140].tolist(), 0, 12, None, None, 1.0, a, 0.0, 0.0)[0] for a in np.linspace(0.001, 0.999, 999))
    assert r["train_rmse"] <= math.sqrt(best / 140) * (1 + 1e-6)


def test_autoregression_matches_numpy(spark):
    y = wave(90, 7)
    df = split_last_n(series_frame(spark, {(1, 1): y}), 20)
    got = [r[0] for r in forecasts.ar_regression(df, period=12, ridge=0.0).orderBy("Date").select("yhat").collect()]
    train = y[:70]
    x = np.array([[1, train[i - 1], train[i - 2], train[i - 12]] for i in range(12, 70)])
    beta = np.linalg.lstsq(x, np.array(train[12:]), rcond=None)[0]
    past = list(train)
    for _ in range(20):
        past.append(float(beta @ np.array([1, past[-1], past[-2], past[-12]])))
    assert got == pytest.approx(past[70:], rel=1e-6)


def exhaustive(rows, y, fixed, free):
    """The lowest criterion over all sets of free columns, and its coefficients, by least squares for each set."""
    best = None
    for bits in range(1 << len(free)):
        columns = [*fixed, *[c for k, c in enumerate(free) if bits >> k & 1]]
        beta, *_ = np.linalg.lstsq(rows[:, columns], y, rcond=None)
        rss = float(((y - rows[:, columns] @ beta) ** 2).sum())
        aic = len(y) * math.log(rss / len(y)) + 2 * len(columns)
        if best is None or aic < best[0] - 1e-9:
            full = np.zeros(rows.shape[1])
            full[columns] = beta
            best = (aic, full)
    return best


def test_chosen_columns_equal_least_squares_over_all_sets():
    rng = np.random.default_rng(5)
    matrices, rows, wanted = [], [], []
    for n in (20, 35, 60, 200):
        x = np.column_stack([np.ones(n), rng.normal(0, 1, (n, 6))])
        x[:, 4] = x[:, 3] + rng.normal(0, 0.2, n)
        y = x @ np.array([3.0, 1.0, 0, 0.5, 0, 0, 0.1]) + rng.normal(0, 1, n)
        both = np.column_stack([x, y])
        matrices.append(both.T @ both)
        rows.append(n)
        wanted.append(exhaustive(x, y, [0, 6], [1, 2, 3, 4, 5]))
    beta, aic = leastsquares.chosen_columns(np.array(matrices), np.array(rows, float), [0, 6], [1, 2, 3, 4, 5])
    assert aic == pytest.approx([w[0] for w in wanted])
    for b, (_, full) in zip(beta, wanted):
        assert b == pytest.approx(full, abs=1e-8)


def test_a_column_explained_by_others_stays_out():
    x = np.column_stack([np.ones(30), np.arange(30.0), 2 * np.arange(30.0), np.zeros(30)])
    y = 1 + 3 * np.arange(30.0) + np.random.default_rng(1).normal(0, 1, 30)
    both = np.column_stack([x, y])
    beta, _ = leastsquares.chosen_columns((both.T @ both)[None], np.array([30.0]), [0], [1, 2, 3])
    assert np.isfinite(beta).all() and (beta[0, 1] == 0) != (beta[0, 2] == 0) and beta[0, 3] == 0
    assert x @ beta[0] == pytest.approx(x[:, :2] @ np.linalg.lstsq(x[:, :2], y, rcond=None)[0])


def test_chosen_lags_and_outside_columns_in_a_comparison(spark):
    rng = np.random.default_rng(3)
    outside = rng.normal(0, 1, (2, 110))
    data, rows = {}, []
    for store in (0, 1):
        y = rng.normal(20, 1, 12).tolist()
        for i in range(12, 110):
            y.append(8 + (0.6 * y[-1] if store else 0.5 * y[-12]) + 3 * outside[store, i] + rng.normal(0, 0.05))
        data[store] = y
        rows += [(store, 1, d, float(v), float(e)) for d, v, e in zip(weeks(110), y, outside[store])]
    rows += [(9, 1, d, 5.0 + k, 0.0) for k, d in enumerate(weeks(30))]
    schema = "Store int, Dept int, Date date, Weekly_Sales double, x double"
    df = split_last_n(spark.createDataFrame(rows, schema), 20)
    got = forecasts.chosen_autoregression(df, ["x"], period=12, ridge=0.0).orderBy("Date").collect()
    for store, y in data.items():
        train, mine = y[:90], [r for r in got if r["Store"] == store]
        x = np.array([[1, *[train[i - k] for k in (1, 2, 3, 4, 12, 13)], outside[store, i]] for i in range(13, 90)])
        _, beta = exhaustive(x, np.array(train[13:]), [0, 7], [1, 2, 3, 4, 5, 6])
        assert mine[0]["lags"] == [k for k, b in zip((1, 2, 3, 4, 12, 13), beta[1:7]) if b] and (1 if store else 12) in mine[0]["lags"]
        past = list(train)
        for i in range(90, 110):
            past.append(float(beta @ np.array([1, *[past[-k] for k in (1, 2, 3, 4, 12, 13)], outside[store, i]])))
        assert [r["yhat"] for r in mine] == pytest.approx(past[90:], rel=1e-5)
    short = [r for r in got if r["Store"] == 9]
    assert len(short) == 20 and {(r["status"], r["yhat"]) for r in short} == {("too short", None)}


def test_outside_columns_reach_the_models_of_a_comparison(spark):
    seen = []

    def model(split, exogenous=()):
        seen.append((tuple(exogenous), split.columns))
        return split.where("is_test").withColumn("yhat", F.lit(1.0))

    series_plans.OUTSIDE[model] = "exogenous"
    try:
        series = series_frame(spark, {(1, 1): wave(60, 1)}).withColumn("x", F.rand(1))
        assert compare_series(series, {"m": (model, {})}, 5, exogenous=["x"]).count() == 1
        future = spark.createDataFrame([(1, 1, weeks(61)[-1], 7.0)], "Store int, Dept int, Date date, x double")
        assert forecast_ahead(series, 3, {"m": (model, {})}, outside=future, exogenous=["x"]).count() == 3
        split = series_plans.future_split(series, 3, outside=future, exogenous=["x"]).where("is_test").orderBy("Date")
        assert [r["x"] for r in split.collect()] == [7.0, None, None]
    finally:
        del series_plans.OUTSIDE[model]
    assert [s[0] for s in seen] == [("x",), ("x",)] and all("x" in s[1] for s in seen)


def test_autoregression_uses_exogenous_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, 90)
    y = [10.0] * 12
    for i in range(12, 90):
        y.append(2 + 0.3 * y[-1] + 0.2 * y[-2] + 0.1 * y[-12] + 4 * x[i])
    rows = [(1, 1, d, float(v), float(e)) for d, v, e in zip(weeks(90), y, x)]
    df = split_last_n(spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double, x double"), 20)
    got = forecasts.ar_regression(df, ["x"], period=12, ridge=0.0).orderBy("Date").select("yhat").collect()
    assert [r[0] for r in got] == pytest.approx(y[70:], rel=1e-5)


def test_fourier_regression_recovers_a_product(spark):
    days = weeks(160)
    years = np.array([(d - date(1995, 1, 1)).days for d in days]) / 365.25
    angle = 2 * np.pi * np.array([(d - date(1970, 1, 1)).days for d in days]) / 365.25
    y = np.exp(2 + 0.1 * years + 0.3 * np.sin(angle))
    df = split_last_n(series_frame(spark, {(1, 1): y}), 52)
    got = forecasts.fourier_regression(df, holiday=None, ridge=0.0).orderBy("Date").select("yhat").collect()
    assert [r[0] for r in got] == pytest.approx(list(y[108:]), rel=1e-6)


def test_a_trend_without_bends_is_the_plain_one(spark):
    df = split_last_n(series_frame(spark, {(1, 1): wave(150, 3), (1, 2): wave(40, 4)}).withColumn("IsHoliday", F.col("Store") == 9), 20)
    df = df.withColumn("x", F.rand(3))
    plain = {(r["Dept"], r["Date"]): r["yhat"] for r in forecasts.fourier_regression(df, ["x"]).collect()}
    got = changepoint_regression(df, ["x"], penalty=math.inf).collect()
    assert {(r["Dept"], r["Date"]) for r in got} == set(plain) and all(r["changepoints"] == [] for r in got)
    assert [r["yhat"] for r in got] == pytest.approx([plain[r["Dept"], r["Date"]] for r in got], rel=1e-6)


def test_planted_changepoints_are_found(spark):
    rng = np.random.default_rng(6)
    data, t = {}, np.arange(240) / 52
    for dept, (places, slopes) in enumerate([((), ()), ((80,), (0.9,)), ((50, 130), (0.8, -1.4))], start=1):
        trend = 3 + 0.1 * t + sum(s * np.maximum(t - p / 52, 0) for p, s in zip(places, slopes))
        data[1, dept] = np.exp(trend + 0.1 * np.sin(2 * np.pi * t) + rng.normal(0, 0.01, 240)).tolist()
    data[2, 1] = [-1.0] * 60
    df = split_last_n(series_frame(spark, data), 40)
    got = changepoint_regression(df, holiday=None, harmonics=1, ridge=0.0).orderBy("Date").collect()
    days = weeks(240)
    for dept, places in ((1, ()), (2, (80,)), (3, (50, 130))):
        mine = [r for r in got if (r["Store"], r["Dept"]) == (1, dept)]
        found = sorted({days.index(d) for d in mine[0]["changepoints"]})
        assert len(mine) == 40
        for p in places:
            assert min(abs(f - p) for f in found) <= 7
        assert all(min([abs(f - p) for p in places], default=99) <= 14 for f in found)
        truth = data[1, dept][200:]
        assert np.mean(np.abs([r["yhat"] / v - 1 for r, v in zip(mine, truth)])) < 0.05
    plain = forecasts.fourier_regression(df, holiday=None, harmonics=1, ridge=0.0).where("Dept = 3").orderBy("Date").collect()
    assert np.mean(np.abs([r["yhat"] / v - 1 for r, v in zip(plain, data[1, 3][200:])])) > 0.2
    assert {(r["status"], r["yhat"]) for r in got if r["Store"] == 2} == {("not fitted", None)}


def test_coordinate_descent_meets_the_optimum():
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (3, 40, 6))
    y = rng.normal(0, 1, (3, 40)) + 2 * x[:, :, 1]
    matrix, right = np.einsum("nki,nkj->nij", x, x), np.einsum("nki,nk->ni", x, y)
    for penalty in (0.0, 3.0, 15.0, 1e9):
        beta = descend(matrix, right, np.full(3, penalty), np.zeros((3, 6)))
        slack = right - np.einsum("nij,nj->ni", matrix, beta)
        assert (np.abs(slack) <= penalty + 1e-4).all()
        assert slack[beta != 0] == pytest.approx(penalty * np.sign(beta[beta != 0]), abs=1e-4)


def test_grouped_ridge_per_group(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k, (a, b, c) in {1: (1.0, 2.0, -3.0), 2: (5.0, 0.5, 0.0)}.items():
        for x1, x2 in rng.normal(0, 2, (40, 2)):
            rows.append((k, float(x1), float(x2), float(a + b * x1 + c * x2)))
    df = spark.createDataFrame(rows, "k int, x1 double, x2 double, y double")
    got = {r["k"]: r["beta"] for r in grouped_ridge(df, ["k"], "y", ["x1", "x2"], 0.0).collect()}
    assert got[1] == pytest.approx([1, 2, -3]) and got[2] == pytest.approx([5, 0.5, 0], abs=1e-9)


def test_seasonal_naive_over_several_seasons(spark):
    y = list(range(1, 41))
    df = split_last_n(series_frame(spark, {(1, 1): y}), 20)
    got = [r[0] for r in forecasts.seasonal_naive(df, 8).orderBy("Date").select("yhat").collect()]
    assert got == [float(y[20 - 8 + i % 8]) for i in range(20)]
    short = split_last_n(series_frame(spark, {(1, 1): list(range(1, 25))}), 20)
    assert forecasts.seasonal_naive(short, 8).where("yhat IS NOT NULL").count() == 0


def plain_replay(demand, opening, q, r, lead):
    stock, due, out = opening, None, []
    for t, d in enumerate(demand, start=1):
        d, start = max(d, 0.0), stock
        arriving = q if due == t else 0.0
        due = None if due == t else due
        stock += arriving
        sold = min(stock, d)
        short = max(0.0, d - stock)
        stock -= sold
        order = stock <= r and due is None
        due = t + lead if order else due
        out.append((t, d, start, arriving, start + arriving, sold, short, stock, q if order else 0.0, float(due) if order else None))
    return out


def test_replay_matches_a_plain_loop_and_conserves_stock(spark):
    random.seed(8)
    demand, policy = {}, []
    for k in range(25):
        demand[(k, 1)] = [random.choice([-3, 0, 5, 20, 60]) + random.random() for _ in range(60)]
        policy.append((k, 1, float(random.randint(5, 150)), float(random.randint(0, 90)), random.randint(1, 7)))
    rows = [(s, d, i + 1, float(v)) for (s, d), values in demand.items() for i, v in enumerate(values)]
    dd = spark.createDataFrame(rows, "Store int, Dept int, period int, demand double")
    pp = spark.createDataFrame(policy, "Store int, Dept int, EOQ double, ROP double, lead_time int")
    got = replay(dd, pp, 60).orderBy("Store", "Period").collect()
    for k, _, q, r, lead in policy:
        mine = [tuple(row)[2:] for row in got if row["Store"] == k]
        expected = plain_replay(demand[(k, 1)], r, q, r, lead)
        for a, b in zip(mine, expected, strict=True):
            assert a == pytest.approx(b)
    for row in got:
        assert row["Inventory_Start_Period"] + row["Order_Arriving_This_Period"] - row["Units_Sold"] == pytest.approx(row["Inventory_End_Period"])
        assert row["Units_Sold"] + row["Stockout_Units"] == pytest.approx(row["Demand"])


def test_replay_leaves_out_lead_time_zero(spark):
    dd = spark.createDataFrame([(1, 1, 1, 5.0)], "Store int, Dept int, period int, demand double")
    pp = spark.createDataFrame([(1, 1, 10.0, 5.0, 0)], "Store int, Dept int, EOQ double, ROP double, lead_time int")
    assert replay(dd, pp).count() == 0
    with pytest.raises(ValueError):
        replay(dd, pp, 3)


def test_sensitivity_with_a_range(spark):
    df = with_defaults(spark.createDataFrame([(1, 1)], "Store int, Dept int"))
    got = sensitivity(df, "ordering_cost_per_order", 10, 90, 5).orderBy("step").collect()
    assert [r["value"] for r in got] == [10, 30, 50, 70, 90]
    assert [r["EOQ"] for r in got] == [round(math.sqrt(2 * 5200 * s / 2)) for s in (10, 30, 50, 70, 90)]
    with pytest.raises(ValueError):
        sensitivity(df, "nothing")


def test_stratified_split_is_exact_and_repeatable(spark):
    rows = [(i, "hot" if i % 3 else "rare" if i % 30 else "one") for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, label string")
    first = split_stratified(df, "label", "id")
    counts = {r["label"]: (r["t"], r["n"]) for r in first.groupBy("label").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert all(t == math.ceil(n * 0.25) for t, n in counts.values()) and len(counts) == 3
    again = split_stratified(df.repartition(5), "label", "id")
    assert first.exceptAll(again).count() == 0


def test_seeded_sample_is_repeatable(spark):
    df = spark.range(20000).withColumn("k", F.col("id") % 7)
    a, b = seeded_sample(df, ["id"], 500), seeded_sample(df.repartition(3), ["id"], 500)
    assert a.count() == 500 and a.exceptAll(b).count() == 0


def test_scores(spark):
    rows = [("a", 10.0, 12.0), ("a", 0.0, 1.0), ("a", None, 5.0), ("b", 0.0, 3.0), ("c", None, 1.0)]
    df = spark.createDataFrame(rows, "Model string, y double, yhat double")
    got = {r["Model"]: tuple(r)[1:] for r in score(df, "y", "yhat", ["Model"]).collect()}
    assert got["a"] == pytest.approx((1.5, math.sqrt(2.5), 20.0))
    assert got["b"] == (3.0, 3.0, None) and got["c"] == (None, None, None)


def test_best_model_takes_the_first_on_ties(spark):
    rows = [(1, 1, "B", 5.0), (1, 1, "A", 5.0), (1, 1, "C", None), (1, 2, "C", 1.0)]
    df = spark.createDataFrame(rows, "Store int, Dept int, Model string, RMSE double")
    assert {(r["Dept"], r["Model"]) for r in best_model(df).collect()} == {(1, "A"), (2, "C")}


def test_missing_columns():
    class Frame:
        columns = ["a"]

    with pytest.raises(ValueError, match="b, c"):
        require_columns(Frame(), ["a", "b", "c"])


def test_panel_files(spark, tmp_path):
    df = series_frame(spark, {(1, 1): [1, 2], (2, 1): [3]})
    save_panel(df, str(tmp_path / "p.parquet"))
    back = read_panel(spark, str(tmp_path / "p.parquet")).select(*df.columns)
    assert back.exceptAll(df).count() == 0 and back.count() == 3
    save_panel(df, str(tmp_path / "c.csv"))
    schema = "Store int, Dept int, Date date, Weekly_Sales double"
    assert read_panel(spark, str(tmp_path / "none.parquet"), str(tmp_path / "c.csv"), schema).exceptAll(df).count() == 0
    with pytest.raises(FileNotFoundError):
        read_panel(spark, str(tmp_path / "none.parquet"))


def test_tree_models_are_stored_and_found(spark, tmp_path):
    rows = [(float(i % 11), float(i % 7), float(3 * (i % 11) - (i % 7))) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    for kind in KINDS:
        small = {"numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 1} if kind == KINDS[0] else {"maxIter": 3, "maxDepth": 3}
        model = fit_trees(df, ["a", "b"], "y", kind, **small)
        for stamp in ("20250101", "20250102"):
            save_model(model, str(tmp_path / f"{kind}_{stamp}"))
        path = latest_artifact(spark, str(tmp_path), kind)
        assert path.endswith("20250102")
        again = predict(load_model(path), df).agg(F.sum("yhat")).first()[0]
        assert again == pytest.approx(predict(model, df).agg(F.sum("yhat")).first()[0])
    assert latest_artifact(spark, str(tmp_path / "absent"), "x") is None


NEWS = [
    (i, f"2025-01-{i + 1:02d}", "s", "Head", text, "k", label, "4")
    for i, (text, label) in enumerate(
        [("storm flood damage port storm", "Natural Disaster"), ("hurricane storm flood coast", "Natural Disaster")] * 5
        + [("strike union workers walkout", "Labor Dispute"), ("workers union strike talks", "Labor Dispute")] * 5
    )
]
NEWS_SCHEMA = (
    "id int, date_published string, source string, headline string, summary string, keywords string, "
    "risk_category string, risk_score string"
)


def test_classifier_is_trained_stored_and_used(spark):
    news = spark.createDataFrame(NEWS, NEWS_SCHEMA)
    folder = scratch_path(spark, "test-models")
    model, record = train_classifier(news, "2025-01-01 00:00:00", folder)
    assert record.first()["Accuracy"] == 1.0
    loaded = NaiveBayes.load(spark, latest_artifact(spark, folder, "risk_category_classifier_"))
    extra = [(100, None, "s", None, "", "", None, None), (101, None, "s", None, "the of and", "", None, None), (102, None, "s", None, "a storm and a flood", "", None, "x")]
    found = {r["id"]: r for r in enrich(spark.createDataFrame(extra, NEWS_SCHEMA), loaded).collect()}
    assert found[100]["ai_predicted_category"] == "N/A (No Input Text)" and found[100]["ai_risk_score"] == 3
    assert found[101]["ai_predicted_category"] == "N/A (No Processable Text)"
    assert found[102]["ai_predicted_category"] == "Natural Disaster" and found[102]["manual_risk_score"] == 0
    offered = category_filter_column(enrich(news, loaded)).select("filter_category").distinct().count()
    assert offered == 2


def test_bayes_by_hand(spark):
    docs = spark.createDataFrame([(1, ["aa", "bb"], "x"), (2, ["aa", "aa", "cc"], "x"), (3, ["bb", "cc", "cc"], "y")], "id int, w array<string>, c string")
    model = NaiveBayes.fit(docs, "id", "w", "c", min_docs=1, max_share=1.0)
    got = {(r["id"], r["label"]): r["score"] for r in model.scores(docs, "id", "w").collect()}
    bags = {1: ["aa", "bb", "aa bb"], 2: ["aa", "aa", "cc", "aa aa", "aa cc"], 3: ["bb", "cc", "cc", "bb cc", "cc cc"]}
    terms = sorted({t for b in bags.values() for t in b})
    df = {t: sum(t in b for b in bags.values()) for t in terms}
    weights = {}
    for i, b in bags.items():
        raw = {t: (1 + math.log(b.count(t))) * (math.log(4 / (1 + df[t])) + 1) for t in set(b)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        weights[i] = {t: v / norm for t, v in raw.items()}
    labels = {1: "x", 2: "x", 3: "y"}
    for c in ("x", "y"):
        mass = {t: sum(weights[i].get(t, 0.0) for i in bags if labels[i] == c) for t in terms}
        total = sum(mass.values()) + 0.1 * len(terms)
        prior = math.log(sum(v == c for v in labels.values()) / 3)
        for i in bags:
            expected = prior + sum(w * math.log((mass[t] + 0.1) / total) for t, w in weights[i].items())
            assert got[(i, c)] == pytest.approx(expected)


def test_alert_order_puts_missing_values_last(spark):
    rows = [(1, None, 5, 1, "b"), (2, "2025-01-02", 3, 2, "a"), (3, "2025-01-02", 9, 0, None), (4, "2025-01-03", 1, 0, "a")]
    df = spark.createDataFrame(rows, "id int, date_published string, ai_risk_score int, manual_risk_score int, ai_predicted_category string")
    assert [r["id"] for r in order_alerts(df).collect()] == [4, 3, 2, 1]
    assert [r["id"] for r in order_alerts(df, "category").collect()] == [2, 4, 1, 3]
    with pytest.raises(ValueError):
        order_alerts(df, "other")


def test_alerts_on_a_stream(spark, tmp_path):
    news = spark.createDataFrame(NEWS, NEWS_SCHEMA)
    news.repartition(3).write.parquet(str(tmp_path / "in"))
    query = write_alerts(news_stream(spark, str(tmp_path / "in"), news.schema), str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "ai_risk_score", "predicted_sentiment")
    want = enrich(news).select("id", "ai_risk_score", "predicted_sentiment")
    assert got.count() == len(NEWS) and got.exceptAll(want).count() == 0


def test_seasonal_naive_repeats_for_any_number_of_rows(spark):
    values = [float(v) for v in range(1, 31)]
    df = series_frame(spark, {(1, 1): values})
    got = forecasts.seasonal_naive(split_last_n(df, 20), period=4).orderBy("Date").select("yhat").collect()
    assert [r[0] for r in got] == [7.0, 8.0, 9.0, 10.0] * 5


@pytest.mark.parametrize("ranges", [2, 8, 256])
def test_labels_are_numbered_over_ranges(spark, ranges):
    rng = random.Random(3)
    names = [f"{'common prefix ' * (i % 2)}{rng.randrange(10**6)}é" for i in range(900)]
    rows = [(n, k) for k, n in enumerate(names)] + [(None, -1), ("", -2)] + [("hot", k) for k in range(2000)]
    df = spark.createDataFrame(rows, "name string, k int").repartition(7)
    codes = label_codes(df, "name", "code", start=5, ranges=ranges)
    wanted = sorted({n for n, _ in rows if n is not None}, key=lambda n: n.encode())
    assert {r["name"]: r["code"] for r in codes.collect()} == {n: 5 + k for k, n in enumerate(wanted)}
    assert "windowspecdefinition(name" not in codes._jdf.queryExecution().optimizedPlan().toString()
    assert label_codes(df.where("k < -5"), "name", "code").count() == 0


def test_weeks_with_several_or_odd_days(spark):
    days = [date(2024, 1, 2), date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 25)]
    df = spark.createDataFrame([(1, 1, d, float(k)) for k, d in enumerate(days)], "Store int, Dept int, Date date, Weekly_Sales double")
    got = {str(r["Date"]): r["Weekly_Sales"] for r in regularise(df, ["Weekly_Sales"]).collect()}
    assert got == {"2024-01-05": 2.0, "2024-01-12": 3.0, "2024-01-19": None, "2024-01-26": 4.0}


def test_a_series_without_usable_values_keeps_its_rows(spark):
    rows = {(store, 1): [float(v % 4 + 1) for v in range(48)] for store in (1, 2)}
    split = split_last_n(series_frame(spark, rows), 4)
    split = split.withColumn("Weekly_Sales", F.when(F.col("Store") == 2, F.col("Weekly_Sales")))
    got = forecasts.smoothing(split, period=4, configs=[(None, None, False)]).toPandas()
    assert got[got["Store"] == 1]["yhat"].isna().all() and (got[got["Store"] == 1]["config"] == "not fitted").all()
    assert got[got["Store"] == 2]["yhat"].notna().all() and len(got) == 8
