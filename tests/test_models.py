"""Models, accuracy and draws against hand-written NumPy."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import arima, smoothing, unit_root, waves
from ledgerloom.functions.padded import Padded
from ledgerloom.operators import forecasting as fc
from ledgerloom.operators import models as m
from ledgerloom.operators import risk as r
from ledgerloom.operators import series as s
from ledgerloom.params import Forecasting, Risk
from tests.conftest import month


def seasonal(n=60, seed=1):
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    return (1e6 * (2 + 0.01 * i) * (1 + 0.2 * np.sin(2 * np.pi * i / 12)) + rng.normal(0, 2e4, n)).tolist()


def ets_sse(y, form, a, b, g):
    first, second = np.mean(y[:12]), np.mean(y[12:24])
    slope = (second - first) / 12 if form[1] == "A" else 0.0
    level = first - 6.5 * slope
    line = [level + slope * (t + 1) for t in range(12)]
    season = [v - at if form[2] == "A" else v / at for v, at in zip(y, line)]
    sse = 0.0
    for t, v in enumerate(y):
        base = level + slope
        old = season[t % 12] if form[2] != "N" else 0.0
        expected = base + old if form[2] == "A" else base * old if form[2] == "M" else base
        sse += (v - expected) ** 2
        new_level = a * (v - old if form[2] == "A" else v / old if form[2] == "M" else v) + (1 - a) * base
        if form[1] == "A":
            slope = b * (new_level - level) + (1 - b) * slope
        if form[2] == "A":
            season[t % 12] = g * (v - base) + (1 - g) * old
        if form[2] == "M":
            season[t % 12] = g * (v / base) + (1 - g) * old
        level = new_level
    return sse


def fitted(df, model, **settings):
    return {x["series_id"]: x for x in m.fit_models(m.pack_series(df), (model,), Forecasting(**settings)).collect()}


def test_ets_is_never_worse_than_the_grid(make_series):
    """Each form's error is that of a plain loop at the weights found, no neighbour at the last step is better, and no grid point."""
    y = seasonal()
    grid = Forecasting().grid
    for form in smoothing.FORMS:
        won = fitted(make_series({"a": y}), "ets", ets_forms=(form,))["a"]
        a, b, g = (won["params"][k] for k in ("alpha", "beta", "gamma"))
        assert won["sse"] == pytest.approx(ets_sse(y, form, a, b, g))
        assert won["sse"] <= min(ets_sse(y, form, *w) for w in itertools.product(grid, grid if form[1] == "A" else (0.0,), grid if form[2] != "N" else (0.0,))) * (1 + 1e-12)
        step = smoothing.STEPS[-1]
        for d in (-step, step):
            assert won["sse"] <= ets_sse(y, form, min(0.999, max(0.001, a + d)), b, g) * (1 + 1e-9)
    best = fitted(make_series({"a": y}), "ets")["a"]
    assert best["aic"] == pytest.approx(min(fitted(make_series({"a": y}), "ets", ets_forms=(f,))["a"]["aic"] for f in smoothing.FORMS))


def padded_series(values, unknown=()):
    n = len(values)
    known = np.ones((1, n), bool)
    known[0, list(unknown)] = False
    return Padded(np.array([0]), np.array([values], float), known, np.array([n]), np.array([0]), np.array([n % 12]))


def plain_errors(w, params):
    p1, p2, t1, t2, sp, sq = params
    ar = {1: p1, 2: p2, 12: sp, 13: -p1 * sp, 14: -p2 * sp}
    ma = {1: t1, 2: t2, 12: sq, 13: t1 * sq, 14: t2 * sq}
    e = []
    for t in range(len(w)):
        e.append(w[t] - sum(c * w[t - k] for k, c in ar.items() if t >= k) - sum(c * e[t - k] for k, c in ma.items() if t >= k))
    return np.array(e)


def test_ar_estimates_and_errors_equal_plain_loops(make_series):
    y = np.array(seasonal(n=90, seed=2))
    w = y[13:] - y[12:-1] - y[1:-12] + y[:-13]
    lag = lambda x, k: np.concatenate([np.zeros(k), x[: len(x) - k]])
    long = np.column_stack([lag(w, k) for k in (1, 2, 3, 12, 13)])
    e = w - long @ np.linalg.lstsq(long, w, rcond=None)[0]
    best = None
    for form, (p, q, sp, sq) in arima.ORDERS.items():
        x = np.column_stack([lag(w, k) for k in [*range(1, p + 1), *[12] * sp]] + [lag(e, k) for k in [*range(1, q + 1), *[12] * sq]])
        c = list(np.linalg.lstsq(x, w, rcond=None)[0])
        phi, sphi, theta, stheta = c[:p] + [0] * (2 - p), c[p : p + sp] or [0], c[p + sp : p + sp + q] + [0] * (2 - q), c[p + sp + q :] or [0]
        inside = lambda v, edge=1.0: min(0.98 * edge, max(-0.98 * edge, v))
        params = [inside(phi[0], 1 - inside(phi[1])), inside(phi[1]), inside(theta[0], 1 + inside(theta[1])), inside(theta[1]), inside(sphi[0]), inside(stheta[0])]
        sse = (plain_errors(w, params) ** 2).sum()
        aic = len(w) * math.log(sse / len(w)) + 2 * (p + q + sp + sq + 1)
        if best is None or aic < best[0]:
            best = aic, form, params
    won = fitted(make_series({"a": y.tolist()}), "ar")["a"]
    assert won["form"] == best[1] and won["aic"] == pytest.approx(best[0])
    assert [won["params"][k] for k in arima.PARAMS] == pytest.approx(best[2], rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("unknown", [(), (40,), (20, 21, 22, 50), (13, 30, 42, 54, 69)])
def test_likelihood_with_unknown_months_is_the_dense_gaussian_one(unknown):
    """The known months' density from their full covariance, against the one that integrates unknown months out."""
    rng = np.random.default_rng(7)
    params = np.array([[0.4, -0.2, -0.5, 0.1, 0.3, -0.6]])
    n = 70
    y = np.cumsum(rng.normal(0, 5, n)) + 30 * np.sin(np.arange(n)) + 100
    at_zero = plain_y(np.zeros(n - 13), params[0], y[:13])
    reach = np.column_stack([plain_y(np.eye(n - 13)[k], params[0], np.zeros(13))[13:] for k in range(n - 13)])
    seen = [t for t in range(13, n) if t not in unknown]
    a = reach[[t - 13 for t in seen]]
    cov, gap = a @ a.T, (y - at_zero)[seen]
    _, _, sse, count, logdet = arima.innovations(padded_series(y, unknown), params, 12)
    assert count[0] == len(seen)
    assert sse[0] == pytest.approx(gap @ np.linalg.solve(cov, gap)) and logdet[0] == pytest.approx(np.linalg.slogdet(cov)[1], abs=1e-8)


def plain_y(e, params, first):
    """Values from errors, by the model's own recursion."""
    p1, p2, t1, t2, sp, sq = params
    ar = {1: p1, 2: p2, 12: sp, 13: -p1 * sp, 14: -p2 * sp}
    ma = {1: t1, 2: t2, 12: sq, 13: t1 * sq, 14: t2 * sq}
    y, w = list(first), []
    for t in range(len(e)):
        w.append(e[t] + sum(c * w[t - k] for k, c in ar.items() if t >= k) + sum(c * e[t - k] for k, c in ma.items() if t >= k))
        y.append(w[-1] + y[-1] + y[-12] - y[-13])
    return np.array(y)


def test_ar_runs_and_spreads_like_simulated_futures():
    rng = np.random.default_rng(8)
    params = np.array([0.3, 0.1, -0.4, 0.2, 0.2, -0.5])
    n, h = 70, 18
    e = rng.normal(0, 2, n - 13)
    y = plain_y(e, params, rng.normal(100, 5, 13))
    fitted_, ahead, spread, *_ = arima.run(padded_series(y), params[None], np.array([2.0]), 12, h)
    assert fitted_[0, 13:] == pytest.approx(y[13:] - e)
    assert ahead[0] == pytest.approx(plain_y(np.concatenate([e, np.zeros(h)]), params, y[:13])[-h:])
    futures = np.array([plain_y(np.concatenate([e, rng.normal(0, 2, h)]), params, y[:13])[-h:] for _ in range(3000)])
    assert futures.std(0) == pytest.approx(spread[0], rel=0.06)
    inside = np.abs(futures - ahead[0]) < 1.96 * spread[0]
    assert abs(inside.mean() - 0.95) < 0.01


@pytest.mark.parametrize("form", smoothing.FORMS)
def test_ets_spreads_like_simulated_futures(form):
    rng = np.random.default_rng(9)
    h, runs, season = 30, 4000, 12
    a, b, g = 0.3, 0.2 if form[1] == "A" else 0.0, 0.25 if form[2] != "N" else 0.0
    wave = 1 + 0.2 * np.sin(np.arange(12)) if form[2] == "M" else 10 * np.sin(np.arange(12))
    state = np.array([200.0]), np.array([1.0 if form[1] == "A" else 0.0]), wave[None]
    spread = smoothing.spread(form, season, state, np.array([[a, b, g]]), np.array([3.0]), h)[0]
    ahead, part = (x[0] for x in smoothing.ahead(form, season, state, h))
    assert ahead - part == pytest.approx(200 + state[1][0] * np.arange(1, h + 1))
    level, slope, s = np.full(runs, 200.0), np.full(runs, state[1][0]), np.repeat(wave[:, None], runs, 1)
    futures = []
    for t in range(h):
        base, old = level + slope, s[t % 12].copy()
        expected = base + old if form[2] == "A" else base * old if form[2] == "M" else base
        v = expected + rng.normal(0, 3, runs)
        futures.append(v)
        error = v - base - old if form[2] == "A" else v / old - base if form[2] == "M" else v - base
        if form[2] == "A":
            s[t % 12] = old + g * error
        if form[2] == "M":
            s[t % 12] = old + g * (v / base - old)
        level, slope = base + a * error, slope + a * b * error
    futures = np.array(futures).T
    assert futures.std(0) == pytest.approx(spread, rel=0.06)
    assert abs((np.abs(futures - ahead) < 1.96 * spread).mean() - 0.95) < 0.012


def test_line_equals_penalised_least_squares_and_spreads_like_new_samples(make_series):
    y = np.array(seasonal(seed=3))
    s_ = Forecasting()
    params = fitted(make_series({"a": y.tolist()}), "fourier")["a"]["params"]
    i = np.arange(len(y) + 18)
    share = i / len(y)
    cols = [np.ones(len(i)), share]
    for k in (1, 2, 3):
        cols += [np.sin(2 * np.pi * k * (i % 12) / 12), np.cos(2 * np.pi * k * (i % 12) / 12)]
    cols += [np.maximum(0, share - 0.8 * k / (s_.knots + 1)) for k in range(1, s_.knots + 1)]
    x = np.column_stack(cols)
    past = x[: len(y)]

    def solved(size):
        inverse = np.linalg.inv(past.T @ past + np.diag([0.0] * 8 + [size] * s_.knots))
        coef = inverse @ past.T @ y
        return ((y - past @ coef) ** 2).sum() / (len(y) - np.trace(inverse @ past.T @ past)) ** 2, size, inverse, coef

    _, penalty, inverse, coef = min((solved(size) for size in s_.knot_penalties), key=lambda x_: x_[0])
    assert params["penalty"] == penalty
    np.testing.assert_allclose([params[f"c{k}"] for k in range(x.shape[1])], coef, rtol=1e-6)
    rng = np.random.default_rng(4)
    misses = []
    for _ in range(2000):  # bends drawn as the penalty assumes, noise of one
        truth = np.concatenate([rng.normal(0, 3, 8), rng.normal(0, penalty**-0.5, s_.knots)])
        sample = x @ truth + rng.normal(0, 1, len(i))
        misses.append(sample[len(y):] - x[len(y):] @ (inverse @ past.T @ sample[: len(y)]))
    p = padded_series(y)
    _, ahead, spread, *_ = waves.run(p, coef[None], np.array([penalty]), np.array([1.0]), p.n, 3, s_.knots, 18)
    assert np.std(misses, 0) == pytest.approx(spread[0], rel=0.06) and ahead[0] == pytest.approx(x[len(y):] @ coef)


def test_a_broken_trend_is_followed(make_series):
    line = lambda i: 5e6 + 8e4 * min(i, 45) - 6e4 * max(i - 45, 0)
    y = [line(i) + 2e5 * math.sin(2 * math.pi * i / 12) for i in range(96)]
    ahead = fc.forecast_horizon(make_series({"a": y[:84]}), models=("fourier",), settings=Forecasting(horizon=12)).orderBy("step").collect()
    assert max(abs(x["forecast"] / y[84 + k] - 1) for k, x in enumerate(ahead)) < 0.05
    assert all(x["lower_bound"] < x["forecast"] < x["upper_bound"] for x in ahead)
    straight = fitted(make_series({"a": [1e6 + 1e4 * i for i in range(60)]}), "fourier")["a"]["params"]
    assert max(abs(straight[f"c{k}"]) for k in range(8, 8 + Forecasting().knots)) < 1e-3


def test_bounds_hold_the_future(make_series):
    """Nineteen of twenty months that follow lie inside, roughly: the parameters are estimated."""
    rng = np.random.default_rng(12)
    series = {f"s{k}": (1e6 + 4e3 * np.arange(90) + 1e5 * np.sin(np.arange(90) * np.pi / 6 + k) + rng.normal(0, 3e4, 90)).tolist() for k in range(40)}
    for models in (("fourier",), ("ar",), ("ets",)):
        rows = fc.forecast_horizon(make_series({k: v[:78] for k, v in series.items()}), models, Forecasting(horizon=12)).collect()
        inside = [x["lower_bound"] <= series[x["series_id"]][77 + x["step"]] <= x["upper_bound"] for x in rows]
        assert 0.85 < np.mean(inside) <= 1, models


def by_step(rows, series="a"):
    return {str(x["date"]): x["forecast"] for x in rows if x["series_id"] == series}


def test_trailing_nulls_do_not_move_the_dates(make_series):
    y = seasonal(n=60)
    whole, cut = fc.forecast_horizon(make_series({"a": y[:57]})).collect(), fc.forecast_horizon(make_series({"a": y[:57] + [None] * 3})).collect()
    assert by_step(whole) == pytest.approx(by_step(cut)) and min(by_step(cut)) == "2024-10-01"


def test_a_missing_month_keeps_the_season(make_series):
    y = [3e6 + 1e4 * i + 5e5 * math.sin(2 * math.pi * i / 12) for i in range(72)]
    gap = make_series({"a": y[:60]}).where("date <> date '2024-03-01'")
    ahead = by_step(fc.forecast_horizon(gap, settings=Forecasting(horizon=12)).collect())
    wrong = [abs(ahead[str(month(60 + i))] / y[60 + i] - 1) for i in range(12)]
    assert max(wrong) < 0.02
    fitted = fc.fitted_values(fc.tournament(gap))
    assert fitted.where("date = date '2024-03-01'").count() == 0


def test_a_perfect_season_has_an_autoregression(make_series):
    y = [3e6 + 1e4 * i + 1e5 * (i % 12) for i in range(60)]
    ahead = fc.forecast_horizon(make_series({"a": y}), models=("ar",), settings=Forecasting(horizon=12)).orderBy("step").collect()
    assert [x["forecast"] for x in ahead] == pytest.approx([3e6 + 1e4 * i + 1e5 * (i % 12) for i in range(60, 72)])
    assert ahead[0]["model"] == "ar"


def test_the_season_is_a_parameter(make_series):
    y = [100.0 + [10, -5, 20, -25][i % 4] for i in range(40)]
    ahead = fc.forecast_horizon(make_series({"a": y}), models=("ets",), settings=Forecasting(horizon=4, season=4)).orderBy("step").collect()
    assert [x["forecast"] for x in ahead] == pytest.approx([110.0, 95.0, 120.0, 75.0])


def test_no_series_or_model_is_missing(make_series):
    df = make_series({"long": seasonal(), "short": seasonal()[:20], "tiny": [1.0, 2.0], "none": [None] * 3})
    for rows in (fc.fitted_parameters(df), fc.holdout_validation(df), fc.rolling_backtest(df)):
        got = {(x["series_id"], x["model"]): x["reason"] for x in rows.collect()}
        assert set(got) == {(s_, k) for s_ in ("long", "short", "tiny", "none") for k in m.MODELS}
        assert all(got["long", k] is None for k in m.MODELS) and got["tiny", "ar"] == "too short"
    stored = fc.fitted_parameters(df.where("series_id = 'long'"))
    left = {x["series_id"]: x["reason"] for x in fc.score(df, stored, 2).where("step is null").collect()}
    assert left == {"short": "no parameters stored", "tiny": "no parameters stored", "none": "no parameters stored"}


def test_stored_models_score_like_fresh_ones(spark, make_series, tmp_path):
    df = make_series({"a": seasonal(), "b": seasonal(seed=9)})
    fc.save_models(df, str(tmp_path / "models"))
    stored = fc.load_models(spark, str(tmp_path / "models"))
    fresh = fc.tournament(df).select("series_id", "model", F.col("run.forecast")[2].alias("f")).collect()
    scored = fc.score(df, stored, 5).filter("step = 3").collect()
    want = {(x["series_id"], x["model"]): x["f"] for x in fresh}
    assert {(x["series_id"], x["model"]): pytest.approx(x["forecast"]) for x in scored} == want


def test_states_go_on_like_a_replay(make_series):
    """In two steps, over a gap, with a series that has no news and one that is new."""
    y, z = seasonal(n=80), seasonal(n=70, seed=5)
    y[73] = None
    whole = make_series({"a": y, "b": z, "still": seasonal(n=60, seed=6)})
    early, middle = (whole.where(F.col("date") < str(month(k))) for k in (66, 72))
    stored = fc.fitted_parameters(early).persist()
    states = fc.model_states(early, stored)
    states, _ = fc.advance_states(states, middle, 5)
    news = whole.where(F.col("date") > str(month(60))).unionByName(make_series({"new": [1.0] * 9}))
    later, ahead = fc.advance_states(states, news, 5)
    want = {(x["series_id"], x["model"], x["step"]): x for x in fc.score(whole, stored, 5).collect()}
    got = {(x["series_id"], x["model"], x["step"]): x for x in ahead.collect()}
    assert set(got) == set(want)
    for k, x in got.items():
        assert x["date"] == want[k]["date"] and x["forecast"] == pytest.approx(want[k]["forecast"], rel=1e-9)
    ends = {(x["series_id"], x["model"]): str(x["state_date"]) for x in later.collect()}
    assert ends["a", "ar"] == "2026-08-01" and ends["still", "ets"] == "2024-12-01" and len(ends) == 9


EDGE_SERIES = {
    "one": [5.0], "two": [5.0, 7.0], "constant": [4.0] * 40, "zeros": [0.0] * 40, "short": list(map(float, range(1, 24))),
    "two_years": list(map(float, range(1, 25))), "none": [None] * 5, "last_only": [None, None, 8.0],
}


def test_forecast_horizon_covers_every_series(make_series):
    rows = fc.forecast_horizon(make_series(EDGE_SERIES)).collect()
    by = {}
    for x in rows:
        by.setdefault(x["series_id"], []).append(x)
    assert set(by) == set(EDGE_SERIES)
    assert all(len(v) == 18 for v in by.values())
    assert all(x["forecast"] is not None and math.isfinite(x["forecast"]) for x in rows)
    one = sorted(by["one"], key=lambda x: x["step"])
    assert one[0]["forecast"] == 3_000_000.0 and one[1]["forecast"] == pytest.approx(3_060_000.0)
    last = sorted(by["last_only"], key=lambda x: x["step"])
    assert last[1]["forecast"] == pytest.approx(8.0 * 1.02)


def test_edge_series_in_analysis(make_series):
    df = make_series(EDGE_SERIES)
    for op in (s.series_stats, s.stationarity, s.decompose_additive, s.autocorrelation, s.partial_autocorrelation,
               lambda d: s.decomposition_strength(s.decompose_additive(d)), s.trend_forecast, fc.holdout_validation,
               lambda d: fc.rolling_backtest(d)):
        op(df).collect()


def test_unit_root_equals_plain_regressions(make_series):
    rng = np.random.default_rng(3)
    walk, wave = np.cumsum(rng.normal(0, 1, 90)) + 50, [50.0]
    for e in rng.normal(0, 1, 89).tolist():
        wave.append(50 + 0.4 * (wave[-1] - 50) + e)
    cases = {"walk": walk.tolist(), "wave": wave, "gap": [None, *walk[:40].tolist(), None, *walk[40:60].tolist()]}
    got = {x["series_id"]: x for x in s.stationarity(make_series(cases)).collect()}
    for name, values in cases.items():
        y = np.array([v for v in values if v is not None])
        n, d = len(y), np.diff([v for v in values if v is not None])
        most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)

        def regression(k, lost):
            x = np.column_stack([np.ones(n - 1 - lost), y[lost:-1], *[d[lost - j : len(d) - j] for j in range(1, k + 1)]])
            coef, *_ = np.linalg.lstsq(x, d[lost:], rcond=None)
            return x, coef, ((d[lost:] - x @ coef) ** 2).sum()

        rows = n - 1 - most
        k = min(range(most + 1), key=lambda k: rows * math.log(regression(k, most)[2] / rows) + 2 * (k + 2))
        x, coef, sse = regression(k, k)
        error = math.sqrt(sse / (len(x) - k - 2) * np.linalg.inv(x.T @ x)[1, 1])
        assert (got[name]["lags"], got[name]["n_obs"]) == (k, len(x)) and got[name]["df_statistic"] == pytest.approx(coef[1] / error, rel=1e-6)
    assert got["wave"]["is_stationary"] and not got["walk"]["is_stationary"]


def test_unit_root_tables():
    """The published 1, 5 and 10 % values for an infinite sample and for 100 observations, and their p-values."""
    for level, p, limit, hundred in (("1pct", 0.01, -3.43, -3.50), ("5pct", 0.05, -2.86, -2.89), ("10pct", 0.10, -2.57, -2.58)):
        assert unit_root.critical(level, 10**9) == pytest.approx(limit, abs=0.005) and unit_root.critical(level, 100) == pytest.approx(hundred, abs=0.005)
        assert unit_root.p_value(unit_root.critical(level, 10**9)) == pytest.approx(p, abs=0.001)
    assert unit_root.p_value(3) == 1 and unit_root.p_value(-20) == 0
    assert unit_root.p_value(-1.62) == pytest.approx(unit_root.p_value(-1.60), abs=0.02)


def test_trend_forecast_and_next_month(make_series):
    df = make_series({"a": [float(10 * i) for i in range(1, 15)]})
    rows = s.trend_forecast(df, 2).orderBy("step").collect()
    assert [x["forecast"] for x in rows] == pytest.approx([150.0, 160.0])
    assert str(rows[0]["date"]) == "2021-03-01"
    late = df.withColumn("date", F.date_add("date", 27))
    assert str(s.trend_forecast(late, 1).first()["date"]) == "2021-04-01"


def test_accuracy(spark):
    rows = [("a", "m", 1.0, 2.0), ("a", "m", 2.0, 2.0), ("a", "m", 0.0, 1.0), ("a", "m", None, 1.0), ("a", "m", 4.0, float("nan"))]
    got = fc.accuracy(spark.createDataFrame(rows, "series_id string, model string, actual double, predicted double")).first()
    assert got["n_points"] == 3 and got["mae"] == pytest.approx(2 / 3) and got["mape"] == pytest.approx(50.0)


def test_draws_do_not_depend_on_layout_and_look_normal(spark):
    df = spark.createDataFrame([("a", month(i), 3e6) for i in range(6)], "series_id string, date date, sales double")
    packed = r.pack_forecast(df)
    one = sorted(map(tuple, r.standard_normals(packed, Risk(runs=600)).collect()))
    two = sorted(map(tuple, r.standard_normals(packed.repartition(5), Risk(runs=600)).collect()))
    assert one == two and len(one) == 3600
    z = np.array([(x[3], x[4]) for x in one])
    assert abs(z.mean(axis=0)).max() < 0.06 and abs(z.std(axis=0) - 1).max() < 0.05
    assert abs(np.corrcoef(z.T)[0, 1]) < 0.06


def test_simulation_equals_numpy(spark):
    df = spark.createDataFrame([("a", month(i), 3e6 + 1e4 * i) for i in range(6)], "series_id string, date date, sales double")
    risk = Risk(runs=20)
    z = {}
    for x in r.standard_normals(r.pack_forecast(df), risk).collect():
        z[x["sim_id"], x["period"]] = x["z_sales"]
    for row in r.simulate_plans(df, risk).collect():
        shock, flows, wc = 0.0, [], None
        for t in range(6):
            e = z[row["sim_id"], t + 1]
            shock = 0.12 * e if t == 0 else 0.3 * shock + 0.12 * math.sqrt(1 - 0.09) * e
            v = (3e6 + 1e4 * t) * (1 + shock)
            first = v if t == 0 else first
            ebit = v * 0.35 - 0.2 * first * 1.05**t
            now = v * 1.5 + v * 0.65
            flows.append(ebit - max(0, 0.22 * ebit) - 50_000 - (0 if wc is None else now - wc))
            wc = now
        assert row["total_fcf"] == pytest.approx(sum(flows)) and row["min_monthly_fcf"] == pytest.approx(min(flows))


def test_two_equal_series_get_equal_results(make_series):
    y = seasonal(seed=4)
    rows = fc.forecast_horizon(make_series({"a": y, "b": y})).collect()
    by = {n: sorted((x["step"], x["forecast"]) for x in rows if x["series_id"] == n) for n in "ab"}
    assert by["a"] == by["b"]
