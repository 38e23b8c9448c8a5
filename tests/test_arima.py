"""Fits to all rows up to an origin equal a plain refit there, however the series is cut."""

import numpy as np
import pandas as pd
import pytest

from series import START, frame
from slotwise.operators import arima, forecasts
from slotwise.params import Params

P = Params(step_min=60, horizon_min=180, span=40, arima_long=4, fill_min=60)
LAGS = arima.lags_of(P)


def ar1(n, slope, seed=3):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for i in range(1, n):
        y[i] = slope * y[i - 1] + rng.normal()
    return y


def table(spark, *series):
    rows = [
        pd.DataFrame({"series_id": i, "ts": [START + pd.Timedelta(hours=k) for k in range(len(y))], "v": y}) for i, y in enumerate(series)
    ]
    return frame(spark, pd.concat(rows))


def plain_fit(y, order, long):
    """Both stages by least squares on written-out rows from LAGS + 1 on."""
    p, d, q = order
    w = np.diff(y) if d else y
    rows = range(LAGS + 1 - d, len(w))
    lagged = np.array([[1.0, *(w[t - i] for i in range(1, long + 1))] for t in rows])
    phi = np.linalg.lstsq(lagged, w[rows.start :], rcond=None)[0]

    def shock(t):
        return w[t] - phi @ np.array([1.0, *(w[t - i] for i in range(1, long + 1))])

    design = np.array([
        [*([] if d else [1.0]), *(w[t - i] for i in range(1, p + 1)), *(shock(t - j) for j in range(1, q + 1))] for t in rows
    ]).reshape(len(rows), -1)
    coef = np.linalg.lstsq(design, w[rows.start :], rcond=None)[0] if design.shape[1] else np.zeros(0)
    rest = w[rows.start :] - design @ coef
    n = len(rows)
    aic = n * (np.log(2 * np.pi * (rest @ rest) / n) + 1) + 2 * (len(coef) + 1)
    const, ar, ma = (0.0 if d else coef[0]), coef[(0 if d else 1) :][:p], coef[(0 if d else 1) + p :]
    if q and np.abs(np.roots([1.0, *ma])).max() >= 1:
        aic = np.inf
    return aic, const, ar, ma, w, shock


def plain_forecast(y, orders, long, steps):
    fits = [(plain_fit(y, o, long), o) for o in orders]
    (_, const, ar, ma, w, shock), order = min(fits, key=lambda f: f[0][0])
    past_w = [w[-1 - i] for i in range(len(ar))]
    past_e = [shock(len(w) - 1 - j) for j in range(len(ma))]
    level = y[-1]
    for _ in range(steps):
        value = const + sum(a * x for a, x in zip(ar, past_w)) + sum(m * e for m, e in zip(ma, past_e))
        past_w, past_e = [value, *past_w][: len(ar)], [0.0, *past_e][: len(ma)]
        level = level + value if order[1] else value
    return order, level


def test_equals_a_plain_refit_at_every_origin(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=260)
    moving = 50 + e + 0.7 * np.concatenate([[0], e[:-1]])
    holes = ar1(260, 0.6) + 1000.0
    holes[rng.choice(260, 40, replace=False)] = np.nan
    holes[100:110] = np.nan
    walk = np.cumsum(rng.normal(size=260))
    every = [moving, holes, walk]
    got = arima.arima_forecasts(table(spark, *every), "v", P).toPandas()
    seen = 0
    for i, y in enumerate(every):
        own = got[got["series_id"] == i].set_index("origin")
        for slot in range(24, 260 - 3, 3):
            past = y[: slot + 1]
            known = past[np.isfinite(past)]
            at = START + pd.Timedelta(hours=slot)
            if len(known) < arima.least_rows(P):
                assert at not in own.index
                continue
            late = slot - np.flatnonzero(np.isfinite(past))[-1]
            order, want = plain_forecast(known, arima.orders_of(P), P.arima_long, P.horizon + late)
            row = own.loc[at]
            assert (row["p"], row["d"], row["q"]) == order
            assert row["y_pred"] == pytest.approx(want, rel=1e-6, abs=1e-6)
            assert row["y_true"] == y[slot + 3] or (np.isnan(row["y_true"]) and np.isnan(y[slot + 3]))
            seen += 1
        assert len(own) == sum(1 for slot in range(24, 257, 3) if np.isfinite(y[: slot + 1]).sum() >= arima.least_rows(P))
    assert seen > 200


def test_the_cut_does_not_matter_and_the_future_is_not_seen(spark):
    y = ar1(300, 0.7)
    changed = y.copy()
    changed[200:] += 100
    one, two, three = (
        arima.arima_forecasts(table(spark, v), "v", P.with_(span=s)).toPandas().sort_values("origin").reset_index(drop=True)
        for v, s in ((y, 40), (y, 10_000), (changed, 64))
    )
    pd.testing.assert_frame_equal(one, two, rtol=1e-9)
    early = one["origin"] < START + pd.Timedelta(hours=200)
    np.testing.assert_allclose(one.loc[early, "y_pred"], three.loc[early, "y_pred"], rtol=1e-6)


def test_constant_short_and_empty_series(spark):
    got = arima.arima_forecasts(table(spark, np.full(120, 7.0), np.arange(10.0), np.full(120, np.nan)), "v", P).toPandas()
    assert set(got["series_id"]) == {0}
    assert got["y_pred"].tolist() == pytest.approx([7.0] * len(got))
    assert arima.arima_forecasts(table(spark, np.array([1.0])).limit(0), "v", P).count() == 0


def test_known_coefficients():
    def fit(y, order, long=10):
        lags = max(order[0], long + order[2])
        sums = arima.sum_products(y, lags, np.array([len(y) - 1]), 0, None)
        return arima.search(sums, [order], long)[1][0]

    assert fit(ar1(5000, 0.7), (1, 0, 0))[1] == pytest.approx(0.7, abs=0.03)
    e = np.random.default_rng(5).normal(size=6000)
    assert fit(e[1:] + 0.6 * e[:-1], (0, 0, 1))[1] == pytest.approx(0.6, abs=0.05)
    values, order = arima.forecast(np.arange(60.0), 12, np.array([40, 59]), 0, None, [(0, 1, 0)], 10, np.array([3, 3]))
    assert values.tolist() == [40.0, 59.0] and order.tolist() == [[0, 1, 0]] * 2
    assert np.isnan(arima.forecast(np.arange(20.0), 12, np.array([19]), 0, None, [(2, 1, 2)], 10, np.array([1]))[0]).all()
    _, white = arima.forecast(e[:1500], 12, np.array([1499]), 0, None, [(0, 0, 0), (1, 0, 0), (0, 1, 0)], 10, np.array([1]))
    assert white[0, 1] == 0


def test_beats_persistence_on_autoregression(spark):
    params = P.with_(horizon_min=60, span=500, arima_long=10)
    y = ar1(1400, 0.5)
    got = forecasts.complete(arima.arima_forecasts(table(spark, y), "v", params))
    own = forecasts.backtest_metrics(got.select(*forecasts.FORECAST_COLUMNS)).first()
    naive = forecasts.backtest_metrics(
        forecasts.window_forecasts(table(spark, y), "v", params).filter("model = 'naive'")
    ).first()
    assert own["n"] > 500 and own["rmse"] < 0.9 * naive["rmse"]
