import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from series import START, collected, frame, values
from slotwise.functions.quantiles import group_quantiles
from slotwise.operators import profile, rolling
from slotwise.params import Params

P = Params(span=50)


@pytest.fixture(scope="module")
def data():
    return values(300, series=2, holes=0.25, seed=9)


def by_series(pdf, f):
    return np.concatenate([np.asarray(f(part["v"])) for _, part in pdf.groupby("series_id")])


def test_even_centred_median_leans_back(spark, data):
    got = collected(rolling.smooth_centered(frame(spark, data), ["v"], P), "series_id", "ts")["v"]
    want = by_series(data, lambda s: s.rolling(4, center=True, min_periods=2).median())
    np.testing.assert_allclose(got, want)
    assert rolling.median_reach(4, center=True) == (2, 1)


def test_long_median_frames(spark, data):
    wide = P.with_(smooth_min=100)
    got = collected(rolling.smooth_centered(frame(spark, data), ["v"], wide), "series_id", "ts")["v"]
    want = by_series(data, lambda s: s.rolling(20, center=True, min_periods=10).median())
    np.testing.assert_allclose(got, want)


@pytest.mark.parametrize("compacted", [False, True])
def test_features(spark, data, compacted):
    rows = data[data.index % 7 != 3] if compacted else data
    got = collected(rolling.rolling_features(frame(spark, rows), ["v"], P, compacted=compacted), "series_id", "ts")
    parts = []
    for s, part in rows.groupby("series_id"):
        v = part["v"].reset_index(drop=True)
        out = pd.DataFrame({"series_id": s, "ts": part["ts"].to_numpy(), "v_diff1": v.diff(1)})
        for m, w in ((15, 3), (30, 6), (60, 12)):
            out[f"v_mean_{m}m"] = v.rolling(w, min_periods=w // 2).mean()
            out[f"v_std_{m}m"] = v.rolling(w, min_periods=w // 2).std()
        parts.append(out.dropna())
    want = pd.concat(parts).sort_values(["series_id", "ts"]).reset_index(drop=True)
    assert len(got) == len(want) > 50
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False, rtol=1e-8)


def test_features_can_stop_at_gaps(spark, data):
    rows = data[(data.index % 300 < 100) | (data.index % 300 > 150)]
    got = rolling.rolling_features(frame(spark, rows), ["v"], P, compacted=True, break_at_gaps=True)
    first_after = START + pd.Timedelta(minutes=5 * 151)
    assert got.filter(F.col("ts") == F.lit(first_after).cast("timestamp_ntz")).count() == 0
    assert got.count() > 0


def test_robust_z(spark, data):
    scored = rolling.mad_outliers(rolling.rolling_mad_z(frame(spark, data), "v", P), P)
    got = collected(scored, "series_id", "ts")

    def z(s):
        med = s.rolling(3, min_periods=1).median()
        mad = (s - med).abs().rolling(3, min_periods=1).median().replace(0, np.nan)
        return ((s - med) / mad).abs()

    want = by_series(data, z)
    np.testing.assert_allclose(got["z"].astype(float), want, rtol=1e-9)
    assert (got["mad_flag"].to_numpy() == (want > 6)).all()


def test_lags(spark, data):
    params = P.with_(lags_min=20, horizon_min=15)
    got = collected(rolling.lag_matrix(frame(spark, data), "v", params), "series_id", "ts")
    want = by_series(data, lambda s: pd.concat([s.shift(i) for i in range(5)] + [s.shift(-3)], axis=1).dropna())
    np.testing.assert_allclose(got[["y", "lag_1", "lag_2", "lag_3", "lag_4", "y_ahead"]].to_numpy(), want)


@pytest.mark.parametrize("keep_all, accuracy", [(20_000, 10_000), (200, 400)])
def test_quantiles_are_exact(spark, keep_all, accuracy):
    rng = np.random.default_rng(1)
    big = np.round(rng.lognormal(1, 2, 30_000), 1)
    big[rng.random(30_000) < 0.4] = 3.0  # one value holds much of the group
    pdf = pd.DataFrame(
        {"k": ["big"] * 30_000 + ["flat"] * 5000 + ["small"] * 7, "v": np.r_[big, np.full(5000, 2.5), rng.random(7)]}
    )
    pdf.loc[pdf.index % 17 == 0, "v"] = np.nan
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = group_quantiles(frame(spark, pdf), ["k"], "v", probs, keep_all=keep_all, accuracy=accuracy)
    for row in got.collect():
        want = pdf.loc[pdf["k"] == row["k"], "v"].quantile(probs).to_numpy()
        np.testing.assert_allclose(row["q"], want, rtol=1e-12)


def test_quantiles_refuse_parameters_that_could_miss(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    with pytest.raises(ValueError):
        group_quantiles(df, ["k"], "v", [0.5], keep_all=100, accuracy=10_000)
    with pytest.raises(ValueError):
        group_quantiles(df, ["k"], "v", [0.9, 0.5])


def test_describe_keeps_sensors_without_values(spark):
    pdf = pd.DataFrame({"series_id": 1, "ts": [START, START + pd.Timedelta("5min")], "v": [1.0, 2.0], "w": [np.nan] * 2})
    got = collected(profile.describe(frame(spark, pdf), ["v", "w"]), "sensor")
    assert list(got["count"]) == [2, 0] and got["p50"][0] == 1.5 and np.isnan(got["p50"][1])


def test_clip(spark, data):
    spiked = data.copy()
    spiked.loc[[10, 320], "v"] = [9999.0, -9999.0]
    got = collected(profile.mad_clip(frame(spark, spiked), ["v"], P), "series_id", "ts")["v"]

    def clip(s):
        med, mad = s.median(), (s - s.median()).abs().median()
        return s.clip(med - 5 * mad, med + 5 * mad)

    np.testing.assert_allclose(got, by_series(spiked, clip))
    assert got.max() < 9999 and got.min() > -9999
    flat = data.assign(v=4.0)
    flat.loc[3, "v"] = 100.0  # MAD is zero: nothing is clipped
    assert profile.mad_clip(frame(spark, flat), ["v"], P).agg(F.max("v")).first()[0] == 100.0


def test_correlations_are_pairwise(spark, data):
    pdf = data.assign(w=np.random.default_rng(2).normal(size=len(data)) + data["v"] / 50)
    pdf.loc[pdf.index % 5 == 0, "w"] = np.nan
    got = {(r["series_id"], r["sensor_a"], r["sensor_b"]): r["corr"] for r in profile.correlations(frame(spark, pdf), ["v", "w"]).collect()}
    for s, part in pdf.groupby("series_id"):
        assert got[s, "v", "w"] == pytest.approx(part["v"].corr(part["w"])) == got[s, "w", "v"]
        assert got[s, "v", "v"] == pytest.approx(1.0)


def test_lowest_decile(spark, data):
    got = collected(profile.lowest_decile(frame(spark, data), "v"), "series_id", "ts")["off"]
    assert (got.to_numpy() == by_series(data, lambda s: s <= s.quantile(0.1))).all()


def test_clipped_summary_equals_the_summary_of_clipped_rows(spark, data):
    pdf = data.assign(w=np.random.default_rng(3).standard_cauchy(len(data)), flat=4.0, none=np.nan)
    pdf.loc[5, "flat"] = 100.0
    rows, sensors = frame(spark, pdf), ["v", "w", "flat", "none"]
    want = collected(profile.describe(profile.mad_clip(rows, sensors, P), sensors), "series_id", "sensor")
    got = collected(profile.describe_clipped(rows, sensors, P), "series_id", "sensor")
    pd.testing.assert_frame_equal(got, want)
    assert (got["max"] < pdf["w"].max()).any()
    with pytest.raises(ValueError):
        profile.describe_clipped(rows, sensors, P, probs=[0.25])


@pytest.mark.parametrize("minutes", [15, 120])
def test_mad_of_short_and_long_frames(spark, data, minutes):
    params = P.with_(feature_windows_min=(minutes,), span=80)
    n = minutes // 5
    got = collected(rolling.rolling_mad_z(frame(spark, data), "v", params), "series_id", "ts")

    def mad(s):
        med = s.rolling(n, min_periods=max(1, n // 2)).median()
        return (s - med).abs().rolling(n, min_periods=max(1, n // 2)).median().replace(0.0, np.nan)

    np.testing.assert_allclose(got["med"], by_series(data, lambda s: s.rolling(n, min_periods=max(1, n // 2)).median()))
    np.testing.assert_allclose(got["mad"], by_series(data, mad))
    assert list(got.columns[:3]) == ["series_id", "ts", "v"]


def test_a_day_long_median_does_not_sort_every_frame(spark):
    v = values(3000, series=1, holes=0.1, seed=5)
    day = P.with_(smooth_min=1440, span=1000)
    rows = rolling.smooth_centered(frame(spark, v), ["v"], day)
    want = v["v"].rolling(288, center=True, min_periods=144).median()
    np.testing.assert_allclose(collected(rows, "ts")["v"], want)
    assert "FlatMapGroupsInPandas" in rows._jdf.queryExecution().executedPlan().toString()
