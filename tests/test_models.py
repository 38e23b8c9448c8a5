"""Models on series whose structure is known."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from series import START, collected, frame
from slotwise.functions import draws
from slotwise.operators import fitted, forecasts, forest, kmeans, states
from slotwise.params import Params
from slotwise.plans import anomalies, backtest
from slotwise.plans import states as state_plan
from slotwise.sources.staging import stage

P = Params(n_init=1, span=500)


def at(slot: int) -> pd.Timestamp:
    return START + pd.Timedelta(minutes=5 * slot)


def series(spark, *columns, series_id=1, names=("v",)):
    n = len(columns[0])
    pdf = pd.DataFrame({"series_id": series_id, "ts": [at(i) for i in range(n)], **dict(zip(names, columns))})
    return frame(spark, pdf)


@pytest.fixture(scope="module")
def regimes(spark):
    rng = np.random.default_rng(0)
    level = np.repeat([10.0, 50.0, 90.0, 10.0, 90.0, 50.0], 200)
    return series(spark, level + rng.normal(0, 1, 1200), level * 2 + rng.normal(0, 1, 1200), names=("a", "b")).cache()


@pytest.fixture(scope="module")
def found(regimes):
    return state_plan.operating_states(regimes, ["a", "b"], P.with_(kmin=3, kmax=3))


@pytest.fixture(scope="module")
def placed(regimes):
    return stage(kmeans.to_points(states.standardize(regimes, ["a", "b"]), ["a", "b"], ["series_id", "ts"]))


def test_standardized_columns(spark, regimes):
    got = states.standardize(regimes.withColumn("flat", F.lit(3.0)), ["a", "flat"]).agg(
        F.avg("a"), F.stddev_pop("a"), F.min("flat"), F.max("flat")
    ).first()
    np.testing.assert_allclose(list(got), [0, 1, 0, 0], atol=1e-9)


def test_three_regimes_give_three_states(placed):
    sweep = kmeans.kmeans_sweep(placed, P.with_(n_init=2))
    assert sweep.k == 3 and [row[0] for row in sweep.curve] == [2, 3, 4, 5]
    inertia = [row[1] for row in sweep.curve]
    assert inertia == sorted(inertia, reverse=True)


def test_labels_follow_the_regimes(found, regimes):
    labels = collected(state_plan.full_timeline(regimes, found), "ts")
    assert len(labels) == 1200 and labels["cluster"].isna().sum() <= 12
    for block in range(6):
        assert labels["cluster"].iloc[block * 200 + 20 : block * 200 + 190].nunique() == 1
    names = {r["state_name"] for r in found.labels.select("state_name").distinct().collect()}
    assert names == {"State_0", "State_1", "State_2"}


def test_state_summary_equals_pandas(found, regimes):
    joined = regimes.join(found.labels, ["series_id", "ts"]).toPandas()
    want = joined.groupby("cluster")["a"].agg(["mean", "std", "median", "min", "max"])
    got = collected(found.summary.filter("sensor = 'a'"), "cluster").set_index("cluster")
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False, check_index_type=False)


def test_scatter_axes(found):
    got = state_plan.scatter(found, P).toPandas()
    assert {"pc1", "pc2", "cluster"} <= set(got.columns)
    assert len(got) == found.labels.count()
    assert got["pc1"].var() > got["pc2"].var()
    assert abs(got["pc1"].mean()) < 1e-6


def test_sweep_does_not_depend_on_input_partitions(regimes, placed):
    other = states.standardize(regimes.repartition(7), ["a", "b"])
    again = stage(kmeans.to_points(other.coalesce(1), ["a", "b"], ["series_id", "ts"]))
    one, two = (kmeans.kmeans_sweep(v, P.with_(kmin=3, kmax=3)) for v in (placed, again))
    assert one.curve[0][1] == pytest.approx(two.curve[0][1], rel=1e-9)
    a, b = (collected(sweep.label(v), "ts")["cluster"] for sweep, v in ((one, placed), (two, again)))
    assert (a == b).all()


def test_shutdown_slots_get_no_label(spark, regimes):
    down = frame(spark, pd.DataFrame([(1, at(100), at(140))], columns=["series_id", "start", "end"]))
    got = state_plan.operating_states(regimes, ["a"], P.with_(kmax=3), shutdowns=down)
    line = collected(state_plan.full_timeline(regimes, got), "ts")["cluster"]
    assert line.iloc[100:141].isna().all() and line.iloc[150:].notna().all()


def test_nearest_centroid_and_names(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 9.0, 9.0), (3, 5.0, 5.0)], "id int, x double, y double")
    got = states.nearest_centroid(df, ["x", "y"], {0: [0, 0], 4: [10, 10]}).orderBy("id")
    assert [r["cluster"] for r in got.collect()] == [0, 4, 0]
    named = states.state_names(spark.createDataFrame([(0,), (9,)], "cluster int"))
    assert [r["state_name"] for r in named.orderBy("cluster").collect()] == ["State_0", "State"]
    with pytest.raises(ValueError):
        states.nearest_centroid(df, ["x", "y"], {0: [0, 0]}, limit=1)


def test_small_states_are_left_out(spark):
    rows = [(1, at(i).to_pydatetime(), 0 if i < 199 else 1) for i in range(399)]
    labels = spark.createDataFrame(rows, "series_id int, ts timestamp_ntz, cluster int")
    got = states.large_states(labels, P)
    assert {r["cluster"] for r in got.select("cluster").distinct().collect()} == {1}


# --- isolation forest


@pytest.fixture(scope="module")
def spiked(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (1500, 3))
    x[[100, 700, 1200]] += 15
    pdf = pd.DataFrame(x, columns=["f0", "f1", "f2"]).assign(series_id=1, ts=[at(i) for i in range(1500)])
    other = pd.DataFrame(rng.normal(5, 2, (150, 3)), columns=["f0", "f1", "f2"]).assign(series_id=2, ts=[at(i) for i in range(150)])
    return frame(spark, pd.concat([pdf, other], ignore_index=True)).cache()


def test_spikes_rank_first(spiked):
    got = forest.isolation_scores(spiked, ["series_id"], "ts", ["f0", "f1", "f2"], P).toPandas()
    assert set(got["series_id"]) == {1}  # the other series has too few rows
    assert len(got) == 1500 and 14 <= got["is_outlier"].sum() <= 15
    top = got.nlargest(3, "score")["ts"]
    assert sorted(top) == [at(100), at(700), at(1200)]


def test_forest_does_not_depend_on_partitions(spiked, monkeypatch):
    monkeypatch.setattr(forest, "PART_ROWS", 100)
    one = forest.isolation_scores(spiked.repartition(7), ["series_id"], "ts", ["f0", "f1", "f2"], P)
    monkeypatch.setattr(forest, "PART_ROWS", 65_536)
    two = forest.isolation_scores(spiked.coalesce(1), ["series_id"], "ts", ["f0", "f1", "f2"], P)
    a, b = (collected(x, "ts")["score"].to_numpy() for x in (one, two))
    np.testing.assert_allclose(a, b, rtol=1e-12)


def test_forest_pieces():
    assert float(forest.mean_path(2)) == 1.0 and float(forest.mean_path(1)) == 0.0
    assert float(forest.mean_path(256)) == pytest.approx(10.2448, abs=1e-3)
    x = np.zeros((300, 2))  # nothing to split: every row ends in the root
    trees = [forest.grow_tree(x[:256], 256, np.random.default_rng(t)) for t in range(5)]
    np.testing.assert_allclose(forest.forest_scores(x, *(np.stack(c) for c in zip(*trees)), 256), 0.5)


def test_every_tree_draws_from_all_rows(spark):
    n = {1: 5000, 2: 30}
    rows = spark.createDataFrame([(g, i, float(i), c) for g, c in n.items() for i in range(c)], "g int, id int, v double, _n long")
    drawn = forest.draw_rows(rows.repartition(6), ["g"], "id", ["v"], 20, 64, 3).toPandas()
    keys = rows.select("g", "id", F.xxhash64("g", "id").alias("h")).toPandas()
    tops = {}
    for g, own in keys.groupby("g"):
        for t in range(20):
            u = draws.uniform(own["h"].to_numpy(), 3, t)
            want = set(own["id"].to_numpy()[np.argsort(u)[:64]])
            got = drawn[(drawn["g"] == g) & (drawn["_tree"] == t)].sort_values("_u")["id"].head(64)
            assert set(got) == want and len(want) == min(64, n[g])
            tops[g, t] = want
    # Trees share no pool: together they use about as many rows as independent draws would.
    assert len(set().union(*(tops[1, t] for t in range(20)))) > 1000


def test_contextual_periods(spark):
    rng = np.random.default_rng(8)
    a, b = 20 + rng.normal(0, 1, 900), 40 + rng.normal(0, 1, 900)
    a[500:503] += 60
    rows = series(spark, a, b, names=("a", "b")).cache()
    labels = rows.select("series_id", "ts", (F.minute("ts") * 0).cast("int").alias("cluster"))
    got = collected(anomalies.contextual_anomalies(rows, labels, ["a", "b"], "a", P), "start")
    hit = got[(got["start"] <= at(502)) & (got["end"] >= at(500))]
    assert len(hit) and set(hit["state"]) == {0} and set(hit["method"]) <= {"Both", "IForest"}
    assert (hit["score"] > 0).any()
    assert set(got["method"]) <= {"Both", "IForest", "MAD"}


def test_period_attributes_ties_and_missing_states(spark):
    pdf = pd.DataFrame(
        {
            "series_id": 1, "ts": [at(i) for i in range(8)], "state": [2, 1, 1, 2, np.nan, np.nan, 5, np.nan],
            "mad_flag": [True, True, True, True, False, True, False, False],
            "forest_flag": [False, True, False, False, False, False, False, True],
            "score": [0.1, np.nan, 0.3, np.nan, 9.0, np.nan, 9.0, 0.5],
        }
    )
    flags = frame(spark, pdf).withColumn("state", F.col("state").cast("int"))
    flags = flags.withColumn("anomalous", F.col("mad_flag") | F.col("forest_flag"))
    got = collected(anomalies.anomaly_periods(flags, P), "start")
    assert list(got["state"]) == [1, -1, -1]
    assert list(got["method"]) == ["Both", "MAD", "IForest"]
    assert got["score"][0] == pytest.approx(0.2) and np.isnan(got["score"][1])


# --- forecasts


def daily_wave(n, noise=0.1, seed=0):
    t = np.arange(n)
    return 50 + 10 * np.sin(2 * np.pi * t / 288) + np.random.default_rng(seed).normal(0, noise, n)


def test_origins_and_window_models(spark):
    y = daily_wave(288 * 4)
    y[600:605] = np.nan
    got = collected(forecasts.window_forecasts(series(spark, y), "v", P), "model", "ts")
    assert set(got["model"]) == {"naive", "seasonal_naive", "ar1"}
    naive = got[got["model"] == "naive"]
    origins = [(o - START).total_seconds() / 300 for o in naive["origin"]]
    assert origins == list(range(288, 288 * 4 - 12, 12))
    filled = pd.Series(y).ffill().to_numpy()
    slots = np.array(origins, int)
    np.testing.assert_allclose(naive["y_pred"], filled[slots])
    np.testing.assert_allclose(naive["y_true"].astype(float), y[slots + 12])
    seasonal = got[got["model"] == "seasonal_naive"]
    np.testing.assert_allclose(seasonal["y_pred"].astype(float), y[slots + 12 - 288])


def test_late_start_of_testing(spark):
    got = forecasts.window_forecasts(series(spark, daily_wave(288 * 6)), "v", P, test_from_days=2)
    assert got.agg(F.min("origin")).first()[0] == dt.datetime(2024, 3, 4)


def test_no_seasonality(spark):
    noise = np.random.default_rng(3).normal(0, 1, 288 * 3)
    rows = forecasts.target_slots(series(spark, noise), "v", P)
    assert not forecasts.seasonality(rows, P).first()["is_seasonal"]
    short = forecasts.target_slots(series(spark, noise[:200]), "v", P)
    assert not forecasts.seasonality(short, P).first()["is_seasonal"]
    models = forecasts.window_forecasts(series(spark, noise), "v", P)
    off = models.filter("model = 'seasonal_naive_disabled'")
    assert off.count() > 0 and off.filter("y_pred is not null").count() == 0


def ar1(n, slope=0.8, const=20.0, seed=1):
    rng = np.random.default_rng(seed)
    y = np.empty(n)
    y[0] = const / (1 - slope)
    for t in range(1, n):
        y[t] = const + slope * y[t - 1] + rng.normal()
    return y


def test_running_regression_recovers_the_slope(spark):
    y = ar1(4000) + 900
    rows = forecasts.autoregression(forecasts.target_slots(series(spark, y), "v", P), P)
    last = rows.orderBy(F.desc("ts")).first()
    slope, intercept = np.polyfit(y[:-1], y[1:], 1)
    assert last["slope"] == pytest.approx(slope, rel=1e-8) and last["intercept"] == pytest.approx(intercept, rel=1e-6)
    step = y[-1]
    for _ in range(12):
        step = intercept + slope * step
    assert last["ar1"] == pytest.approx(step, rel=1e-6)


def test_metrics_best_and_tail(spark):
    rows = [(1, at(0), at(i), m, 10.0, 10.0 + e) for i in range(4) for m, e in (("a", 1.0), ("b", 2.0), ("c", -1.0))]
    rows.append((1, at(0), at(9), "a", None, 1.0))
    pdf = pd.DataFrame(rows, columns=["series_id", "origin", "ts", "model", "y_true", "y_pred"])
    table = frame(spark, pdf)
    metrics = collected(forecasts.backtest_metrics(table), "model")
    assert list(metrics["mae"]) == [1.0, 2.0, 1.0] and list(metrics["n"]) == [4, 4, 4]
    assert forecasts.best_model(forecasts.backtest_metrics(table)).first()["model"] == "a"
    assert forecasts.best_forecast_tail(table, P.with_(season_min=10), days=1).count() == 2


HOURLY = P.with_(step_min=60, horizon_min=60, lags_min=180, gbt_trees=5, gbt_refit_days=5)


def hourly(spark, y):
    pdf = pd.DataFrame({"series_id": 1, "ts": [START + pd.Timedelta(hours=i) for i in range(len(y))], "v": y})
    return frame(spark, pdf)


def test_boosted_trees_never_see_the_future(spark):
    """Changing the values after a cutoff leaves the forecasts made before it alone."""
    y = daily_wave(600, noise=1.0)
    changed = y.copy()
    changed[460:] += 1000
    a, b = (
        collected(fitted.boosted_tree_forecasts(hourly(spark, v), "v", HOURLY), "origin") for v in (y, changed)
    )
    before = a["origin"] < START + pd.Timedelta(hours=460)
    assert before.sum() > 50
    np.testing.assert_allclose(a.loc[before, "y_pred"], b.loc[before, "y_pred"])


def test_boosted_trees_need_training_rows(spark):
    assert fitted.boosted_tree_forecasts(hourly(spark, daily_wave(150)), "v", HOURLY) is None


def test_whole_backtest(spark):
    got = backtest.backtest(hourly(spark, daily_wave(600, noise=1.0)), "v", HOURLY)
    models = {r["model"] for r in got.metrics.collect()}
    assert {"naive", "ar1", "arima", "gbr_lags"} <= models
    assert got.best.count() == 1 and got.tail.select("model").distinct().count() == 1
