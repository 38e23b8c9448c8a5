"""Leaves refitted by prefix sums: MLlib's own values where the trees grew, a plain refit elsewhere."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor

from series import START, frame
from slotwise.operators import fitted, forecasts
from slotwise.params import Params

HOURLY = Params(step_min=60, horizon_min=60, lags_min=180, gbt_trees=8, gbt_refit_days=2, min_train_rows=100, span=500)


def test_trees_grow_again_when_rows_doubled():
    assert fitted.epochs_of([10, 5, 5, 5, 40, 1]) == [(0, 1), (2, 3), (4, 5)]
    assert fitted.epochs_of([7]) == [(0, 0)]
    grown = [sum([100] * (s + 1)) for s, _ in fitted.epochs_of([100] * 90)]
    assert sum(grown) < 2 * 9000


def plain(leaf, label, weights, width):
    value, left = np.zeros((len(weights), width)), label.copy()
    for m, w in enumerate(weights):
        for c in range(width):
            own = leaf[:, m] == c
            if own.any():
                value[m, c] = w * left[own].mean() * (2 if m else 1)
        left = left - value[m][leaf[:, m]]
    return value.ravel()


def test_every_prefix_equals_a_plain_refit(spark):
    rng = np.random.default_rng(1)
    n, weights, width = 3000, [1.0, 0.1, 0.1, 0.1], 4
    leaf, fold, label = rng.integers(0, width, (n, 4)), rng.integers(0, 7, n), rng.normal(size=n)
    fold[fold == 4] = 3  # a fold without rows
    label += leaf[:, 1] - 2 * (leaf[:, 2] == 3)
    rows = spark.createDataFrame(
        [(1, START + dt.timedelta(minutes=i), int(f), Vectors.dense(x.astype(float)), float(y)) for i, (f, x, y) in enumerate(zip(fold, leaf, label))],
        ["series_id", "ts", "fold", "_leaf", "label"],
    )
    got = {r.fold: r.leaves for r in fitted.leaf_values(rows, 2, 6, n, weights, width).collect()}
    assert sorted(got) == [2, 3, 4, 5, 6]
    for f, values in got.items():
        np.testing.assert_allclose(values, plain(leaf[fold <= f], label[fold <= f], weights, width), atol=1e-9)
    assert got[3] == got[4]


def test_the_growing_fold_has_the_values_of_mllib(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 3))
    y = np.sin(x[:, 0] * 2) + x[:, 1] * (x[:, 2] > 0) + rng.normal(0, 0.1, 1500)
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 3, 1) + dt.timedelta(minutes=i), 0, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
        "series_id long, ts timestamp_ntz, fold int, a double, b double, c double, label double",
    )
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = GBTRegressor(maxIter=10, stepSize=0.1, maxDepth=3, seed=1).fit(df)
    model.setLeafCol("_leaf").setPredictionCol("_grown")
    rows = model.transform(df)
    leaves = fitted.leaf_values(rows, 0, 0, 1500, list(model.treeWeights), 8)
    got = fitted.predicted(rows, leaves, 8).select("_grown", "_scaled").toPandas()
    np.testing.assert_allclose(got["_scaled"], got["_grown"], atol=1e-9)


def test_a_series_that_begins_later_is_answered_from_its_first_fold(spark):
    rng = np.random.default_rng(3)
    old = 50 + np.cumsum(rng.normal(size=24 * 30)) * 0.3
    late = old * 10
    late[: 24 * 17] = np.nan
    pdf = pd.concat([
        pd.DataFrame({"series_id": i, "ts": [START + pd.Timedelta(hours=k) for k in range(len(y))], "v": y}) for i, y in enumerate((old, late))
    ])
    got = fitted.boosted_tree_forecasts(frame(spark, pdf), "v", HOURLY).toPandas()
    got = got[got["y_true"].notna()]
    first = got[got["series_id"] == 1]["origin"].min()
    assert START + pd.Timedelta(days=17) < first < START + pd.Timedelta(days=19, hours=12)
    error = (got["y_true"] - got["y_pred"]).abs().groupby(got["series_id"]).mean()
    assert error[0] < 2 and error[1] < 40


def test_too_many_leaves_are_refused(spark):
    with pytest.raises(ValueError):
        fitted.boosted_tree_forecasts(frame(spark, pd.DataFrame({"series_id": [1], "ts": [START], "v": [1.0]})), "v", HOURLY.with_(gbt_depth=12))


def test_metrics_per_fold_and_in_all(spark):
    rows = [(1, START + pd.Timedelta(days=d), START, "m", 1.0, 1.0 + d) for d in range(5)] + [(1, START, START, "m", None, 1.0)]
    table = frame(spark, pd.DataFrame(rows, columns=["series_id", "origin", "ts", "model", "y_true", "y_pred"]))
    got = {r.fold: (r.mae, r.n) for r in forecasts.fold_metrics(table, HOURLY).collect()}
    assert got == {0: (0.5, 2), 1: (2.5, 2), 2: (4.0, 1), None: (2.0, 5)}
