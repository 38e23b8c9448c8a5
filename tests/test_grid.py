import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from series import START, collected, frame, values
from slotwise.operators import grid
from slotwise.params import Params

P = Params()


def at(minutes: float) -> pd.Timestamp:
    return START + pd.Timedelta(minutes=minutes)


def test_resample_is_left_closed_and_skips_nulls(spark):
    pdf = pd.DataFrame(
        {
            "series_id": "a",
            "ts": [at(0), at(4.99), at(5), at(5), at(12)],
            "v": [1.0, 3.0, 10.0, np.nan, 4.0],
        }
    )
    got = collected(grid.resample_mean(frame(spark, pdf), ["v"], P), "ts")
    assert list(got["ts"]) == [at(0), at(5), at(10)]
    assert list(got["v"]) == [2.0, 10.0, 4.0]


def test_dense_grid_has_every_slot_of_each_series(spark):
    pdf = pd.DataFrame({"series_id": [1, 1, 2], "ts": [at(1), at(21), at(7)], "v": [1.0, 2.0, np.nan]})
    got = collected(grid.dense_grid(frame(spark, pdf), ["v"], P), "series_id", "ts")
    assert list(got["ts"]) == [at(0), at(5), at(10), at(15), at(20), at(5)]
    assert got["v"].isna().tolist() == [False, True, True, True, False, True]


def test_slots_before_1970_and_across_days(spark):
    pdf = pd.DataFrame({"series_id": 1, "ts": pd.to_datetime(["1969-12-31 23:57", "1970-01-01 00:03"]), "v": [1.0, 2.0]})
    got = collected(grid.dense_grid(frame(spark, pdf), ["v"], P), "ts")
    assert [str(t) for t in got["ts"]] == ["1969-12-31 23:55:00", "1970-01-01 00:00:00"]


def test_session_time_zone_does_not_matter(spark):
    pdf = pd.DataFrame({"series_id": 1, "ts": pd.to_datetime(["2024-03-31 01:58", "2024-03-31 03:03"]), "v": [1.0, 2.0]})
    df = frame(spark, pdf)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = grid.dense_grid(df, ["v"], P).orderBy("ts").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(rows) == 14 and rows[1]["ts"] == dt.datetime(2024, 3, 31, 2, 0)


@pytest.mark.parametrize("gap, core", [(12, 0), (13, 0), (24, 0), (25, 1), (40, 16)])
def test_gap_is_filled_from_both_sides(spark, gap, core):
    v = np.r_[0.0, np.full(gap, np.nan), gap + 1.0]
    pdf = pd.DataFrame({"series_id": 1, "ts": [at(5 * i) for i in range(gap + 2)], "v": v})
    got = collected(grid.interpolate(frame(spark, pdf), ["v"], P), "ts")["v"].to_numpy()
    assert np.isnan(got).sum() == core
    kept = ~np.isnan(got)
    np.testing.assert_allclose(got[kept], np.arange(gap + 2)[kept])
    short = collected(grid.interpolate(frame(spark, pdf), ["v"], P, fill="short_only"), "ts")["v"]
    assert short.isna().sum() == (0 if gap <= 12 else gap)


def test_edges_take_the_one_neighbour(spark):
    v = np.r_[np.full(15, np.nan), 7.0, np.full(13, np.nan)]
    pdf = pd.DataFrame({"series_id": 1, "ts": [at(5 * i) for i in range(len(v))], "v": v})
    got = collected(grid.interpolate(frame(spark, pdf), ["v"], P), "ts")["v"].to_numpy()
    want = np.r_[np.full(3, np.nan), np.full(25, 7.0), np.nan]
    np.testing.assert_array_equal(got, want)


@pytest.mark.parametrize("holes", [0.3, 0.9, 0.97])
def test_equals_pandas(spark, holes):
    pdf = values(400, series=3, holes=holes, seed=int(holes * 100))
    got = collected(grid.interpolate(frame(spark, pdf), ["v"], Params(span=64)), "series_id", "ts")
    want = np.concatenate(
        [
            part.set_index("ts")["v"].interpolate(method="time", limit=12, limit_direction="both").to_numpy()
            for _, part in pdf.groupby("series_id")
        ]
    )
    np.testing.assert_allclose(got["v"].to_numpy(), want, rtol=1e-12)


def test_all_null_sensor_and_empty_input(spark):
    pdf = pd.DataFrame({"series_id": 1, "ts": [at(0), at(15)], "v": [1.0, 2.0], "w": [np.nan, np.nan]})
    got = grid.regular_grid(frame(spark, pdf), ["v", "w"], P)
    assert got.filter(F.col("w").isNotNull()).count() == 0 and got.count() == 4
    assert grid.regular_grid(frame(spark, pdf).limit(0), ["v", "w"], P).count() == 0


def test_views(spark):
    pdf = values(3000, series=2, holes=0.0)
    df = frame(spark, pdf)
    assert grid.range_view(df, 7, P).groupBy("series_id").count().filter("count = 2016").count() == 2
    tail = grid.range_view(df, 1, P, anchor="tail").agg(F.min("ts"), F.max("ts")).first()
    assert tail[0] == at(5 * (3000 - 288)) and tail[1] == at(5 * 2999)
    last = grid.tail_rows(df, ["series_id"], "ts", 3)
    assert sorted({r["ts"] for r in last.collect()}) == [at(5 * i) for i in (2997, 2998, 2999)]


def test_sensor_choice(spark):
    df = spark.createDataFrame([], "series_id int, ts timestamp_ntz, a double, b double")
    assert grid.sensor_columns(df, ["b", "x"]) == ["b"]
    assert grid.sensor_columns(df, ["x"], "a") == ["a"]
    assert grid.sensor_columns(df, [], "x") == ["a", "b"]


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        Params(step_min=7)
    assert Params(step_min=60).slots(15) == 1 and Params().horizon == 12 and Params().n_lags == 36
