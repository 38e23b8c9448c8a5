"""Cases that once went wrong."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from series import START, collected, frame, values
from slotwise.functions.timeslots import fixed
from slotwise.operators import arima, fitted, forecasts, grid, periods, profile
from slotwise.params import Params
from slotwise.sources import staging, telemetry
from slotwise.streaming import gaps as stream_gaps
from slotwise.streaming import resample

P = Params()


def slots(n, step=5):
    return START + pd.to_timedelta(np.arange(n) * step, unit="min")


def test_a_stuck_sensor_correlates_with_nothing(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"series_id": 0, "ts": slots(50), "a": rng.normal(size=50), "stuck": 2.5})
    pdf["b"] = pdf["a"] * 2 + rng.normal(size=50)
    pdf.loc[3:9, "b"] = np.nan
    found = {(r.sensor_a, r.sensor_b): r["corr"] for r in profile.correlations(frame(spark, pdf), ["a", "b", "stuck"]).collect()}
    want = pdf[["a", "b"]].corr()
    assert found["a", "b"] == found["b", "a"] == pytest.approx(want.loc["a", "b"])
    assert found["a", "stuck"] is None and found["stuck", "stuck"] is None


@pytest.mark.parametrize("made,read", [(8, 131_072), (131_072, 8), (5, 7)])
def test_periods_of_a_grid_cut_with_another_span(spark, made, read):
    pdf = pd.DataFrame({"series_id": 0, "ts": slots(60), "v": 1.0})
    rows = grid.regular_grid(frame(spark, pdf), ["v"], P.with_(span=max(made, 13)))
    rows = rows.withColumn("chunk", F.expr(f"cast(floor((unix_seconds(cast(ts as timestamp)) / 300) / {made}D) as bigint)"))
    mask = rows.withColumn("off", F.col("v") > 0)
    found = periods.mask_to_periods(mask, "off", P.with_(span=max(read, 2))).collect()
    assert [(r.start, r.end) for r in found] == [(pdf["ts"][0], pdf["ts"][59])]


def test_stamps_and_numbers_of_real_exports(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "timestamp,v\n2024-01-02 10:00,1\n01/02/2024 10:00,2\nMar 3 2024,3\n2024,4\n\"March 3, 2024 4:05 PM\",5\nnever,6\n"
        "2024-01-05,1.0d\n2024-01-05,2f\n2024-01-05, 1e3\n2024-01-05,-.5\n2024-01-05,0x1F\n"
    )
    df = telemetry.read_telemetry(spark, str(path))
    got = [(str(r.ts), r.v) for r in df.collect()]
    assert got == [
        ("2024-01-02 10:00:00", 1.0), ("2024-01-02 10:00:00", 2.0), ("2024-03-03 00:00:00", 3.0), ("2024-01-01 00:00:00", 4.0),
        ("2024-03-03 16:05:00", 5.0), *[("2024-01-05 00:00:00", v) for v in (None, None, 1000.0, -0.5, None)],
    ]
    other = telemetry.read_telemetry(spark, str(path), day_first=True)
    assert str(other.filter("v = 2").first().ts) == "2024-02-01 10:00:00"
    raw = spark.read.csv(str(path), header=True)
    assert tuple(telemetry.unreadable_rows(raw).first()) == (11, 1)


def test_labels_written_as_decimals(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("series_id,ts,cluster\na,2024-03-01 00:00:00,2.0\na,2024-03-01 00:05:00,\n")
    assert [r.cluster for r in telemetry.read_labels(spark, str(path), fmt="csv").collect()] == [2, None]
    spark.createDataFrame([("a", 1.0, "x")], "series_id string, cluster double, ts string").write.parquet(str(tmp_path / "l"))
    again = telemetry.read_labels(spark, str(tmp_path / "l"))
    assert dict(again.dtypes) == {"series_id": "string", "ts": "timestamp_ntz", "cluster": "int"} and again.first().cluster == 1


def test_rounding_beyond_whole_numbers_of_64_bits(spark):
    rows = spark.createDataFrame([(1e13,), (-1e300,), (float("nan"),), (1.23456789,)], "x double")
    assert [r[0] for r in rows.select(fixed("x")).collect()] == [1e13, -1e300, None, 1.234568]


def test_arima_counts_missing_slots(spark):
    n = 6 * 288
    y = np.arange(n, dtype=float)
    origin = 5 * 288 + 24
    y[origin - 6 : origin + 1] = np.nan
    pdf = pd.DataFrame({"series_id": 0, "ts": slots(n), "v": y})
    params = P.with_(arima_p=(1,), arima_d=(1,), arima_q=(0,))
    found = arima.arima_forecasts(frame(spark, pdf), "v", params).toPandas().set_index("origin")
    assert found.loc[pdf["ts"][origin], "y_pred"] == pytest.approx(origin + 12, abs=1e-6)


def test_trees_answer_every_origin_once_rows_exist(spark):
    hourly = P.with_(step_min=60, horizon_min=60, lags_min=180, gbt_trees=2, gbt_refit_days=5, min_train_rows=100)
    v = values(30 * 24, series=1, holes=0.0, step=60)
    found = fitted.boosted_tree_forecasts(frame(spark, v), "v", hourly).toPandas()
    lagged = fitted.lag_rows(frame(spark, v), "v", hourly)
    origins = forecasts.walk_forward_origins(lagged, hourly).toPandas()
    ready = v["ts"][3 + 99] + pd.Timedelta("1h")
    assert sorted(found["origin"]) == sorted(t for t in origins["ts"] if t >= ready)


def test_placement_ignores_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert staging.place(spark.range(100), ["id"], 45_000).rdd.getNumPartitions() == 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_streams_do_not_depend_on_the_zone(spark, tmp_path, zone):
    # The night of a change of clocks in New York.
    start = pd.Timestamp("2024-03-10")
    minutes = [0, 31, 150, 155, 210, 215, 1500, 1700, 4000]
    pdf = pd.DataFrame({"series_id": 1, "ts": [start + pd.Timedelta(minutes=m) for m in minutes], "v": [float(m) for m in minutes]})
    frame(spark, pdf).coalesce(1).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = resample.read_stream(spark, str(tmp_path / "in"), "series_id bigint, ts timestamp_ntz, v double")
        for step in (5, 1440):
            out = resample.stream_resample(rows, ["v"], P.with_(step_min=step), lateness="10 minutes")
            resample.write_stream(out, str(tmp_path / f"out{step}"), str(tmp_path / f"progress{step}")).awaitTermination()
        timed = resample.read_stream(stream_gaps.timer_session(spark), str(tmp_path / "in"), "series_id bigint, ts timestamp_ntz, v double")
        report = stream_gaps.stream_gap_report(timed, 15, lateness="10 minutes")
        resample.write_stream(report, str(tmp_path / "s"), str(tmp_path / "ps")).awaitTermination()
        got = {s: [(r.ts, r.v) for r in spark.read.parquet(str(tmp_path / f"out{s}")).orderBy("ts").collect()] for s in (5, 1440)}
        gaps = spark.read.parquet(str(tmp_path / "s")).orderBy("gap_start").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[5] == [(start + pd.Timedelta(minutes=m // 5 * 5), float(m)) for m in minutes[:-1]]
    assert got[1440] == [(start, np.mean(minutes[:6])), (start + pd.Timedelta("1d"), 1600.0)]
    batch = periods.ingest_gaps(frame(spark, pdf), 15).orderBy("gap_start").collect()
    assert [tuple(g) for g in gaps] == [tuple(b) for b in batch][:-1]
