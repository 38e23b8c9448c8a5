from types import SimpleNamespace

import pandas as pd
import pytest

from series import START, collected, frame
from slotwise.operators import grid, periods
from slotwise.params import Params
from slotwise.sources import staging, telemetry
from slotwise.streaming import resample

P = Params()


def test_dirty_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        " DateTime , temp ,draft\n"
        "2024-03-01 00:00:00,1.5,-200\n"
        "not a time,2.5,1\n"
        "2024-03-01 00:05:00,Bad Input,NaN\n"
        "2024-03-01 00:05:00, 4 ,\n"
        "01/03/2024 00:10,1e2,7\n"
    )
    df = telemetry.read_telemetry(spark, str(path), formats=["dd/MM/yyyy HH:mm"])
    assert dict(df.dtypes) == {"series_id": "string", "ts": "timestamp_ntz", "temp": "double", "draft": "double"}
    got = collected(df, "ts", "temp")
    assert [None if pd.isna(v) else v for v in got["temp"]] == [1.5, 4.0, None, 100.0]
    assert [None if pd.isna(v) else v for v in got["draft"]] == [-200.0, None, None, 7.0]
    slots = collected(grid.resample_mean(df, ["temp", "draft"], P), "ts")
    assert list(slots["temp"]) == [1.5, 4.0, 100.0]


def test_timestamp_column_choice():
    assert telemetry.timestamp_column(["a", "date", "time"]) == "time"
    assert telemetry.timestamp_column(["a", "TIME"]) == "a"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_round_trips(spark, tmp_path, fmt):
    rows = [("a", START, START + pd.Timedelta("30min"), 30.0)]
    found = frame(spark, pd.DataFrame(rows, columns=["series_id", "start", "end", "duration_min"]))
    telemetry.write_table(found, str(tmp_path / "p"), fmt=fmt)
    assert telemetry.read_periods(spark, str(tmp_path / "p"), fmt=fmt).collect() == found.collect()
    labels = frame(spark, pd.DataFrame([("a", START, 3)], columns=["series_id", "ts", "cluster"]))
    labels = labels.withColumn("cluster", labels["cluster"].cast("int"))
    telemetry.write_table(labels, str(tmp_path / "l"), fmt=fmt)
    again = telemetry.read_labels(spark, str(tmp_path / "l"), fmt=fmt)
    assert again.collect() == labels.collect() and dict(again.dtypes)["cluster"] == "int"


def test_partitioned_write(spark, tmp_path):
    df = frame(spark, pd.DataFrame({"series_id": [1, 2], "ts": [START, START], "v": [1.0, 2.0]}))
    telemetry.write_table(df, str(tmp_path / "t"), partition_by=["series_id"])
    assert {p.name for p in (tmp_path / "t").glob("series_id=*")} == {"series_id=1", "series_id=2"}


def test_a_rerun_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")

    def table(days, value):
        pdf = pd.DataFrame([
            (s, START + pd.Timedelta(days=d, minutes=5 * i), value + i) for d in days for s in range(3) for i in range(200)
        ], columns=["series_id", "ts", "v"])
        return frame(spark, pdf).repartition(7)

    telemetry.write_days(table([0, 1, 2], 1.0), path, rows_per_file=100)
    kept = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "days" / f"day={START.date()}").glob("*.parquet")}
    telemetry.write_days(table([1], 100.0), path, rows_per_file=100)
    telemetry.write_days(table([1], 100.0), path, rows_per_file=100)
    got = telemetry.read_days(spark, path)
    assert got.columns == ["series_id", "ts", "v"]
    want = table([0, 2], 1.0).unionByName(table([1], 100.0))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert kept == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "days" / f"day={START.date()}").glob("*.parquet")}
    one = telemetry.read_days(spark, path, str(START.date() + pd.Timedelta(days=1)), str(START.date() + pd.Timedelta(days=1)))
    assert one.count() == 600 and one.agg({"v": "min"}).first()[0] == 100.0
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    # Files are clustered: of a day's series, each file holds a run.
    for f in (tmp_path / "days").glob("day=*/*.parquet"):
        rows = [tuple(r) for r in spark.read.parquet(str(f)).select("series_id", "ts").collect()]
        assert rows == sorted(rows) and len(rows) <= 100


def test_parquet_source_and_labels_join(spark, tmp_path):
    raw = frame(spark, pd.DataFrame({"machine": ["x", "y", None], "time": [START] * 3, "v": ["1", "?", "3"]}))
    raw.write.parquet(str(tmp_path / "raw.parquet"))
    df = telemetry.read_telemetry(spark, str(tmp_path / "raw.parquet"), series="machine")
    assert [(r["series_id"], r["v"]) for r in df.orderBy("series_id").collect()] == [("x", 1.0), ("y", None)]
    labels = df.filter("v is not null").selectExpr("series_id", "ts", "7 as cluster")
    assert [r["cluster"] for r in periods.labels_on_grid(df, labels).orderBy("series_id").collect()] == [7, None]


def test_staging_uses_the_shared_folder(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert staging.shared_folder(spark) == folder
    df = staging.stage(spark.range(5).withColumnRenamed("id", "x"))
    assert folder in df.inputFiles()[0] and df.count() == 5
    assert staging.stage_in_place(spark.range(5).repartition(3, "id")).rdd.getNumPartitions() == 3


def test_stream_equals_batch_on_closed_slots_and_drops_late_rows(spark, tmp_path):
    def batch(name, minutes):
        pdf = pd.DataFrame({"series_id": 1, "ts": [START + pd.Timedelta(minutes=m) for m in minutes], "v": [float(m) for m in minutes]})
        frame(spark, pdf).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        schema = "series_id bigint, ts timestamp_ntz, v double"
        rows = resample.read_stream(spark, str(tmp_path / "in"), schema)
        out = resample.stream_resample(rows, ["v"], P, lateness="10 minutes")
        query = resample.write_stream(out, str(tmp_path / "out"), str(tmp_path / "progress"))
        query.awaitTermination()
        return collected(spark.read.parquet(str(tmp_path / "out")), "ts")

    batch("a", [0, 1, 7, 12, 40])
    first = run()
    assert [(t - START).total_seconds() / 60 for t in first["ts"]] == [0, 5, 10]
    assert list(first["v"]) == [0.5, 7.0, 12.0]
    batch("b", [2, 33, 60])  # minute 2 is behind the watermark, minute 33 is not
    second = run()
    assert [(t - START).total_seconds() / 60 for t in second["ts"]] == [0, 5, 10, 30, 40]
    assert second["v"][0] == 0.5 and second["v"][3] == 33.0


def test_cluster_without_a_shared_folder_is_refused():
    class Unset(dict):
        def get(self, key, default=None):
            return default

    context = SimpleNamespace(getConf=lambda: Unset(), master="spark://host")
    with pytest.raises(ValueError):
        staging.shared_folder(SimpleNamespace(sparkContext=context, conf=Unset()))
