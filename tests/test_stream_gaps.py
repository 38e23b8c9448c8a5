"""Gaps that the stream reports equal those of the batch report, whatever the order of arrival."""

import random

import pandas as pd

from series import START, frame
from slotwise.operators import periods
from slotwise.streaming import gaps, resample

SCHEMA = "series_id bigint, ts timestamp_ntz, v double"


def arrivals(spark, path, batches):
    """One file per arrival, in order."""
    for minutes in batches:
        pdf = pd.DataFrame({
            "series_id": [s for s, _ in minutes], "ts": [START + pd.Timedelta(minutes=m) for _, m in minutes], "v": 1.0
        })
        frame(spark, pdf).coalesce(1).write.mode("append").parquet(path)
        run(spark, path)


def run(spark, path):
    rows = resample.read_stream(gaps.timer_session(spark), path, SCHEMA)
    out = gaps.stream_gap_report(rows, 15, lateness="60 minutes")
    resample.write_stream(out, f"{path}-gaps", f"{path}-progress").awaitTermination()


def reported(spark, path):
    return sorted(map(tuple, spark.read.parquet(f"{path}-gaps").collect()), key=repr)


def batch(spark, path, mark):
    found = periods.ingest_gaps(spark.read.schema(SCHEMA).parquet(path), 15).select("series_id", "gap_start", "gap_end", "gap_min")
    return sorted((tuple(r) for r in found.collect() if r.gap_end < START + pd.Timedelta(minutes=mark)), key=repr)


def test_pieces():
    assert gaps.merged([(5, 6), (0, 1), (2, 3), (20, 20)], 2) == [(0, 6), (20, 20)]
    assert gaps.closed([(0, 6), (20, 21), (40, 40)], 20) == ([(6, 20)], [(20, 21), (40, 40)])
    assert gaps.closed([(0, 6)], 100) == ([], [(0, 6)])


def test_restarts_and_disorder_give_the_batch_report(spark, tmp_path):
    rng = random.Random(6)
    times = sorted((rng.choice([0, 0, 0, 1, 2]), rng.randint(0, 3000)) for _ in range(500))
    times = sorted(times, key=lambda r: r[1] + rng.uniform(-25, 25))
    path = str(tmp_path / "in")
    arrivals(spark, path, [times[:200], times[200:210], times[210:400], times[400:]])
    mark = max(m for _, m in times) - 60
    want = batch(spark, path, mark)
    assert reported(spark, path) == want and len(want) > 20
    run(spark, path)
    assert reported(spark, path) == want


def test_a_gap_comes_out_while_the_stream_goes_on(spark, tmp_path):
    path = str(tmp_path / "in")
    arrivals(spark, path, [[(1, 0), (1, 40)], [(1, 101)]])
    assert [(r[1], r[2]) for r in reported(spark, path)] == [(START, START + pd.Timedelta(minutes=40))]
    # A reading that is late, but not too late, divides the second gap before it is reported.
    arrivals(spark, path, [[(1, 70)], [(1, 300)]])
    ends = [(r[2] - START).total_seconds() / 60 for r in reported(spark, path)]
    assert sorted(ends) == [40, 70, 101]
