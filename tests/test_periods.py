import numpy as np
import pandas as pd
import pytest

from series import START, collected, frame
from slotwise.operators import periods
from slotwise.params import Params
from slotwise.plans import shutdowns

P = Params(span=16)


def at(minutes: float) -> pd.Timestamp:
    return START + pd.Timedelta(minutes=minutes)


def spans(spark, *pairs, series=1):
    return frame(spark, pd.DataFrame([(series, at(a), at(b)) for a, b in pairs], columns=["series_id", "start", "end"]))


def slots(spark, n=60, **columns):
    return frame(spark, pd.DataFrame({"series_id": 1, "ts": [at(5 * i) for i in range(n)], **columns}))


def test_single_slot_has_no_duration(spark):
    df = slots(spark, 5, m=[False, True, False, True, True])
    got = collected(periods.mask_to_periods(df, "m", P), "start")
    assert list(got["duration_min"]) == [0.0, 5.0]


def test_merge_touching_nested_and_equal_starts(spark):
    got = collected(
        periods.merge_periods(spans(spark, (0, 10), (10, 20), (21, 22), (21, 90), (30, 40), (91, 95), (0, 5))), "start"
    )
    assert list(zip(got["start"], got["end"])) == [(at(0), at(20)), (at(21), at(90)), (at(91), at(95))]
    assert list(got["duration_min"]) == [20.0, 69.0, 4.0]


def test_merged_periods_are_disjoint_and_cover_the_same_slots(spark):
    rng = np.random.default_rng(3)
    raw = [(a, a + d) for a, d in zip(rng.integers(0, 5000, 300), rng.integers(0, 60, 300))]
    got = collected(periods.merge_periods(spans(spark, *raw)), "start")
    assert (got["start"].iloc[1:].to_numpy() > got["end"].iloc[:-1].to_numpy()).all()
    covered = lambda ps: {m for a, b in ps for m in range(int(a), int(b) + 1)}
    minutes = [((s - START).total_seconds() / 60, (e - START).total_seconds() / 60) for s, e in zip(got["start"], got["end"])]
    assert covered(minutes) == covered(raw)


def test_merge_carries_attributes(spark):
    from pyspark.sql import functions as F

    got = periods.merge_periods(spans(spark, (0, 10), (5, 20), (30, 31)), attributes=[F.count("*").alias("parts")])
    assert [r["parts"] for r in got.orderBy("start").collect()] == [2, 1]


def test_slots_inside_unaligned_overlapping_periods(spark):
    raw = [(2.5, 11), (10, 10), (10, 26), (100, 130), (131, 134), (290, 1000)]
    got = collected(periods.mark_periods(slots(spark, 70), spans(spark, *raw), P), "ts")
    want = [any(a <= 5 * i <= b for a, b in raw) for i in range(70)]
    assert got["inside"].tolist() == want
    kept = periods.exclude_periods(slots(spark, 70), spans(spark, *raw), P)
    assert kept.count() == want.count(False)


def test_periods_of_other_series_do_not_count(spark):
    assert not collected(periods.mark_periods(slots(spark, 9), spans(spark, (0, 40), series=2), P), "ts")["inside"].any()


def test_mask_survives_a_round_trip(spark):
    mask = np.random.default_rng(4).random(200) < 0.6
    df = slots(spark, 200, m=mask)
    back = collected(periods.mark_periods(df, periods.mask_to_periods(df, "m", P), P), "ts")
    assert (back["inside"] == back["m"]).all()


def test_gaps_between_readings(spark):
    minutes = [0, 1, 14.9, 30, 46, 61, 61.1, 1000]
    df = frame(spark, pd.DataFrame({"series_id": 1, "ts": [at(m) for m in minutes]}))
    got = collected(periods.ingest_gaps(df, 15), "gap_start")
    assert list(zip(got["gap_start"], got["gap_end"])) == [(at(14.9), at(30)), (at(30), at(46)), (at(61.1), at(1000))]


def test_next_start_includes_the_same_instant(spark):
    events, targets = spans(spark, (0, 10), (3, 20), (50, 70)), spans(spark, (10, 12), (30, 31))
    got = collected(periods.next_start(events, targets), "start")
    assert list(got["lead_min"][:2]) == [0.0, 10.0] and pd.isna(got["lead_min"][2])


def test_shutdown_needs_seven_slots(spark):
    v = np.full(60, 100.0)
    # Three of the four smoothed rows must be low, so a block comes out one slot shorter.
    v[10:18] = 1.0
    v[30:37] = 1.0
    limits = {"v": 50.0, "absent": 1.0}
    got = collected(shutdowns.shutdown_periods(slots(spark, 60, v=v), limits, P), "start")
    assert list(zip(got["start"], got["end"], got["reason"])) == [(at(55), at(85), "below_thresholds")]


def test_shutdown_rules(spark):
    df = slots(spark, 40, a=np.where(np.arange(40) < 20, 1.0, 9.0), b=np.full(40, 1.0), c=np.full(40, 9.0))
    limits = {c: 5.0 for c in "abc"}
    assert shutdowns.shutdown_periods(df, limits, P).count() == 0
    most = collected(shutdowns.shutdown_periods(df, limits, P, combine="majority"), "start")
    assert len(most) == 1 and most["start"][0] == at(0)
    fallback = collected(shutdowns.shutdown_periods(df, {"x": 1.0}, P, target="a"), "start")
    assert fallback["reason"].tolist() == ["lowest_decile"]
    with pytest.raises(ValueError):
        shutdowns.shutdown_periods(df, {"x": 1.0}, P)


def test_pareto_shares_add_up(spark):
    raw = spans(spark, (0, 30), (100, 150), (200, 300), (400, 435))
    got = collected(periods.pareto(periods.with_duration(raw), (45, 60)), "running_share")
    assert got["running_share"].iloc[-1] == pytest.approx(1.0) and got["periods"].sum() == 4
