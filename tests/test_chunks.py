"""Chunked windows equal plain ones, whatever the chunk length."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from series import collected, frame, runs, values
from slotwise.functions.chunks import Carry, attach, carry, over_chunks, positions
from slotwise.operators import grid, periods, rolling
from slotwise.params import Params

SMALL = Params(span=16)


@pytest.fixture(scope="module")
def rows(spark):
    pdf = values(150, series=3, seed=5)
    pdf["n"] = pdf.groupby("series_id").cumcount() - 40
    return frame(spark, pdf).cache()


@pytest.mark.parametrize("levels", [0, 1, 2])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_columns(rows, levels, exclusive):
    specs = {"a": Carry("last", "v"), "b": Carry("next", "v"), "c": Carry("sum", "v"), "d": Carry("max", "v")}
    got = collected(carry(rows, ["series_id"], "n", 7, specs, exclusive=exclusive, levels=levels), "series_id", "n")
    want = rows.toPandas().sort_values(["series_id", "n"])
    by = want.groupby("series_id")["v"]
    shift = 1 if exclusive else 0
    expected = {
        "a": by.transform(lambda s: s.ffill().shift(shift)),
        "b": by.transform(lambda s: s.bfill().shift(-shift)),
        "c": by.transform(lambda s: s.fillna(0).cumsum().where(s.notna().cumsum() > 0).shift(shift)),
        "d": by.transform(lambda s: s.cummax().ffill().shift(shift)),
    }
    for name, series in expected.items():
        np.testing.assert_allclose(got[name].astype(float), series.to_numpy(), rtol=1e-12, err_msg=name)


def test_negative_order_and_short_frames(rows):
    def build(r, w):
        return r.withColumn("back", F.lag("v", 5).over(w)).withColumn("ahead", F.lead("v", 3).over(w))

    got = collected(over_chunks(rows, ["series_id"], "n", 6, build, 5, 3), "series_id", "n")
    w = Window.partitionBy("series_id").orderBy("n")
    want = collected(build(rows, w), "series_id", "n")
    pd.testing.assert_frame_equal(got[want.columns], want)


def test_frame_longer_than_chunk_is_refused(rows):
    with pytest.raises(ValueError):
        over_chunks(rows, ["series_id"], "n", 4, lambda r, w: r, 5)


@pytest.mark.parametrize("levels", [1, 2])
def test_positions(rows, levels):
    some = rows.filter("pmod(n * 7, 5) > 1")
    got = collected(positions(some, ["series_id"], "n", 8, levels=levels), "series_id", "n")
    assert (got["pos"] == got.groupby("series_id").cumcount()).all()


def test_attach_keeps_rows_without_figures(spark, rows):
    figures = spark.createDataFrame([(0, 1.5)], "series_id bigint, f double")
    got = attach(rows, figures, ["series_id"], ["n"], salts=3)
    assert got.count() == rows.count()
    assert got.filter("f is not null").count() == 150


@pytest.mark.parametrize("span", [13, 16, 1000])
def test_features_and_median_do_not_depend_on_chunks(rows, span):
    wide, narrow = Params(span=10_000), Params(span=span)
    base = grid.interpolate(rows.select("series_id", "ts", "v"), ["v"], wide)
    assert_same(grid.interpolate(rows.select("series_id", "ts", "v"), ["v"], narrow), base)
    base = base.drop("chunk").cache()
    for f in (
        lambda p: rolling.rolling_features(base, ["v"], p),
        lambda p: rolling.rolling_features(base.filter("pmod(minute(ts), 25) > 0"), ["v"], p, compacted=True),
        lambda p: rolling.smooth_centered(base, ["v"], p),
        lambda p: rolling.rolling_mad_z(base, "v", p),
        lambda p: periods.mask_to_periods(base.withColumn("m", F.col("v") > 40), "m", p),
    ):
        assert_same(f(narrow), f(wide))


def assert_same(a, b):
    columns = [c for c in a.columns if c != "chunk"]
    left, right = (x.select(columns).toPandas().sort_values(columns).reset_index(drop=True) for x in (a, b))
    assert len(left)
    pd.testing.assert_frame_equal(left, right, rtol=1e-9)


@pytest.mark.parametrize("span", [3, 8, 1000])
def test_runs_across_chunks(spark, span):
    rng = np.random.default_rng(span)
    mask = rng.random(200) < 0.85
    mask[40:90] = True  # spans whole chunks
    ts = pd.Timestamp("2024-03-01") + pd.to_timedelta(np.arange(200) * 5, unit="min")
    df = frame(spark, pd.DataFrame({"series_id": 1, "ts": ts, "m": mask}))
    for attributes in ((), (F.count("*").alias("slots"),)):
        got = collected(periods.mask_to_periods(df, "m", Params(span=span), attributes=attributes), "start")
        want = [(ts[a], ts[b]) for a, b in runs(mask)]
        assert list(zip(got["start"], got["end"])) == want
        if attributes:
            assert list(got["slots"]) == [b - a + 1 for a, b in runs(mask)]
