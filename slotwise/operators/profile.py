"""Robust clipping, distribution summaries, correlations and threshold fallbacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.chunks import attach
from slotwise.functions.quantiles import group_quantiles
from slotwise.functions.timeslots import slot_of
from slotwise.params import SERIES, TS, Params
from slotwise.sources.staging import stage

# The percentiles of the summary.
SUMMARY_PROBS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def long_form(df: DataFrame, sensors: Sequence[str], keys: Sequence[str] = (SERIES, TS)) -> DataFrame:
    """Wide sensors -> rows ``(keys, sensor, value)``, nulls kept."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in sensors])
    return wide.unpivot(list(keys), list(sensors), "sensor", "value")


def scan_profile(df: DataFrame, params: Params) -> DataFrame:
    """Rows, time range and grid length per series."""
    counts = df.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("readings"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts")
    )
    length = slot_of("last_ts", params.step) - slot_of("first_ts", params.step) + 1
    return counts.withColumn("grid_slots", length)


def clip_bounds(df: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    """``(series_id, sensor, low, high)`` = median -/+ k times the unscaled MAD; both null where
    the MAD is zero or undefined and nothing is to be clipped. The figures, one row per series and
    sensor, are staged, so that the rows are not read again for every use of them."""
    cells = long_form(df, sensors)
    medians = group_quantiles(cells, [SERIES, "sensor"], "value", [0.5], spread=[TS]).select(
        SERIES, "sensor", F.col("q")[0].alias("med")
    )
    return _bounds_around(stage(medians), cells, params)


def _bounds_around(medians: DataFrame, cells: DataFrame, params: Params) -> DataFrame:
    deviations = attach(cells.filter(F.col("value").isNotNull()), medians, [SERIES, "sensor"], [TS]).select(
        SERIES, TS, "sensor", F.abs(F.col("value") - F.col("med")).alias("dev")
    )
    mads = group_quantiles(deviations, [SERIES, "sensor"], "dev", [0.5], spread=[TS]).select(
        SERIES, "sensor", F.nullif(F.col("q")[0], F.lit(0.0)).alias("mad")
    )
    k = params.clip_k
    bounds = medians.join(mads, [SERIES, "sensor"], "left").select(
        SERIES, "sensor",
        (F.col("med") - k * F.col("mad")).alias("low"), (F.col("med") + k * F.col("mad")).alias("high"),
    )
    return stage(bounds)


def mad_clip(df: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    """Clip each sensor of each series to its bounds; nulls stay null."""
    return _clipped(df, sensors, clip_bounds(df, sensors, params))


def _clipped(df: DataFrame, sensors: Sequence[str], bounds: DataFrame) -> DataFrame:
    wide = bounds.groupBy(SERIES).agg(
        *[
            F.max(F.when(F.col("sensor") == c, F.col(b))).alias(f"_{b}_{c}")
            for c in sensors
            for b in ("low", "high")
        ]
    )
    rows = attach(df, wide, [SERIES], [TS])
    # least and greatest skip nulls: right for missing bounds, wrong for a missing value.
    clipped = {
        c: F.expr(f"case when `{c}` is not null then least(greatest(`{c}`, `_low_{c}`), `_high_{c}`) end")
        for c in sensors
    }
    return rows.withColumns(clipped).select(*df.columns)


def describe(
    df: DataFrame,
    sensors: Sequence[str],
    keys: Sequence[str] = (SERIES,),
    *,
    probs: Sequence[float] = SUMMARY_PROBS,
    spread: Sequence[str] = (TS,),
) -> DataFrame:
    """count, mean, std, min, percentiles, max per group and sensor, in long form."""
    v = F.col("value")
    groups = [*keys, "sensor"]
    found = group_quantiles(
        long_form(df, sensors, list(dict.fromkeys([*keys, *spread]))), groups, "value", probs, spread=spread,
        extra=[
            F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        ],
    )
    return found.select(
        *groups, F.col("n").alias("count"), "mean", "std", "min",
        *[F.col("q")[i].alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)],
        "max",
    )


def describe_clipped(
    df: DataFrame, sensors: Sequence[str], params: Params, *, probs: Sequence[float] = SUMMARY_PROBS
) -> DataFrame:
    """``describe(mad_clip(df))`` per series and sensor with one quantile pass less.

    Clipping keeps the order of the values, so the values around a rank of the clipped column are
    those around it in the raw one, clipped. One pass gives these for all percentiles, of which the
    median bounds the deviations; only mean and deviation need the clipped rows, in one aggregate.
    """
    if 0.5 not in probs:
        raise ValueError("the bounds need the median")
    cells, groups, v = long_form(df, sensors), [SERIES, "sensor"], F.col("value")
    raw = stage(group_quantiles(
        cells, groups, "value", probs, spread=[TS], extra=[F.min(v).alias("min"), F.max(v).alias("max")], ends=True
    ))
    middle = f"q[{list(probs).index(0.5)}]"
    medians = raw.filter("n > 0").selectExpr(*groups, f"{middle}.lo + ({middle}.hi - {middle}.lo) * {middle}.w as med")
    bounds = _bounds_around(medians, cells, params)
    moments = _clipped(df, sensors, bounds).groupBy(SERIES).agg(
        *[f(F.col(c).cast("double")).alias(f"_{n}_{c}") for c in sensors for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    )
    each = F.explode(F.array(*[
        F.struct(F.lit(c).alias("sensor"), F.col(f"_mean_{c}").alias("mean"), F.col(f"_std_{c}").alias("std")) for c in sensors
    ])).alias("_m")
    found = raw.join(bounds, groups, "left").join(moments.select(SERIES, each).select(SERIES, "_m.*"), groups, "left")

    def clip(x: str) -> str:
        return f"(case when {x} is not null then least(greatest({x}, low), high) end)"

    return found.selectExpr(
        *groups, "n as count", "mean", "std", f"{clip('min')} as min",
        *[f"{clip(f'q[{i}].lo')} + ({clip(f'q[{i}].hi')} - {clip(f'q[{i}].lo')}) * q[{i}].w as p{round(p * 100):02d}" for i, p in enumerate(probs)],
        f"{clip('max')} as max",
    )


def correlations(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair of sensors, in long form; null where a
    sensor does not vary over the common slots."""
    pairs = [(a, b) for i, a in enumerate(sensors) for b in sensors[i:]]

    def spread(a: str, b: str) -> Column:
        return F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a)))

    wide = df.groupBy(SERIES).agg(
        *[
            (F.covar_pop(a, b) / F.nullif(spread(a, b) * spread(b, a), F.lit(0.0))).alias(f"_{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = [
        F.struct(F.lit(x).alias("sensor_a"), F.lit(y).alias("sensor_b"), F.col(f"_{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ([(a, b)] if a == b else [(a, b), (b, a)])
    ]
    return wide.select(SERIES, F.explode(F.array(*cells)).alias("_c")).select(SERIES, "_c.*")


def lowest_decile(df: DataFrame, target: str, *, name: str = "off") -> DataFrame:
    """Mask of the slots whose target is at or below its 10 % quantile, where no rule is known."""
    cut = group_quantiles(df.select(SERIES, TS, F.col(target).alias("value")), [SERIES], "value", [0.1], spread=[TS])
    rows = attach(df, cut.select(SERIES, F.col("q")[0].alias("_cut")), [SERIES], [TS])
    return rows.withColumn(name, F.coalesce(F.col(target) <= F.col("_cut"), F.lit(False))).drop("_cut")
