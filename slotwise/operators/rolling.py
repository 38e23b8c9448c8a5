"""Rolling statistics, differences and lags on a dense grid or on row positions."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from slotwise.functions.chunks import CHUNK, over_chunks, positions
from slotwise.functions.timeslots import slot_of
from slotwise.operators.grid import SLOT
from slotwise.params import SERIES, TS, Params

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this many rows a median is an array expression over lags; beyond, a sliding order statistic.
_ARRAY_MEDIAN = 16


def median_reach(win: int, *, center: bool) -> tuple[int, int]:
    """Rows before and after the current one; an even centred window leans back."""
    if not center:
        return win - 1, 0
    ahead = (win - 1) // 2
    return win - 1 - ahead, ahead


def rolling_medians(
    rows: DataFrame, w: WindowSpec, keys: Sequence[str], order: str, columns: Mapping[str, str], before: int, after: int, min_count: int
) -> DataFrame:
    """Adds, by new name, the median of the non-null values of a column in the row frame, null below
    ``min_count`` of them. ``rows`` are cut into chunks with the rows that the frames reach.

    Short frames are expressions. Long ones slide through a chunk in one task, which keeps a frame's
    values ordered, so that a row costs the logarithm of the frame and not a sort of it."""
    least = max(1, min_count)
    if before + after + 1 <= _ARRAY_MEDIAN:
        return rows.withColumns({name: _array_median(c, w, before, after, least) for name, c in columns.items()})
    kept = [f for f in rows.schema if f.name not in columns]
    schema = StructType([*kept, *[StructField(name, DoubleType()) for name in columns]])

    def slide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        made = {}
        for name, c in columns.items():
            # Frames at the end are as short as those at the start: no values lie beyond either.
            values = pd.Series(np.concatenate([pdf[c].to_numpy(float), np.full(after, np.nan)]))
            made[name] = values.rolling(before + after + 1, min_periods=least).median().to_numpy()[after:]
        return pdf.assign(**made)[schema.names]

    return rows.groupBy(*keys, CHUNK).applyInPandas(slide, schema).select(*dict.fromkeys([*rows.columns, *columns]))


def _array_median(value: str, w: WindowSpec, before: int, after: int, least: int) -> Column:
    cells = [F.lag(value, i).over(w) for i in range(before, 0, -1)]
    cells.append(F.col(value))
    cells += [F.lead(value, i).over(w) for i in range(1, after + 1)]
    # Nulls sort first, so the n values are the last n of the array; no lambda, no codegen break.
    ordered = F.sort_array(F.array(*cells))
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cells])
    skipped = F.lit(len(cells)) - n
    low = F.get(ordered, skipped + F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, skipped + F.floor(n / 2).cast("int"))
    return F.when(n >= least, low + (high - low) * 0.5)


def smooth_centered(df: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    """Replace each sensor by its centred rolling median over the smoothing window.

    The rows keep their placement: ``chunk`` and ``slot`` stay, for steps that go on from there.
    """
    win = params.slots(params.smooth_min)
    before, after = median_reach(win, center=True)

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rolling_medians(rows, w, [SERIES], SLOT, {c: c for c in sensors}, before, after, win // 2)

    rows = df.withColumn(SLOT, slot_of(TS, params.step))
    return over_chunks(rows, [SERIES], SLOT, params.span, build, before, after)


def feature_names(sensors: Sequence[str], params: Params) -> list[str]:
    return [
        name
        for c in sensors
        for name in (
            f"{c}_diff1",
            *[f"{c}_{stat}_{m}m" for m in params.feature_windows_min for stat in ("mean", "std")],
        )
    ]


def _features(
    rows: DataFrame, keys: Sequence[str], order: str, sensors: Sequence[str], params: Params, *, by_slot: bool = False
) -> DataFrame:
    """``by_slot`` frames reach over slots instead of rows."""
    window = f"partition by {', '.join([*keys, CHUNK])} order by {order}"
    unit = "range" if by_slot else "rows"
    out = []
    for c in sensors:
        out.append(f"`{c}` - max(`{c}`) over ({window} {unit} between 1 preceding and 1 preceding) as `{c}_diff1`")
        for minutes in params.feature_windows_min:
            n = params.slots(minutes)
            frame = f"over ({window} {unit} between {n - 1} preceding and current row)"
            for stat, function in (("mean", "avg"), ("std", "stddev_samp")):
                out.append(
                    f"case when count(`{c}`) {frame} >= {max(1, n // 2)} then {function}(`{c}`) {frame} end"
                    f" as `{c}_{stat}_{minutes}m`"
                )
    return rows.selectExpr("*", *out)


def rolling_features(
    df: DataFrame,
    sensors: Sequence[str],
    params: Params,
    *,
    keys: Sequence[str] = (SERIES,),
    compacted: bool = False,
    break_at_gaps: bool = False,
) -> DataFrame:
    """Difference, rolling means and deviations of each sensor; rows with any null dropped.

    ``compacted`` says that rows were removed from the grid (or that ``keys`` splits it): frames
    then count remaining rows and so reach across the removed ones, unless ``break_at_gaps``,
    where they count slots and removed rows are simply missing.
    """
    before = max(params.slots(m) for m in params.feature_windows_min) - 1
    before = max(before, 1)
    names = feature_names(sensors, params)
    rows = df.withColumn(SLOT, slot_of(TS, params.step))
    order = SLOT
    if compacted and not break_at_gaps:
        order = "pos"
        rows = positions(rows, keys, SLOT, params.span, name=order)
    done = over_chunks(
        rows, keys, order, params.span,
        lambda r, _: _features(r, keys, order, sensors, params, by_slot=compacted and break_at_gaps), before,
    )
    return done.na.drop(subset=names).select(*keys, TS, *names)


def rolling_mad_z(df: DataFrame, target: str, params: Params) -> DataFrame:
    """Adds ``med``, ``mad`` (0 becomes null) and ``z`` = |value - med| / mad of the target."""
    win = max(3, params.slots(params.feature_windows_min[0]))
    reach, least = win - 1, win // 2

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = rolling_medians(rows, w, [SERIES], SLOT, {"med": target}, reach, 0, least)
        rows = rows.withColumn("_dev", F.abs(F.col(target) - F.col("med")))
        rows = rolling_medians(rows, w, [SERIES], SLOT, {"mad": "_dev"}, reach, 0, least)
        return rows.withColumn("mad", F.nullif("mad", F.lit(0.0))).drop("_dev")

    rows = df.withColumn(SLOT, slot_of(TS, params.step))
    rows = over_chunks(rows, [SERIES], SLOT, params.span, build, 2 * reach).drop(SLOT)
    return rows.withColumn("z", F.abs((F.col(target) - F.col("med")) / F.col("mad")))


def mad_outliers(scored: DataFrame, params: Params) -> DataFrame:
    """Adds ``mad_flag``: z above the limit, null counts as no."""
    return scored.withColumn("mad_flag", F.coalesce(F.col("z") > params.mad_z, F.lit(False)))


def lag_matrix(df: DataFrame, target: str, params: Params) -> DataFrame:
    """``lag_1..lag_n`` and the value a horizon ahead (``y_ahead``), complete rows only."""
    lags = [f"lag_{i}" for i in range(1, params.n_lags + 1)]

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns(
            {
                **{name: F.lag(target, i).over(w) for i, name in enumerate(lags, 1)},
                "y_ahead": F.lead(target, params.horizon).over(w),
            }
        )

    rows = df.select(SERIES, TS, F.col(target).alias("y"), slot_of(TS, params.step).alias(SLOT))
    target = "y"
    rows = over_chunks(rows, [SERIES], SLOT, params.span, build, params.n_lags, params.horizon)
    return rows.na.drop(subset=["y", *lags, "y_ahead"]).select(SERIES, TS, "y", *lags, "y_ahead")


def all_below(sensors_to_limits: dict[str, float]) -> Column:
    """Every sensor at or below its limit; a null reading counts as above."""
    tests = [F.coalesce(F.col(c) <= F.lit(float(v)), F.lit(False)) for c, v in sensors_to_limits.items()]
    return reduce(lambda a, b: a & b, tests)


def most_below(sensors_to_limits: dict[str, float]) -> Column:
    """More than half of the sensors at or below their limits."""
    votes = [
        F.coalesce(F.col(c) <= F.lit(float(v)), F.lit(False)).cast("int") for c, v in sensors_to_limits.items()
    ]
    return reduce(lambda a, b: a + b, votes) * 2 > len(votes)
