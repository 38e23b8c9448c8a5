"""When was a machine down? Grid -> smoothing -> thresholds -> runs -> minimum duration."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.chunks import CHUNK
from slotwise.operators.grid import SLOT, regular_grid
from slotwise.operators.periods import at_least, mask_to_periods
from slotwise.operators.profile import lowest_decile
from slotwise.operators.rolling import all_below, most_below, smooth_centered
from slotwise.params import SERIES, TS, Params

OFF = "off"


def shutdown_mask(
    grid: DataFrame,
    limits: Mapping[str, float],
    params: Params,
    *,
    target: str | None = None,
    combine: str = "all",
) -> DataFrame:
    """``(series_id, ts, off)`` before the minimum duration, with ``chunk`` and ``slot`` where known.

    ``limits`` maps sensors to their upper limit; sensors that the grid lacks are ignored. With
    none left the lowest decile of ``target`` counts as off.
    """
    known = {c: v for c, v in limits.items() if c in grid.columns}
    if not known:
        if target not in grid.columns:
            return grid.select(SERIES, TS, F.lit(False).alias(OFF))
        return lowest_decile(smooth_centered(grid, [target], params), target, name=OFF).select(SERIES, TS, OFF)
    smooth = smooth_centered(grid.select(SERIES, TS, *known), list(known), params)
    rule = {"all": all_below, "majority": most_below}[combine]
    return smooth.select(SERIES, TS, CHUNK, SLOT, rule(known).alias(OFF))


def shutdown_periods(
    readings: DataFrame,
    limits: Mapping[str, float],
    params: Params,
    *,
    target: str | None = None,
    combine: str = "all",
) -> DataFrame:
    """``(series_id, start, end, duration_min, reason)``. Runs cannot overlap, so there is
    nothing to merge and the reason survives."""
    used = [c for c in limits if c in readings.columns] or ([target] if target in readings.columns else [])
    if not used:
        raise ValueError("no sensor of the limits and no target among the columns")
    return shutdowns_on_grid(regular_grid(readings, used, params), limits, params, target=target, combine=combine)


def shutdowns_on_grid(
    grid: DataFrame, limits: Mapping[str, float], params: Params, *, target: str | None = None, combine: str = "all"
) -> DataFrame:
    mask = shutdown_mask(grid, limits, params, target=target, combine=combine)
    found = at_least(mask_to_periods(mask, OFF, params), params.min_duration_min)
    known = any(c in grid.columns for c in limits)
    return found.withColumn("reason", F.lit("below_thresholds" if known else "lowest_decile"))
