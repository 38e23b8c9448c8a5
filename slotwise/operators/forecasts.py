"""Walk-forward forecasts as window expressions: every origin at once, no fitting loop.

One definition for every model: the origin is a slot, the target lies ``horizon`` slots later,
and nothing after the origin is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.chunks import Carry, attach, carry, over_chunks
from slotwise.functions.timeslots import epoch_seconds, slot_of, slot_start
from slotwise.operators.grid import SLOT, tail_rows
from slotwise.params import DAY_SECONDS, SERIES, TS, Params

FORECAST_COLUMNS = (SERIES, "origin", TS, "model", "y_true", "y_pred")


def target_slots(grid: DataFrame, target: str, params: Params) -> DataFrame:
    """``(series_id, ts, slot, y)`` of a dense grid."""
    return grid.select(SERIES, TS, slot_of(TS, params.step).alias(SLOT), F.col(target).cast("double").alias("y"))


def with_figures(rows: DataFrame, params: Params) -> DataFrame:
    """Adds the first and last slot and the mean of each series."""
    figures = rows.groupBy(SERIES).agg(
        F.min(SLOT).alias("first_slot"), F.max(SLOT).alias("last_slot"), F.avg("y").alias("y_mean")
    )
    return attach(rows, figures, [SERIES], [SLOT])


def is_origin(params: Params, *, test_from_days: int | None = None) -> Column:
    """Whether a slot with the figures of its series is an origin: from one season after the first slot
    on, one per horizon, with a target inside the series. ``test_from_days`` starts instead that many
    days before the last day."""
    ordinal = F.col(SLOT) - F.col("first_slot")
    keep = (
        (ordinal >= params.season)
        & (F.pmod(ordinal - params.season, F.lit(params.horizon)) == 0)
        & (F.col(SLOT) < F.col("last_slot") + 1 - params.horizon)
    )
    if test_from_days is None:
        return keep
    last_day = F.date_sub(slot_start("last_slot", params.step).cast("date"), test_from_days).cast("timestamp_ntz")
    return keep & (F.col(TS) >= last_day)


def walk_forward_origins(rows: DataFrame, params: Params, *, test_from_days: int | None = None) -> DataFrame:
    """Keeps the origins of a table of slots and counts their slots from the first one."""
    located = rows if "first_slot" in rows.columns else with_figures(rows, params)
    ordinal = F.col(SLOT) - F.col("first_slot")
    kept = located.filter(is_origin(params, test_from_days=test_from_days))
    return kept.withColumn("ordinal", ordinal).drop("first_slot", "last_slot", "y_mean")


def last_observation(rows: DataFrame, params: Params, *, value: str = "y", name: str = "y_last") -> DataFrame:
    """Latest non-null value at or before each slot (as-of lookup on the grid)."""
    return carry(rows, [SERIES], SLOT, params.span, {name: Carry("last", value)})


def seasonality(rows: DataFrame, params: Params) -> DataFrame:
    """Per series the correlation with the value one season earlier and whether it is high enough.

    Pairs with a null are left out; too few pairs give no correlation and hence no."""
    pairs = over_chunks(
        rows.select(SERIES, SLOT, "y"), [SERIES], SLOT, params.span,
        lambda r, w: r.withColumn("y_season", F.lag("y", params.season).over(w)), params.season,
    )
    return pairs.groupBy(SERIES).agg(F.corr("y", "y_season").alias("corr")).withColumn(
        "is_seasonal", F.coalesce(F.col("corr") >= params.season_corr, F.lit(False))
    )


def _pair_sums() -> dict[str, Carry]:
    """Running sums over pairs of ``y`` and its predecessor ``_x``, taken around the series mean so
    that they do not cancel."""
    both, x, y = "y is not null and _x is not null", "(_x - y_mean)", "(y - y_mean)"
    terms = {"_n": "1D", "_sx": x, "_sy": y, "_sxx": f"{x} * {x}", "_sxy": f"{x} * {y}"}
    return {k: Carry("sum", f"case when {both} then {v} else 0D end") for k, v in terms.items()}


def _closed_form(running: DataFrame, params: Params) -> DataFrame:
    """``slope`` and ``intercept`` from the running sums and ``ar1``, the forecast they imply."""
    h = params.horizon
    fitted = running.withColumn("slope", F.expr("(_n * _sxy - _sx * _sy) / nullif(_n * _sxx - _sx * _sx, 0D)"))
    fitted = fitted.withColumn("intercept", F.expr("(_sy - slope * _sx) / nullif(_n, 0D) + y_mean - slope * y_mean"))
    power = f"power(slope, {h})"
    ahead = f"{power} * y + intercept * case when slope = 1D then {h}D else (1D - {power}) / (1D - slope) end"
    return fitted.withColumn("ar1", F.expr(ahead)).drop("_x", "_n", "_sx", "_sy", "_sxx", "_sxy")


def autoregression(rows: DataFrame, params: Params) -> DataFrame:
    """AR(1) fitted to all pairs up to each slot: adds ``slope``, ``intercept``, ``ar1``.

    Running sums give the regression at every slot in one pass; ``ar1`` is its closed form
    ``horizon`` steps ahead.
    """
    located = rows if "y_mean" in rows.columns else with_figures(rows, params)
    lagged = over_chunks(
        located, [SERIES], SLOT, params.span, lambda r, w: r.withColumn("_x", F.lag("y", 1).over(w)), 1
    )
    return _closed_form(carry(lagged, [SERIES], SLOT, params.span, _pair_sums()), params)


def window_forecasts(grid: DataFrame, target: str, params: Params, *, test_from_days: int | None = None) -> DataFrame:
    """Naive, seasonal naive and AR(1) forecasts at every origin, long form, incomplete ones kept.

    A series without seasonality gets null forecasts under ``seasonal_naive_disabled``. Every
    figure is a window over the same chunks: one pass around each slot, one running pass.
    """
    rows = target_slots(grid, target, params)
    h, season = params.horizon, params.season

    def look(r: DataFrame, w) -> DataFrame:
        return r.withColumns(
            {"y_true": F.lead("y", h).over(w), "y_season": F.lag("y", season - h).over(w), "_x": F.lag("y", 1).over(w)}
        )

    known = over_chunks(with_figures(rows, params), [SERIES], SLOT, params.span, look, max(season - h, 1), h)
    known = carry(known, [SERIES], SLOT, params.span, {"y_last": Carry("last", "y"), **_pair_sums()})
    origins = walk_forward_origins(_closed_form(known, params), params, test_from_days=test_from_days)
    at = attach(origins, seasonality(rows, params), [SERIES], [TS])
    seasonal = F.coalesce(F.col("is_seasonal"), F.lit(False))
    models = F.array(
        F.struct(F.lit("naive").alias("model"), F.col("y_last").alias("y_pred")),
        F.struct(
            F.when(seasonal, F.lit("seasonal_naive")).otherwise(F.lit("seasonal_naive_disabled")).alias("model"),
            F.when(seasonal, F.col("y_season")).alias("y_pred"),
        ),
        F.struct(F.lit("ar1").alias("model"), F.col("ar1").alias("y_pred")),
    )
    at = at.withColumn("_target", F.col(SLOT) + h)
    return at.select(
        SERIES, F.col(TS).alias("origin"), slot_start("_target", params.step).alias(TS), "y_true",
        F.explode(models).alias("_m"),
    ).select(SERIES, "origin", TS, "_m.model", "y_true", "_m.y_pred")


def complete(forecasts: DataFrame) -> DataFrame:
    return forecasts.na.drop(subset=["y_true", "y_pred"])


def union_models(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Forecasts of several models in one long table."""
    out = first.select(*FORECAST_COLUMNS)
    for other in others:
        out = out.unionByName(other.select(*FORECAST_COLUMNS))
    return out


def backtest_metrics(forecasts: DataFrame, *, keys: Sequence[str] = (SERIES,)) -> DataFrame:
    """MAE, RMSE and number of complete forecasts per model."""
    error = F.col("y_true") - F.col("y_pred")
    return complete(forecasts).groupBy(*keys, "model").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(F.lit(1)).alias("n"),
    )


def fold_metrics(forecasts: DataFrame, params: Params, *, keys: Sequence[str] = (SERIES,)) -> DataFrame:
    """``backtest_metrics`` per fold and, with a null ``fold``, of all folds together, in one pass.

    A fold is as long as the models' refit interval and counts from the series' first origin."""
    done = complete(forecasts)
    start = done.groupBy(*keys).agg(F.min("origin").alias("_start"))
    passed = epoch_seconds("origin") - epoch_seconds("_start")
    fold = F.floor(passed / F.lit(float(params.gbt_refit_days * DAY_SECONDS))).cast("int")
    rows = attach(done, start, keys, ["origin", "model"]).withColumn("fold", fold)
    error = F.col("y_true") - F.col("y_pred")
    names = [*keys, "model", "fold"]
    return rows.groupingSets([[F.col(c) for c in names], [F.col(c) for c in names[:-1]]], *names).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("n")
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Lowest RMSE per series; the name decides a tie."""
    w = Window.partitionBy(SERIES).orderBy("rmse", "model")
    return metrics.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def best_forecast_tail(forecasts: DataFrame, params: Params, *, days: int = 7) -> DataFrame:
    """Last ``days`` worth of slots of the best model's complete forecasts per series."""
    best = best_model(backtest_metrics(forecasts)).select(SERIES, "model")
    chosen = complete(forecasts).join(best, [SERIES, "model"], "left_semi")
    return tail_rows(chosen, [SERIES], TS, params.season * days)


