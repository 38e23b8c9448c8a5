"""Walk-forward backtest over the trailing days of every series."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame

from slotwise.operators.arima import arima_forecasts
from slotwise.operators.fitted import as_forecasts, boosted_tree_forecasts
from slotwise.operators.forecasts import (
    backtest_metrics, best_forecast_tail, best_model, complete, fold_metrics, union_models, window_forecasts,
)
from slotwise.operators.grid import trailing_slice
from slotwise.params import Params
from slotwise.sources.staging import stage


@dataclass(frozen=True)
class Backtest:
    forecasts: DataFrame
    metrics: DataFrame
    folds: DataFrame
    best: DataFrame
    tail: DataFrame


def backtest(
    grid: DataFrame, target: str, params: Params, *, fitted: Collection[str] = ("arima", "gbt")
) -> Backtest:
    """Compare the window models and any of the fitted ones on the same origins."""
    recent = trailing_slice(grid, params)
    tables = [window_forecasts(recent, target, params)]
    if "arima" in fitted:
        tables.append(as_forecasts(arima_forecasts(recent, target, params)))
    if "gbt" in fitted:
        boosted = boosted_tree_forecasts(recent, target, params)
        if boosted is not None:
            tables.append(boosted)
    forecasts = stage(complete(union_models(*tables)))
    metrics = backtest_metrics(forecasts)
    return Backtest(
        forecasts, metrics, fold_metrics(forecasts, params), best_model(metrics), best_forecast_tail(forecasts, params)
    )
