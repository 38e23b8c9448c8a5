"""Telemetry analytics on Spark: grids, rolling features, periods, states, anomalies, forecasts."""

from slotwise.params import Params

__all__ = ["Params"]
