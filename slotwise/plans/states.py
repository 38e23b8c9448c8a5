"""Operating states of the running machine: features outside shutdowns, clustered."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from slotwise.operators.kmeans import CLUSTER, Sweep, kmeans_sweep, to_points
from slotwise.operators.periods import exclude_periods, labels_on_grid
from slotwise.operators.rolling import feature_names, rolling_features
from slotwise.operators.states import principal_axes, standardize, state_names, state_summary
from slotwise.params import SERIES, TS, Params
from slotwise.sources.staging import stage


@dataclass(frozen=True)
class States:
    sweep: Sweep
    points: DataFrame
    labels: DataFrame
    summary: DataFrame
    curve: DataFrame


def operating_states(
    grid: DataFrame, sensors: Sequence[str], params: Params, *, shutdowns: DataFrame | None = None
) -> States:
    """Features are standardised per series and one model is fitted over all series."""
    running = stage(exclude_periods(grid, shutdowns, params)) if shutdowns is not None else grid
    features = rolling_features(running, sensors, params, compacted=shutdowns is not None)
    names = feature_names(sensors, params)
    points = stage(to_points(standardize(stage(features), names), names, (SERIES, TS)))
    sweep = kmeans_sweep(points, params)
    labels = state_names(sweep.label(points))
    return States(
        sweep=sweep,
        points=points,
        labels=labels,
        summary=state_summary(running, labels, sensors),
        curve=sweep.table(grid),
    )


def full_timeline(grid: DataFrame, states: States) -> DataFrame:
    """Label of every slot of the grid, null where excluded or without features."""
    return labels_on_grid(grid.select(SERIES, TS), states.labels.select(SERIES, TS, CLUSTER))


def scatter(states: States, params: Params) -> DataFrame:
    """First two principal components of each labelled slot with its cluster."""
    return principal_axes(states.points, params).join(states.labels.select(SERIES, TS, CLUSTER), [SERIES, TS])
