"""Tunables, passed explicitly to every operator that needs them."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

SERIES = "series_id"
TS = "ts"
DAY_SECONDS = 86_400

# Accepted names of the timestamp column, in order of preference.
TIMESTAMP_NAMES = ("timestamp", "time", "datetime", "date", "Timestamp", "DateTime")


@dataclass(frozen=True)
class Params:
    """Defaults are fixed values that the results depend on; override with ``with_``."""

    step_min: int = 5
    fill_min: int = 60
    smooth_min: int = 20
    min_duration_min: float = 30.0
    feature_windows_min: tuple[int, ...] = (15, 30, 60)
    clip_k: float = 5.0
    mad_z: float = 6.0
    kmin: int = 2
    kmax: int = 5
    n_init: int = 20
    sample_rows: int = 20_000
    pca_components: int = 2
    n_trees: int = 200
    tree_rows: int = 256
    contamination: float = 0.01
    min_state_rows: int = 200
    horizon_min: int = 60
    lags_min: int = 180
    season_min: int = 1440
    season_corr: float = 0.3
    min_train_rows: int = 200
    backtest_days: int = 30
    train_days: int = 60
    gbt_trees: int = 100
    gbt_rate: float = 0.1
    gbt_depth: int = 3
    gbt_refit_days: int = 7
    arima_long: int = 10
    arima_p: tuple[int, ...] = (0, 1, 2)
    arima_d: tuple[int, ...] = (0, 1)
    arima_q: tuple[int, ...] = (0, 1, 2)
    seed: int = 42
    # Slots of one series that a single window partition may hold.
    span: int = 131_072
    # Model fits that run at the same time.
    parallel_fits: int = 4

    def __post_init__(self) -> None:
        if self.step_min <= 0 or DAY_SECONDS % (self.step_min * 60):
            raise ValueError("step_min must divide a day")
        if self.span < 2:
            raise ValueError("span must be at least 2")

    def with_(self, **changes) -> "Params":
        return dataclasses.replace(self, **changes)

    @property
    def step(self) -> int:
        """Slot length in seconds."""
        return self.step_min * 60

    def slots(self, minutes: float, least: int = 1) -> int:
        """Whole slots in ``minutes``, at least ``least``."""
        return max(least, int(minutes // self.step_min))

    @property
    def horizon(self) -> int:
        """Slots from a forecast's origin to its target; origins are as far apart."""
        return self.slots(self.horizon_min)

    @property
    def n_lags(self) -> int:
        return self.slots(self.lags_min)

    @property
    def season(self) -> int:
        return self.slots(self.season_min)
