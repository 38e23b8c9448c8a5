"""Contextual anomalies: isolation forest within each state, rolling MAD of the target beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators.forest import isolation_scores
from slotwise.operators.periods import mask_to_periods
from slotwise.operators.rolling import feature_names, mad_outliers, rolling_features, rolling_mad_z
from slotwise.operators.states import CLUSTER, large_states
from slotwise.params import SERIES, TS, Params

NO_STATE = -1


def mad_periods(grid: DataFrame, target: str, params: Params) -> DataFrame:
    """Runs of slots whose rolling robust z is above the limit."""
    flagged = mad_outliers(rolling_mad_z(grid, target, params), params)
    return mask_to_periods(flagged, "mad_flag", params)


def state_outliers(grid: DataFrame, labels: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    """``(series_id, cluster, ts, score, is_outlier)``, one forest per series and state.

    Features are rebuilt on the rows of the state alone.
    """
    labelled = large_states(labels.filter(F.col(CLUSTER).isNotNull()), params).select(SERIES, TS, CLUSTER)
    rows = grid.select(SERIES, TS, *sensors).join(labelled, [SERIES, TS])
    features = rolling_features(rows, sensors, params, keys=(SERIES, CLUSTER), compacted=True)
    return isolation_scores(features, [SERIES, CLUSTER], TS, feature_names(sensors, params), params)


def flag_slots(grid: DataFrame, labels: DataFrame, outliers: DataFrame | None, target: str, params: Params) -> DataFrame:
    """Every slot with its state, both flags, their union and the forest's score."""
    flagged = mad_outliers(rolling_mad_z(grid.select(SERIES, TS, target), target, params), params)
    rows = flagged.select(SERIES, TS, "mad_flag").join(
        labels.select(SERIES, TS, F.col(CLUSTER).alias("state")), [SERIES, TS], "left"
    )
    if outliers is None:
        rows = rows.withColumns({"forest_flag": F.lit(False), "score": F.lit(None).cast("double")})
    else:
        marks = outliers.select(SERIES, TS, "score", F.col("is_outlier").alias("_out"))
        rows = rows.join(marks, [SERIES, TS], "left").withColumn("forest_flag", F.coalesce("_out", F.lit(False)))
    return rows.select(
        SERIES, TS, "state", "mad_flag", "forest_flag", "score",
        (F.col("mad_flag") | F.col("forest_flag")).alias("anomalous"),
    )


def anomaly_periods(flags: DataFrame, params: Params) -> DataFrame:
    """Runs of anomalous slots with their most frequent state (lowest on a tie, -1 if none), the
    method that found them and the mean score. Runs are disjoint, so nothing is merged away."""
    forest, mad = F.bool_or("forest_flag"), F.bool_or("mad_flag")
    return mask_to_periods(
        flags, "anomalous", params,
        attributes=[
            F.coalesce(F.mode("state", True), F.lit(NO_STATE)).alias("state"),
            F.when(forest & mad, "Both").when(forest, "IForest").otherwise("MAD").alias("method"),
            F.avg("score").alias("score"),
        ],
    )


def contextual_anomalies(
    grid: DataFrame, labels: DataFrame, sensors: Sequence[str], target: str, params: Params
) -> DataFrame:
    outliers = state_outliers(grid, labels, sensors, params)
    return anomaly_periods(flag_slots(grid, labels, outliers, target, params), params)
