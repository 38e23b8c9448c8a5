"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.timeslots import fixed
from slotwise.operators import arima, fitted, forecasts, grid, periods, profile, rolling, states
from slotwise.params import SERIES, TS, Params
from slotwise.plans import anomalies as anomaly_plan
from slotwise.plans import backtest as backtest_plan
from slotwise.plans import shutdowns as shutdown_plan
from slotwise.plans import states as state_plan
from slotwise.sources import tables
from slotwise.sources.staging import shared_folder, stage
from slotwise.sources.telemetry import clean
from slotwise.streaming import gaps
from slotwise.streaming import resample as streaming

P = Params()
# The same row counts on a one-hour grid, for tables with few readings per hour.
HOURLY = P.with_(
    step_min=60, fill_min=720, smooth_min=240, min_duration_min=120.0, feature_windows_min=(180, 360, 720),
    horizon_min=720, lags_min=2160,
)
DAILY = P.with_(step_min=1440, horizon_min=1440, season_min=7 * 1440)
SENSORS, TARGET = list(tables.SENSORS), tables.TARGET
LIMIT = 55.0
LIMITS = {c: LIMIT for c in SENSORS}
LONG_LIMITS = {"quantity": 25.0, "price": 35_000.0}
FEW_LIMITS = {c: 60.0 for c in SENSORS}
PARETO_EDGES = (45.0, 60.0, 90.0)
LATENESS = "30 minutes"

Query = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[fixed(c, places).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def filled(spark: SparkSession, folder: str, params: Params = P) -> DataFrame:
    return grid.regular_grid(tables.telemetry(spark, folder), SENSORS, params)


def base(spark: SparkSession, folder: str, params: Params = P) -> DataFrame:
    """The interpolated grid, written once for queries that read it several times."""
    return stage(filled(spark, folder, params))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return grid.regular_grid(tables.shipments(spark, folder), tables.MEASURES, DAILY)


def found_shutdowns(spark: SparkSession, folder: str) -> DataFrame:
    return shutdown_plan.shutdown_periods(tables.telemetry(spark, folder), LIMITS, P)


def event_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a period of a tenth of ``value`` whole minutes; such periods overlap."""
    return tables.table(spark, folder, "events").select(
        (F.col("user_id") % tables.SERIES_COUNT).alias(SERIES),
        F.col(TS).alias("start"),
        F.expr(f"{TS} + make_dt_interval(0, 0, cast(floor(value / 10) as int), 0)").alias("end"),
    )


def rule_labels(rows: DataFrame) -> DataFrame:
    """A state per slot by a fixed rule on the target, so that SQL can name the same states."""
    band = F.least(F.floor(F.col(TARGET) / 40.0), F.lit(3)).cast("int")
    return rows.filter(F.col(TARGET).isNotNull()).select(SERIES, TS, band.alias(states.CLUSTER))


def rule_outliers(rows: DataFrame) -> DataFrame:
    score = F.col("error") / 100.0 - 1.5
    return rows.filter(F.col("error").isNotNull()).select(
        SERIES, TS, score.alias("score"), (score > 0).alias("is_outlier")
    )


def flagged_slots(spark: SparkSession, folder: str) -> DataFrame:
    rows = base(spark, folder)
    return anomaly_plan.flag_slots(rows, rule_labels(rows), rule_outliers(rows), TARGET, P)


def recent(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing slice of the target's grid, staged."""
    readings = tables.telemetry(spark, folder)
    return stage(grid.trailing_slice(grid.regular_grid(readings, [TARGET], P).drop("chunk"), P))


def window_forecasts(spark: SparkSession, folder: str, params: Params = P) -> DataFrame:
    return forecasts.window_forecasts(recent(spark, folder), TARGET, params)


# --- sources and grid


def scan_clean(spark, folder):
    return round_doubles(clean(tables.export_text(spark, folder), series="machine"))


def scan_profile(spark, folder):
    return profile.scan_profile(tables.telemetry(spark, folder), P)


def resample_mean(spark, folder):
    return round_doubles(grid.resample_mean(tables.telemetry(spark, folder), SENSORS, P))


def dense_grid(spark, folder):
    return round_doubles(grid.dense_grid(tables.telemetry(spark, folder), SENSORS, P))


def gap_interpolate(spark, folder):
    return round_doubles(filled(spark, folder).drop("chunk"))


def resample_hourly(spark, folder):
    return round_doubles(filled(spark, folder, HOURLY).drop("chunk"))


def resample_daily(spark, folder):
    return round_doubles(daily(spark, folder).drop("chunk"), 4)


def week_view(spark, folder):
    view = grid.range_view(profile.mad_clip(base(spark, folder), [TARGET], P), 7, P)
    return round_doubles(view.select(SERIES, TS, TARGET))


def year_view(spark, folder):
    rows = profile.mad_clip(stage(daily(spark, folder)), tables.MEASURES, DAILY)
    return round_doubles(grid.range_view(rows, 365, DAILY).drop("chunk"), 4)


def backtest_slice(spark, folder):
    return round_doubles(grid.trailing_slice(daily(spark, folder), DAILY).drop("chunk"), 4)


def ingest_gaps(spark, folder):
    return round_doubles(periods.ingest_gaps(tables.telemetry(spark, folder), 15))


# --- profile


def clipped(spark: SparkSession, folder: str) -> DataFrame:
    return profile.mad_clip(base(spark, folder), SENSORS, P)


def mad_clip(spark, folder):
    return round_doubles(clipped(spark, folder).drop("chunk"))


def describe_sensors(spark, folder):
    return round_doubles(profile.describe_clipped(base(spark, folder), SENSORS, P))


def describe_orders(spark, folder):
    return round_doubles(profile.describe(tables.order_values(spark, folder), ["price"]), 4)


def correlation_matrix(spark, folder):
    # A stuck sensor correlates with nothing.
    rows = clipped(spark, folder).withColumn("stuck", F.lit(1.5))
    return round_doubles(profile.correlations(rows, [*SENSORS, "stuck"]))


def decile_fallback_mask(spark, folder):
    return shutdown_plan.shutdown_mask(base(spark, folder), {}, P, target=TARGET)


# --- shutdowns and periods


def rolling_median_centered(spark, folder):
    return round_doubles(rolling.smooth_centered(filled(spark, folder), SENSORS, P).drop("chunk", "slot"))


def shutdown_mask(spark, folder):
    return shutdown_plan.shutdown_mask(filled(spark, folder), LIMITS, P).drop("chunk", "slot")


def mask_to_periods(spark, folder):
    mask = shutdown_plan.shutdown_mask(filled(spark, folder), LIMITS, P)
    return round_doubles(periods.mask_to_periods(mask, shutdown_plan.OFF, P))


def shutdown_periods(spark, folder):
    return round_doubles(found_shutdowns(spark, folder))


def downtime_totals(spark, folder):
    return round_doubles(periods.downtime_totals(found_shutdowns(spark, folder)))


def downtime_pareto(spark, folder):
    return round_doubles(periods.pareto(found_shutdowns(spark, folder), PARETO_EDGES))


def merge_periods(spark, folder):
    return round_doubles(periods.merge_periods(event_spans(spark, folder)))


def slots_in_periods(spark, folder):
    rows = grid.dense_grid(tables.telemetry(spark, folder), SENSORS, P).select(SERIES, TS)
    return periods.mark_periods(rows, event_spans(spark, folder), P).drop("chunk")


def exclude_shutdowns(spark, folder):
    rows = base(spark, folder)
    down = shutdown_plan.shutdowns_on_grid(rows, LIMITS, P)
    return round_doubles(periods.exclude_periods(rows, down, P).drop("chunk"))


# --- rolling windows


def rolling_features(spark, folder):
    return round_doubles(rolling.rolling_features(filled(spark, folder), SENSORS, P))


def features_between_shutdowns(spark, folder):
    rows = base(spark, folder)
    running = periods.exclude_periods(rows, shutdown_plan.shutdowns_on_grid(rows, LIMITS, P), P)
    return round_doubles(rolling.rolling_features(running, SENSORS, P, compacted=True))


def rolling_mad_z(spark, folder):
    scored = rolling.rolling_mad_z(filled(spark, folder), TARGET, P)
    return round_doubles(scored.select(SERIES, TS, TARGET, "med", "mad", "z"), 4)


def mad_outliers(spark, folder):
    flagged = rolling.mad_outliers(rolling.rolling_mad_z(filled(spark, folder), TARGET, P), P)
    return flagged.select(SERIES, TS, "mad_flag")


def mad_anomaly_periods(spark, folder):
    return round_doubles(anomaly_plan.mad_periods(filled(spark, folder), TARGET, P))


def lag_matrix(spark, folder):
    return round_doubles(rolling.lag_matrix(filled(spark, folder), TARGET, P))


# --- states and anomalies


def labels_on_grid(spark, folder):
    rows = base(spark, folder)
    labels = rule_labels(rows).withColumn(states.CLUSTER, F.col(states.CLUSTER).cast("double"))
    return periods.labels_on_grid(rows.select(SERIES, TS), labels)


def state_names(spark, folder):
    return states.state_names(rule_labels(filled(spark, folder)), {0: "Low", 1: "Normal", 2: "High"})


def state_size_gate(spark, folder):
    return states.large_states(rule_labels(base(spark, folder)), P)


def rows_with_features(spark, folder):
    rows = base(spark, folder)
    features = rolling.rolling_features(rows, SENSORS, P)
    return round_doubles(states.rows_with_features(rows.drop("chunk"), features))


def state_summary(spark, folder):
    rows = base(spark, folder)
    return round_doubles(states.state_summary(rows, rule_labels(rows), SENSORS, keys=(SERIES, states.CLUSTER)))


def standardize(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias(SERIES), "l_orderkey", "l_linenumber",
        *[F.col(f"l_{c}").alias(c) for c in ("quantity", "extendedprice", "discount", "tax")],
    )
    scaled = states.standardize(
        lines, ["quantity", "extendedprice", "discount", "tax"], spread=("l_orderkey", "l_linenumber")
    )
    return round_doubles(scaled, 5)


def centroid_assign(spark, folder):
    points = tables.vectors(spark, folder)
    dims = [f"x{i}" for i in range(tables.EMBEDDING_SIZE)]
    means = points.groupBy("label").agg(*[F.avg(c).alias(c) for c in dims])
    most = 1_000_000 // len(dims)  # what nearest_centroid takes; one row more tells that there are more
    centres = {r["label"]: [r[c] for c in dims] for r in means.limit(most + 1).collect()}
    found = states.nearest_centroid(points, dims, centres)
    return round_doubles(found.select("vec_id", states.CLUSTER, "distance"), 5)


def merged_mask(spark, folder):
    return flagged_slots(spark, folder).select(SERIES, TS, "mad_flag", "forest_flag", "anomalous")


def period_attributes(spark, folder):
    return round_doubles(anomaly_plan.anomaly_periods(flagged_slots(spark, folder), P))


def sustained_alert(spark, folder):
    scored = rolling.rolling_mad_z(filled(spark, folder), TARGET, P)
    alert = scored.withColumn("alert", F.coalesce(F.col("z") > 0.9, F.lit(False)))
    return round_doubles(periods.sustained(alert, "alert", 15, P))


def anomaly_lead_time(spark, folder):
    rows = base(spark, folder)
    early = anomaly_plan.mad_periods(rows, TARGET, P).select(SERIES, "start", "end")
    down = shutdown_plan.shutdowns_on_grid(rows, LIMITS, P)
    return round_doubles(periods.next_start(early, down))


def _states(spark: SparkSession, folder: str) -> tuple[DataFrame, state_plan.States]:
    rows = base(spark, folder)
    down = shutdown_plan.shutdowns_on_grid(rows, LIMITS, P)
    return rows, state_plan.operating_states(rows, SENSORS, P, shutdowns=down)


def kmeans_sweep(spark, folder):
    return _states(spark, folder)[1].curve


def operating_states(spark, folder):
    rows, found = _states(spark, folder)
    return state_plan.full_timeline(rows, found)


def cluster_summary(spark, folder):
    return _states(spark, folder)[1].summary


def pca_scatter(spark, folder):
    return state_plan.scatter(_states(spark, folder)[1], P)


def state_isolation_forest(spark, folder):
    rows = base(spark, folder)
    return anomaly_plan.state_outliers(rows, rule_labels(rows), SENSORS, P)


def contextual_anomalies(spark, folder):
    rows = base(spark, folder)
    return anomaly_plan.contextual_anomalies(rows, rule_labels(rows), SENSORS, TARGET, P)


# --- forecasts


def asof_last_value(spark, folder):
    rows = grid.dense_grid(tables.telemetry(spark, folder), [TARGET], P)
    seen = forecasts.last_observation(forecasts.target_slots(rows, TARGET, P), P)
    return round_doubles(seen.select(SERIES, TS, "y", "y_last"))


def walk_forward_origins(spark, folder):
    rows = forecasts.target_slots(recent(spark, folder), TARGET, P)
    return round_doubles(forecasts.walk_forward_origins(rows, P).select(SERIES, TS, "y", "ordinal"))


def walk_forward_origins_late(spark, folder):
    rows = forecasts.target_slots(recent(spark, folder), TARGET, P)
    late = forecasts.walk_forward_origins(rows, P, test_from_days=10)
    return round_doubles(late.select(SERIES, TS, "y", "ordinal"))


def seasonality_test(spark, folder):
    rows = forecasts.target_slots(recent(spark, folder), TARGET, P)
    return round_doubles(forecasts.seasonality(rows, P))


def ar1_expanding(spark, folder):
    rows = forecasts.autoregression(forecasts.target_slots(recent(spark, folder), TARGET, P), P)
    at = forecasts.walk_forward_origins(rows, P)
    return round_doubles(at.select(SERIES, TS, "slope", "intercept", "ar1"), 4)


def forecast_naive(spark, folder):
    found = window_forecasts(spark, folder).filter(F.col("model") == "naive")
    return round_doubles(forecasts.complete(found))


def forecast_seasonal_naive(spark, folder):
    # A limit of -1 enables the model for every series whose correlation is defined.
    found = window_forecasts(spark, folder, P.with_(season_corr=-1.0))
    return round_doubles(forecasts.complete(found.filter(F.col("model").startswith("seasonal"))))


def forecast_union(spark, folder):
    found = window_forecasts(spark, folder)
    parts = [found.filter(F.col("model").startswith(m)) for m in ("naive", "seasonal", "ar1")]
    return round_doubles(forecasts.union_models(*parts), 4)


def backtest_metrics(spark, folder):
    return round_doubles(forecasts.backtest_metrics(window_forecasts(spark, folder)), 4)


def best_model(spark, folder):
    return round_doubles(forecasts.best_model(forecasts.backtest_metrics(window_forecasts(spark, folder))), 4)


def backtest_folds(spark, folder):
    """Metrics per fold, and in all with a null fold."""
    return round_doubles(forecasts.fold_metrics(window_forecasts(spark, folder), P), 4)


def backtest_all(spark, folder):
    """The same for all five models: persistence, season, AR(1), ARIMA, boosted trees."""
    return round_doubles(backtest_plan.backtest(recent(spark, folder), TARGET, P).folds, 4)


def forecast_tail(spark, folder):
    return round_doubles(forecasts.best_forecast_tail(window_forecasts(spark, folder), P), 4)


def forecast_gbt(spark, folder):
    found = fitted.boosted_tree_forecasts(recent(spark, folder), TARGET, P)
    if found is None:
        return spark.createDataFrame(
            [], f"{SERIES} bigint, origin timestamp_ntz, {TS} timestamp_ntz, model string, y_true double, y_pred double"
        )
    return forecasts.complete(found)


def forecast_arima(spark, folder):
    return forecasts.complete(arima.arima_forecasts(recent(spark, folder), TARGET, P))


def forecast_coverage(spark, folder):
    """Origins per series, and how many of those with an observed target ARIMA answers: all that have
    ``least_rows`` observations up to them."""
    rows = recent(spark, folder)
    found = forecasts.complete(arima.arima_forecasts(rows, TARGET, P)).groupBy(SERIES).agg(F.count(F.lit(1)).alias("arima"))
    series = forecasts.target_slots(rows, TARGET, P)
    origins = forecasts.walk_forward_origins(series, P).groupBy(SERIES).agg(F.count(F.lit(1)).alias("origins"))
    return origins.join(found, SERIES, "left").select(SERIES, "origins", F.coalesce("arima", F.lit(0).cast("bigint")).alias("arima"))


# --- one long series


def long_grid(spark: SparkSession, folder: str) -> DataFrame:
    return grid.regular_grid(tables.long_series(spark, folder), tables.LONG_SENSORS, P)


def long_series_grid(spark, folder):
    return round_doubles(long_grid(spark, folder).drop("chunk"), 4)


def long_series_shutdowns(spark, folder):
    return round_doubles(shutdown_plan.shutdown_periods(tables.long_series(spark, folder), LONG_LIMITS, P))


def long_series_profile(spark, folder):
    rows = stage(long_grid(spark, folder))
    return round_doubles(profile.describe_clipped(rows, tables.LONG_SENSORS, P), 4)


def long_series_outliers(spark, folder):
    return round_doubles(anomaly_plan.mad_periods(long_grid(spark, folder), "quantity", P))


def long_series_states(spark, folder):
    """States of the whole series: exclusion of shutdowns, features, sweep and labels."""
    rows = stage(long_grid(spark, folder))
    down = shutdown_plan.shutdowns_on_grid(rows, LONG_LIMITS, P)
    found = state_plan.operating_states(rows, tables.LONG_SENSORS, P, shutdowns=down)
    return state_plan.full_timeline(rows, found)


# --- streaming


def stream_resample(spark, folder):
    schema = tables.table(spark, folder, "events").schema
    raw = streaming.read_stream(spark, folder, schema, pathGlobFilter="events.parquet")
    readings = raw.select(
        (F.col("user_id") % tables.SERIES_COUNT).alias(SERIES), TS,
        *[F.when(F.col("event_type") == s, F.col("value")).alias(s) for s in SENSORS],
    )
    run = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    out = streaming.stream_resample(readings, SENSORS, P, lateness=LATENESS)
    query = streaming.write_stream(out, f"{run}/slots", f"{run}/progress")
    query.awaitTermination()
    return round_doubles(spark.read.schema(out.schema).parquet(f"{run}/slots"))


def stream_gaps(spark, folder):
    """Gaps as the stream reports them, up to its last watermark."""
    schema = tables.table(spark, folder, "events").schema
    session = gaps.timer_session(spark)
    raw = streaming.read_stream(session, folder, schema, pathGlobFilter="events.parquet")
    readings = raw.select((F.col("user_id") % tables.SERIES_COUNT).alias(SERIES), TS)
    run = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    out = gaps.stream_gap_report(readings, 15, lateness=LATENESS)
    streaming.write_stream(out, f"{run}/gaps", f"{run}/progress").awaitTermination()
    return round_doubles(spark.read.schema(out.schema).parquet(f"{run}/gaps"))


_QUERIES = (
    scan_clean, scan_profile, resample_mean, dense_grid, gap_interpolate, resample_hourly, resample_daily, week_view,
    year_view, backtest_slice, ingest_gaps, mad_clip, describe_sensors, describe_orders, correlation_matrix,
    decile_fallback_mask, rolling_median_centered, shutdown_mask, mask_to_periods, shutdown_periods, downtime_totals,
    downtime_pareto, merge_periods, slots_in_periods, exclude_shutdowns, rolling_features, features_between_shutdowns,
    rolling_mad_z, mad_outliers, mad_anomaly_periods, lag_matrix, labels_on_grid, state_names, state_size_gate,
    rows_with_features, state_summary, standardize, centroid_assign, merged_mask, period_attributes, sustained_alert,
    anomaly_lead_time, kmeans_sweep, operating_states, cluster_summary, pca_scatter, state_isolation_forest,
    contextual_anomalies, asof_last_value, walk_forward_origins, walk_forward_origins_late, seasonality_test,
    ar1_expanding, forecast_naive, forecast_seasonal_naive, forecast_union, backtest_metrics, best_model,
    forecast_tail, forecast_gbt, forecast_arima, long_series_grid, long_series_shutdowns, long_series_profile,
    long_series_outliers, long_series_states, stream_resample, stream_gaps, forecast_coverage, backtest_folds, backtest_all,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Shutdown periods on a one-hour grid, for the smallest tables."""
    return shutdown_plan.shutdown_periods(tables.telemetry(spark, folder), FEW_LIMITS, HOURLY)
