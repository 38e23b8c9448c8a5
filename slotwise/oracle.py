"""SQL statements that give the same answers as the catalog, written the plain way.

They are independent of the operators: global windows per series, range joins and correlated
lookups, which are fine for a check on small tables.
"""

from __future__ import annotations

from slotwise.sources.tables import EMBEDDING_SIZE, LONG_SENSORS, SENSORS, TARGET

STEP = 300
FILL = 12
WIDE = ", ".join(SENSORS)


def rnd(x: str, places: int = 6) -> str:
    scale = f"{10**places}.0::DOUBLE"
    return f"CASE WHEN NOT isnan(({x})::DOUBLE) THEN floor(({x}) * {scale} + 0.5001) / {scale} END"


def rounded(columns, places: int = 6) -> str:
    return ", ".join(f"{rnd(c, places)} AS {c}" for c in columns)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RAW = "raw AS (SELECT user_id % 4 AS series_id, ts, {} FROM events)".format(
    ", ".join(f"CASE WHEN event_type = '{s}' THEN value END AS {s}" for s in SENSORS)
)
DAILY_RAW = (
    "raw AS (SELECT l_returnflag AS series_id, l_shipdate AS ts, l_extendedprice AS price, l_quantity AS quantity"
    " FROM lineitem)"
)


def grid_ctes(raw: str = RAW, sensors=SENSORS, step: int = STEP, fill: int = FILL) -> list[str]:
    """raw -> slots (means) -> dense (all slots) -> grid (interpolated)."""
    interval = f"INTERVAL {step} SECOND"
    means = ", ".join(f"avg({c}) AS {c}" for c in sensors)
    slots = (
        f"slots AS (SELECT series_id, epoch_us(ts) // {step * 1000000} AS slot, {means} FROM raw GROUP BY ALL)"
    )
    dense = (
        "dense AS (SELECT b.series_id, b.slot, TIMESTAMP '1970-01-01' + b.slot * " + interval + " AS ts, "
        + ", ".join(sensors)
        + " FROM (SELECT series_id, unnest(generate_series(min(slot), max(slot))) AS slot FROM slots GROUP BY series_id) b"
        " LEFT JOIN slots s ON s.series_id = b.series_id AND s.slot = b.slot)"
    )
    back = "OVER (PARTITION BY series_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (PARTITION BY series_id ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    anchors = ", ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN slot END IGNORE NULLS) {back} AS pt_{c}, "
        f"last_value({c} IGNORE NULLS) {back} AS pv_{c}, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN slot END IGNORE NULLS) {ahead} AS nt_{c}, "
        f"first_value({c} IGNORE NULLS) {ahead} AS nv_{c}"
        for c in sensors
    )
    cells = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN slot - pt_{c} <= {fill} OR nt_{c} - slot <= {fill} THEN "
        f"coalesce(pv_{c} + (nv_{c} - pv_{c}) * (CAST(slot - pt_{c} AS DOUBLE) / CAST(nt_{c} - pt_{c} AS DOUBLE)), "
        f"pv_{c}, nv_{c}) END AS {c}"
        for c in sensors
    )
    return [
        raw, slots, dense, f"anchors AS (SELECT *, {anchors} FROM dense)",
        f"grid AS (SELECT series_id, slot, ts, {cells} FROM anchors)",
    ]


GRID = grid_ctes()
W = "PARTITION BY series_id ORDER BY slot"


LONG_RAW = (
    "raw AS (SELECT 0::BIGINT AS series_id, l_shipdate + ((l_orderkey * 7 + l_linenumber * 13) % 288) * INTERVAL 5 MINUTE AS ts,"
    " l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem)"
)
LONG_GRID = grid_ctes(LONG_RAW, LONG_SENSORS)


def median_cte(source: str = "grid", sensors=SENSORS) -> str:
    frame = f"OVER ({W} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)"
    cells = ", ".join(f"CASE WHEN count({c}) {frame} >= 2 THEN median({c}) {frame} END AS {c}" for c in sensors)
    return f"smooth AS (SELECT series_id, slot, ts, {cells} FROM {source})"


def all_below(limit: float) -> str:
    return " AND ".join(f"coalesce({c} <= {limit}, false)" for c in SENSORS)


def island_ctes(source: str, mask: str, name: str, extra: str = "") -> list[str]:
    """Runs of ``mask`` over a dense source, by the difference of row numbers."""
    return [
        f"{name}_rows AS (SELECT *, slot - row_number() OVER (PARTITION BY series_id ORDER BY slot) AS run"
        f" FROM {source} WHERE {mask})",
        f"{name} AS (SELECT series_id, min(ts) AS start, max(ts) AS \"end\","
        f" epoch(max(ts) - min(ts)) / 60.0 AS duration_min{extra} FROM {name}_rows GROUP BY series_id, run)",
    ]


SHUTDOWN = [
    *GRID, median_cte(), f"masked AS (SELECT series_id, slot, ts, {all_below(55.0)} AS \"off\" FROM smooth)",
    *island_ctes("masked", '"off"', "runs"),
    "down AS (SELECT * FROM runs WHERE duration_min >= 30)",
]
PERIOD = f'series_id, start, "end", {rnd("duration_min")} AS duration_min'


def feature_cells(c: str, window: str) -> str:
    parts = [f"{c} - lag({c}) OVER ({window}) AS {c}_diff1"]
    for minutes, rows in ((15, 3), (30, 6), (60, 12)):
        frame = f"OVER ({window} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
        enough = f"CASE WHEN count({c}) {frame} >= {rows // 2} THEN"
        parts.append(f"{enough} avg({c}) {frame} END AS {c}_mean_{minutes}m")
        parts.append(f"{enough} stddev_samp({c}) {frame} END AS {c}_std_{minutes}m")
    return ", ".join(parts)


def feature_columns(sensors) -> list[str]:
    return [
        f"{c}_{tail}"
        for c in sensors
        for tail in ("diff1", "mean_15m", "std_15m", "mean_30m", "std_30m", "mean_60m", "std_60m")
    ]


def features(source: str, sensors) -> str:
    names = feature_columns(sensors)
    cells = ", ".join(feature_cells(c, W) for c in sensors)
    some_null = " OR ".join(f"{n} IS NULL" for n in names)
    return f"features AS (SELECT * FROM (SELECT series_id, slot, ts, {cells} FROM {source}) WHERE NOT ({some_null}))"


def mad_z_ctes(target: str = TARGET) -> list[str]:
    return [
        f"med AS (SELECT series_id, slot, ts, {target}, CASE WHEN count({target}) OVER f >= 1 THEN median({target}) OVER f END"
        f" AS med FROM grid WINDOW f AS ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))",
        f"dev AS (SELECT *, abs({target} - med) AS dev FROM med)",
        f"mads AS (SELECT * EXCLUDE dev, nullif(median(dev) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS mad"
        " FROM dev)",
        f"scored AS (SELECT *, abs(({target} - med) / mad) AS z FROM mads)",
        "flags AS (SELECT *, coalesce(z > 6, false) AS mad_flag FROM scored)",
    ]


MAD_Z = mad_z_ctes()


def clip_ctes(sensors=SENSORS) -> list[str]:
    wide = ", ".join(sensors)
    return [
        f"cells AS (UNPIVOT (SELECT series_id, {wide} FROM grid) ON {wide} INTO NAME sensor VALUE v)",
        "medians AS (SELECT series_id, sensor, quantile_cont(v, 0.5) AS med FROM cells GROUP BY ALL)",
        "limits AS (SELECT series_id, sensor, any_value(med) AS med, nullif(quantile_cont(abs(v - med), 0.5), 0) AS mad"
        " FROM cells JOIN medians USING (series_id, sensor) GROUP BY ALL)",
        "clipped AS (SELECT g.series_id, g.slot, g.ts, "
        + ", ".join(
            f"CASE WHEN g.{c} IS NULL THEN NULL WHEN l_{c}.mad IS NULL THEN g.{c} ELSE least(greatest(g.{c},"
            f" l_{c}.med - 5.0 * l_{c}.mad), l_{c}.med + 5.0 * l_{c}.mad) END AS {c}"
            for c in sensors
        )
        + " FROM grid g "
        + " ".join(f"LEFT JOIN limits l_{c} ON l_{c}.series_id = g.series_id AND l_{c}.sensor = '{c}'" for c in sensors)
        + ")",
        f"long AS (UNPIVOT (SELECT series_id, {wide} FROM clipped) ON {wide} INTO NAME sensor VALUE v)",
    ]


CLIP = [*GRID, *clip_ctes()]
PROBS = ((0.01, "p01"), (0.05, "p05"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"), (0.99, "p99"))


def describe(source: str, places: int = 6) -> str:
    quantiles = ", ".join(f"{rnd(f'quantile_cont(v, {p})', places)} AS {name}" for p, name in PROBS)
    return (
        f"SELECT series_id, sensor, count(v) AS count, {rnd('avg(v)', places)} AS mean,"
        f" {rnd('stddev_samp(v)', places)} AS std, {rnd('min(v)', places)} AS min, {quantiles},"
        f" {rnd('max(v)', places)} AS max FROM {source} GROUP BY series_id, sensor"
    )


LABELS = (
    f"labels AS (SELECT series_id, slot, ts, CAST(least(floor({TARGET} / 40.0), 3) AS INTEGER) AS cluster FROM grid"
    f" WHERE {TARGET} IS NOT NULL)"
)
FLAGGED = [
    *GRID, LABELS, *MAD_Z,
    "slots_flagged AS (SELECT f.series_id, f.slot, f.ts, l.cluster AS state, f.mad_flag,"
    " coalesce(g.error / 100.0 - 1.5 > 0, false) AS forest_flag, g.error / 100.0 - 1.5 AS score,"
    " f.mad_flag OR coalesce(g.error / 100.0 - 1.5 > 0, false) AS anomalous"
    " FROM flags f JOIN grid g USING (series_id, slot) LEFT JOIN labels l USING (series_id, slot))",
]


def recent_ctes(season_corr: float = 0.3) -> list[str]:
    """Trailing slice, values around every slot, origins, and the three window forecasts."""
    return [
        *GRID,
        "last_day AS (SELECT series_id, date_trunc('day', max(ts)) AS day FROM grid GROUP BY 1)",
        f"recent AS (SELECT g.series_id, g.slot, g.ts, g.{TARGET} AS y FROM grid g JOIN last_day d USING (series_id)"
        " WHERE g.ts >= d.day - INTERVAL 90 DAY)",
        f"around AS (SELECT *, lead(y, 12) OVER w AS y_true, lag(y, 276) OVER w AS y_season, lag(y) OVER w AS x,"
        f" lag(y, 288) OVER w AS y_day, last_value(y IGNORE NULLS) OVER w AS y_last,"
        f" slot - min(slot) OVER (PARTITION BY series_id) AS ordinal,"
        f" count(*) OVER (PARTITION BY series_id) AS n_slots FROM recent WINDOW w AS ({W}))",
        f"fitted AS (SELECT *, regr_slope(y, x) OVER w AS slope, regr_intercept(y, x) OVER w AS intercept"
        f" FROM around WINDOW w AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
        "origins AS (SELECT *, pow(slope, 12) * y + intercept * CASE WHEN slope = 1 THEN 12 ELSE"
        " (1 - pow(slope, 12)) / (1 - slope) END AS ar1 FROM fitted"
        " WHERE ordinal >= 288 AND (ordinal - 288) % 12 = 0 AND ordinal < n_slots - 12)",
        "seasons AS (SELECT series_id, corr(y, y_day) AS corr, coalesce(corr(y, y_day) >= "
        f"{season_corr}, false) AS is_seasonal FROM around WHERE y IS NOT NULL AND y_day IS NOT NULL GROUP BY 1)",
        "flagged_origins AS (SELECT o.*, coalesce(s.is_seasonal, false) AS is_seasonal FROM origins o"
        " LEFT JOIN seasons s USING (series_id))",
        "predicted AS ("
        "SELECT series_id, ts AS origin, ts + INTERVAL 1 HOUR AS ts, 'naive' AS model, y_true, y_last AS y_pred FROM flagged_origins"
        " UNION ALL SELECT series_id, ts, ts + INTERVAL 1 HOUR, CASE WHEN is_seasonal THEN 'seasonal_naive'"
        " ELSE 'seasonal_naive_disabled' END, y_true, CASE WHEN is_seasonal THEN y_season END FROM flagged_origins"
        " UNION ALL SELECT series_id, ts, ts + INTERVAL 1 HOUR, 'ar1', y_true, ar1 FROM flagged_origins)",
        "done AS (SELECT * FROM predicted WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)",
        "metrics AS (SELECT series_id, model, avg(abs(y_true - y_pred)) AS mae,"
        " sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, count(*) AS n FROM done GROUP BY 1, 2)",
        "best AS (SELECT * FROM metrics QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY rmse, model) = 1)",
    ]


FORECAST = "series_id, origin, ts, model"


SPANS = (
    "spans AS (SELECT user_id % 4 AS series_id, ts AS start,"
    ' ts + CAST(floor(value / 10) AS INTEGER) * INTERVAL 1 MINUTE AS "end" FROM events)'
)


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    g = with_(*GRID)
    hourly = with_(*grid_ctes(step=3600))
    daily_grid = grid_ctes(DAILY_RAW, ("price", "quantity"), 86400, 1)
    daily = with_(*daily_grid)
    measures = rounded(("price", "quantity"), 4)
    wide = rounded(SENSORS)

    sql["scan_clean"] = (
        f"SELECT user_id % 4 AS series_id, ts, {rnd("CASE WHEN event_type <> 'error' THEN value END")} AS reading,"
        " CAST(event_id AS DOUBLE) AS counter, CAST(NULL AS DOUBLE) AS kind FROM events WHERE user_id % 17 <> 0"
    )
    sql["scan_profile"] = (
        "SELECT user_id % 4 AS series_id, count(*) AS readings, min(ts) AS first_ts, max(ts) AS last_ts,"
        f" epoch_us(max(ts)) // {STEP * 1000000} - epoch_us(min(ts)) // {STEP * 1000000} + 1 AS grid_slots FROM events GROUP BY 1"
    )
    sql["resample_mean"] = g + f"SELECT series_id, TIMESTAMP '1970-01-01' + slot * INTERVAL {STEP} SECOND AS ts, {wide} FROM slots"
    sql["dense_grid"] = g + f"SELECT series_id, ts, {wide} FROM dense"
    sql["gap_interpolate"] = g + f"SELECT series_id, ts, {wide} FROM grid"
    sql["resample_hourly"] = hourly + f"SELECT series_id, ts, {wide} FROM grid"
    sql["resample_daily"] = daily + f"SELECT series_id, ts, {measures} FROM grid"
    sql["week_view"] = with_(*CLIP) + (
        f"SELECT series_id, ts, {rnd(TARGET)} AS {TARGET} FROM clipped"
        f" QUALIFY row_number() OVER ({W}) <= {7 * 86400 // STEP}"
    )
    sql["year_view"] = with_(*daily_grid, *clip_ctes(("price", "quantity"))) + (
        f"SELECT series_id, ts, {measures} FROM clipped QUALIFY row_number() OVER ({W}) <= 365"
    )
    sql["backtest_slice"] = daily + (
        f"SELECT series_id, ts, {measures} FROM grid"
        " QUALIFY ts >= date_trunc('day', max(ts) OVER (PARTITION BY series_id)) - INTERVAL 90 DAY"
    )
    sql["ingest_gaps"] = (
        "SELECT series_id, gap_start, ts AS gap_end, " + rnd("(epoch_us(ts) - epoch_us(gap_start)) / 60e6")
        + " AS gap_min FROM (SELECT user_id % 4 AS series_id, ts, lag(ts) OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id)"
        " AS gap_start FROM events) WHERE ts - gap_start > INTERVAL 15 MINUTE"
    )

    clip = with_(*CLIP)
    sql["mad_clip"] = clip + f"SELECT series_id, ts, {wide} FROM clipped"
    sql["describe_sensors"] = clip + describe("long")
    sql["describe_orders"] = with_(
        "long AS (SELECT o_orderpriority AS series_id, 'price' AS sensor, o_totalprice AS v FROM orders)"
    ) + describe("long", 4)
    sql["correlation_matrix"] = clip + " UNION ALL ".join(
        f"SELECT series_id, '{a}' AS sensor_a, '{b}' AS sensor_b, {rnd(f'corr({a}, {b})')} AS corr FROM clipped"
        f" WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1"
        for a in SENSORS
        for b in SENSORS
    ) + " UNION ALL " + " UNION ALL ".join(
        f"SELECT series_id, '{a}' AS sensor_a, '{b}' AS sensor_b, CAST(NULL AS DOUBLE) AS corr FROM clipped GROUP BY 1"
        for a, b in [*[("stuck", c) for c in SENSORS], *[(c, "stuck") for c in SENSORS], ("stuck", "stuck")]
    )
    sql["decile_fallback_mask"] = with_(*GRID, median_cte()) + (
        f"SELECT g.series_id, ts, coalesce({TARGET} <= cut, false) AS \"off\" FROM smooth g JOIN"
        f" (SELECT series_id, quantile_cont({TARGET}, 0.1) AS cut FROM smooth GROUP BY 1) c ON c.series_id = g.series_id"
    )

    down = with_(*SHUTDOWN)
    sql["rolling_median_centered"] = down + f"SELECT series_id, ts, {wide} FROM smooth"
    sql["shutdown_mask"] = down + 'SELECT series_id, ts, "off" FROM masked'
    sql["mask_to_periods"] = down + f"SELECT {PERIOD} FROM runs"
    sql["shutdown_periods"] = down + f"SELECT {PERIOD}, 'below_thresholds' AS reason FROM down"
    sql["downtime_totals"] = down + (
        f"SELECT series_id, count(*) AS periods, {rnd('sum(duration_min)')} AS downtime_min FROM down GROUP BY 1"
    )
    sql["downtime_pareto"] = with_(
        *SHUTDOWN,
        "bands AS (SELECT series_id, CAST((duration_min >= 45)::INT + (duration_min >= 60)::INT + (duration_min >= 90)::INT"
        " AS INTEGER) AS band, count(*) AS periods, sum(duration_min) AS downtime_min FROM down GROUP BY 1, 2)",
    ) + (
        f"SELECT series_id, band, periods, {rnd('downtime_min')} AS downtime_min,"
        f" {rnd('downtime_min / sum(downtime_min) OVER (PARTITION BY series_id)')} AS share,"
        f" {rnd('sum(downtime_min) OVER (PARTITION BY series_id ORDER BY downtime_min DESC, band ROWS UNBOUNDED PRECEDING) / sum(downtime_min) OVER (PARTITION BY series_id)')}"
        " AS running_share FROM bands"
    )
    sql["merge_periods"] = with_(
        SPANS,
        "opened AS (SELECT *, CASE WHEN start <= max(\"end\") OVER (PARTITION BY series_id ORDER BY start, \"end\""
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM spans)",
        "grouped AS (SELECT *, sum(opens) OVER (PARTITION BY series_id ORDER BY start, \"end\" ROWS UNBOUNDED PRECEDING) AS grp FROM opened)",
    ) + (
        'SELECT series_id, min(start) AS start, max("end") AS "end",'
        f" {rnd('(epoch_us(max(\"end\")) - epoch_us(min(start))) / 60e6')} AS duration_min FROM grouped GROUP BY series_id, grp"
    )
    sql["slots_in_periods"] = with_(*GRID, SPANS) + (
        "SELECT d.series_id, d.ts, EXISTS (SELECT 1 FROM spans s WHERE s.series_id = d.series_id AND d.ts >= s.start"
        ' AND d.ts <= s."end") AS inside FROM dense d'
    )
    outside = (
        "running AS (SELECT g.* FROM grid g WHERE NOT EXISTS (SELECT 1 FROM down p WHERE p.series_id = g.series_id"
        ' AND g.ts >= p.start AND g.ts <= p."end"))'
    )
    sql["exclude_shutdowns"] = with_(*SHUTDOWN, outside) + f"SELECT series_id, ts, {wide} FROM running"

    sql["rolling_features"] = with_(*GRID, features("grid", SENSORS)) + (
        f"SELECT series_id, ts, {rounded(feature_columns(SENSORS))} FROM features"
    )
    sql["features_between_shutdowns"] = with_(*SHUTDOWN, outside, features("running", SENSORS)) + (
        f"SELECT series_id, ts, {rounded(feature_columns(SENSORS))} FROM features"
    )
    z = with_(*GRID, *MAD_Z)
    sql["rolling_mad_z"] = z + f"SELECT series_id, ts, {rounded((TARGET, 'med', 'mad', 'z'), 4)} FROM scored"
    sql["mad_outliers"] = z + "SELECT series_id, ts, mad_flag FROM flags"
    mad_runs = island_ctes("flags", "mad_flag", "odd")
    sql["mad_anomaly_periods"] = with_(*GRID, *MAD_Z, *mad_runs) + f"SELECT {PERIOD} FROM odd"
    lags = [f"lag_{i}" for i in range(1, 37)]
    lag_cells = ", ".join(f"lag({TARGET}, {i}) OVER w AS lag_{i}" for i in range(1, 37))
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ["y", *lags, "y_ahead"])
    sql["lag_matrix"] = g + (
        f"SELECT series_id, ts, {rounded(['y', *lags, 'y_ahead'])} FROM (SELECT series_id, ts, {TARGET} AS y, {lag_cells},"
        f" lead({TARGET}, 12) OVER w AS y_ahead FROM grid WINDOW w AS ({W})) WHERE {complete}"
    )

    labelled = with_(*GRID, LABELS)
    sql["labels_on_grid"] = labelled + (
        "SELECT g.series_id, g.ts, CAST(l.cluster AS DOUBLE) AS cluster FROM grid g LEFT JOIN labels l ON l.series_id = g.series_id AND l.ts = g.ts"
    )
    sql["state_names"] = labelled + (
        "SELECT series_id, ts, cluster, CASE cluster WHEN 0 THEN 'Low' WHEN 1 THEN 'Normal' WHEN 2 THEN 'High' ELSE 'State' END"
        " AS state_name FROM labels"
    )
    sql["state_size_gate"] = labelled + (
        "SELECT * FROM (SELECT series_id, ts, cluster, count(*) OVER (PARTITION BY series_id, cluster) AS rows_in_state FROM labels)"
        " WHERE rows_in_state >= 200"
    )
    sql["rows_with_features"] = with_(*GRID, features("grid", SENSORS)) + (
        f"SELECT series_id, ts, {wide} FROM grid g WHERE EXISTS (SELECT 1 FROM features f WHERE f.series_id = g.series_id AND f.slot = g.slot)"
    )
    sql["state_summary"] = with_(
        *GRID, LABELS,
        f"long AS (UNPIVOT (SELECT g.series_id, l.cluster, {', '.join('g.' + c for c in SENSORS)} FROM grid g JOIN labels l"
        f" USING (series_id, slot)) ON {WIDE} INTO NAME sensor VALUE v)",
        "pairs AS (SELECT DISTINCT series_id, cluster, unnest([" + ", ".join(f"'{c}'" for c in SENSORS) + "]) AS sensor FROM labels)",
    ) + (
        f"SELECT p.series_id, p.cluster, p.sensor, {rnd('avg(v)')} AS mean, {rnd('stddev_samp(v)')} AS std,"
        f" {rnd('quantile_cont(v, 0.5)')} AS median, {rnd('min(v)')} AS min, {rnd('max(v)')} AS max"
        " FROM pairs p LEFT JOIN long l ON l.series_id = p.series_id AND l.cluster = p.cluster AND l.sensor = p.sensor GROUP BY 1, 2, 3"
    )
    scale = ", ".join(
        f"{rnd(f'(l_{c} - avg(l_{c}) OVER w) / stddev_pop(l_{c}) OVER w', 5)} AS {c}"
        for c in ("quantity", "extendedprice", "discount", "tax")
    )
    sql["standardize"] = (
        f"SELECT l_returnflag AS series_id, l_orderkey, l_linenumber, {scale} FROM lineitem"
        " WINDOW w AS (PARTITION BY l_returnflag)"
    )
    gap = " + ".join(f"pow(e.embedding[{i}]::DOUBLE - c.x{i}, 2)" for i in range(1, EMBEDDING_SIZE + 1))
    means = ", ".join(f"avg(embedding[{i}]::DOUBLE) AS x{i}" for i in range(1, EMBEDDING_SIZE + 1))
    sql["centroid_assign"] = with_(
        f"centres AS (SELECT label, {means} FROM embeddings GROUP BY label)",
        f"gaps AS (SELECT e.vec_id, c.label AS cluster, {gap} AS d FROM embeddings e, centres c)",
    ) + (
        f"SELECT vec_id, cluster, {rnd('sqrt(d)', 5)} AS distance FROM gaps"
        " QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1"
    )
    flagged = with_(*FLAGGED)
    sql["merged_mask"] = flagged + "SELECT series_id, ts, mad_flag, forest_flag, anomalous FROM slots_flagged"
    sql["period_attributes"] = with_(
        *FLAGGED,
        *island_ctes(
            "slots_flagged", "anomalous", "odd",
            ", run, bool_or(mad_flag) AS m, bool_or(forest_flag) AS f, avg(score) AS score",
        ),
        "modes AS (SELECT series_id, run, state FROM (SELECT series_id, run, state, count(*) AS k FROM odd_rows WHERE state IS NOT NULL"
        " GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY series_id, run ORDER BY k DESC, state) = 1)",
    ) + (
        f'SELECT o.series_id, start, "end", {rnd("duration_min")} AS duration_min, coalesce(m2.state, -1) AS state,'
        f" CASE WHEN m AND f THEN 'Both' WHEN f THEN 'IForest' ELSE 'MAD' END AS method, {rnd('score')} AS score"
        " FROM odd o LEFT JOIN modes m2 ON m2.series_id = o.series_id AND m2.run = o.run"
    )
    sql["sustained_alert"] = with_(*GRID, *MAD_Z, *island_ctes("flags", "coalesce(z > 0.9, false)", "alerts")) + (
        f"SELECT {PERIOD} FROM alerts WHERE duration_min >= 15"
    )
    sql["anomaly_lead_time"] = with_(*SHUTDOWN, *MAD_Z, *mad_runs) + (
        'SELECT series_id, start, "end", next_start, '
        + rnd('epoch(next_start - "end") / 60.0')
        + ' AS lead_min FROM (SELECT series_id, start, "end", (SELECT min(d.start) FROM down d WHERE d.series_id = o.series_id'
        ' AND d.start >= o."end") AS next_start FROM odd o)'
    )

    sql["asof_last_value"] = g + (
        f"SELECT series_id, ts, {rnd(TARGET)} AS y, {rnd(f'last_value({TARGET} IGNORE NULLS) OVER ({W})')} AS y_last FROM dense"
    )
    back = with_(*recent_ctes())
    sql["walk_forward_origins"] = back + f"SELECT series_id, ts, {rnd('y')} AS y, ordinal FROM origins"
    sql["walk_forward_origins_late"] = back + (
        f"SELECT o.series_id, ts, {rnd('y')} AS y, ordinal FROM origins o JOIN last_day d USING (series_id) WHERE ts >= day - INTERVAL 10 DAY"
    )
    sql["seasonality_test"] = back + f"SELECT series_id, {rnd('corr')} AS corr, is_seasonal FROM seasons"
    sql["ar1_expanding"] = back + f"SELECT series_id, ts, {rounded(('slope', 'intercept', 'ar1'), 4)} FROM origins"
    both = rounded(("y_true", "y_pred"))
    both4 = rounded(("y_true", "y_pred"), 4)
    sql["forecast_naive"] = back + f"SELECT {FORECAST}, {both} FROM done WHERE model = 'naive'"
    sql["forecast_seasonal_naive"] = with_(*recent_ctes(-1.0)) + f"SELECT {FORECAST}, {both} FROM done WHERE model LIKE 'seasonal%'"
    sql["forecast_union"] = back + f"SELECT {FORECAST}, {both4} FROM predicted"
    sql["backtest_metrics"] = back + f"SELECT series_id, model, {rounded(('mae', 'rmse'), 4)}, n FROM metrics"
    sql["backtest_folds"] = with_(
        *recent_ctes(),
        "dealt AS (SELECT *, CAST(floor((epoch(origin) - min(epoch(origin)) OVER (PARTITION BY series_id)) / 604800) AS INTEGER) AS fold FROM done)",
        "by_fold AS (SELECT series_id, model, fold, avg(abs(y_true - y_pred)) AS mae,"
        " sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, count(*) AS n FROM dealt"
        " GROUP BY GROUPING SETS ((series_id, model, fold), (series_id, model)))",
    ) + f"SELECT series_id, model, fold, {rounded(('mae', 'rmse'), 4)}, n FROM by_fold"
    sql["best_model"] = back + f"SELECT series_id, model, {rounded(('mae', 'rmse'), 4)}, n FROM best"
    sql["forecast_tail"] = back + (
        f"SELECT series_id, origin, ts, d.model, {both4} FROM done d JOIN best b USING (series_id) WHERE d.model = b.model"
        " QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 2016"
    )
    sql["long_series_grid"] = with_(*LONG_GRID) + f"SELECT series_id, ts, {rounded(LONG_SENSORS, 4)} FROM grid"
    sql["long_series_shutdowns"] = with_(
        *LONG_GRID, median_cte(sensors=("quantity", "price")),
        "masked AS (SELECT series_id, slot, ts, coalesce(quantity <= 25, false) AND coalesce(price <= 35000, false) AS \"off\" FROM smooth)",
        *island_ctes("masked", '"off"', "runs"),
    ) + f"SELECT {PERIOD}, 'below_thresholds' AS reason FROM runs WHERE duration_min >= 30"
    sql["long_series_profile"] = with_(*LONG_GRID, *clip_ctes(LONG_SENSORS)) + describe("long", 4)
    sql["long_series_outliers"] = with_(
        *LONG_GRID, *mad_z_ctes("quantity"), *island_ctes("flags", "mad_flag", "odd")
    ) + f"SELECT {PERIOD} FROM odd"
    sql["stream_resample"] = g + (
        f"SELECT series_id, TIMESTAMP '1970-01-01' + slot * INTERVAL {STEP} SECOND AS ts, {wide} FROM slots"
        f" WHERE TIMESTAMP '1970-01-01' + (slot + 1) * INTERVAL {STEP} SECOND <="
        " (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 30 MINUTE FROM events)"
    )
    sql["forecast_coverage"] = back + (
        "SELECT series_id, count(*) AS origins, count(CASE WHEN y_true IS NOT NULL AND seen >= 35 THEN 1 END) AS arima"
        " FROM origins JOIN (SELECT series_id, slot, count(y) OVER (PARTITION BY series_id ORDER BY slot) AS seen FROM recent)"
        " USING (series_id, slot) GROUP BY 1"
    )
    sql["stream_gaps"] = with_(
        "marked AS (SELECT user_id % 4 AS series_id, ts, lag(ts) OVER (PARTITION BY user_id % 4 ORDER BY ts) AS before FROM events)",
        "passed AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 30 MINUTE AS mark FROM events)",
    ) + (
        "SELECT series_id, before AS gap_start, ts AS gap_end, " + rnd("(epoch_us(ts) - epoch_us(before)) / 60e6")
        + " AS gap_min FROM marked, passed WHERE ts - before > INTERVAL 15 MINUTE AND ts < mark"
    )
    return sql
