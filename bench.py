"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from slotwise import catalog

HEADLINE = (
    "resample_mean", "dense_grid", "gap_interpolate", "describe_sensors", "correlation_matrix", "shutdown_periods",
    "merge_periods", "slots_in_periods", "rolling_features", "features_between_shutdowns", "mad_anomaly_periods",
    "period_attributes", "standardize", "operating_states", "contextual_anomalies", "backtest_metrics",
    "forecast_arima", "forecast_gbt", "stream_resample", "long_series_grid", "long_series_shutdowns",
    "long_series_profile", "long_series_outliers", "long_series_states",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", str(Path("spark-warehouse", "bench").resolve()))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["resample_mean"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
