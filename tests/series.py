"""Small series for the tests and their plain pandas treatment."""

from __future__ import annotations

import numpy as np
import pandas as pd

START = pd.Timestamp("2024-03-01")


def frame(spark, pdf: pd.DataFrame):
    """Zone-less timestamps, NaN as null."""
    df = spark.createDataFrame(pdf)
    for c, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(c, df[c].cast("timestamp_ntz"))
        if kind == "double":
            df = df.selectExpr(*[f"nanvl({x}, null) as {x}" if x == c else x for x in df.columns])
    return df


def values(rows: int, *, series: int = 2, holes: float = 0.4, seed: int = 0, step: int = 5) -> pd.DataFrame:
    """Dense slots with missing cells; first and last slot always present."""
    rng = np.random.default_rng(seed)
    parts = []
    for s in range(series):
        v = np.round(rng.gamma(2.0, 20.0, rows), 2)
        v[rng.random(rows) < holes] = np.nan
        ts = START + pd.to_timedelta(np.arange(rows) * step, unit="min")
        parts.append(pd.DataFrame({"series_id": s, "ts": ts, "v": v}))
    return pd.concat(parts, ignore_index=True)


def collected(df, *order: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(int), 0]))
    return [(a, b - 1) for a, b in zip(edges[::2], edges[1::2])]
