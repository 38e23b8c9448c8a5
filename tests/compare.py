"""Runs catalog queries beside their SQL and compares rows as multisets."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == 0:
        return 0.0
    return v.to_pydatetime() if isinstance(v, pd.Timestamp) else v


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    lists = [[_cell(v) for v in frame[c].astype(object)] for c in columns]
    return sorted(zip(*lists), key=repr)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    # pandas holds whole numbers with gaps as floats.
    gappy = {c: t for c, t in sql_frame.dtypes.items() if isinstance(t, pd.api.extensions.ExtensionDtype) and t.kind == "i"}
    spark_frame = spark_frame.astype({c: t for c, t in gappy.items() if spark_frame[c].dtype.kind == "f"})
    a, b = rows_of(spark_frame), rows_of(sql_frame)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from pyspark.sql import SparkSession

    from slotwise import catalog, oracle

    folder = sys.argv[1]
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    checks = oracle.oracle_sql()
    for name, query in catalog.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            got = query(spark, folder).toPandas()
            t1 = time.time()
            verdict = "rows only" if name not in checks else difference(got, con.execute(checks[name]).df()) or "ok"
            print(f"{name:28s} {len(got):7d} {t1 - t:6.1f}s  {verdict}", flush=True)
        except Exception as e:
            print(f"{name:28s} FAILED {type(e).__name__}: {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main()
