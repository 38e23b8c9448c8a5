"""Running independent model fits side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(spark: SparkSession, fit: Callable, settings: Iterable, parallelism: int) -> list:
    """Results in the order of ``settings``. Each fit is a chain of short jobs, so a few of them
    at a time keep the cluster busy."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fit), settings))
