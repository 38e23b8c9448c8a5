"""Gap reports that come out of the stream itself.

A series keeps its unbroken stretches of readings, a few rows whatever its rate, and a timer at the
start of the second one. When the watermark passes the start of a stretch, no reading can fall into
the gap before it any more: the timer emits the gap and drops the stretch before it. Nothing is
looked up again after the stream has ended, and a restart goes on from the checkpointed state.

Readings are merged into stretches before the shuffle, one row per series, Arrow batch and stretch,
so that a series with a large share of all readings sends its state's task little.

The state needs a store with timers; ``timer_session`` gives a session that has one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from slotwise.functions.timeslots import minutes_between
from slotwise.params import SERIES, TS
from slotwise.streaming.resample import instants, wall

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Stretch = tuple[int, int]


def timer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        value = spark.conf.get(key, None)
        if value is not None:
            session.conf.set(key, value)
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


def merged(stretches: list[Stretch], most: int) -> list[Stretch]:
    """Stretches in order; those at most ``most`` apart become one."""
    out: list[Stretch] = []
    for first, last in sorted(stretches):
        if out and first - out[-1][1] <= most:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def closed(stretches: list[Stretch], passed: int) -> tuple[list[Stretch], list[Stretch]]:
    """Gaps that end at or before ``passed``, and the stretches that are still needed."""
    done = sum(1 for first, _ in stretches[1:] if first <= passed)
    return [(a[1], b[0]) for a, b in zip(stretches, stretches[1 : done + 1])], stretches[done:]


class GapProcessor(StatefulProcessor):
    """Keeps the stretches of one series; times are microseconds."""

    def __init__(self, most: int) -> None:
        self._most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._stretches = handle.getListState("stretches", "first long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self._known()
        waited = known[1:2]
        for pdf in rows:
            known = merged(known + list(zip(pdf["first"].astype("int64").tolist(), pdf["last"].astype("int64").tolist())), self._most)
        self._stretches.put(known)
        if known[1:2] != waited:
            self._wait(known)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gaps, rest = closed(self._known(), timerValues.getCurrentWatermarkInMs() * 1000)
        if gaps:
            self._stretches.put(rest)
            self._wait(rest)
            yield pd.DataFrame({SERIES: [key[0]] * len(gaps), "start": [a for a, _ in gaps], "end": [b for _, b in gaps]})

    def _known(self) -> list[Stretch]:
        return [(int(a), int(b)) for a, b in self._stretches.get()]

    def _wait(self, known: list[Stretch]) -> None:
        """For the first whole millisecond after the start of the second stretch; a timer that an
        earlier stretch has overtaken finds nothing to do."""
        if len(known) > 1:
            self._handle.registerTimer(known[1][0] // 1000 + 1)

    def close(self) -> None:
        pass


def stream_gap_report(readings: DataFrame, max_gap_min: float, *, lateness: str) -> DataFrame:
    """Gaps longer than ``max_gap_min`` per series, ``gap_start, gap_end, gap_min``, each emitted once,
    when the watermark has passed its end. Readings later than ``lateness`` are dropped unless they
    lengthen a stretch that is still kept."""
    most = round(max_gap_min * 60_000_000)
    key = readings.schema[SERIES].dataType.simpleString()

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf.sort_values("at", kind="stable")
            parts = []
            for _, own in pdf.groupby(SERIES, sort=False, dropna=False):
                at = own["at"].to_numpy()
                cut = np.flatnonzero(np.diff(at) > most)
                parts.append(pd.DataFrame({
                    SERIES: own[SERIES].iloc[0], "first": at[np.concatenate([[0], cut + 1])], "last": at[np.concatenate([cut, [len(at) - 1]])]
                }))
            yield pd.concat(parts)

    micros = instants(readings).select(SERIES, F.unix_micros(TS).alias("at")).filter(F.col("at").isNotNull())
    compact = micros.mapInPandas(stretches, f"`{SERIES}` {key}, first long, last long")
    timed = compact.withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", lateness)
    found = timed.groupBy(SERIES).transformWithStateInPandas(
        GapProcessor(most), f"`{SERIES}` {key}, start long, end long", "Append", "EventTime"
    )
    found = found.select(SERIES, *[F.timestamp_micros(c).alias(c) for c in ("start", "end")])
    found = found.select(SERIES, wall("start").alias("gap_start"), wall("end").alias("gap_end"))
    return found.withColumn("gap_min", minutes_between("gap_start", "gap_end"))
