"""Gaps and islands, interval algebra, and joins between periods and slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.chunks import CHUNK, Carry, carry, chunk_of
from slotwise.functions.timeslots import epoch_seconds, epoch_seconds_exact, minutes_between, slot_of
from slotwise.operators.grid import SLOT
from slotwise.params import SERIES, TS, Params

ISLAND = "island"
# Seconds per chunk where rows are ordered by instants instead of slots.
INSTANT_CHUNK = 300


def islands(df: DataFrame, mask: str, params: Params) -> DataFrame:
    """Rows of a dense grid where ``mask`` holds, with the run they belong to.

    A run is named by the last slot before it where the mask fails, which one running ``last``
    finds without a sort over the series.
    """
    rows = df.withColumn(SLOT, slot_of(TS, params.step))
    off = f"case when not coalesce(`{mask}`, false) then {SLOT} end"
    rows = carry(rows, [SERIES], SLOT, params.span, {ISLAND: Carry("last", off)})
    return rows.filter(F.col(mask)).drop(SLOT)


def with_duration(periods: DataFrame) -> DataFrame:
    return periods.withColumn("duration_min", minutes_between("start", "end"))


def mask_to_periods(
    df: DataFrame, mask: str, params: Params, *, attributes: Sequence[Column] = ()
) -> DataFrame:
    """One row per run of true slots: first and last slot, duration between them, and aggregates
    of the slots inside (``attributes``)."""
    if attributes:
        runs = islands(df, mask, params).groupBy(SERIES, ISLAND).agg(
            F.min(TS).alias("start"), F.max(TS).alias("end"), *attributes
        )
    else:
        runs = _runs(df, mask, params)
    lead = [SERIES, "start", "end", "duration_min"]
    runs = with_duration(runs.drop(ISLAND))
    return runs.select(*lead, *[c for c in runs.columns if c not in lead])


def _runs(df: DataFrame, mask: str, params: Params) -> DataFrame:
    """Runs within each chunk first; then only runs that touch a chunk edge, two per chunk at
    most, are looked at across chunks."""
    slot = F.col(SLOT) if SLOT in df.columns else slot_of(TS, params.step).alias(SLOT)
    rows = df.select(SERIES, TS, *([CHUNK] if CHUNK in df.columns else []), F.col(mask).alias("_on"), slot)
    if CHUNK not in rows.columns:
        rows = rows.withColumn(CHUNK, chunk_of(SLOT, params.span))
    whole = Window.partitionBy(SERIES, CHUNK)
    w = whole.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0)
    off = F.when(~F.coalesce(F.col("_on"), F.lit(False)), F.col(SLOT))
    local = (
        rows.withColumns({
            ISLAND: F.last(off, ignorenulls=True).over(w),
            "_first": F.min(SLOT).over(whole), "_last": F.max(SLOT).over(whole),
        })
        .filter("_on")
        .groupBy(SERIES, CHUNK, ISLAND)
        .agg(
            F.min(TS).alias("_from"), F.max(TS).alias("_to"), F.min(SLOT).alias("_a"), F.max(SLOT).alias("_b"),
            F.first("_first").alias("_first"), F.first("_last").alias("_last"),
        )
    )
    # The edges are those of the rows at hand: the grid may have been cut with another span.
    edge = (F.col("_a") == F.col("_first")) | (F.col("_b") == F.col("_last"))
    across = Window.partitionBy(SERIES, "_home").orderBy("_a")
    upto = across.rowsBetween(Window.unboundedPreceding, 0)
    joined = local.withColumn("_home", F.when(~edge, F.col(CHUNK))).withColumn(
        "_opens", F.when(F.coalesce(F.lag("_b").over(across) + 1 != F.col("_a"), F.lit(True)), F.col("_a"))
    )
    return (
        joined.withColumn(ISLAND, F.last("_opens", ignorenulls=True).over(upto))
        .groupBy(SERIES, "_home", ISLAND)
        .agg(F.min("_from").alias("start"), F.max("_to").alias("end"))
        .drop("_home")
    )


def at_least(periods: DataFrame, minutes: float) -> DataFrame:
    return periods.filter(F.col("duration_min") >= minutes)


def merge_periods(periods: DataFrame, *, attributes: Sequence[Column] = ()) -> DataFrame:
    """Union of overlapping or touching periods (next start <= furthest end so far)."""
    if not attributes:
        # Of periods with the same start only the longest matters.
        periods = periods.groupBy(SERIES, "start").agg(F.max("end").alias("end"))
    rows = periods.withColumn("_order", epoch_seconds("start"))
    span = INSTANT_CHUNK
    reach = carry(
        rows.withColumn(CHUNK, chunk_of("_order", span)), [SERIES], "_order", span,
        {"_reach": Carry("max", "end")}, ties=["start", "end"], exclusive=True,
    ).drop(CHUNK)
    opens = "case when _reach is null or start > _reach then start end"
    groups = carry(
        reach.withColumn(CHUNK, chunk_of("_order", span)), [SERIES], "_order", span,
        {"_group": Carry("last", opens)}, ties=["start", "end"],
    )
    merged = groups.groupBy(SERIES, "_group").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), *attributes
    )
    merged = with_duration(merged.drop("_group"))
    lead = [SERIES, "start", "end", "duration_min"]
    return merged.select(*lead, *[c for c in merged.columns if c not in lead])


def mark_periods(df: DataFrame, periods: DataFrame, params: Params, *, name: str = "inside") -> DataFrame:
    """Adds whether a slot of the grid lies in any period, both ends included.

    Sweep line instead of a range join: a period is +1 at its first slot and -1 after its last,
    so long or overlapping periods never multiply rows.
    """
    first = -F.floor(-epoch_seconds_exact("start") / params.step)
    last = F.floor(epoch_seconds_exact("end") / params.step)
    covered = periods.select(SERIES, first.cast("bigint").alias("_a"), last.cast("bigint").alias("_b")).filter("_a <= _b")
    steps = (
        covered.select(
            SERIES,
            F.explode(
                F.array(
                    F.struct(F.col("_a").alias(SLOT), F.lit(1).alias("_d")),
                    F.struct((F.col("_b") + 1).alias(SLOT), F.lit(-1).alias("_d")),
                )
            ).alias("_e"),
        )
        .select(SERIES, F.col(f"_e.{SLOT}").alias(SLOT), F.col("_e._d").alias("_d"))
        .groupBy(SERIES, SLOT)
        .agg(F.sum("_d").alias("_d"))
    )
    rows = df.drop(CHUNK).withColumn(SLOT, slot_of(TS, params.step)).withColumn("_grid", F.lit(True))
    both = rows.unionByName(steps, allowMissingColumns=True).withColumn("_late", F.col("_grid").isNotNull())
    open_count = carry(
        both, [SERIES], SLOT, params.span, {"_open": Carry("sum", "_d")}, ties=["_late"]
    )
    return (
        open_count.filter("_grid")
        .withColumn(name, F.coalesce(F.col("_open") > 0, F.lit(False)))
        .drop("_open", "_d", "_late", "_grid", SLOT)
    )


def exclude_periods(df: DataFrame, periods: DataFrame, params: Params) -> DataFrame:
    """Grid rows outside every period."""
    return mark_periods(df, periods, params, name="_in").filter("not _in").drop("_in")


def labels_on_grid(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of slot labels; slots without one get null."""
    return df.join(labels, [SERIES, TS], "left")


def downtime_totals(periods: DataFrame) -> DataFrame:
    return periods.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("periods"), F.sum("duration_min").alias("downtime_min")
    )


def ingest_gaps(df: DataFrame, minutes: int) -> DataFrame:
    """Pauses longer than ``minutes`` between successive readings.

    Two readings in the same stretch of ``minutes`` cannot be that far apart, so only the first
    and last reading of each stretch are kept before anything is ordered.
    """
    width = minutes * 60
    stretches = df.groupBy(SERIES, slot_of(TS, width).alias("_b")).agg(
        F.min(TS).alias("_first"), F.max(TS).alias("_last")
    )
    span = 4096
    before = carry(stretches, [SERIES], "_b", span, {"gap_start": Carry("last", "_last")}, exclusive=True)
    gaps = before.select(SERIES, "gap_start", F.col("_first").alias("gap_end"))
    gaps = gaps.withColumn("gap_min", minutes_between("gap_start", "gap_end"))
    return gaps.filter(F.col("gap_min") > minutes)


def sustained(df: DataFrame, mask: str, minutes: float, params: Params) -> DataFrame:
    """Runs of the mask that last at least ``minutes``."""
    return at_least(mask_to_periods(df, mask, params), minutes)


def next_start(events: DataFrame, targets: DataFrame) -> DataFrame:
    """For each event period the first target period that starts at or after it ends.

    Both sides are one ordered stream in which every event looks ahead; no join on a range.
    """
    span = INSTANT_CHUNK
    # Many events may end in the same second: their answer is the same, so they share a row.
    ends = events.select(SERIES, F.col("end").alias("_t")).distinct().withColumn("_s", F.lit(None).cast("timestamp_ntz"))
    starts = targets.select(SERIES, F.col("start").alias("_t")).distinct().withColumn("_s", F.col("_t"))
    both = ends.unionByName(starts).groupBy(SERIES, "_t").agg(F.max("_s").alias("_s"))
    both = both.withColumn("_order", epoch_seconds("_t"))
    ahead = carry(both, [SERIES], "_order", span, {"next_start": Carry("next", "_s")}, ties=["_t"])
    return events.join(
        ahead.select(SERIES, F.col("_t").alias("end"), "next_start"), [SERIES, "end"], "left"
    ).withColumn("lead_min", minutes_between("end", "next_start"))


def pareto(periods: DataFrame, edges_min: Sequence[float]) -> DataFrame:
    """Downtime by duration band, largest first, with its share and running share per series."""
    band = F.lit(0)
    for edge in edges_min:
        band = band + (F.col("duration_min") >= edge).cast("int")
    bands = periods.groupBy(SERIES, band.alias("band")).agg(
        F.count(F.lit(1)).alias("periods"), F.sum("duration_min").alias("downtime_min")
    )
    # At most one row per band and series from here on.
    whole = Window.partitionBy(SERIES)
    ranked = whole.orderBy(F.col("downtime_min").desc(), "band").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("downtime_min").over(whole)
    return bands.select(
        SERIES, "band", "periods", "downtime_min",
        (F.col("downtime_min") / F.nullif(total, F.lit(0.0))).alias("share"),
        (F.sum("downtime_min").over(ranked) / F.nullif(total, F.lit(0.0))).alias("running_share"),
    )
