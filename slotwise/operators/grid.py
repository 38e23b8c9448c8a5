"""Fixed time grid: slot means, dense slots, limited interpolation, range views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.chunks import CHUNK, Carry, attach, carry, chunk_of
from slotwise.functions.timeslots import slot_of, slot_start
from slotwise.params import DAY_SECONDS, SERIES, TS, Params

SLOT = "slot"
_BLOCK = 65_536


def sensor_columns(df: DataFrame, expected: Sequence[str] = (), target: str | None = None) -> list[str]:
    """Expected sensors that exist, else the target if it exists, else every sensor."""
    present = [c for c in expected if c in df.columns]
    if present:
        return present
    if target in df.columns:
        return [target]
    return [c for c in df.columns if c not in (SERIES, TS, SLOT, CHUNK)]


def resample_mean(df: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    """Mean of the non-null readings in each non-empty slot."""
    return _slot_means(df.select(SERIES, slot_of(TS, params.step).alias(SLOT), *sensors), sensors, params)


def dense_grid(df: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    """As ``resample_mean``, with a null row for each empty slot between first and last.

    Empty rows for every slot join the readings before the one aggregation, so filling the
    grid needs no join.
    """
    # Stated here, the filter is not inferred for one consumer only, and the exchange is reused.
    df = df.filter(F.col(SERIES).isNotNull() & F.col(TS).isNotNull())
    readings = df.select(SERIES, slot_of(TS, params.step).alias(SLOT), *sensors)
    skeleton = slot_skeleton(series_bounds(df, params))
    empty = skeleton.select(SERIES, SLOT, *[F.lit(None).cast("double").alias(c) for c in sensors])
    return _slot_means(readings.unionByName(empty), sensors, params)


def _slot_means(readings: DataFrame, sensors: Sequence[str], params: Params) -> DataFrame:
    means = readings.groupBy(SERIES, SLOT).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in sensors])
    return means.select(SERIES, slot_start(SLOT, params.step).alias(TS), *sensors)


def series_bounds(df: DataFrame, params: Params) -> DataFrame:
    """First and last slot per series."""
    slot = slot_of(TS, params.step)
    return df.groupBy(SERIES).agg(F.min(slot).alias("first_slot"), F.max(slot).alias("last_slot"))


def slot_skeleton(bounds: DataFrame) -> DataFrame:
    """Every slot between the bounds. Blocks are spread before they are unfolded, into a fixed
    number of partitions: the block rows are few bytes, which would tempt AQE to coalesce them."""
    partitions = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = bounds.select(
        SERIES, "first_slot", "last_slot",
        F.explode(F.sequence(F.floor(F.col("first_slot") / _BLOCK), F.floor(F.col("last_slot") / _BLOCK))).alias("_b"),
    ).repartition(partitions, SERIES, "_b")
    return blocks.select(
        SERIES,
        F.explode(
            F.sequence(
                F.greatest("first_slot", F.col("_b") * _BLOCK),
                F.least("last_slot", F.col("_b") * _BLOCK + (_BLOCK - 1)),
            )
        ).alias(SLOT),
    )


def interpolate(df: DataFrame, sensors: Sequence[str], params: Params, *, fill: str = "both") -> DataFrame:
    """Fill null cells of a dense grid along time.

    ``fill="both"``: a cell is filled if a valid slot lies within the limit on either side; the
    value is linear between the neighbours however far apart, or the one neighbour's at a series
    edge. ``fill="short_only"``: only gaps of at most the limit are filled.
    """
    limit = params.slots(params.fill_min)
    specs = {}
    for c in sensors:
        at = f"case when `{c}` is not null then {SLOT} end"
        specs |= {
            f"_pt_{c}": Carry("last", at), f"_pv_{c}": Carry("last", f"`{c}`"),
            f"_nt_{c}": Carry("next", at), f"_nv_{c}": Carry("next", f"`{c}`"),
        }
    rows = df.withColumn(SLOT, slot_of(TS, params.step)).withColumn(CHUNK, chunk_of(SLOT, params.span))
    rows = carry(rows, [SERIES], SLOT, params.span, specs)
    if fill == "both":
        near = "{back} <= {limit} or {ahead} <= {limit}"
    elif fill == "short_only":
        near = "coalesce(`_nt_{c}` - `_pt_{c}` - 1, {back}, {ahead}) <= {limit}"
    else:
        raise ValueError(f"unknown fill {fill!r}")
    filled = []
    for c in sensors:
        back, ahead = f"({SLOT} - `_pt_{c}`)", f"(`_nt_{c}` - {SLOT})"
        line = (
            f"`_pv_{c}` + (`_nv_{c}` - `_pv_{c}`)"
            f" * (cast({back} as double) / cast(`_nt_{c}` - `_pt_{c}` as double))"
        )
        rule = near.format(c=c, back=back, ahead=ahead, limit=limit)
        filled.append(
            f"case when `{c}` is not null then `{c}`"
            f" when {rule} then coalesce({line}, `_pv_{c}`, `_nv_{c}`) end as `{c}`"
        )
    return rows.selectExpr(SERIES, TS, CHUNK, *filled)


def regular_grid(df: DataFrame, sensors: Sequence[str], params: Params, *, fill: str = "both") -> DataFrame:
    """Readings -> dense, interpolated grid (``series_id, ts, chunk, sensors``)."""
    return interpolate(dense_grid(df, sensors, params), sensors, params, fill=fill)


def range_view(df: DataFrame, days: int, params: Params, *, anchor: str = "head") -> DataFrame:
    """The first (``head``) or last (``tail``) ``days`` of slots of each series' dense grid."""
    n = (days * DAY_SECONDS) // params.step
    rows = df.withColumn(SLOT, slot_of(TS, params.step))
    rows = attach(rows, series_bounds(df, params), [SERIES], [TS])
    if anchor == "head":
        keep = F.col(SLOT) - F.col("first_slot") < n
    elif anchor == "tail":
        keep = F.col("last_slot") - F.col(SLOT) < n
    else:
        raise ValueError(f"unknown anchor {anchor!r}")
    return rows.filter(keep).select(*df.columns)


def trailing_slice(df: DataFrame, params: Params) -> DataFrame:
    """Slots from midnight of a series' last day minus the test and training days on."""
    days = params.backtest_days + params.train_days
    last = df.groupBy(SERIES).agg(F.date_sub(F.max(TS).cast("date"), days).cast("timestamp_ntz").alias("_from"))
    return attach(df, last, [SERIES], [TS]).filter(F.col(TS) >= F.col("_from")).select(*df.columns)


def tail_rows(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """Last ``n`` rows per group; Spark limits each partition before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")
