"""Windows over long series, cut into bounded chunks.

A window partitioned by series alone puts the whole of a hot series into one
task. Here every window is partitioned by ``(series, chunk)`` with at most
``span`` rows each:

* frames of bounded reach get the neighbours' boundary rows (``over_chunks``);
* frames without bound get one carried-in row per chunk (``carry``), which comes
  from running over per-chunk summaries, again in chunks.

Both give exactly the result of the unchunked window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK = "chunk"
_OWN = "_own"


def chunk_of(order: str, span: int) -> Column:
    return F.expr(_chunk_sql(order, span))


def over_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    span: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Run ``build(rows, window)`` where frames reach ``before`` / ``after`` steps of ``order``.

    ``order`` must be dense within a series (a slot number on a full grid, or a row
    position), so that a row frame and a range of ``order`` are the same thing. The
    result keeps the column ``chunk``, by which it is partitioned.
    """
    if before > span or after > span:
        raise ValueError("span must be at least as long as the frame")
    if before == 0 and after == 0:
        rows = df if CHUNK in df.columns else df.withColumn(CHUNK, chunk_of(order, span))
        return build(rows, Window.partitionBy(*keys, CHUNK).orderBy(order))
    own = _chunk_sql(order, span)
    offset = f"pmod({order}, {span})"
    targets = [own]
    if before:
        targets.append(f"case when {offset} >= {span - before} then {own} + 1 end")
    if after:
        targets.append(f"case when {offset} < {after} then {own} - 1 end")
    kept = [f"`{c}`" for c in df.columns if c != CHUNK]
    copied = df.selectExpr(*kept, f"explode(array_compact(array({', '.join(targets)}))) as {CHUNK}").selectExpr(
        "*", f"{CHUNK} = {own} as {_OWN}"
    )
    out = build(copied, Window.partitionBy(*keys, CHUNK).orderBy(order))
    return out.filter(F.col(_OWN)).drop(_OWN)


@dataclass(frozen=True)
class Carry:
    """One running column: ``kind`` is ``last``, ``next``, ``sum`` or ``max`` of the SQL ``value``.

    ``last`` is the latest non-null value up to the row, ``next`` the first from the row on.
    """

    kind: str
    value: str

    def __post_init__(self) -> None:
        if self.kind not in ("last", "next", "sum", "max"):
            raise ValueError(f"unknown kind {self.kind!r}")


def carry(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    span: int,
    specs: dict[str, Carry],
    *,
    ties: Sequence[str] = (),
    exclusive: bool = False,
    levels: int = 1,
) -> DataFrame:
    """Add running columns over all rows of a series without a window over those rows.

    The only window by series alone runs over summaries: one row per chunk, that is n / span
    rows for a series of n (3 million for 400 billion slots at the default span), or
    n / span**levels if the summaries are summarised again. Rows equal in ``order`` are told
    apart by ``ties``.
    """
    keys, kinds = list(keys), [spec.kind for spec in specs.values()]
    has_chunk = CHUNK in df.columns
    rows = df.selectExpr(
        "*",
        *[f"{spec.value} as _v{i}" for i, spec in enumerate(specs.values())],
        *([] if has_chunk else [f"{_chunk_sql(order, span)} as {CHUNK}"]),
    )
    if levels == 0:
        return _run(rows, df.columns + ([] if has_chunk else [CHUNK]), keys, order, ties, specs, exclusive, None)

    prefix = f"_c{levels}_"
    summary = rows.groupBy(*keys, CHUNK).agg(
        *[F.expr(f"{_SUMMARY[kind].format(v=f'_v{i}', o=order)} as _s{i}") for i, kind in enumerate(kinds)]
    )
    carried = carry(
        summary.withColumnRenamed(CHUNK, "_at"),
        keys,
        "_at",
        span,
        {f"{prefix}{i}": Carry(kind, f"_s{i}") for i, kind in enumerate(kinds)},
        exclusive=True,
        levels=levels - 1,
    )
    carried = carried.selectExpr(*keys, f"_at as {CHUNK}", *[f"{prefix}{i}" for i in range(len(kinds))])
    columns = df.columns + ([] if has_chunk else [CHUNK])
    return _run(
        rows.join(carried, [*keys, CHUNK], "left"), columns, [*keys, CHUNK], order, ties, specs, exclusive, prefix
    )


_SUMMARY = {
    "last": "max_by({v}, case when {v} is not null then {o} end)",
    "next": "min_by({v}, case when {v} is not null then {o} end)",
    "sum": "sum({v})",
    "max": "max({v})",
}
# Value within the chunk, and how what is carried in joins it.
_LOCAL = {"last": "last({v}, true)", "next": "last({v}, true)", "sum": "sum({v})", "max": "max({v})"}
_JOINED = {
    "last": "coalesce({local}, {incoming})",
    "next": "coalesce({local}, {incoming})",
    "sum": "coalesce({local} + {incoming}, {local}, {incoming})",
    "max": "greatest({local}, {incoming})",
}


def _chunk_sql(order: str, span: int) -> str:
    return f"cast(floor({order} / {span}D) as bigint)"


def _run(rows, columns, partition, order, ties, specs, exclusive, carried) -> DataFrame:
    frame = f"rows between unbounded preceding and {'1 preceding' if exclusive else 'current row'}"
    by = f"partition by {', '.join(partition)} order by "
    forward = f"({by}{', '.join([order, *ties])} {frame})"
    # An unbounded-following frame is quadratic in Spark, so look ahead by running backwards.
    backward = f"({by}{', '.join(f'{c} desc' for c in [order, *ties])} {frame})"
    local = [
        f"{_LOCAL[spec.kind].format(v=f'_v{i}')} over {backward if spec.kind == 'next' else forward} as _l{i}"
        for i, spec in enumerate(specs.values())
    ]
    joined = [
        (f"_l{i}" if carried is None else _JOINED[spec.kind].format(local=f"_l{i}", incoming=f"{carried}{i}"))
        + f" as `{name}`"
        for i, (name, spec) in enumerate(specs.items())
    ]
    return rows.selectExpr("*", *local).selectExpr(*[f"`{c}`" for c in columns if c not in specs], *joined)


def positions(
    df: DataFrame, keys: Sequence[str], order: str, span: int, *, name: str = "pos", levels: int = 1
) -> DataFrame:
    """0-based row number within ``keys`` by ``order``, for rows that no longer fill the grid."""
    rows = df if CHUNK in df.columns else df.withColumn(CHUNK, chunk_of(order, span))
    counts = rows.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = carry(
        counts.withColumnRenamed(CHUNK, "_at"), keys, "_at", span, {"_before": Carry("sum", "_n")},
        exclusive=True, levels=levels - 1,
    ).select(*keys, F.col("_at").alias(CHUNK), "_before")
    w = Window.partitionBy(*keys, CHUNK).orderBy(order)
    return (
        rows.join(offsets, [*keys, CHUNK], "left")
        .withColumn(name, (F.coalesce("_before", F.lit(0)) + F.row_number().over(w) - 1).cast("bigint"))
        .drop("_before", CHUNK)
    )


def attach(df: DataFrame, figures: DataFrame, keys: Sequence[str], spread: Sequence[str], salts: int = 64) -> DataFrame:
    """Left join per-group figures onto rows; the rows of a hot group go to ``salts`` sub-groups.

    Spark turns this into a broadcast at run time when the figures are measured to be small.
    """
    salted = figures.withColumn("_salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts).cast("bigint")))
    return rows.join(salted, [*keys, "_salt"], "left").drop("_salt")
