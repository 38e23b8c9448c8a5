"""Exact linear-interpolated quantiles per group that never hold a group in one place.

Spark's ``percentile`` keeps a value -> count map of the whole group in one task. Here a
bounded sketch first brackets each wanted rank; rows outside the brackets are only counted,
rows inside keep their value. Brackets are cut into cells, so that ordering the kept values
is spread as well. Counts and kept values together give the exact ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.chunks import attach
from slotwise.sources.staging import stage

# Sketch error is n / ACCURACY ranks; brackets reach five times as far on either side.
ACCURACY = 10_000
KEEP_ALL = 20_000
CELLS = 1024


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    spread: Sequence[str] | None = None,
    extra: Sequence[Column] = (),
    accuracy: int = ACCURACY,
    keep_all: int = KEEP_ALL,
    ends: bool = False,
) -> DataFrame:
    """One row per group: ``keys``, ``n`` (non-null values) and ``q`` (array in the order of the
    ascending ``probs``), with ``ends`` the structs ``lo, hi, w`` of the two neighbouring values and the
    second one's share. Given ``extra`` aggregates these come along, and so do groups without
    any value. ``spread`` names columns that tell the rows of a group apart, for salting; by
    default the value itself. Groups of up to ``keep_all`` values are kept as they are."""
    keys, probs = list(keys), list(probs)
    margin = 5.0 / accuracy
    if keep_all * (margin - 1.0 / accuracy) < 1.0:
        raise ValueError("keep_all is too small for this accuracy")
    if probs != sorted(probs):
        raise ValueError("probs must ascend")
    cuts = [min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)]
    # Staged: one row per group, whose measured size lets Spark join it without moving the rows.
    figures = stage(df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.percentile_approx(value, cuts, accuracy).alias("_cuts"), *extra
    ))
    brackets = figures.selectExpr(*keys, "n", f"case when n > {keep_all} then _cuts end as _cuts")
    spread = list(spread or [value])
    narrow = df.filter(F.col(value).isNotNull()).select(*dict.fromkeys([*keys, value, *spread]))
    rows = attach(narrow, brackets, keys, spread)
    # Cuts ascend in pairs: past _a lower and _b upper ends means inside bracket _b if _a > _b.
    v, count = f"`{value}`", range(len(probs))
    started = " + ".join(f"int({v} >= get(_cuts, {2 * i}))" for i in count)
    ended = " + ".join(f"int({v} > get(_cuts, {2 * i + 1}))" for i in count)
    lo, hi = "get(_cuts, 2 * _b)", "get(_cuts, 2 * _b + 1)"
    inner = f"least({CELLS - 1}, coalesce(int(floor((_v - {lo}) / nullif({hi} - {lo}, 0D) * {CELLS})), 0))"
    # Cells ascend with the value: bracket i owns (2i + 1) * CELLS and on, what lies before it
    # 2i * CELLS. Cell -1 holds a small group whole.
    cell = f"case when _cuts is null then -1 when _a > _b then (2 * _b + 1) * {CELLS} + {inner} else 2 * _b * {CELLS} end"
    histogram = (
        rows.selectExpr(*keys, "n", "_cuts", f"{v} as _v", f"{started} as _a", f"{ended} as _b")
        .selectExpr(*keys, "n", f"{cell} as _cell", "case when _cuts is null or _a > _b then _v end as _at")
        .groupBy(*keys, "n", "_cell", "_at")
        .agg(F.count(F.lit(1)).alias("_m"))
    )
    cells = histogram.groupBy(*keys, "_cell").agg(F.sum("_m").alias("_m"))
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*keys, "_cell", F.coalesce(F.sum("_m").over(upto), F.lit(0)).alias("_before"))
    # Counted rows have a cell of their own and no value. They stay in: a filter on what makes
    # them so would only keep the two readers of the histogram from sharing it.
    w = Window.partitionBy(*keys, "_cell").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = histogram.join(starts, [*keys, "_cell"], "left").withColumn("_upto", F.col("_before") + F.sum("_m").over(w))
    picks = [
        F.expr(f"max(case when _upto > {rank} and _upto - _m <= {rank} then _at end)").alias(f"_{side}{i}")
        for i, p in enumerate(probs)
        for side, rank in (("lo", f"floor({float(p)}D * (n - 1))"), ("hi", f"ceil({float(p)}D * (n - 1))"))
    ]
    chosen = ranked.groupBy(*keys, "n").agg(*picks)
    missed = "cast(raise_error('quantile bracket missed its rank') as double)"
    quantiles = []
    for i, p in enumerate(probs):
        lo, hi = f"coalesce(_lo{i}, {missed})", f"coalesce(_hi{i}, {missed})"
        h = f"{float(p)}D * (n - 1)"
        share = f"({h} - floor({h}))"
        quantiles.append(f"named_struct('lo', {lo}, 'hi', {hi}, 'w', {share})" if ends else f"{lo} + ({hi} - {lo}) * {share}")
    found = chosen.selectExpr(*keys, "n", f"array({', '.join(quantiles)}) as q")
    if not extra:
        return found
    return figures.drop("_cuts").join(found.drop("n"), keys, "left")

