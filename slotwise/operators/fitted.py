"""Forecasts by boosted trees on lags, refitted fold by fold without a fit per fold.

Folds are prefixes of time. Trees are grown by MLlib on the first fold and again whenever the training
rows have doubled, so all growing together costs less than twice the last fit. In every fold, the
leaves of the trees at hand are refitted to *all* rows of its prefix: with ``Z`` the indicators of
the leaves a row falls into, stagewise boosting needs only ``Z'Z`` and ``Z'y``, and these are sums
over rows. One scan adds them up by the fold in which a row becomes known; running sums over the
folds give each prefix. In the fold in which trees are grown this gives exactly MLlib's values.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.chunks import attach, over_chunks
from slotwise.functions.fits import side_by_side
from slotwise.functions.timeslots import slot_start
from slotwise.operators.forecasts import FORECAST_COLUMNS, target_slots, walk_forward_origins
from slotwise.operators.grid import SLOT
from slotwise.params import DAY_SECONDS, SERIES, TS, Params
from slotwise.sources.staging import place, stage, stage_in_place

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLD = "fold"
# Leaf indicators of all trees: their cross products are one matrix of this size.
MOST_LEAVES = 4096
BLOCK = 4096


def lag_rows(grid: DataFrame, target: str, params: Params) -> DataFrame:
    """``(series_id, ts, slot, y, lag_1.., y_true)`` with complete lags; the target may be missing."""
    lags = [f"lag_{i}" for i in range(1, params.n_lags + 1)]

    def build(r: DataFrame, w) -> DataFrame:
        out = {name: F.lag("y", i).over(w) for i, name in enumerate(lags, 1)}
        return r.withColumns({**out, "y_true": F.lead("y", params.horizon).over(w)})

    rows = target_slots(grid, target, params)
    return over_chunks(rows, [SERIES], SLOT, params.span, build, params.n_lags, params.horizon)


def fold_range(origins: DataFrame, complete: DataFrame, params: Params) -> tuple[int, int, int] | None:
    """First slot of the folds, their width in slots, and their number. They cover all origins from the
    first one by which ``min_train_rows`` training rows are complete; so many slots reach the driver."""
    seen = [r[0] for r in complete.select(SLOT).orderBy(SLOT).limit(params.min_train_rows).collect()]
    if len(seen) < params.min_train_rows:
        return None
    low, high = origins.filter(F.col(SLOT) >= seen[-1] + params.horizon).agg(F.min(SLOT), F.max(SLOT)).first()
    if low is None:
        return None
    width = params.gbt_refit_days * DAY_SECONDS // params.step
    return low, width, (high - low) // width + 1


def epochs_of(rows_by_fold: list[int]) -> list[tuple[int, int]]:
    """First and last fold of the epochs: trees are grown again once the rows have doubled."""
    known = np.cumsum(rows_by_fold)
    starts = [0]
    for f in range(1, len(known)):
        if known[f] >= 2 * known[starts[-1]]:
            starts.append(f)
    return list(zip(starts, [s - 1 for s in starts[1:]] + [len(known) - 1]))


def boosted_tree_forecasts(grid: DataFrame, target: str, params: Params) -> DataFrame | None:
    """Boosted trees over all series, each standardised by training rows that were known when its
    trees were grown (or, for a series that begins later, in its first fold).

    A training row counts only if its target is observed by the fold's first slot. Every origin with
    complete lags is answered once ``min_train_rows`` training rows exist; ``None`` if they never do.
    A series without training rows has no scale and no forecast in that fold.
    """
    if params.gbt_trees * 2**params.gbt_depth > MOST_LEAVES:
        raise ValueError("too many leaves for their cross products")
    lags = [f"lag_{i}" for i in range(1, params.n_lags + 1)]
    lagged = stage(lag_rows(grid, target, params))
    origins = walk_forward_origins(lagged, params)
    complete = lagged.na.drop(subset=["y", "y_true", *lags])
    folds = fold_range(origins, complete, params)
    if folds is None:
        return None
    low, width, n_folds = folds
    known = F.greatest(F.lit(0), F.ceil((F.col(SLOT) + params.horizon - low) / F.lit(float(width)))).cast("int")
    complete = complete.withColumn(FOLD, known).filter(F.col(FOLD) < n_folds)
    asked = origins.withColumn(FOLD, F.floor((F.col(SLOT) - low) / F.lit(float(width))).cast("int"))
    asked = asked.filter(F.col(FOLD) >= 0).na.drop(subset=lags)
    counts = dict(complete.groupBy(FOLD).count().collect())
    rows_by_fold = [counts.get(f, 0) for f in range(n_folds)]
    begun = complete.groupBy(SERIES).agg(F.min(FOLD).alias("_begun"))

    def epoch(span: tuple[int, int]) -> DataFrame:
        first, last = span
        since = F.greatest(F.lit(first), F.col("_begun"))
        scale = attach(complete, begun, [SERIES], [TS]).filter((F.col(FOLD) <= since) & (since <= last)).groupBy(SERIES).agg(
            F.max(since).alias("_since"), F.avg("y").alias("_m"),
            F.coalesce(F.nullif(F.stddev_pop("y"), F.lit(0.0)), F.lit(1.0)).alias("_d"),
        )

        def scaled(rows: DataFrame) -> DataFrame:
            fitting = attach(rows, scale, [SERIES], [TS]).filter(F.col("_m").isNotNull())
            fitting = fitting.withColumns(
                {c: (F.col(c) - F.col("_m")) / F.col("_d") for c in lags}
                | {"label": (F.col("y_true") - F.col("_m")) / F.col("_d")}
            )
            return VectorAssembler(inputCols=lags, outputCol="features").transform(fitting)

        n_rows = sum(rows_by_fold[: last + 1])
        learn = stage(scaled(complete.filter(F.col(FOLD) <= last)).select(SERIES, TS, FOLD, "features", "label"))
        # Fixed placement makes the seeded fit repeatable; the fit reads it once per tree level.
        grown = learn.filter(F.col(FOLD) <= first).select(SERIES, TS, "features", "label")
        grown = stage_in_place(place(grown, [SERIES, TS], sum(rows_by_fold[: first + 1])))
        model = GBTRegressor(
            maxIter=params.gbt_trees, stepSize=params.gbt_rate, maxDepth=params.gbt_depth, seed=params.seed
        ).fit(grown)
        model.setLeafCol("_leaf").setPredictionCol("_grown")
        leaves = leaf_values(model.transform(learn), first, last, n_rows, list(model.treeWeights), 2**params.gbt_depth)
        tests = scaled(asked.filter(F.col(FOLD).between(first, last)))
        found = predicted(model.transform(tests.filter(F.col(FOLD) >= F.col("_since"))), leaves, 2**params.gbt_depth)
        return found.withColumn("_target", F.col(SLOT) + params.horizon).select(
            SERIES, F.col(TS).alias("origin"), slot_start("_target", params.step).alias(TS), F.lit("gbr_lags").alias("model"), "y_true", (F.col("_scaled") * F.col("_d") + F.col("_m")).alias("y_pred"),
        )

    parts = side_by_side(grid.sparkSession, epoch, epochs_of(rows_by_fold), params.parallel_fits)
    return reduce(DataFrame.unionByName, parts)


def leaf_values(rows: DataFrame, first: int, last: int, n_rows: int, weights: list[float], width: int) -> DataFrame:
    """``(fold, leaves)``: for every fold the weighted value of each leaf (tree by tree, ``width`` each),
    refitted to the rows with ``_leaf`` and ``label`` that the fold knows."""
    trees = len(weights)
    size = trees * width

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold, total = None, None
        for pdf in batches:
            for f, own in pdf.groupby(FOLD):
                if f != fold:
                    if total is not None:
                        yield parts(fold, total)
                    fold, total = int(f), np.zeros((size, size + 1))
                add_leaves(total, np.stack(own["_leaf"].to_numpy()), own["label"].to_numpy(float), width)
        if total is not None:
            yield parts(fold, total)

    def parts(fold: int, total: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({
            FOLD: fold, "tree": range(trees), "sums": [total[m * width : (m + 1) * width].tobytes() for m in range(trees)]
        })

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in pdf["sums"])
        return pd.DataFrame({FOLD: [pdf[FOLD].iloc[0]], "tree": [pdf["tree"].iloc[0]], "sums": [total.tobytes()]})

    def refit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, at, n = np.zeros((size, size + 1)), first, 0
        for pdf in batches:
            for f, m, sums in zip(pdf[FOLD], pdf["tree"], pdf["sums"]):
                for done in range(at, max(int(f), first)):
                    yield answer(done, total)
                at = max(int(f), first)
                total[m * width : (m + 1) * width] += np.frombuffer(sums).reshape(width, size + 1)
                n += 1
        if n:
            for done in range(at, last + 1):
                yield answer(done, total)

    def answer(fold: int, total: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({FOLD: [fold], "leaves": [refitted(total, weights, width)]})

    # A range of folds a task; its matrix is small beside the rows that it sums.
    tasks = max(1, -(-n_rows // (100 * size)))
    known = rows.select(F.greatest(FOLD, F.lit(first)).alias(FOLD), vector_to_array("_leaf").alias("_leaf"), "label", F.xxhash64(SERIES, TS).alias("_h"))
    dealt = known.repartitionByRange(tasks, FOLD, "_h").sortWithinPartitions(FOLD).drop("_h")
    schema = f"{FOLD} int, tree int, sums binary"
    summed = dealt.mapInPandas(products, schema).groupBy(FOLD, "tree").applyInPandas(add_up, schema)
    # One small matrix per fold, in order: what one task holds does not grow with the rows.
    ordered = summed.repartition(1).sortWithinPartitions(FOLD, "tree")
    return stage(ordered.mapInPandas(refit, f"{FOLD} int, leaves array<double>"))


def add_leaves(total: np.ndarray, leaf: np.ndarray, label: np.ndarray, width: int) -> None:
    """Adds ``Z'Z`` and, as the last column, ``Z'y``. Counts of a block are exact in single precision."""
    at = leaf.astype(np.int64) + np.arange(leaf.shape[1]) * width
    for low in range(0, len(at), BLOCK):
        own = at[low : low + BLOCK]
        z = np.zeros((len(own), total.shape[0]), dtype=np.float32)
        z[np.arange(len(own))[:, None], own] = 1.0
        total[:, :-1] += z.T @ z
        total[:, -1] += np.bincount(own.ravel(), np.repeat(label[low : low + BLOCK], own.shape[1]), total.shape[0])


def refitted(total: np.ndarray, weights: list[float], width: int) -> np.ndarray:
    """Stagewise squared-error boosting on given leaves: the first tree holds means of the target, each
    later one means of twice what is left, as the gradient of the squared error is."""
    value = np.zeros(total.shape[0])
    for m, weight in enumerate(weights):
        own = slice(m * width, (m + 1) * width)
        count = total[own, own].diagonal()
        left = total[own, -1] - total[own, : m * width] @ value[: m * width]
        mean = np.divide(left, count, out=np.zeros(width), where=count > 0)
        value[own] = weight * mean * (2.0 if m else 1.0)
    return value


def predicted(rows: DataFrame, leaves: DataFrame, width: int) -> DataFrame:
    """Adds ``_scaled``, the sum of a row's leaves in its fold."""
    found = attach(rows, leaves, [FOLD], [SERIES, TS], salts=1)
    at = vector_to_array("_leaf")
    values = F.transform(at, lambda leaf, i: F.get("leaves", (i * width + leaf).cast("int")))
    return found.withColumn("_scaled", F.aggregate(values, F.lit(0.0), lambda a, x: a + x))


def as_forecasts(df: DataFrame) -> DataFrame:
    return df.select(*FORECAST_COLUMNS)
