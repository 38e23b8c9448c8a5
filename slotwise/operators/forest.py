"""Isolation forest per group (Liu, Ting and Zhou, 2008), grown and scored in distributed tasks.

A tree grows on the ``tree_rows`` rows of its group with the smallest numbers among *all* rows, as
every (row, tree) has a number of its own. One pass over the rows finds them, and each tree is a task
of its own. Scoring deals the rows of a group into parts of bounded size and sends each part the
forest it needs; nothing is broadcast.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from slotwise.functions.chunks import attach
from slotwise.functions.draws import uniform
from slotwise.functions.quantiles import group_quantiles
from slotwise.params import Params
from slotwise.sources.staging import stage

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_ROWS = 65_536


def isolation_scores(
    df: DataFrame, keys: Sequence[str], row_key: str, features: Sequence[str], params: Params
) -> DataFrame:
    """``(keys, row_key, score, is_outlier)``.

    ``score`` is the isolation score minus the group's threshold, so higher is worse and the
    ``contamination`` share of rows lies above 0. Groups below ``min_state_rows`` are left out.
    """
    keys = list(keys)
    df = stage(df.select(*keys, row_key, *features))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= params.min_state_rows)
    rows = attach(df, sizes, keys, [row_key]).filter(F.col("_n").isNotNull())
    forests = stage(_grow(rows, keys, row_key, features, params))
    scored = stage(_score(rows, forests, sizes, keys, row_key, features, params))
    cuts = group_quantiles(scored, keys, "raw", [1.0 - params.contamination], spread=[row_key])
    cuts = cuts.select(*keys, F.col("q")[0].alias("_cut"))
    judged = attach(scored, cuts, keys, [row_key])
    score = F.col("raw") - F.col("_cut")
    return judged.select(*keys, row_key, score.alias("score"), (score > 0).alias("is_outlier"))


def _grow(rows, keys, row_key, features, params: Params) -> DataFrame:
    """One row per group with all trees in heap layout (children of i at 2i+1 and 2i+2)."""
    names, n_trees, tree_rows, seed = list(features), params.n_trees, params.tree_rows, params.seed
    drawn = draw_rows(rows, keys, row_key, names, n_trees, tree_rows, seed)
    key_types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema]
    schema = ", ".join([*key_types, "_tree int", "feature array<int>", "cut array<double>", "path array<double>"])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_u", row_key]).iloc[:tree_rows]
        if len(pdf) < min(tree_rows, int(pdf["_n"].iloc[0])):
            raise RuntimeError("too few rows were drawn for a tree")
        tree = int(pdf["_tree"].iloc[0])
        feature, cut, path = grow_tree(pdf[names].to_numpy(float), tree_rows, np.random.default_rng([seed, tree]))
        head = {k: [pdf[k].iloc[0]] for k in [*keys, "_tree"]}
        return pd.DataFrame({**head, "feature": [feature], "cut": [cut], "path": [path]})

    trees = drawn.groupBy(*keys, "_tree").applyInPandas(grow, schema)
    parts = F.sort_array(F.collect_list(F.struct("_tree", "feature", "cut", "path")))
    return trees.groupBy(*keys).agg(parts.alias("_trees")).select(
        *keys, *[F.flatten(F.col(f"_trees.{c}")).alias(c) for c in ("feature", "cut", "path")]
    )


def draw_rows(
    rows: DataFrame, keys: Sequence[str], row_key: str, features: Sequence[str], n_trees: int, tree_rows: int, seed: int
) -> DataFrame:
    """``(keys, row_key, features, _n, _tree, _u)``: for every tree the rows of its group with small
    numbers ``_u``, the ``tree_rows`` smallest of all rows among them. Twice as many are expected to
    pass; that fewer than wanted do has a chance of 1e-28, and is an error where it happens."""
    keyed = rows.select(*keys, row_key, *features, "_n", F.xxhash64(*keys, row_key).alias("_h"))
    schema = keyed.drop("_h").schema.add("_tree", IntegerType()).add("_u", DoubleType())

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_h", "_n"))
            most = 2.0 * tree_rows / n
            rest = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            for first in range(0, n_trees, 16):
                hits = [(t, u, np.flatnonzero(u < most)) for t in range(first, min(n_trees, first + 16)) for u in [uniform(h, seed, t)]]
                at = np.concatenate([i for _, _, i in hits])
                if len(at):
                    tree = np.concatenate([np.full(len(i), t, dtype=np.int32) for t, _, i in hits])
                    own = rest.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(tree, pa.int32()), pa.array(np.concatenate([u[i] for _, u, i in hits]))],
                        names=[*own.schema.names, "_tree", "_u"],
                    )

    return keyed.mapInArrow(draw, schema)


def _score(rows, forests, sizes, keys, row_key, features, params: Params) -> DataFrame:
    parts = F.ceil(F.col("_n") / PART_ROWS)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(row_key), parts)).select(*keys, "_part", row_key, *features)
    sent = forests.join(sizes, keys).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*[f"`{k}` {fields[k]}" for k in [*keys, row_key]], "raw double"])
    names, n_trees, tree_rows = list(features), params.n_trees, params.tree_rows

    def score(part: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if part.empty or forest.empty:
            return pd.DataFrame({c: [] for c in [*keys, row_key, "raw"]})
        trees = [np.asarray(forest[c].iloc[0]).reshape(n_trees, -1) for c in ("feature", "cut", "path")]
        raw = forest_scores(part[names].to_numpy(float), *trees, min(tree_rows, int(forest["_n"].iloc[0])))
        return part[[*keys, row_key]].assign(raw=raw)

    group = [*keys, "_part"]
    return dealt.groupBy(*group).cogroup(sent.groupBy(*group)).applyInPandas(score, schema)


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def grow_tree(sample: np.ndarray, tree_rows: int, rng: np.random.Generator):
    """One tree, a level at a time. Leaves have feature -1 and their path length; all trees of a forest
    have the nodes of ``tree_rows`` rows."""
    size = len(sample)
    depth = max(1, int(np.ceil(np.log2(max(min(size, tree_rows), 2)))))
    width = 2 ** (max(1, int(np.ceil(np.log2(max(tree_rows, 2))))) + 1) - 1
    feature = np.full(width, -1, dtype=np.int32)
    cut, path = np.zeros(width), np.zeros(width)
    node = np.zeros(size, dtype=np.int64)
    for level in range(depth + 1):
        first = 2**level - 1
        here = np.flatnonzero(node >= first)
        if not len(here):
            break
        here = here[np.argsort(node[here], kind="stable")]
        ids, starts, sizes = np.unique(node[here] - first, return_index=True, return_counts=True)
        low = np.minimum.reduceat(sample[here], starts, axis=0)
        high = np.maximum.reduceat(sample[here], starts, axis=0)
        splits = high > low
        inner = splits.any(axis=1) & (sizes > 1) & (level < depth)
        path[first + ids] = np.where(inner, 0.0, level + mean_path(sizes))
        # A random split column among those that vary in the node.
        choice = np.argmax(np.where(splits, rng.random(splits.shape), -1.0), axis=1)
        pick = np.arange(len(ids))
        at = low[pick, choice] + rng.random(len(ids)) * (high[pick, choice] - low[pick, choice])
        feature[first + ids[inner]] = choice[inner]
        cut[first + ids[inner]] = at[inner]
        f = feature[node[here]]
        go = f >= 0
        right = sample[here[go], f[go]] > cut[node[here[go]]]
        node[here[go]] = 2 * node[here[go]] + 1 + right
    return feature, cut, path


def forest_scores(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, path: np.ndarray, size: int) -> np.ndarray:
    """2 ** (-mean path / expected path); near 1 is isolated, below 0.5 is ordinary."""
    rows = np.arange(len(x))
    total = np.zeros(len(x))
    for f, c, p in zip(feature, cut, path):
        node = np.zeros(len(x), dtype=np.int64)
        going = np.ones(len(x), dtype=bool)
        while True:
            going = f[node] >= 0
            if not going.any():
                break
            i = rows[going]
            at = node[i]
            node[i] = 2 * at + 1 + (x[i, f[at]] > c[at])
        total += p[node]
    return 2.0 ** (-(total / len(feature)) / max(float(mean_path(size)), 1e-12))
