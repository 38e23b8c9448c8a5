"""K-means for all numbers of clusters and all starts at once.

Starts are seeded by k-means|| (Bahmani et al., 2012): two passes draw points in proportion to their
distance from what was drawn before, for all starts together, and the weighted candidates of a start
are reduced to k centres by k-means++. Every (k, start) is first moved to rest on a sample, one task
each. Their inertia over all points, taken in one pass, decides which ``FINALISTS`` of each k go on;
these move over all points together, one pass a round: a task assigns its points to the centres of
all models and returns sums per centre, which Spark adds up. The driver holds centres only. Sums travel as whole
numbers of a unit that fits the data, so that a result does not depend on which task ends first.

The silhouette is Euclidean: distances of a sample to *all* points are summed per cluster, block by
block, for every k in the same pass.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from slotwise.functions.draws import uniform
from slotwise.params import Params

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POINT, KEY, CLUSTER = "x", "_key", "cluster"
BLOCK = 512
SEED_PASSES = 2
FINALISTS = 3
# Rounds over the sample and over all points.
SAMPLE_ROUNDS, ROUNDS = 300, 20
# Sum of squared moves of the centres, relative to the mean variance of a coordinate.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Sweep:
    """The best centres of every k in ascending order, the chosen k, and ``(k, inertia, silhouette)``."""

    centres: dict[int, np.ndarray]
    k: int
    curve: list[tuple[int, float, float]]

    def table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(self.curve, "k INT, inertia DOUBLE, silhouette DOUBLE")

    def label(self, points: DataFrame) -> DataFrame:
        """The columns beside the point, and the nearest centre of the chosen k."""
        centres = self.centres[self.k]
        rest = points.drop(POINT, KEY)
        names = rest.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near, _ = nearest(_points(batch), centres)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(near, pa.int32())], names=[*names, CLUSTER])

        return points.mapInArrow(run, rest.schema.add(CLUSTER, IntegerType()))


def to_points(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep``, the point as one array, and a key that tells the rows apart by ``keep``."""
    point = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*keep, point.alias(POINT), F.xxhash64(*keep).alias(KEY))


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(POINT))
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(KEY)).to_numpy(zero_copy_only=False)


def gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1), 0.0)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre (the first on a tie) and the squared distance to it."""
    d = gaps(x, centres) if len(x) else np.empty((0, len(centres)))
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def hits(d: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """1 at the nearest centre of each model, whose columns lie between ``edges``."""
    hit, row = np.zeros(d.shape), np.arange(len(d))
    for a, b in zip(edges, edges[1:]):
        hit[row, a + d[:, a:b].argmin(axis=1)] = 1.0
    return hit


def _whole(x: np.ndarray, scale: float) -> np.ndarray:
    return np.rint(np.asarray(x, dtype=float) * scale).astype(np.int64)


def shape_of(points: DataFrame) -> tuple[int, float] | None:
    """Coordinates of a point, and units per 1 such that no sum over all points leaves 64 bits."""
    largest = F.max(F.array_max(F.transform(POINT, lambda v: F.abs(v))))
    rows, dim, most = points.agg(F.count(F.lit(1)), F.max(F.size(POINT)), largest).first()
    if not rows:
        return None
    bound = rows * max(1.0, dim * (2.0 * most) ** 2)
    return dim, 2.0 ** (61 - math.ceil(math.log2(bound)))


def _sums(points: DataFrame, models: dict[int, np.ndarray], shape: tuple[int, float]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each model the number of points of its centres, the sums of these points, and the inertia."""
    dim, scale = shape
    fields = [f"s{i}" for i in range(dim)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = list(models)
        every = np.concatenate([models[m] for m in ids])
        edges = np.cumsum([0] + [len(models[m]) for m in ids])
        n, cost, total = np.zeros(len(every), np.int64), np.zeros(len(every)), np.zeros((len(every), dim))
        for batch in batches:
            x = _points(batch)
            for low in range(0, len(x), BLOCK):
                part = x[low : low + BLOCK]
                d = gaps(part, every)
                hit = hits(d, edges)
                d[hit == 0] = 0.0
                n += hit.sum(axis=0).astype(np.int64)
                cost += d.sum(axis=0)
                total += hit.T @ part
        model = np.repeat(ids, np.diff(edges))
        centre = np.concatenate([np.arange(b - a) for a, b in zip(edges, edges[1:])])
        columns = [model, centre, n, _whole(cost, scale), *_whole(total, scale).T]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["model", "centre", "n", "cost", *fields]
        )

    schema = ", ".join(f"{c} long" for c in ["model", "centre", "n", "cost", *fields])
    rows = points.select(POINT).mapInArrow(run, schema).groupBy("model", "centre").agg(
        *[F.sum(c).alias(c) for c in ["n", "cost", *fields]]
    ).collect()
    out = {m: (np.zeros(len(c), np.int64), np.zeros((len(c), dim)), [0.0]) for m, c in models.items()}
    for r in rows:
        n, total, cost = out[r["model"]]
        n[r["centre"]] = r["n"]
        total[r["centre"]] = [r[f] / scale for f in fields]
        cost[0] += r["cost"] / scale
    return {m: (n, total, cost[0]) for m, (n, total, cost) in out.items()}


def _drawn(points: DataFrame, chosen: list[np.ndarray], share: np.ndarray, salt: int) -> list[np.ndarray]:
    """New candidates of every start: a point is drawn with ``share`` of its squared distance to those
    chosen before. The expected number is the same at every size of the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, key = _points(batch), _keys(batch)
            starts, found = [], []
            for s, own in enumerate(chosen):
                hit = np.flatnonzero(uniform(key, salt, s) < share[s] * nearest(x, own)[1])
                starts += [s] * len(hit)
                found += x[hit].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array(found, pa.list_(pa.float64()))], names=["start", POINT])

    rows = points.mapInArrow(run, f"start long, {POINT} array<double>").collect()
    new = [sorted(r[POINT] for r in rows if r["start"] == s) for s in range(len(chosen))]
    return [np.concatenate([own, np.array(more)]) if more else own for own, more in zip(chosen, new)]


def _plus_plus(candidates: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on weighted candidates."""
    centres = [candidates[rng.choice(len(candidates), p=weight / weight.sum())]]
    for _ in range(k - 1):
        pull = weight * nearest(candidates, np.array(centres))[1]
        if pull.sum() <= 0:
            pull = weight.astype(float)
        centres.append(candidates[rng.choice(len(candidates), p=pull / pull.sum())])
    return np.array(centres)


def seeds(points: DataFrame, params: Params, shape: tuple[int, float]) -> dict[int, list[np.ndarray]]:
    """First centres of every k and start."""
    starts, draw = max(1, params.n_init), 2 * params.kmax

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[float, list[float]] | None] = [None] * starts
        for batch in batches:
            x, key = _points(batch), _keys(batch)
            for s in range(starts if len(x) else 0):
                u = uniform(key, params.seed, s)
                at = int(u.argmin())
                if best[s] is None or u[at] < best[s][0]:
                    best[s] = (float(u[at]), x[at].tolist())
        rows = [(s, *b) for s, b in enumerate(best) if b is not None]
        kinds = (pa.int64(), pa.float64(), pa.list_(pa.float64()))
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["start", "u", POINT])

    drawn = points.mapInArrow(first, f"start long, u double, {POINT} array<double>")
    lowest = {r["start"]: r[POINT] for r in drawn.groupBy("start").agg(F.min_by(POINT, "u").alias(POINT)).collect()}
    chosen = [np.array([lowest[s]]) for s in range(starts)]
    for round_ in range(SEED_PASSES):
        cost = _sums(points, dict(enumerate(chosen)), shape)
        share = np.array([draw / cost[s][2] if cost[s][2] > 0 else 0.0 for s in range(starts)])
        chosen = _drawn(points, chosen, share, params.seed + 1 + round_)
    weight = _sums(points, dict(enumerate(chosen)), shape)
    out = {}
    for k in range(params.kmin, params.kmax + 1):
        out[k] = [
            _plus_plus(c, np.maximum(weight[s][0], 0) + 1e-9, k, np.random.default_rng([params.seed, k, s])) for s, c in enumerate(chosen)
        ]
    return out


def _variance(centres: np.ndarray, n: np.ndarray, total: np.ndarray, cost: float) -> float:
    """Mean variance of a coordinate, from one model's sums: squares around its centres, moved to the mean."""
    rows = max(int(n.sum()), 1)
    away = centres - total.sum(axis=0) / rows
    moved = cost + (away * (2 * (total - n[:, None] * centres) + n[:, None] * away)).sum()
    return max(float(moved), 0.0) / rows / centres.shape[1]


def settled(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Centres after moving over a sample until they rest."""
    least = TOLERANCE * x.var(axis=0).mean()
    for _ in range(SAMPLE_ROUNDS):
        at, _ = nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))[:, None]
        total = np.stack([np.bincount(at, column, len(centres)) for column in x.T], axis=1)
        moved = np.where(n > 0, total / np.maximum(n, 1), centres)
        if ((moved - centres) ** 2).sum() <= least:
            break
        centres = moved
    return centres


def _settled(points: DataFrame, models: dict[int, np.ndarray], sample: np.ndarray) -> dict[int, np.ndarray]:
    """Every model settled on the sample, a few models a task."""
    ids = list(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                found = settled(sample, models[ids[i]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]], pa.int64()), pa.array([found.ravel()], pa.list_(pa.float64()))], names=["model", "centres"]
                )

    spark = points.sparkSession
    tasks = min(len(ids), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(ids), 1, tasks).mapInArrow(run, "model long, centres array<double>").collect()
    found = {r["model"]: np.array(r["centres"]).reshape(models[r["model"]].shape) for r in rows}
    return {m: found[m] for m in ids}


def fit_all(
    points: DataFrame, params: Params, shape: tuple[int, float], sample: np.ndarray
) -> dict[int, tuple[np.ndarray, float, np.ndarray]]:
    """For every k the centres of least inertia over all starts, that inertia, and the sizes."""
    ks = range(params.kmin, params.kmax + 1)
    first = {k * 10_000 + s: c for k, starts in seeds(points, params, shape).items() for s, c in enumerate(starts)}
    moving = _settled(points, first, sample)
    sums = _sums(points, moving, shape)
    m = next(iter(moving))
    least = TOLERANCE * _variance(moving[m], *sums[m])
    cheapest = sorted(moving, key=lambda m: (sums[m][2], m))
    finalists = [m for k in ks for m in [m for m in cheapest if m // 10_000 == k][:FINALISTS]]
    moving = {m: moving[m] for m in finalists}
    done: dict[int, tuple[np.ndarray, float, np.ndarray]] = {}
    for round_ in range(ROUNDS):
        for m, (n, total, cost) in (sums if round_ == 0 else _sums(points, moving, shape)).items():
            if m not in moving:
                continue
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], moving[m])
            if ((moved - moving[m]) ** 2).sum() <= least or round_ == ROUNDS - 1:
                done[m] = (moving.pop(m), cost, n)
            else:
                moving[m] = moved
        if not moving:
            break
    best = {}
    for k in ks:
        centres, cost, n = min((done[m] for m in sorted(done) if m // 10_000 == k), key=lambda r: r[1])
        order = sorted(range(k), key=lambda i: tuple(centres[i]))
        best[k] = (centres[order], cost, n[order])
    return best


def sampled(points: DataFrame, rows: int) -> np.ndarray:
    """The points with the smallest keys: a uniform sample that does not depend on the partitions."""
    return np.array([r[0] for r in points.orderBy(KEY, POINT).select(POINT).limit(rows).collect()])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances in single precision; both are shifted alike before, so that it does."""
    d = a @ (-2 * b.T)
    d += np.einsum("ij,ij->i", a, a)[:, None]
    d += np.einsum("ij,ij->i", b, b)
    np.maximum(d, 0, out=d)
    return np.sqrt(d, out=d)


def silhouettes(
    points: DataFrame, fits: dict[int, tuple[np.ndarray, float, np.ndarray]], sample: np.ndarray, scale: float
) -> dict[int, float]:
    """Mean Euclidean silhouette of a sample of the points against all of them."""
    ks = [k for k in fits if k > 1]
    if not len(sample) or not ks:
        return {k: -1.0 for k in fits}
    every = np.concatenate([fits[k][0] for k in ks])
    edges = np.cumsum([0] + [len(fits[k][0]) for k in ks])
    fields = [f"s{i}" for i in range(len(every))]
    middle = sample.mean(axis=0)
    asked = (sample - middle).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sample), len(every)))
        for batch in batches:
            x = _points(batch)
            for low in range(0, len(x), BLOCK):
                part = x[low : low + BLOCK]
                hit = hits(gaps(part, every), edges).astype(np.float32)
                part = (part - middle).astype(np.float32)
                for at in range(0, len(asked), BLOCK):
                    total[at : at + BLOCK] += _distances(asked[at : at + BLOCK], part) @ hit
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sample)), pa.int64()), *[pa.array(c, pa.int64()) for c in _whole(total, scale).T]], names=["row", *fields]
        )

    schema = ", ".join(f"{c} long" for c in ["row", *fields])
    sums = points.select(POINT).mapInArrow(run, schema).groupBy("row").agg(*[F.sum(f).alias(f) for f in fields])
    table = np.array([r[1:] for r in sums.orderBy("row").collect()], dtype=float) / scale
    out = {k: -1.0 for k in fits}
    for k, a, b in zip(ks, edges, edges[1:]):
        centres, _, n = fits[k]
        own = nearest(sample, centres)[0]
        at = np.arange(len(sample))
        inner = table[:, a:b][at, own] / np.maximum(n[own] - 1, 1)
        others = np.where(n > 0, table[:, a:b] / np.maximum(n, 1), np.inf)
        others[at, own] = np.inf
        outer = others.min(axis=1)
        good = (n[own] > 1) & np.isfinite(outer)
        size = np.maximum(np.maximum(inner, outer), np.finfo(float).tiny)
        out[k] = float(np.where(good, (np.where(good, outer, 0.0) - inner) / np.where(good, size, 1.0), 0.0).mean())
    return out


def kmeans_sweep(points: DataFrame, params: Params) -> Sweep:
    """Fit every k from kmin to kmax; the highest silhouette wins, the first one on a tie.

    ``points`` (``to_points``) is read by many passes: pass it staged.
    """
    shape = shape_of(points)
    if shape is None:
        raise ValueError("no points to cluster")
    sample = sampled(points, params.sample_rows)
    fits = fit_all(points, params, shape, sample)
    scores = silhouettes(points, fits, sample, shape[1])
    best = max(sorted(fits), key=lambda k: scores[k])
    return Sweep({k: f[0] for k, f in fits.items()}, best, [(k, float(fits[k][1]), scores[k]) for k in sorted(fits)])
