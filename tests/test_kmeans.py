"""All starts of all k at once: the same answers as plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.operators import kmeans
from slotwise.params import Params

P = Params(n_init=4, sample_rows=2000)


def blobs(n=2000, k=4, dim=3, seed=4):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 6, (k, dim))
    return middles[np.arange(n) % k] + rng.normal(0, 1, (n, dim))


def points(spark, x, parts=5):
    names = [f"v{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in names))
    return kmeans.to_points(df, names, ["id"]).repartition(parts)


def plain_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def plain_lloyd(x, centres):
    for _ in range(300):
        at = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        moved = np.array([x[at == c].mean(0) if (at == c).any() else centres[c] for c in range(len(centres))])
        if ((moved - centres) ** 2).sum() <= 1e-4 * x.var(axis=0).mean():
            break
        centres = moved
    return ((x - centres[at]) ** 2).sum()


def test_inertia_and_silhouette_equal_plain_ones(spark):
    x = blobs()
    table = points(spark, x).cache()
    sweep = kmeans.kmeans_sweep(table, P)
    assert [c[0] for c in sweep.curve] == [2, 3, 4, 5] and sweep.k == max(sweep.curve, key=lambda c: c[2])[0]
    rng = np.random.default_rng(0)
    for k, inertia, silhouette in sweep.curve:
        at = ((x[:, None] - sweep.centres[k][None]) ** 2).sum(-1).argmin(1)
        assert inertia == pytest.approx(((x - sweep.centres[k][at]) ** 2).sum(), rel=1e-9)
        assert silhouette == pytest.approx(plain_silhouette(x, at), abs=1e-4)
        # No worse than ten plain starts from random points.
        assert inertia <= min(plain_lloyd(x, x[rng.choice(len(x), k, replace=False)]) for _ in range(10)) * 1.001
    labels = {r.id: r.cluster for r in sweep.label(table).collect()}
    want = ((x[:, None] - sweep.centres[sweep.k][None]) ** 2).sum(-1).argmin(1)
    assert [labels[i] for i in range(len(x))] == want.tolist()


def test_a_sample_scores_like_all(spark):
    table = points(spark, blobs(3000)).cache()
    shape = kmeans.shape_of(table)
    some, every = (kmeans.sampled(table, n) for n in (300, 10_000))
    fits = kmeans.fit_all(table, P.with_(kmin=4, kmax=4), shape, some)
    one, two = (kmeans.silhouettes(table, fits, x, shape[1])[4] for x in (some, every))
    assert one == pytest.approx(two, abs=0.05)


def test_results_do_not_depend_on_partitions(spark):
    x = blobs(1500)
    one, two = (kmeans.kmeans_sweep(points(spark, x, n).cache(), P) for n in (1, 9))
    assert one.k == two.k
    for k in one.centres:
        np.testing.assert_allclose(one.centres[k], two.centres[k], atol=1e-9)


def test_few_equal_and_no_points(spark):
    same = kmeans.kmeans_sweep(points(spark, np.ones((6, 2)), 3).cache(), P)
    assert [c[1] for c in same.curve] == [0.0] * 4
    two = kmeans.kmeans_sweep(points(spark, np.array([[0.0, 0.0], [9.0, 9.0]])).cache(), P.with_(kmax=2))
    assert two.k == 2 and two.curve[0][1] == pytest.approx(0.0)
    with pytest.raises(ValueError):
        kmeans.kmeans_sweep(points(spark, np.ones((1, 2))).filter(F.lit(False)), P)
