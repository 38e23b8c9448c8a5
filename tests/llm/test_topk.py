import numpy as np
import pytest

from slotwise.llm.topk import build_tree, exact_top_k, search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k=10):
    good = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q_id, q in {i: min((tuple(v) for j, v in good if j == i)) for i, _ in good if is_query(i)}.items():
        found = [(-int(np.dot(q, v)), i) for i, v in good if i != q_id and len(v) == len(q)]
        out += [(q_id, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("n,shard,block", [(0, 8, 4), (3, 8, 4), (300, 40, 7)])
def test_equals_brute_force(spark, n, shard, block):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(n)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1])] if n else []
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, [1.0, 2.0]), (None, [1.0] * 6), (2005, [])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = exact_top_k(df, df.where("vec_id % 10 = 0"), shard_rows=shard, block_rows=block, leaf_rows=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, -1.0, 0.5]) for i in range(200)] + [(500, [2.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = exact_top_k(df, df.where("vec_id % 100 = 0"), shard_rows=32)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0)


def test_search_prunes():
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.normal(c, 0.1, (500, 4)) for c in (-20, 0, 20)]).round(2) * 100
    tree = build_tree(np.arange(1500), vectors, 16)
    ids, scores = search(tree, -1, vectors[1400], 5, -np.inf)
    assert scores.tolist() == sorted((vectors @ vectors[1400]).tolist(), reverse=True)[:5]
