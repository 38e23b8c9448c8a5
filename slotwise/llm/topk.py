"""Exact top-k inner products by ball-tree branch and bound.

Vectors are dealt over shards of about ``SHARD_ROWS`` rows; each shard's tree is built once and
written as one row. Queries travel in blocks, and every (block, shard) pair is one piece of work of
bounded size. Within it a query visits nodes in the order of their upper bound of the inner product,
``q . centre + |q| * radius``, and stops when that is below its current kth score. The kth score is
shared: one scout shard gives every query a first one, a task hands it from shard to shard, and
only what still beats it is returned.

Components become floor(1024 * x) and scores are integers, so bounds carry a margin for rounding and
ties are never pruned; ties go to the smaller id.

Defined results: vectors that are null or hold null or non-finite components, and rows without id,
take no part. Vectors meet only those of their own length. A row with the query's id is never its
answer. Repeated ids: each row is a candidate, and the smallest vector is the query. Scores beyond
64 bits end at the largest number. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import column_batches, stage

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF_ROWS = 64
# Below this, sums of products of whole numbers are exact in double precision.
EXACT = float(1 << 52)


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as arrays:
        return dict(arrays)


def build_tree(ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """Nodes in depth-first order: centre, radius, row range and right child (0 for a leaf). A node
    is cut at the median along the line between two far points."""
    order = np.lexsort((ids,))
    nodes: list[list] = []

    def node(rows: np.ndarray, start: int) -> int:
        at = len(nodes)
        own = vectors[rows]
        centre = own.mean(axis=0)
        away = ((own - centre) ** 2).sum(axis=1)
        nodes.append([centre, float(np.sqrt(away.max())), start, start + len(rows), 0])
        if len(rows) <= leaf_rows or away.max() == 0:
            order[start : start + len(rows)] = rows
            return at
        one = own[away.argmax()]
        two = own[((own - one) ** 2).sum(axis=1).argmax()]
        along = np.argsort(own @ (two - one), kind="stable")
        half = len(rows) // 2
        node(rows[along[:half]], start)
        nodes[at][4] = node(rows[along[half:]], start + half)
        return at

    node(order.copy(), 0)
    return {
        "centre": np.array([n[0] for n in nodes]), "radius": np.array([n[1] for n in nodes]),
        "span": np.array([n[2:5] for n in nodes], dtype=np.int64), "ids": ids[order], "vectors": vectors[order],
    }


def search(tree: dict[str, np.ndarray], query_id: int, q: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the shard that can be among the k best, given a kth score so far."""
    norm = float(np.sqrt(q @ q))
    bound = tree["centre"] @ q + norm * tree["radius"]
    size = norm * (np.sqrt((tree["centre"] ** 2).sum(axis=1)) + tree["radius"])
    bound += 1e-9 * size + 1
    span, vectors, ids = tree["span"], tree["vectors"], tree["ids"]
    whole = np.abs(vectors).max() * np.abs(q).max() * len(q) >= EXACT
    best_ids, best = np.empty(0, np.int64), np.empty(0, object if whole else np.float64)
    heap = [(-bound[0], 0)]
    while heap:
        upper, at = heapq.heappop(heap)
        if -upper < least:
            break
        start, end, right = span[at]
        if right:
            for child in (at + 1, int(right)):
                if bound[child] >= least:
                    heapq.heappush(heap, (-bound[child], child))
            continue
        if whole:
            ints = [int(x) for x in q]
            scores = np.array([sum(int(a) * b for a, b in zip(v, ints)) for v in vectors[start:end]], dtype=object)
        else:
            scores = vectors[start:end] @ q
        good = (scores >= least) & (ids[start:end] != query_id)
        if good.any():
            best = np.concatenate([best, scores[good]])
            best_ids = np.concatenate([best_ids, ids[start:end][good]])
            top = np.lexsort((best_ids, -best))[:k]
            best, best_ids = best[top], best_ids[top]
            if len(best) == k:
                least = max(least, float(best[-1]) * (1 - 1e-12 * np.sign(best[-1])) if whole else best[-1])
    return best_ids, best


def _trees(vectors: DataFrame, shards: int, leaf_rows: int) -> DataFrame:
    def build(key, pdf):
        import pandas as pd

        tree = build_tree(pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()), leaf_rows)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [_dump(**tree)]})

    keyed = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    return keyed.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary")


def _blocks(queries: DataFrame, blocks: int) -> DataFrame:
    def pack(key, pdf):
        import pandas as pd

        block = {"ids": pdf["id"].to_numpy(np.int64), "vectors": np.stack(pdf["v"].to_numpy())}
        block["least"] = pdf["least"].to_numpy(np.float64)
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "queries": [_dump(**block)]})

    keyed = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return keyed.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, queries binary")


def _answers(trees: DataFrame, blocks: DataFrame, shards: DataFrame, n_blocks: int, k: int) -> DataFrame:
    """Each tree meets each block of queries of its dimension once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], np.ndarray] = {}
        for columns in column_batches(batches, ("dim", "block", "tree", "queries")):
            for dim, number, tree, queries in zip(*columns):
                tree, block = _load(tree), _load(queries)
                if len(known) > 64:
                    known.clear()
                least = known.setdefault((dim, number), block["least"])
                out_q, out_v, out_s = [], [], []
                for i, (q_id, q) in enumerate(zip(block["ids"].tolist(), block["vectors"])):
                    ids, scores = search(tree, q_id, q, k, least[i])
                    if len(scores) == k:
                        least[i] = max(least[i], float(scores[-1]) - (abs(float(scores[-1])) * 1e-12))
                    out_q.extend([q_id] * len(ids))
                    out_v.extend(ids.tolist())
                    out_s.extend(max(-(2**63), min(2**63 - 1, int(s))) for s in scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"]
                )

    number = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    pairs = trees.select("dim", "shard", "tree", number).join(
        blocks.join(shards, "dim").select("dim", "shard", "block", "queries"), ["dim", "shard", "block"]
    )
    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def exact_top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k best of all other vectors."""

    def ready(df: DataFrame) -> DataFrame:
        x = F.col(vector_col)
        bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
        return df.where(x.isNotNull() & F.col(id_col).isNotNull() & ~bad & (F.size(x) > 0)).select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(x, lambda e: _floor(e.cast("double") * 1024)).alias("v"),
            F.size(x).alias("dim"),
        )

    rows = stage(ready(vectors))
    asked = ready(queries).groupBy("id", "dim").agg(F.min("v").alias("v"))
    n_rows, n_queries = rows.count(), max(1, queries.count())
    shards, n_blocks = max(1, -(-n_rows // shard_rows)), -(-n_queries // block_rows)
    trees = stage(_trees(rows, shards, leaf_rows))
    there = trees.select("dim", "shard")
    first = there.groupBy("dim").agg(F.min("shard").alias("shard"))
    scout = stage(_answers(
        trees.join(first, ["dim", "shard"]), _blocks(asked.withColumn("least", F.lit(-float("inf"))), n_blocks), first, n_blocks, k
    ))
    kth = scout.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    known = asked.join(kth, F.col("id") == F.col("query_id"), "left").select(
        "id", "dim", "v",
        F.when(F.col("n") == k, F.col("kth").cast("double") - F.abs(F.col("kth")) * 1e-12).otherwise(-float("inf")).alias("least"),
    )
    rest = _answers(
        trees.join(first, ["dim", "shard"], "left_anti"), _blocks(known, n_blocks),
        there.join(first, ["dim", "shard"], "left_anti"), n_blocks, k,
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scout.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floor(x):
    """floor as a double: whole numbers beyond 64 bits stay what they are."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)
