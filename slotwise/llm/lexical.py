"""Ranked lexical search by MaxScore with bounds of term pairs.

The index is a table of shards, one row each: up to ``SHARD_DOCS`` documents in the order of their
task, so nothing is shuffled to build it. A shard holds, for every term that the queries use, its
documents with their impact and the largest impact, and for chosen pairs of terms the intersection
list and the largest joint impact. Pairs come from the queries: of each, its heaviest terms with one
another.

A query meets a shard with the score that its k-th best document has so far. Its terms are matched
into groups of one or two, those pairs first whose joint maximum is furthest below the sum of their
maxima. A group adds at most ``max(joint, one alone)`` to a score, which is less than MaxScore's sum
of independent maxima. A group gives its candidates from no list (it leaves that bound), from its
intersection list (it leaves one term's maximum), from one term's list (it leaves the other's) or
from both; the choice takes few documents while what all groups leave stays below the kth score.
Candidates are then scored group by group, the largest bound first, and dropped when what is left
cannot lift them to the kth score. Whatever could tie is kept, so results are exact.

The kth score is shared: one scout shard answers first, then every task starts with its scores and
carries them from shard to shard. Queries travel in blocks whose number of terms is
bounded (``BLOCK_TERMS``); only counts of the terms of a block reach the driver. Weights come from
all documents.

Fixed values: terms are maximal runs of characters other than ASCII blanks, marks and controls, with
only A-Z lower-cased; a document of length n has m = 50 + (50 n N) div L, and a term with weight
w = floor(1000 ln((2N + 2) / (2 df + 1))) adds w ((10^9 tf) div (1000 tf + 20 m)).

Defined results: a null text has no terms, and neither documents nor queries without terms take
part. Each row is a document of its own, so repeated rows are ranked each; ties go to the smaller
id, null ids last. Rows with one query id are one query with the terms of all; a null id is one too.
Texts of any length pass. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import io
import math
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import column_batches, stage, text_of

SHARD_DOCS = 1 << 14
SHARD_HITS = 1 << 20
BLOCK_TERMS = 1 << 18
# Of a query, this many of its heaviest terms are paired with one another.
PAIRED_TERMS = 16
# Bytes that stand within terms (digits, letters, all of a character beyond ASCII).
_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _WORD else 0x20 for b in range(256))
NO_ID = np.iinfo(np.int64).max


def terms_of(text: str) -> list[bytes]:
    """Terms of a text as UTF-8, with repeats."""
    return text.encode().translate(_TABLE).split()


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as arrays:
        return dict(arrays)


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """query_id, term: the distinct terms of each query."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in column_batches(batches, ("query_id", "text")):
            rows = [(i, t) for i, text in zip(ids, texts) for t in dict.fromkeys(terms_of(text))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["query_id", "term"]
            )

    texts = items.select(F.col(id_col).cast("long").alias("query_id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(split, "query_id long, term binary").distinct()


def count_shards(
    docs: DataFrame, vocabulary: Sequence[bytes], id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS,
    shard_hits: int = SHARD_HITS,
) -> DataFrame:
    """One row per shard: its documents (id, known, n) and, of the vocabulary only, their terms with
    counts: n_docs (with a term), n_terms, and the arrays as bytes."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(vocabulary)}
        wanted = number.__contains__
        ids, sizes, known, at, terms, counts = (array("q") for _ in range(6))

        def close() -> pa.RecordBatch:
            term, doc, tf = (np.array(x, dtype=np.int64) for x in (terms, at, counts))
            order = np.argsort(term, kind="stable")
            doc, tf = doc[order], tf[order]
            held, df = np.unique(term, return_counts=True)
            blob = _dump(
                ids=np.array(ids, dtype=np.int64), known=np.array(known, dtype=bool), n=np.array(sizes, dtype=np.int64),
                term=held.astype(np.uint32), df=df.astype(np.uint32), doc=doc.astype(np.uint32), tf=tf.astype(np.uint32),
            )
            row = (len(ids), sum(sizes), held.tolist(), df.tolist(), blob)
            for column in (ids, sizes, known, at, terms, counts):
                del column[:]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds)], names=["n_docs", "n_terms", "terms", "df", "shard"]
            )

        for doc_ids, texts in column_batches(batches, ("doc_id", "text")):
            for doc_id, text in zip(doc_ids, texts):
                words = terms_of(text)
                if not words:
                    continue
                found = Counter(filter(wanted, words))
                at.extend(repeat(len(ids), len(found)))
                terms.extend(map(number.__getitem__, found))
                counts.extend(found.values())
                ids.append(NO_ID if doc_id is None else doc_id)
                known.append(doc_id is not None)
                sizes.append(len(words))
                if len(ids) >= shard_docs or len(at) >= shard_hits:
                    yield close()
        if ids:
            yield close()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    schema = "n_docs long, n_terms long, terms array<int>, df array<long>, shard binary"
    return texts.mapInArrow(shards, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact_shard(counted: dict[str, np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, pairs: np.ndarray) -> dict[str, np.ndarray]:
    """Impacts of a shard's terms, their maxima, and the intersection lists of pairs. ``cut`` holds the
    end of each term's documents, ``pair_cut`` that of each pair's."""
    n = counted["n"]
    m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)
    term, df = counted["term"].astype(np.int64), counted["df"].astype(np.int64)
    doc, tf = counted["doc"].astype(np.int64), counted["tf"].astype(np.int64)
    impact = np.repeat(weights[term], df) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
    cut = np.cumsum(df)
    top = np.maximum.reduceat(impact, cut - df) if len(term) else np.empty(0, np.int64)
    # Pairs with both terms here; documents of a pair are found by position in the shorter list.
    place = np.full(len(weights), -1, dtype=np.int64)
    place[term] = np.arange(len(term))
    first, second = place[pairs[:, 0]], place[pairs[:, 1]]
    here = (first >= 0) & (second >= 0)
    kept, lists, joint = np.flatnonzero(here), [], []
    for a, b in zip(first[here], second[here]):
        if df[a] > df[b]:
            a, b = b, a
        x, y = slice(cut[a] - df[a], cut[a]), slice(cut[b] - df[b], cut[b])
        at = np.searchsorted(doc[y], doc[x])
        same = at < df[b]
        same[same] = doc[y][at[same]] == doc[x][same]
        lists.append(doc[x][same])
        joint.append(int((impact[x][same] + impact[y][at[same]]).max(initial=0)))
    return {
        "ids": counted["ids"], "known": counted["known"], "term": term.astype(np.uint32), "cut": cut, "top": top,
        "doc": doc.astype(np.uint32), "impact": impact, "pair": kept.astype(np.uint32), "joint": np.array(joint, dtype=np.int64),
        "pair_cut": np.cumsum([len(x) for x in lists], dtype=np.int64),
        "pair_doc": np.concatenate(lists).astype(np.uint32) if lists else np.empty(0, np.uint32),
    }


def grouped(terms: np.ndarray, top: np.ndarray, pairs: dict[tuple[int, int], tuple[int, int]]) -> list[tuple]:
    """Groups (bound, members, pair or -1) of a query's terms; the first member has the larger maximum.
    ``pairs`` gives a pair's place and joint maximum. Those that tighten the bound most go first."""
    gains = []
    for a, b in combinations(range(len(terms)), 2):
        found = pairs.get((int(terms[a]), int(terms[b])))
        if found is not None:
            bound = max(found[1], int(top[a]), int(top[b]))
            gains.append((bound - int(top[a]) - int(top[b]), a, b, bound, found[0]))
    out, free = [], set(range(len(terms)))
    for gain, a, b, bound, at in sorted(gains):
        if gain < 0 and a in free and b in free:
            free -= {a, b}
            out.append((bound, (a, b) if top[a] >= top[b] else (b, a), at))
    out.extend((int(top[a]), (a,), -1) for a in sorted(free))
    return out


def sources(groups: list[tuple], top: np.ndarray, size: np.ndarray, pair_size: np.ndarray, least: int) -> list[tuple]:
    """For each group the lists that give candidates, and what the group adds at most to a document in
    none of them: (left, members, pair or -1). What is left of all groups stays below ``least``. Of
    the possible choices, those go first that save the most documents for what they leave."""
    moves, chosen = [], []
    for g, (bound, members, at) in enumerate(groups):
        a, b = members[0], members[-1]
        if len(members) == 1:
            ways = [(0, int(size[a]), members, -1), (bound, 0, (), -1)]
        else:
            ways = [
                (0, int(size[a] + size[b]), members, -1), (int(top[b]), int(size[a]), (a,), -1), (int(top[a]), int(size[b]), (b,), -1),
                (int(top[a]), int(pair_size[at]), (), at), (bound, 0, (), -1),
            ]
        # The lower hull of documents over what is left: each further step saves less per unit.
        hull = []
        for way in sorted(ways, key=lambda w: w[:2]):
            if hull and way[1] >= hull[-1][1]:
                continue
            while len(hull) > 1 and (hull[-2][1] - hull[-1][1]) * (way[0] - hull[-1][0]) <= (hull[-1][1] - way[1]) * (hull[-1][0] - hull[-2][0]):
                hull.pop()
            hull.append(way)
        chosen.append(hull[0])
        moves += [((y[1] - x[1]) / (y[0] - x[0] or 1), g, k, x, y) for k, (x, y) in enumerate(zip(hull, hull[1:]))]
    left = sum(w[0] for w in chosen)
    for _, g, _, x, y in sorted(moves, key=lambda m: m[:3]):
        if chosen[g] is x and left + y[0] - x[0] < least:
            left += y[0] - x[0]
            chosen[g] = y
    return [(w[0], w[2], w[3]) for w in chosen]


def search(shard: dict[str, np.ndarray], terms: np.ndarray, pairs: dict, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents (places in the shard) that can be among the k best, their scores, and how many were
    candidates. ``terms`` are places of the query's terms in the shard; ``least`` is a kth score so far."""
    cut, pair_cut, doc, impact, top = shard["cut"], shard["pair_cut"], shard["doc"], shard["impact"], shard["top"][terms]

    def span(a: int) -> slice:
        t = int(terms[a])
        return slice(int(cut[t - 1]) if t else 0, int(cut[t]))

    groups = grouped(terms, top, pairs)
    size = np.array([s.stop - s.start for s in map(span, range(len(terms)))])
    score = np.zeros(len(shard["ids"]), dtype=np.int64)
    seen = np.zeros(len(score), dtype=bool)
    waiting = []
    for (bound, members, _), (_, used, at) in zip(groups, sources(groups, top, size, np.diff(pair_cut, prepend=0), least)):
        for a in used:
            s = span(a)
            score[doc[s]] += impact[s]
            seen[doc[s]] = True
        if at >= 0:
            seen[shard["pair_doc"][int(pair_cut[at - 1]) if at else 0 : int(pair_cut[at])]] = True
        rest = tuple(a for a in members if a not in used)
        if rest:
            waiting.append((int(top[rest[0]]) if used else bound, rest))
    found = np.flatnonzero(seen)
    candidates, least = len(found), max(least, 1)
    left = sum(bound for bound, _ in waiting)
    for bound, members in sorted(waiting, reverse=True):
        if len(found) >= k:
            least = max(least, int(np.partition(score[found], -k)[-k]))
        found = found[score[found] + left >= least]
        for a in members:
            s = span(a)
            own = doc[s]
            at = np.searchsorted(own, found)
            at[at == len(own)] = 0
            same = own[at] == found
            score[found[same]] += impact[s][at[same]]
        left -= bound
    if len(found) >= k:
        least = max(least, int(np.partition(score[found], -k)[-k]))
    found = found[score[found] >= least]
    return found, score[found], candidates


def _answers(index: DataFrame, asked: list[tuple[int | None, np.ndarray]], pairs: np.ndarray, k: int, least: np.ndarray) -> DataFrame:
    """query_id, doc_id, score: what every shard can add to each query's k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 + max((int(t.max()) for _, t in asked if len(t)), default=0)
        kth, tops = least.copy(), [np.empty(0, np.int64) for _ in asked]
        for (blobs,) in column_batches(batches, ("index",)):
            for blob in blobs:
                shard = _load(blob)
                shard["doc"] = shard["doc"].astype(np.int64)
                place = np.full(size, -1, dtype=np.int64)
                known = shard["term"] < size
                place[shard["term"][known]] = np.flatnonzero(known)
                ends = np.sort(place[pairs[shard["pair"]]], axis=1).tolist()
                lists = {(a, b): x for (a, b), x in zip(ends, enumerate(shard["joint"].tolist()))}
                out = []
                for q, (_, terms) in enumerate(asked):
                    here = np.sort(place[terms][place[terms] >= 0])
                    if not len(here):
                        continue
                    found, score, _ = search(shard, here, lists, k, int(kth[q]))
                    best = np.lexsort((shard["ids"][found], ~shard["known"][found], -score))[:k]
                    found, score = found[best], score[best]
                    out.extend(zip(repeat(asked[q][0]), shard["ids"][found].tolist(), shard["known"][found].tolist(), score.tolist()))
                    tops[q] = np.sort(np.concatenate([tops[q], score]))[-k:]
                    if len(tops[q]) == k:
                        kth[q] = max(kth[q], tops[q][0])
                if out:
                    queries, ids, named, scores = zip(*out)
                    ids = [i if n else None for i, n in zip(ids, named)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in (queries, ids, scores)], names=["query_id", "doc_id", "score"]
                    )

    return index.select("index").mapInArrow(run, "query_id long, doc_id long, score long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The k best of each query; Spark cuts each task's rows to k before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, terms: DataFrame, k: int, id_col: str, text_col: str, shard_docs: int, paired: int) -> DataFrame:
    """All documents against the queries of one block."""
    spark = docs.sparkSession
    rows = terms.groupBy("query_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).collect()
    vocabulary = sorted({bytes(t) for r in rows for t in r.terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = stage(count_shards(docs, vocabulary, id_col, text_col, shard_docs))
    n_docs, n_terms = counted.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_docs or not rows:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score long")
    df = np.zeros(len(vocabulary), dtype=np.int64)
    held = counted.select(F.explode(F.arrays_zip("terms", "df")).alias("x"))
    for r in held.groupBy("x.terms").agg(F.sum("x.df").alias("df")).collect():
        df[r.terms] = r.df
    weights = np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64)
    asked = []
    for r in sorted(rows, key=lambda r: (r.query_id is None, r.query_id)):
        own = np.array([number[bytes(t)] for t in r.terms], dtype=np.int64)
        asked.append((r.query_id, own[(weights[own] > 0) & (df[own] > 0)]))
    heavy = [sorted(own.tolist(), key=lambda t: (-weights[t], t))[:paired] for _, own in asked]
    pairs = np.array(sorted({tuple(sorted(p)) for own in heavy for p in combinations(own, 2)}), dtype=np.int64).reshape(-1, 2)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (blobs,) in column_batches(batches, ("shard",)):
            for blob in blobs:
                made = _dump(**impact_shard(_load(blob), weights, n_docs, n_terms, pairs))
                yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["index"])

    index = stage(counted.select("shard").mapInArrow(build, "index binary").withColumn("key", F.xxhash64("index")))
    scout = index.agg(F.min("key")).first()[0]
    least = np.zeros(len(asked), dtype=np.int64)
    first = stage(_answers(index.where(F.col("key") == scout), asked, pairs, k, least))
    at = {name: q for q, (name, _) in enumerate(asked)}
    for r in _ranked(first, k).where(F.col("rank") == k).collect():
        least[at[r.query_id]] = r.score
    rest = _answers(index.where(F.col("key") != scout), asked, pairs, k, least)
    return _ranked(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int"), "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", shard_docs: int = SHARD_DOCS, paired: int = PAIRED_TERMS, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """query_id, rank, doc_id, score: of all documents, the k best with a score above 0 for each query."""
    terms = stage(query_terms(items, item_id_col, item_text_col))
    blocks = max(1, -(-terms.count() // block_terms))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    parts = [
        stage(_search_block(docs, terms.where(block == b), k, id_col, text_col, shard_docs, paired)) for b in range(blocks)
    ]
    return reduce(DataFrame.unionByName, parts)
