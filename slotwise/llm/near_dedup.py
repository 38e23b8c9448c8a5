"""MinHash near-dedup: fast similarity sketching, banding, exact verification, components.

A document's set are the distinct n-word shingles of its ASCII-lower-cased words (64-bit hashes of
them). Its sketch has t coordinates. In round i of the first t rounds each element goes to a random
bin with the value i + hash; in the next t rounds all elements go to bin i - t, so that every
coordinate is filled. The smallest value of a bin stays, and rounds end once all bins are full. Two
sketches agree in a coordinate with the chance of their sets' similarity, with concentration as for
independent hashes. Bands of ``BAND_ROWS`` coordinates make keys; the number of bands is such that a
pair at the threshold meets in no band with a chance of at most ``MISS``.

Equal sets are one vertex from the start. In each band key the most central vertex is tested against
the others on the full sets; passing pairs link. Keys whose members are all in one component then are
done. The members of the others are joined exactly, by prefixes of their sets in order of rarity, and
pairs of different components that can reach the threshold are tested. So no link of a band key is
lost, copies do not multiply, and nothing is capped.

Defined results: null text is empty; empty sets link with nothing. A null id is linked with nothing
and its component is null. Rows that repeat an id are one document: they are reachable from each
other. Ties do not exist; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import column_batches, stage, text_of
from slotwise.llm.components import grouped, link_within

BAND_ROWS = 6
MISS = 1e-9
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Hashes of words remembered per worker.
WORDS_KNOWN = 1_000_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KNOWN:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingles; fewer words than ``words`` are one shingle."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * GOLDEN + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """t coordinates of a set of at least one element."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(t, full, np.uint64)
    step = max(1, min(t, 4096 // len(items)))
    for start in range(0, 2 * t, step):
        rounds = np.arange(start, min(start + step, 2 * t), dtype=np.uint64)
        h = mix(items[None, :] + (rounds[:, None] + np.uint64(1)) * GOLDEN)
        value = (rounds[:, None] << np.uint64(48)) | (h >> np.uint64(16))
        bins = np.where(rounds[:, None] < t, mix(h) % np.uint64(t), rounds[:, None] - np.uint64(t)).astype(np.int64)
        np.minimum.at(out, bins.ravel(), value.ravel())
        if out.max() < full:
            # All bins are full once the round of the largest value is over; later rounds only have larger values.
            break
    return out


def band_keys(coordinates: np.ndarray, band_rows: int) -> np.ndarray:
    rows = coordinates.reshape(-1, band_rows)
    key = np.arange(len(rows), dtype=np.uint64)
    for k in range(band_rows):
        key = mix(key * GOLDEN + rows[:, k])
    return key.view(np.int64)


def _sketched(docs: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """Per row: doc_id, n (set size), a 128-bit hash of the set and the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for ids, texts in column_batches(batches, ("doc_id", "text")):
            sets = [shingles(t, words, known) for t in texts]
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            keys = [band_keys(sketch(s, bands * band_rows), band_rows) if len(s) else np.empty(0, np.int64) for s in sets]
            offsets = np.cumsum([0] + [len(k) for k in keys]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))),
                ],
                names=["doc_id", "n", "digest", "keys"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, keys array<long>")


def _linked(pairs: DataFrame, texts: DataFrame, words: int, least: int) -> DataFrame:
    """Of the pairs (a, b) those whose full sets have 100 * intersection >= least * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        last, one = None, np.empty(0, np.uint64)
        for columns in column_batches(batches, ("a", "b", "text_a", "text_b")):
            out_a, out_b = [], []
            for a, b, text_a, text_b in zip(*columns):
                if text_a != last:  # neighbouring pairs often share it
                    last, one = text_a, shingles(text_a, words, known)
                two = shingles(text_b, words, known)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= least * (len(one) + len(two) - both):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def _items(texts: DataFrame, words: int) -> DataFrame:
    """(id, n, item) of every element of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for ids, bodies in column_batches(batches, ("doc_id", "text")):
            for first in range(0, len(ids), 512):
                sets = [shingles(t, words, known) for t in bodies[first : first + 512]]
                sizes = [len(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(ids[first : first + 512], np.int64), sizes)),
                        pa.array(np.repeat(np.array(sizes, np.int64), sizes)),
                        pa.array(np.concatenate(sets).view(np.int64)),
                    ],
                    names=["id", "n", "item"],
                )

    return texts.mapInArrow(run, "id long, n long, item long")


def _prefix_pairs(rest: DataFrame, texts: DataFrame, words: int, least: int) -> DataFrame:
    """All pairs of different components that can reach the threshold, by prefixes.

    Elements are put in order of rarity. Sets at the threshold must share one of the first
    n - ceil(least * n / 100) + 1, and behind the first shared one both must have enough left. Edited
    copies start with what only they have, so those with too many edits meet nobody."""
    vertices = rest.select("id", "c").distinct()
    items = stage(
        _items(texts.join(vertices.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"), words).distinct()
    )
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("id", "n").orderBy("df", "item")
    placed = items.join(counts, "item").withColumn("at", F.row_number().over(order)).where(
        (F.col("df") > 1) & (F.col("at") <= F.col("n") - F.ceil(F.col("n") * least / 100) + 1)
    ).join(vertices, "id").select("item", "id", "n", "at", "c")
    placed = stage(placed)
    other = placed.select("item", *[F.col(x).alias(f"{x}_b") for x in ("id", "n", "at", "c")])
    left = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b")) + 1
    enough = left * (100 + least) >= least * (F.col("n") + F.col("n_b"))
    return placed.join(other, "item").where(
        (F.col("id") < F.col("id_b")) & (F.col("c") != F.col("c_b")) & enough
    ).select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 3, least: int = 85, band_rows: int = BAND_ROWS, miss: float = MISS
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept. ``least`` is the similarity in
    hundredths."""
    bands = max(1, math.ceil(math.log(miss) / math.log(1 - (least / 100) ** band_rows)))
    plain = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    rows = stage(_sketched(plain, words, bands, band_rows))
    sets = stage(
        rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    )
    members = stage(grouped(sets.select("id", F.explode("keys").alias("key"))))
    texts = stage(plain.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    _, found = link_within(
        members, lambda pairs: _linked(pairs, texts, words, least), lambda rest: _prefix_pairs(rest, texts, words, least)
    )

    groups = sets.join(found, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    full = rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "digest").join(groups, "digest").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
    empty = rows.where("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = 5, least: int = 80) -> DataFrame:
    """One document of each group stays, with its columns."""
    gone = near_duplicates(docs, words, least).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
