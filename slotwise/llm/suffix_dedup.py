"""Substring dedup by column-wise construction of a collection's suffix array.

Every byte covered by a string of ``width`` bytes that also starts anywhere else is removed.

How the collection is dealt over tasks: equal windows of ``width`` bytes hold the same smallest
``GRAM``-byte hash, so neighbouring windows with the same one are kept together as a string of
bounded length, and strings meet by that hash. Hashes that occur once cannot repeat; their strings
are never made. Equal strings become one with a count before they are shuffled. A hash with more than
``HOT_STRINGS`` different strings is dealt anew, window by window.

In a task the strings are built column-wise: each round inserts one symbol per string, from the last
to the first. A symbol is eight bytes where they divide the width, and a string has eight sequences
of them, so that every byte starts one. The position of a symbol's suffix is its place in a stable sort of the transform so
far; the transform and the array of common prefixes (ended at ``width``) are read from one pair of
sequential files and written with the insertions to another. A common prefix is one more than the
least one between the two occurrences of the symbol. At the end a backward walk gives each suffix's
rank, and suffixes with a neighbour of ``width`` common bytes repeat. The number of rounds is bounded
by the length of the strings, not of the documents.

Copies of a text are one text with a count throughout, found by a 128-bit hash.

Defined results: null and texts shorter than the window lose nothing. Repeated rows are copies, so
all of a repeated text of at least ``width`` bytes goes. Ids are only carried along and may be null.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import column_batches, stage, text_of
from slotwise.llm.near_dedup import mix

GRAM = 64
# Different strings of one hash beyond which its windows are dealt one by one.
HOT_STRINGS = 20_000
# Bytes of strings that one construction takes at a time, cut between hashes.
BATCH_BYTES = 1_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each ``gram`` bytes (a power of two), by doubling."""
    h = mix(data.astype(np.uint64) + FACTOR)
    power, size = FACTOR, 1
    with np.errstate(over="ignore"):
        while size < gram:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
    return mix(h)


def window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def window_runs(text: bytes, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, windows, twice) of the runs of windows with one smallest hash; twice: it
    is there more than once in a run, whose windows can then repeat each other."""
    hashes = gram_hashes(np.frombuffer(text, np.uint8), gram)
    longest = width - gram + 1
    least = window_least(hashes, longest)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(least)]]))
    # Places that are smallest in a window around them: where the largest smallest is their own hash.
    edge = np.full(longest - 1, ~np.uint64(0))
    most = ~window_least(np.concatenate([edge, ~least, edge]), longest)
    places = np.flatnonzero(most == hashes)
    again = (hashes[places[1:]] == hashes[places[:-1]]) & (places[1:] - places[:-1] < longest)
    twice = np.zeros(len(starts), bool)
    twice[np.searchsorted(starts, np.clip(places[1:][again] - longest + 1, 0, len(least) - 1), "right") - 1] = True
    if counts.max() > longest:  # the same bytes over and over
        pieces = -(-counts // longest)
        at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, counts = np.repeat(starts, pieces) + at * longest, np.repeat(counts, pieces) - at * longest
        twice = np.repeat(twice, pieces)
        counts = np.minimum(counts, longest)
    return least[starts].view(np.int64), starts, counts, twice


class Columns:
    """The transform and common prefixes of a collection, in two pairs of sequential files: each round
    reads one pair from start to end and writes the other."""

    KINDS = (np.int32, np.uint8)

    def __init__(self, folder: str):
        self.pairs = [[open(os.path.join(folder, f"{kind}{side}"), "w+b", buffering=0) for kind in "tp"] for side in "ab"]
        self.now = self.size = 0

    def write(self, *arrays: np.ndarray) -> None:
        self.now, self.size = 1 - self.now, len(arrays[0])
        for file, array in zip(self.pairs[self.now], arrays):
            file.seek(0)
            file.write(memoryview(array).cast("B"))

    def read(self) -> list[np.ndarray]:
        arrays = [np.empty(self.size, kind) for kind in self.KINDS]
        for file, array in zip(self.pairs[self.now], arrays):
            file.seek(0)
            file.readinto(memoryview(array).cast("B"))
        return arrays

    def close(self) -> None:
        for pair in self.pairs:
            for file in pair:
                file.close()


def symbol_columns(strings: list[bytes], step: int) -> tuple[np.ndarray, np.ndarray]:
    """Every string as ``step`` sequences of symbols of ``step`` bytes, one for each place to start. Column
    j holds the jth symbol from the end of each sequence, 0 after its first; and the symbols of each.
    What is left of a string behind its last whole symbol belongs to no whole window of the sequence."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    counts = np.maximum(lengths[:, None] - np.arange(step), 0) // step
    begins = (np.cumsum(lengths) - lengths)[:, None] + np.arange(step)
    counts, begins = counts.ravel(), begins.ravel()
    at = np.repeat(begins, counts) + step * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    values = np.zeros(len(at), np.uint64)
    for i in range(step):
        values = values << np.uint64(8) | data[at + i]
    codes = np.zeros(len(data) + 1, np.int32)
    codes[at] = np.unique(values, return_inverse=True)[1] + 1
    columns = np.zeros((int(counts.max()) + 1, len(counts)), np.int32)
    for j in range(1, len(columns)):
        long = np.flatnonzero(counts >= j)
        columns[j - 1, long] = codes[begins[long] + step * (counts[long] - j)]
    return columns, counts


def repeated_starts(strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each string the starts of its windows of ``width`` bytes that start elsewhere in the
    collection too.

    Symbols are as many bytes as divide the width, at most eight, and a string takes part once for
    each place where its symbols can start: each byte still is the start of one suffix, and there are
    as many fewer rounds as a symbol has bytes."""
    step = next(s for s in (8, 4, 2, 1) if width % s == 0)
    least = width // step
    if least > 254:
        raise ValueError("common prefixes are kept in bytes")
    columns, counts = symbol_columns(strings, step)
    longest, m = len(columns) - 1, len(counts)
    kinds = int(columns.max()) + 1
    with tempfile.TemporaryDirectory() as folder:
        files = Columns(folder)
        files.write(columns[0], np.zeros(m, np.uint8))
        # Rows of the transform in stable order of their symbols, and how many each symbol has.
        order = np.argsort(columns[0], kind="stable").astype(np.int32)
        totals = np.bincount(columns[0], minlength=kinds)
        # The last inserted suffixes in that order: whose they are, their places in it, their symbols.
        owner, at, symbol = order.astype(np.int64), np.arange(m), columns[0][order]
        for j in range(1, longest + 1):
            going = symbol > 0
            owner, at, symbol = owner[going], at[going], symbol[going]
            transform, prefixes = files.read()
            n, ended = len(transform), int(totals[0])
            rows = order[at].astype(np.int64)
            # Occurrences of the same symbol before and after.
            ends = np.cumsum(totals)
            before, after = order[at - 1].astype(np.int64), order[np.minimum(at + 1, n - 1)].astype(np.int64)
            has_before, has_after = at > ends[symbol - 1], at + 1 < ends[symbol]
            shared = 1 + least_between(
                prefixes, np.concatenate([before[has_before], rows[has_after]]), np.concatenate([rows[has_before], after[has_after]])
            )
            own = np.zeros(len(rows), np.int64)
            own[has_before] = shared[: has_before.sum()]
            spots = m + at - ended
            old = np.ones(n + len(rows), bool)
            old[spots] = False
            grown, common = np.empty(len(old), np.int32), np.empty(len(old), np.uint8)
            grown[old], common[old] = transform, prefixes
            symbol = columns[j, owner]
            grown[spots] = symbol
            common[spots[has_after] + 1] = np.minimum(shared[has_before.sum() :], least)
            common[spots] = np.minimum(own, least)
            files.write(grown, common)
            # The same order with the insertions.
            order = np.flatnonzero(old).astype(np.int32)[order]
            by_symbol = np.argsort(symbol * np.int64(len(old)) + spots)
            owner, spots, symbol = owner[by_symbol], spots[by_symbol], symbol[by_symbol]
            at = places_of(order, spots, ends[symbol] - totals[symbol], ends[symbol]) + np.arange(len(spots))
            totals = totals + np.bincount(symbol, minlength=kinds)
            old = np.ones(len(old), bool)
            old[at] = False
            merged = np.empty(len(old), np.int32)
            merged[old], merged[at] = order, spots
            order = merged
        transform, prefixes = files.read()
        files.close()
    back = np.empty(len(transform), np.int64)
    back[order] = np.arange(len(transform)) - int(totals[0]) + m
    repeats = prefixes >= least
    repeats[:-1] |= prefixes[1:] >= least
    whose, starts = [], []
    rows, owner = np.arange(m), np.arange(m)
    for j in range(1, longest + 1):
        going = transform[rows] > 0
        rows, owner = back[rows[going]], owner[going]
        if j >= least:
            hit = owner[repeats[rows]]
            whose.append(hit // step)
            starts.append(hit % step + step * (counts[hit] - j))
    if not whose:
        return [np.empty(0, np.int64) for _ in strings]
    whose, starts = np.concatenate(whose), np.concatenate(starts)
    by_string = np.lexsort((starts, whose))
    return np.split(starts[by_string], np.searchsorted(whose[by_string], np.arange(1, len(strings))))


def places_of(order: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where each row belongs in its part low .. high of ``order``, whose parts ascend: binary searches side
    by side."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = order[middle] < rows[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray, block: int = 16) -> np.ndarray:
    """min(values[low + 1 .. high]) for each pair, from the least values up to and from each place of a
    block, and those of 1, 2, 4, .. blocks."""
    if not len(low):
        return np.empty(0, np.int64)
    blocks = np.full((len(values) // block + 1, block), 255, np.uint8)
    blocks.ravel()[: len(values)] = values
    up_to = np.minimum.accumulate(blocks, axis=1)
    from_ = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]
    levels = [np.ascontiguousarray(up_to[:, -1])]
    while 2 ** len(levels) <= len(blocks):
        half = 2 ** (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    first, last = (low + 1) // block, high // block
    a, b = (low + 1) % block, high % block
    out = np.minimum(from_[first, a], up_to[last, b])
    within = np.flatnonzero(first == last)
    place = np.arange(block)
    own = blocks[first[within]]
    own[(place < a[within, None]) | (place > b[within, None])] = 255
    out[within] = own.min(axis=1)
    far = np.flatnonzero(last - first > 1)
    size = last[far] - first[far] - 1
    depth = np.frexp(size)[1] - 1
    for d in np.unique(depth):
        part = far[depth == d]
        out[part] = np.minimum(out[part], np.minimum(levels[d][first[part] + 1], levels[d][last[part] - 2**d]))
    return out.astype(np.int64)


def ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring starts as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist()))


def _runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for digests, texts in column_batches(batches, ("digest", "text")):
            keys, starts, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            twice, whose = [np.empty(0, bool)], []
            for digest, text in zip(digests, texts):
                k, s, c, t = window_runs(text, width, gram)
                keys.append(k)
                starts.append(s)
                counts.append(c)
                twice.append(t)
                whose.append((digest, len(k)))
            owners = np.repeat(np.arange(len(whose)), [n for _, n in whose])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys)), pa.array([d for d, _ in whose], pa.binary()).take(pa.array(owners)),
                    pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(counts).astype(np.int32)),
                    pa.array(np.concatenate(twice)),
                ],
                names=["key", "digest", "start", "windows", "twice"],
            )

    return docs.mapInArrow(run, "key long, digest binary, start int, windows int, twice boolean")


def _cut(texts: DataFrame, width: int) -> DataFrame:
    """The strings of each text's repeated hashes."""

    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["key", "body", "digest", "start", "copies"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                for digests, bodies, copies, spans in column_batches(iter([part]), ("digest", "text", "copies", "spans")):
                    for digest, body, n, own in zip(digests, bodies, copies, spans):
                        for s in own:
                            out.append((s["key"], body[s["start"] : s["start"] + s["windows"] + width - 1], digest, s["start"], n))
                            if len(out) >= 20_000:
                                yield made(out)
                                out = []
        if out:
            yield made(out)

    return texts.mapInArrow(run, "key long, body binary, digest binary, start int, copies long")


def _construct(strings: DataFrame, width: int, batch_bytes: int) -> DataFrame:
    """Per string (key, body, copies), sorted by key in its partition: its repeated windows as ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int]] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids, spans = [], []
            # The only string of a hash meets no other, and the count of its copies says all.
            several = Counter(key for key, _, _ in held)
            joined = [k for k, (key, _, copies) in enumerate(held) if several[key] > 1 or copies == 1]
            starts = dict(zip(joined, repeated_starts([held[k][1] for k in joined], width) if joined else []))
            for k, (_, body, copies) in enumerate(held):
                found = [(0, len(body) - width)] if copies > 1 else ranges(starts[k])
                if found:
                    ids.append(hashlib.md5(body).digest())
                    spans.append([{"low": a, "high": b} for a, b in found])
            kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(spans, kind)], names=["body_id", "repeats"])

        for keys, bodies, copies in column_batches(batches, ("key", "body", "copies")):
            for key, body, n in zip(keys, bodies, copies):
                if size >= batch_bytes and key != held[-1][0]:
                    yield close()
                    held, size = [], 0
                held.append((key, body, n))
                size += len(body)
        if held:
            yield close()

    placed = strings.repartition("key").sortWithinPartitions("key", "body")
    return placed.mapInArrow(run, "body_id binary, repeats array<struct<low:int,high:int>>")


def _removed(texts: DataFrame, width: int) -> DataFrame:
    """Per text: bytes and runs removed, and the hash of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for digests, bodies, repeats in column_batches(batches, ("digest", "text", "repeats")):
            out = []
            for digest, body, own in zip(digests, bodies, repeats):
                gone = np.zeros(len(body) + 1, np.int32)
                for r in own:
                    gone[r["low"]] += 1
                    gone[r["high"] + width] -= 1
                mask = np.cumsum(gone[:-1]) > 0
                rest = np.frombuffer(body, np.uint8)[~mask].tobytes()
                runs = int(np.count_nonzero(mask[1:] & ~mask[:-1]) + (len(mask) > 0 and bool(mask[0])))
                out.append((digest, int(mask.sum()), runs, hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["digest", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return texts.mapInArrow(run, "digest binary, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _digested(docs: DataFrame) -> DataFrame:
    text = text_of().cast("binary")
    return docs.select(F.col("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("digest"))


def repeated_ranges(
    docs: DataFrame, width: int = 200, gram: int = GRAM, hot_strings: int = HOT_STRINGS, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Per different text with something to remove: digest, text and its repeated windows as ranges."""
    digested = _digested(docs)
    long = digested.where(F.octet_length("text") >= width)
    runs = stage(
        _runs(long.select("digest", "text"), width, gram).groupBy("key", "digest", "start", "windows", "twice")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    several = runs.groupBy("key").agg(
        F.sum("copies").alias("c"), F.max("twice").alias("twice")
    ).where("c > 1 OR twice").select("key")
    spans = runs.join(several, "key", "left_semi").groupBy("digest").agg(
        F.max("copies").alias("copies"), F.collect_list(F.struct("key", "start", "windows")).alias("spans")
    )
    texts = stage(long.select("digest", "text").dropDuplicates(["digest"]).join(spans, "digest"))
    cut = stage(_cut(texts, width))
    strings = stage(cut.groupBy("key", "body").agg(F.sum("copies").alias("copies")))
    hot = stage(strings.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot_strings).select("key"))
    at = F.sequence(F.lit(0), F.octet_length("body") - width)
    if hot.isEmpty():
        found = _construct(strings, width, batch_bytes)
    else:
        windows = stage(strings.join(hot, "key", "left_semi").select(
            F.unhex(F.md5("body")).alias("body_id"), "copies",
            F.explode(F.transform(at, lambda i: F.struct(i.alias("low"), F.substring("body", i + 1, F.lit(width)).alias("body")))).alias("w"),
        ).select("body_id", "copies", "w.low", "w.body"))
        single = windows.groupBy("body").agg(F.sum("copies").alias("copies")).withColumn("key", F.xxhash64("body"))
        again = _construct(single, width, batch_bytes).select(F.col("body_id").alias("window_id"))
        of_hot = windows.withColumn("window_id", F.unhex(F.md5("body"))).join(again, "window_id").groupBy("body_id").agg(
            F.collect_list(F.struct(F.col("low"), F.col("low").alias("high"))).alias("repeats")
        )
        found = _construct(strings.join(hot, "key", "left_anti"), width, batch_bytes).unionByName(of_hot)
    places = cut.select(F.unhex(F.md5("body")).alias("body_id"), "digest", "start").join(found, "body_id")
    by_text = places.select("digest", F.explode(
        F.transform("repeats", lambda r: F.struct((r["low"] + F.col("start")).alias("low"), (r["high"] + F.col("start")).alias("high")))
    ).alias("r")).groupBy("digest").agg(F.collect_list("r").alias("repeats"))
    return texts.select("digest", "text").join(by_text, "digest")


def remove_repeats(docs: DataFrame, width: int = 200, **parts) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the remaining bytes,
    null where nothing is removed)."""
    removed = stage(_removed(repeated_ranges(docs, width, **parts), width))
    rows = _digested(docs).select(
        "doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"),
    )
    return rows.join(removed, "digest", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept",
    )
