"""Cost-balanced packing of token sequences.

A document's cost is ``linear * n + quadratic * n * n`` for n tokens: the dense layers and attention
within the document. Documents are dealt in shards of bounded size, the rows of one task in their
order. In a shard, whole sequences are cut from long documents; what is left is assigned in
descending order to the sequence of lowest cost that still has room for all of it, and is cut only
when none has. Sequences are filled completely; the rest of a shard, less than one sequence, goes
into sequences of power-of-two length, which need no padding.

Nothing is shuffled: ids are made, packed and summed up in the task that reads the text, and a task
holds the ids of one shard (``SHARD_TOKENS``) or one document. The sequence id is the shard's first
row in its task and thus stable for a given layout of the input; a lost task gives the same rows
again.

Defined results: a null text is empty and has the closing id alone. Repeated rows are packed each.
A null doc_id is allowed. An empty table gives no pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import column_batches, text_of

SHARD_TOKENS = 1 << 20
# Sequences of one task; 2^40 of them per partition.
TASK_BITS = 40
SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, cost double, ids binary"
)


@lru_cache(maxsize=2)
def byte_bpe(name: str) -> Callable[[str], np.ndarray]:
    """Ids of a byte-level BPE from its vocabulary as ranks, the same ids as of the JSON file. Texts
    with the string of a special token go to the JSON file's own library."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(fast.encode_ordinary(text), dtype="<u4")

    return encode


def balanced(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; every token is in one piece."""
    pieces = []
    used = 0
    rest = []
    for d, n in enumerate(lengths):
        whole = n // capacity
        pieces.extend((d, k * capacity, capacity, used + k, 0) for k in range(whole))
        used += whole
        if n % capacity:
            rest.append((n % capacity, d, whole * capacity))
    rest.sort(key=lambda x: (-x[0], x[1]))
    total = sum(n for n, _, _ in rest)
    room = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if total % capacity >> b & 1]
    free = np.array(room, dtype=np.int64)
    filled = np.zeros(len(room), dtype=np.int64)
    cost = np.zeros(len(room))
    for n, d, start in rest:
        while n:
            fits = free >= n
            if not fits.any():
                fits = free > 0
            s = int(np.where(fits, cost, np.inf).argmin())
            take = int(min(n, free[s]))
            pieces.append((d, start, take, used + s, int(filled[s])))
            free[s] -= take
            filled[s] += take
            cost[s] += linear * take + quadratic * take * take
            n -= take
            start += take
    return pieces


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    tokenizer: str = "byte_bpe_50k",
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Pieces of all documents: doc_id, start (ids of the document before it), length, doc_tokens,
    sequence_id, offset in it, cost, and the ids as little-endian unsigned 32-bit numbers."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer)
        end = np.array([end_id], dtype="<u4")
        first = TaskContext.get().partitionId() << TASK_BITS

        def close(names: list, ids: list) -> pa.RecordBatch:
            nonlocal first
            pieces = balanced([len(x) for x in ids], capacity, linear, quadratic)
            rows = [
                (names[d], start, n, len(ids[d]), first + s, offset, linear * n + quadratic * n * n,
                 ids[d][start : start + n].tobytes())
                for d, start, n, s, offset in pieces
            ]
            first += 1 + max((s for _, _, _, s, _ in pieces), default=-1)
            columns = list(zip(*rows)) or [[]] * 8
            kinds = [pa.int64()] * 6 + [pa.float64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[f.split()[0] for f in SCHEMA.split(", ")],
            )

        names, ids, held = [], [], 0
        for doc_ids, texts in column_batches(batches, ("doc_id", "text")):
            for doc_id, text in zip(doc_ids, texts):
                names.append(doc_id)
                ids.append(np.concatenate([encode(text), end]))
                held += len(ids[-1])
                if held >= shard_tokens:
                    yield close(names, ids)
                    names, ids, held = [], [], 0
        if names:
            yield close(names, ids)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(shards, SCHEMA)
