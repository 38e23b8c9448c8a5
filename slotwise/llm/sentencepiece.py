"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Pieces and their log scores come from a model file, read on the driver; the trie's two arrays are of
the size of the vocabulary and travel with the function. Text takes the dummy prefix and whitespace
markers as the model says. A character that no piece covers costs the lowest score less 10 and
becomes byte pieces.

No best path needs a cut inside a word to depend on its neighbours unless a piece crosses the cut,
so text is first cut where no piece of the model can cross, and the paths of short stretches are
remembered per worker. Results are those of the search over the whole text.

Defined results: a null text is empty and has no ids. Ids are little-endian unsigned 32-bit numbers
in a binary column. Other columns pass through; ``ids`` and ``decoded`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import text_of

MARK = "▁"
# Fixed values of the model format: kinds of pieces, and the penalty of an unknown character.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
# Stretches remembered per worker, and the longest of them in bytes.
REMEMBERED, LONGEST = 400_000, 96


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: varints, 4- and 8-byte values, and byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = blob[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(blob):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, blob[at : at + n]
            at += n


@dataclass
class Pieces:
    """A model's pieces: text, log score and kind by id, and how it treats white space."""

    texts: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    squeeze: bool = False

    @classmethod
    def read(cls, path: str) -> "Pieces":
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        texts, scores, kinds = [], [], []
        for number, value in message:
            if number == 1:
                piece = dict(_fields(value))
                texts.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
        normalizer = dict(_fields(next((v for n, v in message if n == 3), b"")))
        return cls(texts, scores, kinds, bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)))

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(t[1:-1], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}


class DoubleArray:
    """A trie over bytes: the child of state s by byte b is ``base[s] + b`` if ``check`` of it is s.
    ``value`` holds a piece's id, or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        tree: dict = {}
        for key, value in keys:
            at = tree
            for b in key:
                at = at.setdefault(b, {})
            at[-1] = value
        base, check, value = [0] * 1024, [-1] * 1024, [-1] * 1024
        check[0] = 0
        hole = 1

        def room(upto: int) -> None:
            if upto >= len(check):
                more = max(len(check), upto)
                base.extend([0] * more)
                check.extend([-1] * more)
                value.extend([-1] * more)

        todo = [(0, tree)]
        for state, children in todo:
            value[state] = children.pop(-1, -1)
            if not children:
                continue
            codes = sorted(children)
            while hole < len(check) and check[hole] != -1:
                hole += 1
            at = first = max(hole, codes[0] + 1)
            while True:
                room(at + 512)
                start = at - codes[0]
                if check[at] == -1 and all(check[start + c] == -1 for c in codes):
                    break
                at += 1
            # Holes that a long search left behind are given up.
            if at - first > 128:
                hole = at
            base[state] = start
            for c in codes:
                check[start + c] = state
                todo.append((start + c, children[c]))
        self.base, self.check, self.value = base, check, value


class Unigram:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        usable = [
            (t.encode(), i) for i, (t, k) in enumerate(zip(pieces.texts, pieces.kinds)) if k in (NORMAL, USER_DEFINED) and t
        ]
        self.trie = DoubleArray(usable)
        normal = [s for s, k in zip(pieces.scores, pieces.kinds) if k == NORMAL]
        low, high = min(normal, default=0.0), max(normal, default=0.0)
        self.unknown_score = low - UNKNOWN_PENALTY
        # A user-defined piece wins over the pieces that it consists of.
        self.score = [
            len(t.encode()) * high - 0.1 if k == USER_DEFINED else s
            for t, s, k in zip(pieces.texts, pieces.scores, pieces.kinds)
        ]
        self.unknown_id = next((i for i, k in enumerate(pieces.kinds) if k == UNKNOWN), 0)
        texts = [t for t, _ in ((b.decode(), i) for b, i in usable)]
        # A marker after another character starts a new stretch if no piece holds it inside.
        marked = not any(MARK in t.lstrip(MARK) for t in texts)
        # So does a line break on either side if no piece has one.
        self.cut = re.compile(
            (rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if marked and not any("\n" in t for t in texts) else r"(?s:.+)")
        )
        self.known: dict[str, bytes] = {}

    def path(self, text: str) -> list[int]:
        """Ids of the best segmentation; of equal ones the one with the longest last piece."""
        data = text.encode("utf-8", "surrogatepass")
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        size = len(base)
        n = len(data)
        best: list[float | None] = [None] * (n + 1)
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            first = data[at]
            width = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
            so_far = best[at]
            state, whole = 0, False
            for end in range(at, n):
                nxt = base[state] + data[end]
                if nxt >= size or check[nxt] != state or not base[state]:
                    break
                state = nxt
                piece = value[state]
                if piece >= 0:
                    total = so_far + score[piece]
                    if best[end + 1] is None or total > best[end + 1]:
                        best[end + 1], back[end + 1] = total, (at, piece)
                    whole |= end + 1 - at == width
            if not whole:
                end = at + width
                total = so_far + self.unknown_score
                if best[end] is None or total > best[end]:
                    best[end], back[end] = total, (at, -1)
            at += width
        ids: list[int] = []
        end = n
        byte_ids = self.pieces.byte_ids
        while end:
            start, piece = back[end]
            if piece >= 0:
                ids.append(piece)
            elif byte_ids:
                ids.extend(byte_ids[b] for b in reversed(data[start:end]))
            else:
                ids.append(self.unknown_id)
            end = start
        return ids[::-1]

    def prepared(self, text: str) -> str:
        if self.pieces.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if self.pieces.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", MARK)

    def encode(self, text: str) -> bytes:
        known = self.known
        out = []
        for stretch in self.cut.findall(self.prepared(text)):
            ids = known.get(stretch)
            if ids is None:
                ids = np.array(self.path(stretch), dtype="<u4").tobytes()
                if len(stretch) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[stretch] = ids
            out.append(ids)
        return b"".join(out)

    @cached_property
    def _bytes(self) -> list[bytes]:
        p = self.pieces
        return [
            bytes([int(t[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL
            else " ⁇ ".encode() if k == UNKNOWN else t.replace(MARK, " ").encode()
            for t, k in zip(p.texts, p.kinds)
        ]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self._bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.pieces.dummy_prefix and text.startswith(" ") else text


_LOADED: dict[str, Unigram] = {}


def load(path: str) -> Unigram:
    """The model of a worker; built once per process."""
    if path not in _LOADED:
        _LOADED[path] = Unigram(Pieces.read(path))
    return _LOADED[path]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _mapped(df: DataFrame, source: str, target: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    """All columns of df, with ``target`` made from ``source``."""
    kept = df.drop(target)
    schema = T.StructType([*kept.schema.fields, T.StructField(target, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            made = pa.array([function(x) for x in batch.column(batch.schema.get_field_index(source)).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, target])

    return kept.mapInArrow(run, schema)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Adds ``ids``."""
    path = path or model_path()
    filled = docs.withColumn(text_col, text_of(text_col))
    return _mapped(filled, text_col, "ids", T.BinaryType(), pa.binary(), lambda: load(path).encode)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``."""
    path = path or model_path()

    def make():
        model = load(path)
        return lambda ids: model.decode(np.frombuffer(ids or b"", "<u4"))

    return _mapped(encoded, "ids", "decoded", T.StringType(), pa.string(), make)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_ids, ids_crc32, and whether decoding gives the text back (a whitespace
    marker in the text itself comes back as a blank)."""
    both = decode(encode(docs.select("doc_id", "text"), "text", path), path)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.replace("text", F.lit(MARK), F.lit(" "))).alias("restored"),
    )
