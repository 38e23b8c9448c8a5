"""Token ids in files of independent Zstandard frames with a trailing seek table.

A file holds documents one after the other, each in frames of its own (a long document in several of
at most ``FRAME_TOKENS`` ids), then two frames that a Zstandard decoder skips: the documents' ids and
lengths, and the seek table of the public seekable format with the compressed size, the plain size
and a checksum (low 32 bits of XXH64) of every frame. A reader fetches the two tables from the end of
the file and decompresses the frames of the documents it wants; a frame that does not match its
checksum is an error. Any Zstandard decoder reads the whole file as the plain ids, little-endian
unsigned 32-bit.

``write_tokens`` deals the texts by ranges of the id, orders each range and encodes it while writing,
so a task holds one document and the tables of its file, never its ids. Files carry a random name and
a task hands its file's name on only when it is complete: what a lost or repeated attempt leaves
behind is listed nowhere. The list of files is staged in the shared folder, and so are the files; the
folder may be any that pyarrow opens (local paths, HDFS, object stores). ``read_tokens`` reads files
in pieces of about ``PIECE_BYTES``, one after the other.

Defined results: a null text is empty and has the closing id alone. Rows with a null id come last.
Repeated ids are written one after the other, ordered by text. Texts of any length pass. Extra
columns are not written. An empty table gives an empty list of files and no documents.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import column_batches, shared_folder, stage, text_of
from slotwise.llm.packing import byte_bpe

FRAME_TOKENS = 1 << 18
# Text of one file, and plain bytes that one task of a reader takes.
FILE_BYTES = 256 << 20
PIECE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
# Fixed values of the seekable format: magic numbers and the flag for checksums.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
_HEAD = struct.Struct("<II")
_FOOT = struct.Struct("<IBI")
FRAME = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("known", "<u1"), ("tokens", "<u8"), ("frames", "<u4")])
FILE_SCHEMA = "file string, part int, first_id long, last_id long, n_docs long, n_tokens long, n_bytes long"


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI or a plain path, as every executor opens it."""
    uri = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pa.fs.FileSystem.from_uri(uri)


def _checksum(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents into one open file."""

    def __init__(self, out, level: int = 3, frame_tokens: int = FRAME_TOKENS) -> None:
        self._out, self._step = out, frame_tokens * 4
        self._pack = zstandard.ZstdCompressor(level=level, write_checksum=False).compress
        self._frames, self._documents = bytearray(), bytearray()
        self.size = self.documents = self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        plain = np.ascontiguousarray(ids, dtype="<u4").tobytes()
        cuts = range(0, len(plain), self._step)
        for at in cuts:
            part = plain[at : at + self._step]
            packed = self._pack(part)
            self._write(packed)
            self._frames += np.array((len(packed), len(part), _checksum(part)), dtype=FRAME).tobytes()
        self._documents += np.array((doc_id or 0, doc_id is not None, len(ids), len(cuts)), dtype=DOCUMENT).tobytes()
        self.documents += 1
        self.tokens += len(ids)

    def close(self) -> None:
        """The tables go last, so a file without them was not finished."""
        table = bytes(self._documents)
        self._write(_HEAD.pack(SKIPPABLE, len(table) + 4) + struct.pack("<I", _checksum(table)) + table)
        # Seek entries cover skippable frames too: no plain bytes, nothing to check.
        self._frames += np.array((len(table) + 12, 0, _checksum(b"")), dtype=FRAME).tobytes()
        foot = _FOOT.pack(len(self._frames) // FRAME.itemsize, CHECKSUMS, SEEKABLE)
        self._write(_HEAD.pack(SEEK_TABLE, len(self._frames) + len(foot)) + bytes(self._frames) + foot)

    def _write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)


class FrameFile:
    """Reads single documents of a file. ``read_bytes`` counts what was fetched from it."""

    def __init__(self, path: str) -> None:
        self.path, self.read_bytes = path, 0
        store, inner = _store(path)
        self._in = store.open_input_file(inner)
        size = self._in.size()
        frames, flags, magic = _FOOT.unpack(self._fetch(size - _FOOT.size, _FOOT.size))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError(f"{path} does not end in a seek table with checksums")
        length = frames * FRAME.itemsize
        table = self._fetch(size - _FOOT.size - length - _HEAD.size, length + _HEAD.size)
        if _HEAD.unpack_from(table) != (SEEK_TABLE, length + _FOOT.size):
            raise ValueError(f"the seek table of {path} is damaged")
        self._frames = np.frombuffer(table, FRAME, offset=_HEAD.size)
        self._offsets = np.concatenate([[0], np.cumsum(self._frames["packed"], dtype=np.int64)])
        listed = self._fetch(int(self._offsets[-2]), int(self._frames["packed"][-1]))
        magic, _, check = struct.unpack_from("<III", listed)
        if magic != SKIPPABLE or _checksum(listed[12:]) != check:
            raise ValueError(f"the document table of {path} is damaged")
        self.documents = np.frombuffer(listed, DOCUMENT, offset=12)
        self.first_frame = np.concatenate([[0], np.cumsum(self.documents["frames"], dtype=np.int64)])
        # Ids of the file before each document.
        self.starts = np.concatenate([[0], np.cumsum(self.documents["tokens"], dtype=np.int64)])

    def __enter__(self) -> FrameFile:
        return self

    def __exit__(self, *_) -> None:
        self._in.close()

    def _fetch(self, at: int, length: int) -> bytes:
        self.read_bytes += length
        return self._in.read_at(length, at)

    def doc_id(self, k: int) -> int | None:
        row = self.documents[k]
        return int(row["doc_id"]) if row["known"] else None

    def positions(self, doc_ids: Sequence[int]) -> list[int]:
        """Places of the documents with these ids; ids ascend in a file, so this is a search."""
        known = int(self.documents["known"].sum())
        ids = self.documents["doc_id"][:known]
        wanted = np.unique(np.asarray(doc_ids, dtype=np.int64))
        low, high = np.searchsorted(ids, wanted, "left"), np.searchsorted(ids, wanted, "right")
        return [k for a, b in zip(low.tolist(), high.tolist()) for k in range(a, b)]

    def ids(self, k: int) -> bytes:
        """Ids of the k-th document: only its own frames are fetched and decompressed."""
        a, b = int(self.first_frame[k]), int(self.first_frame[k + 1])
        data = self._fetch(int(self._offsets[a]), int(self._offsets[b] - self._offsets[a]))
        unpack, parts, at = zstandard.ZstdDecompressor(), [], 0
        for frame in range(a, b):
            size, plain, check = (int(x) for x in self._frames[frame])
            part = unpack.decompress(data[at : at + size], max_output_size=plain)
            if len(part) != plain or _checksum(part) != check:
                raise ValueError(f"frame {frame} of {self.path} does not match its checksum")
            parts.append(part)
            at += size
        return b"".join(parts)


def write_tokens(
    docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k",
    end_id: int | None = 0, file_bytes: int = FILE_BYTES, frame_tokens: int = FRAME_TOKENS, level: int = 3,
) -> DataFrame:
    """Writes the ids of all texts in ascending order of the id, and returns the list of files: file,
    part (its place in the order), first_id, last_id, n_docs, n_tokens, n_bytes."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer)
        end = np.array([] if end_id is None else [end_id], dtype="<u4")
        writer = out = None
        for parts, doc_ids, texts in column_batches(batches, ("part", "doc_id", "text")):
            for part, doc_id, text in zip(parts, doc_ids, texts):
                if writer is None:
                    store, inner = _store(folder)
                    store.create_dir(inner, recursive=True)
                    name = f"{part:06d}-{uuid.uuid4().hex}.zst"
                    out = store.open_output_stream(f"{inner.rstrip('/')}/{name}", compression=None)
                    writer, place, first, last = FrameWriter(out, level, frame_tokens), part, doc_id, doc_id
                last = doc_id if doc_id is not None else last
                writer.add(doc_id, np.concatenate([encode(text), end]))
        if writer is not None:
            writer.close()
            out.close()
            row = (f"{folder}/{name}", place, first, last, writer.documents, writer.tokens, writer.size)
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds)], names=[f.split()[0] for f in FILE_SCHEMA.split(", ")]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    dealt = texts.repartitionByRange(files, order[0], order[1]).sortWithinPartitions(*order)
    return stage(dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(write, FILE_SCHEMA))


def read_tokens(files: DataFrame, doc_ids: Sequence[int] | None = None, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Documents of listed files: doc_id, start (ids of all documents before it), n_tokens, ids. With
    ``doc_ids`` (a list that fits into a task) only these are fetched and decompressed."""
    wanted = None if doc_ids is None else sorted(set(doc_ids))
    # One row per file: a running sum over the list, not over documents.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.withColumn("before", before)
    if wanted is not None:
        if not wanted:
            listed = listed.where("false")
        else:
            listed = listed.where((F.col("first_id") <= wanted[-1]) & (F.col("last_id") >= wanted[0]))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") * 4 / F.lit(piece_bytes))).cast("int")
    listed = listed.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in column_batches(batches, ("file", "before", "piece", "pieces")):
            for path, before, piece, pieces in zip(*columns):
                with FrameFile(path) as file:
                    yield from documents(file, before, piece, pieces)

    def documents(file: FrameFile, before: int, piece: int, pieces: int) -> Iterator[pa.RecordBatch]:
        # A document belongs to the piece in which it starts.
        total = int(file.starts[-1])
        low, high = (np.searchsorted(file.starts[:-1], total * p // pieces) for p in (piece, piece + 1))
        places = range(int(low), int(high) if piece + 1 < pieces else len(file.documents))
        if wanted is not None:
            places = [k for k in file.positions(wanted) if places.start <= k < places.stop]
        rows, held = [], 0
        for k in places:
            rows.append((file.doc_id(k), before + int(file.starts[k]), int(file.documents["tokens"][k]), file.ids(k)))
            held += len(rows[-1][3])
            if held >= BATCH_BYTES:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids"]
        )

    spread = listed.select("file", "before", "piece", "pieces").repartition(listed.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
