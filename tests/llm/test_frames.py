import os
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
import zstandard
from pyspark.sql import functions as F
from rows import DOCS, documents, sentence
from tokenizers import Tokenizer

from slotwise.llm import queries
from slotwise.llm.frames import SEEKABLE, FrameFile, read_tokens, write_tokens


def brute(rows):
    """doc_id, start, n_tokens, ids in the order of the files."""
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = exact.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def local(path):
    return path.removeprefix("file://")


def test_files_give_back_what_was_written(spark):
    rng = random.Random(3)
    texts = [sentence(rng, n) for n in (1, 5, 400, 3000)] + [None, "", "a <|endoftext|> b", "é€𝄞 \n\n  x"] + [sentence(rng, 20)] * 30
    rows = list(enumerate(texts))
    files = write_tokens(documents(spark, texts).repartition(5), frame_tokens=500)
    got = sorted(map(tuple, read_tokens(files, piece_bytes=1000).collect()))
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == brute(rows)
    assert files.agg(F.sum("n_docs")).first()[0] == len(texts)


def test_any_decoder_reads_the_ids(spark):
    rng = random.Random(4)
    texts = [sentence(rng, n) for n in (3, 800, 20)]
    files = write_tokens(documents(spark, texts), frame_tokens=100).orderBy("part").collect()
    plain = b""
    for f in files:
        data = open(local(f.file), "rb").read()
        assert len(data) == f.n_bytes and int.from_bytes(data[-4:], "little") == SEEKABLE
        plain += zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(x[3] for x in brute(list(enumerate(texts))))


def test_only_wanted_documents_are_read(spark):
    rng = random.Random(5)
    texts = [sentence(rng, 300) for _ in range(200)]
    files = write_tokens(documents(spark, texts).coalesce(1), file_bytes=1 << 30)
    want = [r for r in brute(list(enumerate(texts))) if r[0] in (3, 77, 150)]
    got = sorted(map(tuple, read_tokens(files, [150, 3, 77, 999]).collect()))
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == want
    row = files.orderBy(F.desc("n_docs")).first()
    with FrameFile(row.file) as file:
        tables = file.read_bytes
        file.ids(1)
        assert file.read_bytes - tables < 4 * len(file.ids(1))
        assert file.read_bytes < row.n_bytes / 2
    assert read_tokens(files, []).count() == 0


def test_damage_is_an_error(spark):
    files = write_tokens(documents(spark, ["some words of a text " * 50] * 3)).collect()
    path = local(files[0].file)
    data = bytearray(open(path, "rb").read())
    folder = os.path.dirname(path)
    with FrameFile(path) as file:
        checks = len(file.documents)
    data[9] ^= 0x55
    damaged = f"{folder}/damaged.zst"
    open(damaged, "wb").write(data)
    with FrameFile(damaged) as file, pytest.raises((ValueError, zstandard.ZstdError)):
        [file.ids(k) for k in range(checks)]
    open(damaged, "wb").write(bytes(data[:-20]))
    with pytest.raises(ValueError):
        FrameFile(damaged)


def test_null_and_repeated_ids_clashing_columns_and_empty_tables(spark):
    rows = [(None, "last"), (5, "b"), (5, "b"), (5, "a"), (2, "é " * 5), (-1, "neg")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, part int, ids int")
    got = read_tokens(write_tokens(df)).collect()
    want = brute(rows)
    assert sorted((r.start, r.n_tokens) for r in got) == [(0, want[0][2])] + sorted((s, n) for _, s, n, _ in want[1:])
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((i is None, i) for i, _ in rows)
    assert sorted(bytes(r.ids) for r in got) == sorted(x[3] for x in want)
    assert max(got, key=lambda r: r.start).doc_id is None
    empty = write_tokens(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and read_tokens(empty).count() == 0


def test_a_text_of_many_frames(spark):
    text = "ab " * 400_000
    got = read_tokens(write_tokens(documents(spark, [text, "x"]), frame_tokens=1 << 12)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got] == brute([(0, text), (1, "x")])


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op11_token_frames(spark, folder).collect()))
    assert got == [(i, s, n, zlib.crc32(b)) for i, s, n, b in brute(rows)]
