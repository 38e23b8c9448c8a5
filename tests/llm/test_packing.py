import random

import numpy as np
from rows import DOCS, documents, sentence

from slotwise.llm.packing import balanced, byte_bpe, pack


def check(pieces, lengths, capacity):
    for d, n in enumerate(lengths):
        own = sorted(p[1:3] for p in pieces if p[0] == d)
        assert sum(x[1] for x in own) == n and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[0][0] == 0
    sequences = {}
    for _, _, n, s, offset in pieces:
        sequences.setdefault(s, []).append((offset, n))
    padding = 0
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        used = sum(n for _, n in own)
        assert used <= capacity
        padding += 0 if used & (used - 1) == 0 else capacity - used
    return padding


def test_every_token_once_and_no_padding():
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.choice([1, 7, 100, 900, 2047, 2048, 2049, 9000]) for _ in range(rng.randint(1, 60))]
        assert check(balanced(lengths, 2048, 1.0, 1e-3), lengths, 2048) == 0


def test_costs_are_even():
    pieces = balanced([1000] * 4 + [24] * 200, 2048, 1.0, 1e-2)
    cost = {}
    for _, _, n, s, _ in pieces:
        cost[s] = cost.get(s, 0) + n + 1e-2 * n * n
    full = sorted(cost.values())[-4:]
    assert full[-1] < 1.1 * full[0]


def test_pieces_of_documents(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    rng = random.Random(4)
    texts = [sentence(rng, n) for n in (1, 5, 400, 3000)] + [None, "", "a <|endoftext|> b", "é€𝄞 \n\n  x"]
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: exact.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    rows = pack(documents(spark, texts), shard_tokens=3000).collect()
    for i, ids in want.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == ids
        assert {r.doc_tokens for r in own} == {len(ids)}
    keys = [(r.sequence_id, r.offset) for r in rows]
    assert len(keys) == len(set(keys))
    assert pack(spark.createDataFrame([], DOCS)).count() == 0


def test_the_fast_ids_are_those_of_the_library(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    exact, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), byte_bpe("byte_bpe_50k")
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert fast(r.text).tolist() == exact.encode(r.text, add_special_tokens=False).ids


def test_columns_and_odd_rows(spark):
    from slotwise.llm import queries

    got = queries.op7_packing(spark, "/root/testdata/sf0.001")
    assert got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    df = spark.createDataFrame([(None, "a b", 1, 2), (4, "c", 3, 4), (4, "c", 3, 4)], "doc_id long, text string, ids int, offset int")
    rows = pack(df).collect()
    assert sum(r.length for r in rows) == 7 and {(r.doc_id, r.doc_tokens) for r in rows} == {(None, 3), (4, 2)}
