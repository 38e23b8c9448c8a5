import hashlib
import random
from collections import Counter

import pytest
from rows import DOCS, documents, sentence

from slotwise.llm.suffix_dedup import remove_repeats, repeated_starts, window_runs


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(d)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_construction_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        width = rng.choice([3, 5, 8])
        letters = b"abc"[: rng.randint(1, 3)]
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(width, 30))) for _ in range(rng.randint(1, 12))]
        seen = Counter(s[i : i + width] for s in strings for i in range(len(s) - width + 1))
        want = [[i for i in range(len(s) - width + 1) if seen[s[i : i + width]] > 1] for s in strings]
        assert [x.tolist() for x in repeated_starts(strings, width)] == want


def test_runs_cover_every_window_once():
    text = (sentence(random.Random(1), 300) + "z" * 900).encode()
    keys, starts, counts, twice = window_runs(text, 200, 64)
    assert counts.sum() == len(text) - 199 and counts.max() <= 137
    assert (starts[1:] == starts[:-1] + counts[:-1]).all() and twice.any()


@pytest.mark.parametrize("hot", [20_000, 2])
def test_documents_equal_brute_force(spark, hot):
    rng = random.Random(8)
    shared = [sentence(rng, 40) for _ in range(3)]
    texts = [sentence(rng, 60) for _ in range(12)]
    texts += [f"{sentence(rng, 20)} {rng.choice(shared)} {sentence(rng, 20)}" for _ in range(12)]
    texts += [texts[0], texts[0] + " tail", None, "", "short", "ab" * 400, "né" * 300, shared[0][:199], shared[0][:200]]
    inner = sentence(rng, 40)
    texts.append(f"{inner} {sentence(rng, 30)} {inner}")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(documents(spark, texts), hot_strings=hot).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 200)


def test_repeated_rows_and_empty_table(spark):
    text = sentence(random.Random(2), 60)
    df = spark.createDataFrame([(1, text, 0), (1, text, 0), (None, "x", 0)], "doc_id long, text string, digest int")
    assert sorted(((r.doc_id, r.n_removed) for r in remove_repeats(df).collect()), key=repr) == sorted(
        [(1, len(text)), (1, len(text)), (None, 0)], key=repr
    )
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
