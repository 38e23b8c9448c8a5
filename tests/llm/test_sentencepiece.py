import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import documents, sentence

from slotwise.llm.sentencepiece import BYTE, CONTROL, MARK, NORMAL, UNKNOWN, DoubleArray, Pieces, Unigram, decode, encode, load, model_path, round_trip


def toy(rng):
    texts = ["<unk>", "<s>"] + [f"<0x{b:02X}>" for b in range(256)]
    kinds = [UNKNOWN, CONTROL] + [BYTE] * 256
    scores = [0.0] * len(texts)
    words = {MARK, *"abc"} | {"".join(rng.choice(MARK + "abc") if i == 0 else rng.choice("abc") for i in range(rng.randint(2, 4))) for _ in range(30)}
    for w in sorted(words):
        texts.append(w)
        kinds.append(NORMAL)
        scores.append(-rng.random() * 10)
    return Pieces(texts, scores, kinds)


def best_score(model, text):
    """Plain dynamic programming over characters of the whole text."""
    score = {t: s for t, s, k in zip(model.pieces.texts, model.pieces.scores, model.pieces.kinds) if k == NORMAL}
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            s = score.get(piece, model.unknown_score if len(piece) == 1 else None)
            if s is not None:
                best[end] = max(best[end], best[start] + s)
    return best[-1]


def score_of(model, ids):
    total, byte = 0.0, 0
    for i in ids:
        if model.pieces.kinds[i] != BYTE:
            total += model.pieces.scores[i]
    text = b"".join(model._bytes[i] for i in ids if model.pieces.kinds[i] == BYTE).decode()
    return total + len(text) * model.unknown_score


def test_paths_are_best():
    rng = random.Random(9)
    for _ in range(20):
        model = Unigram(toy(rng))
        for _ in range(20):
            text = "".join(rng.choice("abc  é\n€") for _ in range(rng.randint(0, 25)))
            ids = np.frombuffer(model.encode(text), "<u4")
            assert score_of(model, ids) == pytest.approx(best_score(model, model.prepared(text)))


def test_trie_finds_what_a_dict_finds():
    keys = {sentence(random.Random(i), 1).encode(): i for i in range(400)}
    trie = DoubleArray(list(keys.items()))
    for key, value in list(keys.items()) + [(b"nothing", -1)]:
        state = 0
        for b in key:
            nxt = trie.base[state] + b
            state = nxt if nxt < len(trie.check) and trie.base[state] and trie.check[nxt] == state else None
            if state is None:
                break
        assert (trie.value[state] if state is not None else -1) == value


def test_round_trip_of_a_real_model(spark):
    texts = ["", None, "plain words  and   gaps ", "\n\n\t x", "é€𝄞 日本", "a" * 5000, " lead", sentence(random.Random(1), 300)]
    assert load(model_path()).pieces.squeeze is False
    rows = decode(encode(documents(spark, texts).withColumn("ids", F.lit(0)))).collect()
    assert {r.doc_id: r.decoded for r in rows} == {i: t or "" for i, t in enumerate(texts)}
    assert all(r.restored for r in round_trip(documents(spark, texts)).collect())
    assert round_trip(documents(spark, []).limit(0)).count() == 0
