import random
from collections import defaultdict

import numpy as np
import pytest
from rows import DOCS, documents, sentence

from slotwise.llm.components import components
from slotwise.llm.near_dedup import WordHashes, drop_near_duplicates, near_duplicates, shingles, sketch


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute(rows, k, least):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for e in s:
            holders[e].append(i)
    for i, s in sets.items():
        for j in {j for e in s for j in holders[e] if j > i}:
            if 100 * len(s & sets[j]) >= least * len(s | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(rng, size, words, most_edits):
    base = sentence(rng, words).split()
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randint(0, most_edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("words,least", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, words, least):
    rng = random.Random(5)
    texts = family(rng, 60, 120, 9) + family(rng, 25, 60, 2) + [sentence(rng, 80) for _ in range(20)]
    texts += [None, "", " ", "one", "one", "ONE two", "one TWO", texts[3].upper(), "x y z " * 4000]
    rng.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, texts), words, least).collect()}
    assert got == brute(list(enumerate(texts)), words, least)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    items = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    for n in (1, 2, 7, 300):
        assert (sketch(items[:n], 128) < np.uint64(2**64 - 1)).all()
    one, two = sketch(items[:900], 512), sketch(items[100:1000], 512)
    assert abs((one == two).mean() - 0.8) < 0.08
    assert (sketch(items[:900][::-1].copy(), 512) == one).all()


def test_only_ascii_is_folded_and_few_words_are_one_shingle():
    known = WordHashes()
    assert len(shingles("Ab c", 3, known)) == 1
    assert (shingles("Ab c", 3, known) == shingles("aB\tC", 3, known)).all()
    assert (shingles("É", 3, known) != shingles("é", 3, known)).all()


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d", 9, 9), (1, "a b c d", 9, 9), (None, "a b c d", 9, 9), (2, None, 9, 9)], "doc_id long, text string, n int, key int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, None, True), (2, 2, True)], key=repr)
    assert drop_near_duplicates(df).columns == df.columns
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (201, 200), (5, 5)], "a long, b long")
    got = {r.id: r.component for r in components(path).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}
