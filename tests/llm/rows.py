"""Small tables for the tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ba", "de", "ki", "lo", "mu", "ra", "so", "tu", "ve", "zi") for b in ("n", "r", "st", "l", "x", "m", "p", "t", "d", "k")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
