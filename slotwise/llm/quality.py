"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every document. Expectation-maximisation over
the counts of vote patterns (at most 3 to the number of heuristics, counted over all documents)
estimates how often each heuristic's votes are right on good and on bad documents, and the share of
good ones. The resulting posterior labels, as weights of both classes, train a logistic regression on
hashed token shapes; that linear scorer decides.

No text is shuffled or kept. The scorer is fitted on a hash sample of about ``SAMPLE_ROWS`` documents,
whose sparse counts come to the driver; votes, pattern counts and scores cover all documents.

Defined results: a document without words (null, empty, blank) gets score 0 and is rejected. Repeated
rows are scored each, and their copies count in the estimates. With fewer than two kinds of posterior
labels there is nothing to learn and the posterior itself is the score. Other columns pass through;
the added columns _posterior, _score and _keep replace columns of those names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq, itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import column_batches, text_of
from slotwise.llm.near_dedup import GOLDEN, mix

SAMPLE_ROWS = 10_000
BUCKETS = 1 << 16
KEEP = 0.5
GOOD, BAD, NOTHING = 1, 0, 2
SHAPES_KNOWN = 500_000

# Very common words of the four languages.
STOP_WORDS = frozenset(
    (
        "the of and to in a is that for it on with as are was be this from or by at an not but "
        "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es "
        "le la les de et en un une du que qui dans est pour pas au sur par avec "
        "el los las y del se por con para no lo su al"
    ).split()
)
SYMBOLS = "#$%&*|~^<>{}[]=\\_@+"
ENDS = frozenset(".!?")
HEURISTICS = ("symbols", "shouting", "repeats", "variety", "common_words", "sentences", "word_length")
# Words end at these blanks only.
BLANK = re.compile(r"[\x20\x09-\x0D]+")

# Upper case 2, other letters 1, by code point; letters beyond the table count as other letters.
_KINDS = np.array([2 if chr(i).isupper() else 1 if unicodedata.category(chr(i))[0] == "L" else 0 for i in range(0x600)] + [1], np.int8)


def words_of(text: str) -> list[str]:
    return [w for w in BLANK.split(text) if w]


def votes_of(text: str, words: list[str]) -> tuple[int, ...]:
    """Each heuristic's vote. They overlap on purpose."""
    n, chars = len(words), len(text)
    if not n:
        return (NOTHING,) * len(HEURISTICS)
    kinds = _KINDS[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), "<u4"), len(_KINDS) - 1)]
    letters, upper = int(np.count_nonzero(kinds)), int(np.count_nonzero(kinds == 2))
    symbols = sum(map(text.count, SYMBOLS)) / chars
    shouting = upper / letters if letters else 0.0
    again = sum(map(eq, words, words[1:])) / n
    variety = len(set(words)) / n
    stops = sum(map(STOP_WORDS.__contains__, map(str.lower, words))) / n
    ends = sum(map(ENDS.__contains__, map(itemgetter(-1), words))) / n
    long = chars / n

    def vote(good: bool, bad: bool) -> int:
        return BAD if bad else GOOD if good else NOTHING

    return (
        vote(symbols < 0.01, symbols > 0.04),
        vote(shouting < 0.12, shouting > 0.4),
        vote(again < 0.02 and n >= 8, again > 0.15 and n >= 6),
        vote(variety > 0.5 and n >= 8, variety < 0.3 and 20 <= n < 400),
        vote(stops > 0.08 and n >= 8, stops < 0.02 and n >= 12),
        vote(0.01 < ends < 0.3 and n >= 8, ends > 0.6 and n >= 8),
        vote(3 < long < 9 and n >= 8, long > 14 or long < 2.5),
    )


@dataclass
class LabelModel:
    """P(good), and for each heuristic P(vote | class, it votes) as {class: (bad, good)}. No vote says
    nothing about the class."""

    prior: float = 0.5
    rates: list[dict[int, list[float]]] = field(default_factory=list)

    def log_odds(self, votes: tuple[int, ...]) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(
            math.log(r[GOOD][v] / r[BAD][v]) for r, v in zip(self.rates, votes) if v != NOTHING
        )

    def posterior(self, votes: tuple[int, ...]) -> float:
        return _logistic(self.log_odds(votes))

    def accuracy(self) -> dict[str, float]:
        """Per heuristic: the share of its votes that agree with the class, as estimated."""
        return {
            name: self.prior * r[GOOD][GOOD] + (1 - self.prior) * r[BAD][BAD] for name, r in zip(HEURISTICS, self.rates)
        }


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, smooth: float = 1.0) -> LabelModel:
    """EM on (votes, count), from the majority vote."""
    total = sum(c for _, c in patterns)
    if not total:
        return LabelModel(0.5, [{GOOD: [0.5, 0.5], BAD: [0.5, 0.5]} for _ in HEURISTICS])
    weights = []
    for votes, _ in patterns:
        good, bad = votes.count(GOOD), votes.count(BAD)
        # A bad vote is rarer and says more.
        weights.append((good + 0.5) / (good + 2 * bad + 1) if bad else 0.95)
    model = LabelModel()
    for _ in range(rounds):
        share = {GOOD: weights, BAD: [1 - w for w in weights]}
        size = {c: sum(w * n for w, (_, n) in zip(share[c], patterns)) for c in share}
        model = LabelModel((size[GOOD] + smooth) / (total + 2 * smooth), [])
        for h in range(len(patterns[0][0])):
            counts = {c: [smooth] * 2 for c in share}
            for c, ws in share.items():
                for w, (votes, n) in zip(ws, patterns):
                    if votes[h] != NOTHING:
                        counts[c][votes[h]] += w * n
            model.rates.append({c: [x / sum(v) for x in v] for c, v in counts.items()})
        weights = [_logistic(model.log_odds(v)) for v, _ in patterns]
    return model


class Shapes(dict):
    """Word -> hash of its shape: runs of upper case, lower case and digits become A, a and 0."""

    RUNS = re.compile(r"([^\W\d_]+)|(\d+)")

    def __missing__(self, word: str) -> int:
        def run(m: re.Match) -> str:
            if m[2]:
                return "0"
            letters = m[1]
            head = "A" if letters[0].isupper() else "a"
            if len(letters) == 1 or letters.isupper() or letters.islower():
                return head
            return "Aa" if head == "A" and letters[1:].islower() else "aA"

        if len(self) >= SHAPES_KNOWN:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(self.RUNS.sub(run, word))
        return value


def features_of(words: list[str], shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: hashed shapes, pairs of neighbouring shapes, and whether a word repeats the
    one before, as a vector of length 1."""
    if not words:
        return np.empty(0, np.int32), np.empty(0)
    own = np.fromiter(map(shapes.__getitem__, words), np.uint64, len(words))
    pairs = mix(own[:-1] * GOLDEN + own[1:])
    again = sum(map(eq, words, words[1:]))
    hashed, counts = np.unique(np.concatenate([own, pairs]), return_counts=True)
    buckets = np.concatenate([mix(hashed) % np.uint64(BUCKETS - 2) + np.uint64(2), np.array([0, 1], np.uint64)]).astype(np.int32)
    values = np.concatenate([counts, [again, len(words) - 1 - again]]).astype(float)
    return buckets, values / math.sqrt(float(values @ values))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray, values: np.ndarray) -> float:
        return _logistic(float(self.weights[buckets] @ values) + self.bias)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 200, rate: float = 0.3, ridge: float = 1e-6) -> Scorer | None:
    """Logistic regression on soft labels, by Adam on all rows."""
    rows = [r for r in rows if len(r[0])]
    target = np.array([p for _, _, p in rows])
    if not len(rows) or target.sum() < 1 or (1 - target).sum() < 1:
        return None
    starts = np.cumsum([0] + [len(b) for b, _, _ in rows])[:-1]
    buckets, values = np.concatenate([b for b, _, _ in rows]), np.concatenate([v for _, v, _ in rows])
    of_row = np.repeat(np.arange(len(rows)), [len(b) for b, _, _ in rows])
    theta = np.zeros(BUCKETS + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        raw = np.add.reduceat(theta[buckets] * values, starts) + theta[-1]
        gap = 1 / (1 + np.exp(-np.clip(raw, -500, 500))) - target
        grad = np.append(np.bincount(buckets, gap[of_row] * values, BUCKETS), gap.sum()) / len(rows) + ridge * theta
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Scorer(theta[:-1].copy(), float(theta[-1]))


def fit_labels(docs: DataFrame, text_col: str = "text") -> LabelModel:
    """The label model over the votes on all documents with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (texts,) in column_batches(batches, ("text",)):
            counts: dict[bytes, int] = {}
            for text in texts:
                if words := words_of(text):
                    votes = bytes(votes_of(text, words))
                    counts[votes] = counts.get(votes, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["votes", "n"]
            )

    votes = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "votes binary, n long")
    # At most 3^7 rows, whatever the number of documents.
    patterns = votes.groupBy("votes").agg(F.sum("n").alias("n")).collect()
    return estimate(sorted((tuple(r.votes), r.n) for r in patterns))


@dataclass
class QualityModel:
    labels: LabelModel
    scorer: Scorer | None

    def transform(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """Adds _posterior, _score and _keep."""
        labels, scorer = self.labels, self.scorer
        extra = [T.StructField("_posterior", T.DoubleType()), T.StructField("_score", T.DoubleType()), T.StructField("_keep", T.BooleanType())]
        own = docs.drop(*[f.name for f in extra])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shapes = Shapes()
            for batch in batches:
                posteriors, scores = [], []
                for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                    words = words_of(text or "")
                    posterior = labels.posterior(votes_of(text or "", words))
                    score = 0.0 if not words else posterior if scorer is None else scorer.score(*features_of(words, shapes))
                    posteriors.append(posterior)
                    scores.append(score)
                made = [pa.array(posteriors, pa.float64()), pa.array(scores, pa.float64()), pa.array([s >= KEEP for s in scores])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f.name for f in extra]])

        return own.mapInArrow(run, T.StructType([*own.schema.fields, *extra]))


def train(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    labels = fit_labels(docs, text_col)
    share = min(1.0, sample_rows / max(docs.count(), 1))
    # By a hash of whole rows, so that copies of a text don't all come together.
    parts = 1 << 40
    picked = docs.where(F.pmod(F.xxhash64(*docs.columns), F.lit(parts)) < math.ceil(share * parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for (texts,) in column_batches(batches, ("text",)):
            rows = [(*features_of(w, shapes), labels.posterior(votes_of(t, w))) for t in texts for w in [words_of(t)]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b.tobytes() for b, _, _ in rows], pa.binary()), pa.array([v.tobytes() for _, v, _ in rows], pa.binary()),
                    pa.array([p for _, _, p in rows], pa.float64()),
                ],
                names=["buckets", "values", "p"],
            )

    sample = picked.select(text_of(text_col).alias("text")).mapInArrow(run, "buckets binary, values binary, p double")
    rows = [(np.frombuffer(r.buckets, np.int32), np.frombuffer(r["values"]), r.p) for r in sample.toLocalIterator()]
    return QualityModel(labels, fit_scorer(rows))


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, posterior of the weak labels, score of the scorer, and whether it stays."""
    scored = train(docs).transform(docs.select("doc_id", text_of().alias("text")))
    return scored.select("doc_id", F.col("_posterior").alias("posterior"), F.col("_score").alias("score"), F.col("_keep").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """Documents that the scorer keeps, with their columns."""
    return train(docs).transform(docs).where("_keep").select(*docs.columns)
