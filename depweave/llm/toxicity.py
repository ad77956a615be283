"""Toxicity by maximum-scoring segments.

Tokens are words and their beginnings of 3 to 8 letters, so that inflected forms of a word add up.
Each has the log-odds of toxic against clean documents under Dirichlet priors that follow its share
of the whole corpus, moved towards zero by some standard deviations. A word's score is the strongest
of its tokens' log-odds, less a small drift. Neutral words thus score just below zero, and a passage is a run of words with a positive sum.
All maximal segments of a text are found in one linear scan. By extreme-value theory the chance that
clean text of n words has a segment of sum S is about K·n·exp(-lambda·S): lambda follows from the
scores and the words' shares in clean text, K is fitted to the best segments of clean documents. A
document's evidence is the sum of lambda·S - ln(K·n) over the segments where that is positive, and a
logistic function fitted on labelled rows makes a score of 0 to 1 of it.

Tokens are counted, once per document, over all documents, in 2**BITS buckets of a hash, which bounds
all that is gathered and broadcast. Labels are learned from at most `sample` documents of either label.

Defined cases: null and empty texts have no words and get the score of no evidence. Without labels
of both kinds every score is 0. A document with several rows in `labels` is toxic if one of them
says so. Rows with a null doc_id are scored and never learned from. Repeated rows each have a row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import first_of_each, fold_of
from .shared import Shared
from .text import Memo, folded

SAMPLE = 10_000
BITS = 20
DRIFT = 0.1
DEVIATIONS = 2.5
HELD_OUT, FOLDS = 0, 5
_CUT = 1 << 13

Stage = Callable[[str, DataFrame], DataFrame]


def words_of(text: str | None) -> list[str]:
    return folded(text or "").decode().split()


def buckets_of(word: str) -> list[int]:
    """The buckets of a word and of its beginnings. A whole word is marked by a blank."""
    tokens = [word + " ", *(word[:k] for k in range(3, min(len(word), 8) + 1))]
    return [zlib.crc32(token.encode()) & ((1 << BITS) - 1) for token in tokens]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, sum) of all maximal scoring segments, in linear time.

    Only runs of positive scores can start or end a segment. A run is joined to the nearest earlier
    segment that begins lower than the run does, if that one ends lower than the run ends.
    """
    positive = np.concatenate(([False], scores > 0, [False]))
    edges = np.flatnonzero(positive[1:] != positive[:-1])
    if not len(edges):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    # start, end, sum before start, sum at end, place of the nearest one that begins lower
    stack: list[tuple[int, int, float, float, int]] = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        low, high = float(total[start]), float(total[end])
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= low:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= high:
                stack.append((start, end, low, high, at))
                break
            start, _, low, _, below = stack[at]
            del stack[at:]
            at = below
    return [(start, end, high - low) for start, end, low, high, _ in stack]


@dataclass
class Model:
    odds: np.ndarray
    rate: float = 1.0
    log_k: float = 0.0
    offset: float = 0.0
    slope: float = 1.0

    def word(self, word: str) -> float:
        own = self.odds[buckets_of(word)]
        return float(own[np.abs(own).argmax()]) - DRIFT


class Scorer:
    """A model and the scores of the words it has seen."""

    def __init__(self, model: Model):
        self.model, self.known = model, Memo(48 << 20)

    def scores(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        for word in self.known.missing(words):
            self.known[word] = self.model.word(word)
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def found(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """(start, end, evidence) of the significant segments."""
        least = self.model.log_k + np.log(max(len(scores), 1))
        rows = [(a, b, self.model.rate * s - least) for a, b, s in segments(scores)]
        return [row for row in rows if row[2] > 0]

    def evidence(self, scores: np.ndarray) -> float:
        return float(np.log1p(sum(e for _, _, e in self.found(scores))))

    def probability(self, text: str | None) -> float:
        x = self.model.offset + self.model.slope * self.evidence(self.scores(text))
        return float(1 / (1 + np.exp(-x)))


def token_counts(texts: DataFrame) -> np.ndarray:
    """The number of documents of `texts` (column `text`) with each bucket's tokens. Tasks send their
    sums in pieces of fixed size, which are added per piece; 2**BITS numbers arrive."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, total = Counter(), np.zeros(1 << BITS, np.int64)

        def settle() -> None:
            for word, n in words.items():
                for bucket in buckets_of(word):
                    total[bucket] += n
            words.clear()

        for frame in frames:
            for text in frame["text"]:
                words.update(set(words_of(text)))
                if len(words) > 500_000:
                    settle()
        settle()
        for k in range(0, len(total), _CUT):
            packed = zlib.compress(total[k : k + _CUT].tobytes(), 1)
            yield pd.DataFrame({"piece": [k // _CUT], "packed": [packed]})

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for piece, packed in zip(frame["piece"], frame["packed"], strict=True):
                own = np.frombuffer(zlib.decompress(packed), np.int64)
                sums[piece] = sums[piece] + own if piece in sums else own
        for piece, total in sums.items():
            packed = zlib.compress(total.tobytes(), 1)
            yield pd.DataFrame({"piece": [piece], "packed": [packed]})

    kind = "piece long, packed binary"
    sums = texts.select("text").mapInPandas(counted, kind).repartition("piece").mapInPandas(added, kind)
    total = np.zeros(1 << BITS, np.int64)
    for row in sums.collect():
        at = row["piece"] * _CUT
        total[at : at + _CUT] += np.frombuffer(zlib.decompress(row["packed"]), np.int64)
    return total


def log_odds(every: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Log-odds of each bucket under a Dirichlet prior that follows the corpus, moved towards zero."""
    weight = 0.1 * toxic.sum() + 1
    prior = weight * (every + 1e-3) / (every.sum() + 1e-3 * len(every))
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    sure = np.maximum(np.abs(odds) - DEVIATIONS * np.sqrt(1 / a + 1 / b), 0)
    return (np.sign(odds) * sure).astype(np.float32)


def decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(shares * exp(rate * scores)) = 1. It exists if the mean score is
    negative and some score is positive; otherwise any rate serves and 1 is given."""
    if not (scores > 0).any() or shares @ scores >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while shares @ np.exp(np.minimum(high * scores, 600)) < 1:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if shares @ np.exp(np.minimum(middle * scores, 600)) < 1 else (low, middle)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope by Newton's method, with a weak pull towards zero."""
    beta, rows = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (y - p) - 1e-2 * beta
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _evidence(sample: DataFrame, model: Model) -> pd.DataFrame:
    """(toxic, n, best, x) of each row of the sample, which is bounded."""
    shared = Shared(sample.sparkSession, model)

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for frame in frames:
            rows = []
            for toxic, text in zip(frame["toxic"], frame["text"], strict=True):
                own = scorer.scores(text)
                best = max((s for _, _, s in segments(own)), default=0.0)
                rows.append((toxic, len(own), best, scorer.evidence(own)))
            yield pd.DataFrame(rows, columns=["toxic", "n", "best", "x"])

    kind = "toxic int, n long, best double, x double"
    seen = sample.select("toxic", "text").mapInPandas(measured, kind).toPandas()
    # Sums of doubles depend on the order.
    return seen.sort_values(["toxic", "n", "best", "x"], ignore_index=True)


def fit(docs: DataFrame, labels: DataFrame, stage: Stage, sample: int = SAMPLE) -> Model | None:
    """None if there are not both toxic and clean labels among the rows to learn from."""
    known = (
        labels.where((fold_of(FOLDS) != HELD_OUT) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") == 0, 0).otherwise(1)).alias("toxic"))
    )
    # At most 2 * `sample` rows. Repeated rows of a document are one to learn from.
    chosen = F.broadcast(first_of_each(known, "toxic", "doc_id", sample))
    learned = stage(
        "learned",
        # Of different texts of one doc_id that with the smallest hash, so a fit can be repeated.
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("least"))
        .select("doc_id", "least.text", "least.toxic"),
    )
    every = token_counts(docs)
    toxic, clean = (token_counts(learned.where(F.col("toxic") == k)) for k in (1, 0))
    if not toxic.sum() or not clean.sum():
        return None
    model = Model(log_odds(every, toxic, clean))
    smooth = clean + 0.5 * every / max(every.sum(), 1)
    model.rate = decay(model.odds - DRIFT, smooth / smooth.sum())
    seen = _evidence(learned, model)
    # The mean of the extreme-value distribution of rate * best - ln(n) is ln(K) + 0.5772.
    quiet = seen[(seen["toxic"] == 0) & (seen["n"] > 0)]
    model.log_k = float((model.rate * quiet["best"] - np.log(quiet["n"])).mean() - 0.5772)
    seen = _evidence(learned, model)
    model.offset, model.slope = logistic(seen["x"].to_numpy(), seen["toxic"].to_numpy())
    return model


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of `docs`."""
    held_out = F.coalesce(fold_of(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    if model is None:
        score = F.lit(0.0)
    else:
        shared = Shared(docs.sparkSession, model)

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = Scorer(shared.value)
            for batch in batches:
                yield pd.Series([scorer.probability(text) for text in batch], dtype="float64")

        score = scored(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", held_out, score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, first, last, evidence): every significant passage, as numbers of the first word and
    of the one after the last."""
    shared = Shared(docs.sparkSession, model)

    @F.pandas_udf("array<struct<first: long, last: long, evidence: double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.Series(
                [
                    [
                        {"first": a, "last": b, "evidence": float(e)}
                        for a, b, e in scorer.found(scorer.scores(text))
                    ]
                    for text in batch
                ]
            )

    rows = docs.select("doc_id", F.explode(found(F.coalesce("text", F.lit("")))).alias("p"))
    return rows.select("doc_id", "p.*")
