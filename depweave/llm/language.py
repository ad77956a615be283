"""Language identification: the family first, then the language within it.

Both steps are decided by one-versus-one linear support vector machines over hashed counts of byte
trigrams of the lower-cased text, scaled to length one. The machines are fitted on a bounded sample
of labelled rows: at most `sample` of each language, even over the documents (`samples`). Every whole
text is then classified where it lies; nothing is shuffled.

Families are given by `FAMILIES`; a language that is in none is a family of its own. The score is the
product of the winner's certainties (a logistic function of the margin) against its closest rival
family and its closest rival language.

Defined cases: a text that is null or has no letter is `und` with score 0. With a single learned
language each text gets it; with none each text is `und`. Rows with a null doc_id are classified and
not learned from; their `held_out` is false. Repeated rows each have a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import first_of_each, fold_of
from .shared import Shared

SAMPLE = 300
BITS = 13

# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "pl", "cs", "sk", "uk", "be", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "tt"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "mt"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_PLAIN = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def counts(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams."""
    raw = b" " + text.lower().encode().translate(_PLAIN) + b" "
    if len(raw) < 3:
        raw += b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    hashed = (grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return np.bincount(hashed[grams != 0x202020], minlength=1 << BITS)


def svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 30) -> np.ndarray:
    """A linear support vector machine by coordinate descent on the dual; y is 1 or -1. The last
    weight is the offset. The order of rows is fixed, so the result is reproducible."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    norms = (x * x).sum(axis=1)
    order = np.random.default_rng(0)
    # Both classes weigh the same in all.
    cost = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) * 2.0 * c / max(len(y), 1)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            old = alpha[i]
            alpha[i] = min(max(old - (y[i] * (x[i] @ w) - 1) / norms[i], 0), cost[i])
            if alpha[i] != old:
                w += (alpha[i] - old) * y[i] * x[i]
    return w


class Ovo:
    """One-versus-one machines over some classes."""

    def __init__(self, classes: list[str], x: np.ndarray, labels: np.ndarray):
        self.classes, self.pairs = classes, list(combinations(range(len(classes)), 2))
        weights = []
        for a, b in self.pairs:
            rows = (labels == classes[a]) | (labels == classes[b])
            weights.append(svm(x[rows], np.where(labels[rows] == classes[a], 1.0, -1.0)))
        self.weights = np.array(weights).T if weights else np.zeros((x.shape[1] + 1, 0))

    def decide(self, x: np.ndarray) -> tuple[str, float]:
        """The class with most votes, of equal ones that with the greatest sum of margins, and its
        certainty against its closest rival."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        votes, total = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        least = np.full(len(self.classes), np.inf)
        for (a, b), m in zip(self.pairs, margins, strict=True):
            for one, margin in ((a, m), (b, -m)):
                votes[one] += margin >= 0 if one == a else margin > 0
                total[one] += margin
                least[one] = min(least[one], margin)
        best = max(range(len(self.classes)), key=lambda k: (votes[k], total[k], -k))
        return self.classes[best], float(1 / (1 + np.exp(-3 * least[best])))


class Model:
    def __init__(self, x: np.ndarray, labels: np.ndarray):
        families = np.array([_FAMILY_OF.get(code, code) for code in labels], dtype=object)
        self.top = Ovo(sorted(set(families)), x, families)
        self.within = {
            family: Ovo(sorted(set(labels[families == family])), x, labels)
            for family in self.top.classes
        }

    def predict(self, text: str) -> tuple[str, float]:
        if not self.top.classes:
            return "und", 0.0
        x = counts(text).astype(np.float64)
        x /= max(np.sqrt(x @ x), 1.0)
        family, sure = self.top.decide(x)
        lang, within = self.within[family].decide(x)
        return lang, sure * within


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from rows (doc_id, text, lang): at most `sample` of each language, so the driver
    holds `sample` vectors of 2**BITS numbers per language.

    Rows that can't be in the sample are left out by their hash before texts move: of n different rows
    (doc_id, text) of a language about twice the sample stay, however many have the same doc_id, and
    repeated rows stay or go together, so no language is lost.
    """
    rows = labelled.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    # A row per language.
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    different = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"))
    sizes = {r["lang"]: r["n"] for r in different.collect()}
    if not sizes:
        return Model(np.zeros((0, 1 << BITS)), np.array([], dtype=object))
    pairs = [F.lit(v) for lang, n in sizes.items() for v in (lang, max(1, n // (2 * sample)))]
    share = F.element_at(F.create_map(*pairs), F.col("lang"))
    near = rows.where(F.pmod(F.xxhash64("key"), share) == 0)
    chosen = first_of_each(near, "lang", "key", sample)

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                x = counts(text)
                at = np.flatnonzero(x)
                yield pd.DataFrame({"lang": [lang], "at": [at], "n": [x[at]]})

    kind = "lang string, at array<int>, n array<int>"
    found = chosen.select("lang", "text").mapInPandas(vectors, kind).toPandas()
    found["key"] = [bytes(np.concatenate([a, n])) for a, n in zip(found["at"], found["n"], strict=True)]
    found = found.sort_values(["lang", "key"])
    x = np.zeros((len(found), 1 << BITS))
    for row, (at, n) in zip(x, zip(found["at"], found["n"], strict=True), strict=True):
        row[at] = n
        row /= max(np.sqrt(row @ row), 1.0)
    return Model(x, found["lang"].to_numpy(dtype=object))


def lang_and_score(docs: DataFrame, model: Model, text: Column | str = "text") -> Column:
    """The prediction as a struct (lang_pred, score). The model's size follows from the number of
    languages alone."""
    shared = Shared(docs.sparkSession, model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [shared.value.predict(t) if t is not None else ("und", 0.0) for t in batch]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    value = F.col(text) if isinstance(text, str) else text
    # Only texts with a letter go to Python.
    lettered = F.when(F.coalesce(value.rlike("\\p{L}"), F.lit(False)), value)
    return predict(lettered)


HELD_OUT, FOLDS = 2, 4


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold_of(FOLDS) != HELD_OUT)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the rows that are not held out."""
    model = fit(training_rows(docs), sample)
    return docs.select(
        "doc_id",
        F.coalesce(fold_of(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        lang_and_score(docs, model).alias("p"),
    ).select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` whose language can be told, with all their columns: those with `und` go."""
    model = fit(training_rows(docs), sample)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole).withColumn("p", lang_and_score(docs, model, F.col("row.text")))
    return rows.where(F.col("p.lang_pred") != "und").select("row.*")
