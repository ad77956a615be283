"""Importance resampling towards a target: the documents that look most like the target's text, drawn
at random in proportion to that.

Features are all runs of 1 to `order` consecutive words, joined by one space, and fall into `buckets`
buckets by the CRC-32 of their bytes. The gain of a bucket is the floored 1000-fold logarithm of its
share in the target over its share in the corpus, one added to each count. A document's weight is the
floored mean of its features' gains; it is found by one gather from the array of gains. Weights plus
Gumbel noise that follows from the document's id are its score, and the highest scores are a sample
without replacement in proportion to the weights.

Texts are scanned once: the buckets of each document's features are written, two bytes for a feature.
Counts are added up in tasks and meet per bucket; `buckets` numbers reach the driver, and as many go
to the tasks, whatever the data.

Scores are ranked by a least-significant-digit radix sort of the key (score falling, doc_id, nulls last);
`radix_ranked` says how. No task holds more than a chunk of the rows in order.

Defined cases: a null text has no words; a document without features has weight 0 and, like all with
fewer than `least` words, no rank. A null doc_id counts as an empty one for the noise and comes last among equals. Repeated rows have rows and ranks of their own,
those alike in score and doc_id in any order. Without a target all gains come from counts of 0. An empty table gives an empty result. Further columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import Memo, folded

ORDER, BUCKETS, LEAST, PERCENT, SEED = 1, 10_000, 20, 10, 2024
DIGIT_BITS, CHUNK_BITS = 12, 18
_SIGN = -(1 << 63)

Stage = Callable[[str, DataFrame], DataFrame]


def features(text: bytes, order: int) -> Iterator[bytes]:
    """The features of a folded text, shorter runs first."""
    words = text.split()
    yield from words
    for n in range(2, order + 1):
        for k in range(len(words) - n + 1):
            yield b" ".join(words[k : k + n])


class Hasher:
    """Buckets of features, with a memory for those of single words."""

    def __init__(self, order: int, buckets: int):
        if not 1 <= buckets <= 1 << 16:
            raise ValueError("buckets")
        self.order, self.buckets, self.known = order, buckets, Memo(longest=64)

    def buckets_of(self, text: str | None) -> tuple[int, np.ndarray]:
        """(words, bucket of each feature)."""
        data = folded(text or "")
        words = data.split()
        new = self.known.missing(words)
        for word in new:
            self.known[word] = crc32(word) % self.buckets
        single = np.fromiter(map(self.known.__getitem__, words), np.uint16, len(words))
        self.known.forget_long(new)
        if self.order == 1:
            return len(words), single
        runs = [crc32(f) % self.buckets for f in features(data, self.order)][len(words) :]
        return len(words), np.concatenate([single, np.array(runs, np.uint16)])


def hashed(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, packed): `packed` is the bucket of every feature, 16 bits each."""

    @F.pandas_udf("n_words long, n_features long, packed binary")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(order, buckets)
        for batch in batches:
            rows = []
            for text in batch:
                n_words, found = hasher.buckets_of(text)
                rows.append((n_words, len(found), found.tobytes()))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "packed"])

    rows = docs.select(F.col(key).alias("doc_id"), scanned(F.col("text")).alias("h"))
    return rows.select("doc_id", "h.*")


def counts(packed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows are in each bucket."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for frame in frames:
            for data in frame["packed"]:
                total += np.bincount(np.frombuffer(data, np.uint16), minlength=buckets)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": found, "n": total[found]})

    sums = (
        packed.select("packed")
        .mapInPandas(counted, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    total = np.zeros(buckets, np.int64)
    # At most `buckets` rows.
    for row in sums.collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket."""
    smooth = len(corpus)
    in_corpus, in_target = float(corpus.sum() + smooth), float(target.sum() + smooth)
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1) * in_corpus) / ((s + 1) * in_target)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def _weight(gain: np.ndarray) -> Callable:
    @F.pandas_udf("long")
    def weight(packed: pd.Series) -> pd.Series:
        found = (np.frombuffer(data, np.uint16) for data in packed)
        return pd.Series([int(gain[f].sum()) // len(f) if len(f) else 0 for f in found], dtype="int64")

    return weight


def noise(key: str, seed: int = SEED) -> Column:
    """1000-fold Gumbel noise, floored, from the first 32 bits of a digest of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


@dataclass
class Piece:
    """The low `width` bits of a long column, in the composite key above those of the pieces before."""

    column: Column
    width: int


def _varying(least: int, most: int) -> int:
    """How many low bits differ among numbers from `least` to `most`."""
    return ((least ^ most) & (2**64 - 1)).bit_length()


def _digit(pieces: list[Piece], start: int, end: int) -> Column:
    """Bits `start` to `end` of the composite key; `pieces` from the least significant."""
    digit, base = F.lit(0).cast("long"), 0
    for piece in pieces:
        low, high = max(start, base), min(end, base + piece.width)
        if low < high:
            bits = F.shiftrightunsigned(piece.column, low - base).bitwiseAND((1 << (high - low)) - 1)
            digit = digit.bitwiseOR(F.shiftleft(bits, low - start))
        base += piece.width
    return digit


def _starts(keyed: DataFrame) -> DataFrame:
    """(chunk, digit, start): the place of a chunk's first row of a digit. All rows of smaller digits
    come before it, and those of the same digit in earlier chunks."""
    counts = keyed.groupBy("chunk", "digit").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(
        W.partitionBy("digit").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    )
    # As many rows as a digit has values, at most.
    totals = counts.groupBy("digit").agg(F.sum("n").alias("total"))
    smaller = F.sum("total").over(W.orderBy("digit").rowsBetween(W.unboundedPreceding, -1))
    bases = totals.select("digit", F.coalesce(smaller, F.lit(0)).alias("base"))
    own = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    return own.join(F.broadcast(bases), "digit").select(
        "chunk", "digit", (F.col("base") + F.col("before")).alias("start")
    )


def radix_ranked(
    rows: DataFrame,
    score: str,
    key: str,
    stage: Stage,
    digit_bits: int = DIGIT_BITS,
    chunk_bits: int = CHUNK_BITS,
) -> tuple[DataFrame, int]:
    """(`rows` with `rank` from 1 by `score` falling, `key` rising, nulls last; how many they are).

    The composite key has the bits in which scores differ, one bit for nulls and the bits in which keys
    differ. Each pass is a stable counting sort by one digit, from the lowest: rows are cut into chunks
    of 2**chunk_bits successive places, the rows of each digit in each chunk are counted, the counts'
    sums over smaller digits and earlier chunks give where a chunk's rows of a digit go, and a row's
    own destination is that plus its number among them. Rows are shuffled by (chunk, digit), so what
    meets is bounded by a chunk however many rows share a digit. A pass's rows are written, in no order
    but with their places. Counts are at most 2**digit_bits a chunk.
    """
    now = stage("unsorted", rows.withColumn("place", F.monotonically_increasing_id()))
    span = now.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(score).alias("s0"),
        F.max(score).alias("s1"),
        F.min(key).alias("k0"),
        F.max(key).alias("k1"),
        F.coalesce(F.bool_or(F.col(key).isNull()), F.lit(False)).alias("null"),
    ).first()
    # With the sign turned, the order of longs is that of their bits.
    falling = F.bitwise_not(F.col(score).bitwiseXOR(F.lit(_SIGN)))
    rising = F.coalesce(F.col(key).bitwiseXOR(F.lit(_SIGN)), F.lit(0))
    pieces = [
        Piece(rising, _varying(span["k0"] or 0, span["k1"] or 0)),
        Piece(F.col(key).isNull().cast("long"), int(span["null"])),
        Piece(falling, _varying(span["s0"] or 0, span["s1"] or 0)),
    ]
    bits = sum(piece.width for piece in pieces)
    # One pass at least, which makes places gapless.
    for start in range(0, max(bits, 1), digit_bits):
        keyed = now.withColumn("chunk", F.shiftright("place", chunk_bits)).withColumn(
            "digit", _digit(pieces, start, min(start + digit_bits, bits))
        )
        starts = stage("starts", _starts(keyed))
        order = W.partitionBy("chunk", "digit").orderBy("place")
        numbered = keyed.withColumn("number", F.row_number().over(order) - 1)
        moved = numbered.join(starts, ["chunk", "digit"])
        place = (F.col("start") + F.col("number")).alias("place")
        now = stage("sorted", moved.select(*rows.columns, place))
    return now.select(*rows.columns, (F.col("place") + 1).alias("rank")), span["n"]


def resampled(
    docs: DataFrame,
    target: DataFrame,
    stage: Stage,
    order: int = ORDER,
    buckets: int = BUCKETS,
    least: int = LEAST,
    percent: int = PERCENT,
    seed: int = SEED,
    digit_bits: int = DIGIT_BITS,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per row of `docs`: of those with at least
    `least` words `percent` in a hundred are drawn towards the texts of `target` and have a rank."""
    found = stage("hashed", hashed(docs, order, buckets))
    wanted = hashed(target.select("text").withColumn("doc_id", F.lit(0)), order, buckets)
    gain = gains(counts(found, buckets), counts(wanted, buckets))
    weight = _weight(gain)(F.col("packed")).alias("weight")
    weighed = found.select("doc_id", "n_words", "n_features", weight)
    columns = ["doc_id", "n_features", "weight", (F.col("weight") + noise("doc_id", seed)).alias("score")]
    scored = stage("scored", weighed.select("n_words", *columns))
    names = ["doc_id", "n_features", "weight", "score"]
    enough = scored.where(F.col("n_words") >= least).select(names)
    ranked, n = radix_ranked(enough, "score", "doc_id", stage, digit_bits, chunk_bits)
    drawn = F.when(F.col("rank") <= percent * n // 100, F.col("rank")).alias("rank")
    rest = scored.where(F.col("n_words") < least).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*names, drawn).unionByName(rest)
