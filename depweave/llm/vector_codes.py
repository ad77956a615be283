"""Vector codes: parts of vectors as numbers of codebook entries, by per-dimension value dictionaries.

Components become integers floor(SCALE * x). Vectors lie in blocks. A block has a dictionary for each
dimension, the distinct integers there, and of each vector only the places in the dictionaries. To
compare a block with a codebook, the squared differences of every distinct integer to all entries are
tabulated once per dimension; the distances of the parts are then gathers from the tables and additions.
The sums of the vectors of an entry are taken from how often each distinct integer goes to it.

A dictionary never has more values than its block has vectors, so its size and the tables' are bounded
by BLOCK whatever the values are. Blocks are written once and read in every round; of a round only the
sums of the entries reach the driver, and only the codebooks go to the tasks.

All numbers are exact: where squares could leave 64 bits, Python's integers take their place, and sums
travel as digits of 32 bits.

Defined cases: a row is dropped if its vector is null or holds a null, a component that isn't finite or
one so large (a double above 2**1011) that SCALE times it isn't. The vectors' length is that of the
first row kept (by vec_id, nulls last, then by vector). A vector of another length, or any if the
length is no multiple of the number of parts or 0, can't be cut alike: it has a row with a null code
and a null error and takes no part in fitting. Repeated rows and vec_ids are rows of their own; of
equal vec_ids the lesser vector comes first. With fewer rows than entries the codebook is as short. An
error above a long is null, as is a sum above one; nulls don't count in sums. An empty table gives an
empty result. Further columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components of a block.
BLOCK = 1 << 20
_DIGIT = 1 << 32
_LONG = (1 << 63) - 1
_SAFE = 1 << 53

Stage = Callable[[str, DataFrame], DataFrame]
#: One array of Python integers for each part: entries by positions within the part.
Codebooks = list[np.ndarray]


def _integers(values: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    return np.array([int(v) for v in values.tolist()], dtype=object)


def floored(vector: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vector.astype(np.float64))


def encoded_block(whole: np.ndarray) -> tuple[list[int], bytes, bytes, bool]:
    """(sizes, values, codes, wide) of vectors (rows) of whole doubles: the sizes of the dictionaries, the
    dictionaries one after another, and dimension by dimension the places of the vectors."""
    kinds, places = [], []
    for column in whole.T:
        values, place = np.unique(column, return_inverse=True)
        kinds.append(values)
        places.append(place)
    wide = max(map(len, kinds)) > 1 << 16
    codes = np.array(places, dtype=np.uint32 if wide else np.uint16)
    return [len(k) for k in kinds], np.concatenate(kinds).tobytes(), codes.tobytes(), wide


@dataclass
class Block:
    """Dictionaries, the largest magnitude in them, and codes (dimensions by vectors)."""

    kinds: list[np.ndarray]
    most: int
    codes: np.ndarray

    @classmethod
    def of(cls, sizes: list[int], values: bytes, codes: bytes, wide: bool) -> Block:
        doubles = np.frombuffer(values, np.float64)
        most = int(np.abs(doubles).max())
        whole = doubles.astype(np.int64) if most < _SAFE else _integers(doubles)
        ends = np.cumsum(sizes)[:-1]
        table = np.frombuffer(codes, np.uint32 if wide else np.uint16)
        return cls(np.split(whole, ends), most, table.reshape(len(sizes), -1))

    def part(self, book: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) nearest to each vector's part that begins at dimension `first`."""
        width = book.shape[1]
        kinds = self.kinds[first : first + width]
        most = max(self.most, int(np.abs(book).max()))
        kind = np.int64 if 4 * most * most * width < _LONG else object
        book = book.astype(kind)
        distance = np.zeros((self.codes.shape[1], len(book)), kind)
        for k, values in enumerate(kinds):
            table = (values.astype(kind)[:, None] - book[:, k]) ** 2
            distance += table[self.codes[first + k]]
        entry = distance.argmin(axis=1)
        return entry, distance[np.arange(len(entry)), entry]

    def sums(self, entry: np.ndarray, book: np.ndarray, first: int) -> np.ndarray:
        """The sum of the parts of each entry, by positions."""
        k, width = book.shape
        safe = self.most * len(entry) < _LONG and self.most < _SAFE
        total = np.empty((k, width), object)
        for position in range(width):
            values = self.kinds[first + position]
            pairs = entry * len(values) + self.codes[first + position]
            often = np.bincount(pairs, minlength=k * len(values)).reshape(k, len(values))
            total[:, position] = (often if safe else often.astype(object)) @ values
        return total


def _digits(total: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a number, all digits with its sign."""
    sign, rest, place = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        rest, digit = divmod(rest, _DIGIT)
        if digit:
            yield place, sign * digit
        place += 1


_BLOCK_COLUMNS = ("sizes", "values", "codes", "wide")


def _blocks_of(batch: pa.RecordBatch) -> Iterator[Block]:
    for row in zip(*(batch.column(name).to_pylist() for name in _BLOCK_COLUMNS), strict=True):
        yield Block.of(*row)


def _blocks(kept: DataFrame, length: int, block: int) -> DataFrame:
    """(ids, labels, sizes, values, codes, wide): the vectors of `length` components in blocks."""
    id_type, label_type = (kept.schema[name].dataType for name in ("vec_id", "label"))
    result = T.StructType(
        [
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("labels", T.ArrayType(label_type)),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("values", T.BinaryType()),
            T.StructField("codes", T.BinaryType()),
            T.StructField("wide", T.BooleanType()),
        ]
    )
    step = max(1, block // length)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                own = batch.slice(start, step)
                flat = own.column("embedding").flatten().to_numpy(zero_copy_only=False)
                sizes, values, codes, wide = encoded_block(floored(flat).reshape(-1, length))
                ends = pa.array([0, own.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(ends, own.column("vec_id")),
                        pa.ListArray.from_arrays(ends, own.column("label")),
                        pa.array([sizes], pa.list_(pa.int32())),
                        pa.array([values], pa.binary()),
                        pa.array([codes], pa.binary()),
                        pa.array([wide], pa.bool_()),
                    ],
                    names=result.names,
                )

    rows = kept.where(F.size("embedding") == length).select("vec_id", "label", "embedding")
    return rows.mapInArrow(packed, result)


def _next(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round."""
    width = books[0].shape[1]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(book), width + 1), object) for book in books]
        for batch in batches:
            for block in _blocks_of(batch):
                for p, book in enumerate(books):
                    entry, _ = block.part(book, p * width)
                    totals[p][:, :width] += block.sums(entry, book, p * width)
                    totals[p][:, width] += np.bincount(entry, minlength=len(book))
        rows = [
            (p, e, position, place, digit)
            for p, total in enumerate(totals)
            for (e, position), number in np.ndenumerate(total)
            for place, digit in _digits(int(number))
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        names = ["part", "entry", "position", "place", "digit"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    kind = "part long, entry long, position long, place long, digit long"
    sums = (
        blocks.select(*_BLOCK_COLUMNS)
        .mapInArrow(summed, kind)
        .groupBy("part", "entry", "position", "place")
        .agg(F.sum("digit").alias("digit"))
    )
    totals = [np.zeros((len(book), width + 1), object) for book in books]
    # A few rows for each component of a codebook.
    for row in sums.collect():
        totals[row["part"]][row["entry"], row["position"]] += row["digit"] * _DIGIT ** row["place"]
    return [
        np.array(
            [
                [s // total[width] for s in total[:width]] if total[width] else list(old)
                for total, old in zip(sums_of_part, book, strict=True)
            ],
            dtype=object,
        )
        for sums_of_part, book in zip(totals, books, strict=True)
    ]


def digest(books: Codebooks) -> str:
    """SHA-256 of all components as decimals, by part, entry and position, joined by commas."""
    listed = ",".join(str(x) for book in books for x in book.ravel())
    return hashlib.sha256(listed.encode()).hexdigest()


@dataclass
class Codes:
    """`rows` is (vec_id, label, code, error); `books` are the final codebooks."""

    rows: DataFrame
    books: Codebooks


def _coded(blocks: DataFrame, books: Codebooks) -> DataFrame:
    width = books[0].shape[1]
    ids, labels = (blocks.schema[name].dataType.elementType for name in ("ids", "labels"))
    result = T.StructType(
        [
            T.StructField("vec_id", ids),
            T.StructField("label", labels),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, block in enumerate(_blocks_of(batch)):
                entries, errors = [], 0
                for p, book in enumerate(books):
                    entry, distance = block.part(book, p * width)
                    entries.append(entry.astype(np.uint8))
                    errors = errors + distance.astype(object) if distance.max() > _SAFE else errors + distance
                text = np.stack(entries, axis=1).tobytes().hex()
                step = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids").slice(place, 1).flatten(),
                        batch.column("labels").slice(place, 1).flatten(),
                        pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string()),
                        pa.array([e if e <= _LONG else None for e in errors], pa.int64()),
                    ],
                    names=result.names,
                )

    return blocks.mapInArrow(coded, result)


def _finite(x: Column) -> Column:
    scaled = x.cast("double") * SCALE
    return F.coalesce(~F.isnan(scaled) & (F.abs(scaled) < float("inf")), F.lit(False))


def compress(
    vectors: DataFrame,
    stage: Stage,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    block: int = BLOCK,
) -> Codes:
    """Codes of `vectors` (vec_id, embedding, label), of `parts` parts each; at most 256 `entries`."""
    if not 1 <= entries <= 256:
        raise ValueError("entries")
    kept = vectors.select("vec_id", "label", "embedding").where(
        F.col("embedding").isNotNull() & F.forall("embedding", _finite)
    )
    order = (F.asc_nulls_last("vec_id"), F.asc("embedding"))
    head = kept.select("vec_id", "embedding").orderBy(*order).limit(1).collect()
    length = len(head[0]["embedding"]) if head else 0
    if not length or length % parts:
        nothing = kept.select("vec_id", "label").withColumn("code", F.lit(None).cast("string"))
        return Codes(nothing.withColumn("error", F.lit(None).cast("long")), [])
    fits = F.size("embedding") == length
    first = kept.where(fits).select("vec_id", "embedding").orderBy(*order).limit(entries).collect()
    start = np.stack([_integers(floored(np.array(row["embedding"]))) for row in first])
    books = np.split(start, parts, axis=1)
    blocks = stage("blocks", _blocks(kept, length, block))
    for _ in range(rounds):
        books = _next(blocks, books)
    rows = _coded(blocks, books)
    other = kept.where(~fits).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    return Codes(rows.unionByName(other), books)


def code_table(vectors: DataFrame, stage: Stage) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per row kept: `label_error` is the
    sum of the errors of all rows of the label, nulls being one label.

    The join with the sums is straight on two shuffles, or a broadcast where the sums are measured to
    be small, so a label with a third of the rows is split or not shuffled at all.
    """
    codes = compress(vectors, stage)
    rows = stage("codes", codes.rows)
    sums = stage("label_errors", rows.groupBy("label").agg(F.try_sum("error").alias("label_error")))
    of_label = sums.select(F.col("label").alias("of"), "label_error")
    return rows.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codes.books)).alias("codebooks_sha256")
    )
