"""A two-pass Bloom filter over a column of hashes.

Pass one: each task keeps two bit arrays, "seen" and "seen again", over the hashes of its rows, and
sends them cut into segments. The segments of all tasks meet per segment: a bit is "again" if it is
in some task, or if two tasks have "seen" it. Pass two: a row all of whose bits are "again" possibly
has a partner; no other row has one.

The filter has `bits` bits whatever the data, which bounds what is held by a task, gathered by the
driver and broadcast (`bits` / 8 bytes). About ten bits a row keep the false alarms near one per
cent; a smaller filter raises more of them and never misses a repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 1 << 27
PROBES = 4
SEGMENT_BYTES = 1 << 15


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(PROBES, n) bit numbers. `bits` is a power of two."""
    h = hashes.astype(np.int64).view(np.uint64)
    mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    step = (mixed ^ (mixed >> np.uint64(29))) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (h + turns * step) & np.uint64(bits - 1)


def _test(array: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((array[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _set(array: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    bit = np.left_shift(np.uint8(1), (flat & np.uint64(7)).astype(np.uint8))
    np.bitwise_or.at(array, flat >> np.uint64(3), bit)


def _segments(seen: np.ndarray, again: np.ndarray, size: int) -> Iterator[pd.DataFrame]:
    rows = []
    for k in range(0, len(seen), size):
        if seen[k : k + size].any():
            pair = [zlib.compress(a[k : k + size].tobytes(), 1) for a in (seen, again)]
            rows.append((k // size, *pair))
        if len(rows) == 64:
            yield pd.DataFrame(rows, columns=["segment", "seen", "again"])
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=["segment", "seen", "again"])


def _merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by segment; one segment is held at a time."""
    segment, seen, again = None, None, None
    done = []

    def close() -> list[tuple[int, bytes]]:
        return [(segment, zlib.compress(again.tobytes(), 1))] if again is not None else []

    for frame in frames:
        for row in frame.itertuples(index=False):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (row.seen, row.again))
            if row.segment != segment:
                done += close()
                segment, seen, again = row.segment, a.copy(), b.copy()
            else:
                again |= b | (seen & a)
                seen |= a
        if done:
            yield pd.DataFrame(done, columns=["segment", "again"])
            done = []
    if last := close():
        yield pd.DataFrame(last, columns=["segment", "again"])


def _gathered(segments: DataFrame, column: str, bits: int) -> np.ndarray:
    """At most `bits` / 8 bytes, whatever the data, by one job, whose tasks run side by side."""
    size = min(SEGMENT_BYTES, bits // 8)
    whole = np.zeros(bits // 8, np.uint8)
    for row in segments.collect():
        at = row["segment"] * size
        whole[at : at + size] = np.frombuffer(zlib.decompress(row[column]), np.uint8)
    return whole


class Filter:
    """A filter for the workers: `bits` / 8 bytes, packed."""

    def __init__(self, spark: SparkSession, whole: np.ndarray, bits: int):
        self._packed = spark.sparkContext.broadcast(zlib.compress(whole.tobytes(), 1))
        self._bits, self._whole = bits, None

    def test(self, hashes: np.ndarray) -> np.ndarray:
        if self._whole is None:
            self._whole = np.frombuffer(zlib.decompress(self._packed.value), np.uint8)
        return _test(self._whole, positions(hashes, self._bits))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_whole": None}


def _probe(table: DataFrame, whole: np.ndarray, column: str | Column, bits: int) -> Column:
    """Whether all bits of a hash are set; a null hash has no bits."""
    shared = Filter(table.sparkSession, whole, bits)

    @F.pandas_udf("boolean")
    def probe(hashes: pd.Series) -> pd.Series:
        return pd.Series(shared.test(hashes.to_numpy(np.int64)))

    value = F.col(column) if isinstance(column, str) else column
    return probe(F.coalesce(value, F.lit(0))) & value.isNotNull()


def _of_column(frame: pd.DataFrame) -> Iterator[np.ndarray]:
    yield frame["h"].to_numpy(np.int64)


def repeats(
    rows: DataFrame,
    hashes_of: Callable[[pd.DataFrame], Iterator[np.ndarray]] = _of_column,
    bits: int = BITS,
) -> np.ndarray:
    """The filter of all hashes that may occur twice or more. `hashes_of` gives those of some rows;
    by default they are the column `h` (long, without nulls)."""
    size = min(SEGMENT_BYTES, bits // 8)

    def filters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for frame in frames:
            for hashes in hashes_of(frame):
                own, count = np.unique(hashes, return_counts=True)
                at = positions(own, bits)
                repeated = (count > 1) | _test(seen, at)
                _set(again, at[:, repeated])
                _set(seen, at)
        yield from _segments(seen, again, size)

    parts = rows.mapInPandas(filters, "segment long, seen binary, again binary")
    merged = (
        parts.repartition("segment")
        .sortWithinPartitions("segment")
        .mapInPandas(_merged, "segment long, again binary")
    )
    return _gathered(merged, "again", bits)


def maybe_repeated(table: DataFrame, column: str, bits: int = BITS) -> Column:
    """A column for `table`: true where the hash in `column` (long) may occur in another row too.
    True for every hash that does; false for a null."""
    hashes = table.select(F.col(column).alias("h")).where(F.col("h").isNotNull())
    return _probe(table, repeats(hashes, bits=bits), column, bits)


def maybe_in(table: DataFrame, column: str, keys: DataFrame, bits: int = BITS) -> Column:
    """A column for `table`: true where the hash in `column` may be among the hashes of `keys` (one
    long column); true for every one that is."""
    size = min(SEGMENT_BYTES, bits // 8)

    def filters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(bits // 8, np.uint8)
        for frame in frames:
            _set(seen, positions(np.unique(frame["h"].to_numpy(np.int64)), bits))
        yield from _segments(seen, seen, size)

    named = keys.select(F.col(keys.columns[0]).alias("h")).where(F.col("h").isNotNull())
    merged = (
        named.mapInPandas(filters, "segment long, seen binary, again binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInPandas(_merged, "segment long, again binary")
    )
    return _probe(table, _gathered(merged, "again", bits), column, bits)
