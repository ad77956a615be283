"""A Bloom filter of known names in built-in functions, for rows that are to be dropped before a shuffle.

The filter is a table of bit maps. A name's hash chooses a bucket and PROBES bits in the bucket's map;
a name whose bits aren't all set is not known. Rows look their bucket up by a broadcast join and test
the bits there, all in generated code. A map is an array of numbers, which is read in place; of a binary
value each row would get a copy. No known name is ever dropped.

The number of buckets follows from the number of names, for about BITS bits a name, up to MOST buckets;
so at most MOST maps of 4,096 bytes are broadcast, whatever the data. With more names than that is made
for, more unknown names pass, and the join that follows drops them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bucket's map, and of a number in it.
MAP, WORD = 1 << 15, 64
BITS, PROBES, MOST = 12, 4, 4_096

Stage = Callable[[str, DataFrame], DataFrame]


def _bucket(name: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets).cast("long"))


def _places(name: Column) -> list[Column]:
    """PROBES bits, from a hash of their own: 15 bits of it each."""
    h = F.xxhash64(name, F.lit(1))
    return [F.shiftrightunsigned(h, 15 * k).bitwiseAND(MAP - 1) for k in range(PROBES)]


def _word(bit: Column) -> tuple[Column, Column]:
    """The place of the number that holds a bit, and the number with that bit alone."""
    one = F.lit(1).cast("long")
    shifted = F.call_function("shiftleft", one, bit.bitwiseAND(WORD - 1).cast("int"))
    return F.shiftright(bit, 6).cast("int"), shifted


class NameFilter:
    """The filter of the first column of `names`. `stage(name, table)` writes a table and gives it back."""

    def __init__(self, names: DataFrame, stage: Stage):
        distinct = names.select(F.col(names.columns[0]).alias("name")).where("name IS NOT NULL")
        # One number comes to the driver, and it has a bound.
        wanted = F.ceil(F.count(F.lit(1)) * BITS / MAP)
        self.buckets = int(distinct.agg(F.least(F.greatest(wanted, F.lit(1)), F.lit(MOST))).first()[0])
        bits = distinct.select(
            _bucket(F.col("name"), self.buckets).alias("bucket"),
            F.explode(F.array(*_places(F.col("name")))).alias("bit"),
        )
        at, value = _word(F.col("bit"))
        words = bits.groupBy("bucket", at.alias("at")).agg(F.bit_or(value).alias("bits"))
        found = F.map_from_entries(F.collect_list(F.struct("at", "bits")))
        every = F.sequence(F.lit(0), F.lit(MAP // WORD - 1))
        none = F.lit(0).cast("long")
        self.maps = stage(
            "name_maps",
            words.groupBy("bucket").agg(found.alias("found")).select(
                "bucket", F.transform(every, lambda at: F.coalesce(F.element_at("found", at), none)).alias("map")
            ),
        )

    def maybe_known(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows of `rows` whose `column` may be a known name."""

        def is_set(bit: Column) -> Column:
            word = F.get("_map", F.shiftright(bit, 6).cast("int"))
            return F.getbit(word, bit.bitwiseAND(WORD - 1).cast("int")) == 1

        maps = F.broadcast(self.maps.select(F.col("bucket").alias("_bucket"), F.col("map").alias("_map")))
        found = rows.withColumn("_bucket", _bucket(F.col(column), self.buckets)).join(maps, "_bucket")
        hit = reduce(Column.__and__, map(is_set, _places(F.col(column))))
        return found.where(hit).select(*rows.columns)
