"""Exact duplicates by two-pass Bloom filtering (see `bloom`).

Texts are equal when they are the same after every character of `[\\x20\\x09-\\x0D]` is deleted. Of
equal texts the row stays whose original has most code points, then the one with the smallest
doc_id. Rows that the filter clears pass straight through; only the others are shuffled.

Defined cases: a null text is the empty text and empty texts are equal. A null doc_id comes last in
the order. Repeated rows of one doc_id count as rows: one of them stays. Empty tables give empty
results. Columns other than doc_id and text are not read by `decisions` and are carried along,
whatever their names, by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom

Stage = Callable[[str, DataFrame], DataFrame]


def normalised(text: str | Column = "text") -> Column:
    value = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(value, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def decisions(docs: DataFrame, stage: Stage, bits: int = bloom.BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    The digests are written once, so both passes read those and not the texts, and each row has a
    number `uid` that parts rows of one doc_id.
    """
    text = F.coalesce("text", F.lit(""))
    digests = stage(
        "digests",
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.char_length(text).alias("n"),
            F.sha2(normalised(), 256).alias("sha"),
        ),
    ).withColumn("h", F.xxhash64("sha"))
    marked = digests.withColumn("maybe", bloom.maybe_repeated(digests, "h", bits))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    single = marked.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    suspects = stage("suspects", marked.where("maybe").select("uid", "doc_id", "n", "sha"))
    # `~` turns the order round, also at the ends of the range, and leaves nulls smallest.
    best = F.max(F.struct("n", F.bitwise_not("doc_id").alias("d"), F.bitwise_not("uid").alias("u")))
    # One row per group, combined before the shuffle; staged, so that the join stands straight on
    # two shuffles and adaptive execution can split the rows of a hot group.
    groups = stage(
        "groups",
        suspects.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")),
    )
    grouped = suspects.join(groups, "sha").select(
        "doc_id",
        F.bitwise_not("best.d").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.bitwise_not("best.u")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return single.select(columns).unionByName(grouped.select(columns))


def keep_one(docs: DataFrame, bits: int = bloom.BITS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows alike in text length and doc_id
    the greatest by the other columns, in their order (as JSON text, where maps have no order).

    Rows that the filter clears are not shuffled. The others meet in one aggregation that keeps the
    best whole row of each group and combines before the shuffle.
    """
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).withColumn(
        "sha", F.sha2(normalised(F.col("row.text")), 256)
    )
    hashed = inner.withColumn("h", F.xxhash64("sha"))
    marked = hashed.withColumn("maybe", bloom.maybe_repeated(hashed, "h", bits))
    order = F.struct(
        F.char_length(F.coalesce("row.text", F.lit(""))).alias("n"),
        F.bitwise_not("row.doc_id").alias("d"),
        F.to_json("row").alias("tie") if "map<" in docs.schema.simpleString() else F.col("row"),
    )
    best = marked.where("maybe").groupBy("sha").agg(F.max_by("row", order).alias("row")).select("row")
    rows = marked.where(~F.col("maybe")).select("row").unionByName(best)
    return rows.select("row.*")
