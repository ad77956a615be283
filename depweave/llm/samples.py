"""Folds by document and bounded samples for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fold_of(folds: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo `folds`; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def first_of_each(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Of each group at most `most` rows, in the order of the key's hash: an even sample. Each task
    keeps `most` rows of a group before the shuffle."""
    order = W.partitionBy(group).orderBy(F.xxhash64(key), key)
    ranked = rows.withColumn("_row", F.row_number().over(order))
    return ranked.where(F.col("_row") <= most).drop("_row")
