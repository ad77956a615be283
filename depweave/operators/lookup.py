"""Reads by key from the result tables. A key that is missing gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(table: DataFrame, column: str, keys: str | DataFrame) -> DataFrame:
    """Rows of `table` whose `column` is the one key, or is in the first column of `keys`.

    One key is a filter that reaches the scan, and result tables are written in key order, so it
    reads a few row groups. A table of keys is a semi join.
    """
    if isinstance(keys, str):
        return table.where(F.col(column) == keys)
    named = keys.select(F.col(keys.columns[0]).alias(column))
    return table.join(named, column, "left_semi").select(*table.columns)


def flower_of(flowers: DataFrame, roots: str | DataFrame) -> DataFrame:
    return by_key(flowers, "root", roots)


def cooccurs_of(cooccurs: DataFrame, deps: str | DataFrame) -> DataFrame:
    return by_key(cooccurs, "dep1", deps)
