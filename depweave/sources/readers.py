"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (
    CONTENTS,
    FILES,
    LANGUAGES,
    REPOS_GO,
    REPOS_PYTHON,
    STOPWORDS,
    check_language,
)


def _read(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, lang: str | DataFrame | None
) -> DataFrame:
    reader = spark.read.format(fmt)
    if lang is None:
        return reader.schema(schema).load(path)
    one = None if isinstance(lang, DataFrame) else check_language(lang)
    # `lang` is a partition column of the folder: the filter selects folders, not rows.
    with_lang = T.StructType(schema.fields + [T.StructField("lang", T.StringType())])
    table = reader.schema(with_lang).load(path)
    if one is None:
        # One row a language at most. Which folders are read follows from it when the query runs.
        wanted = lang.select("lang").where(F.col("lang").isin(*LANGUAGES)).distinct()
        return table.join(F.broadcast(wanted), "lang", "left_semi").select(*with_lang.names)
    return table.where(F.col("lang") == one).drop("lang")


def read_contents(
    spark: SparkSession, path: str, fmt: str = "parquet", lang: str | DataFrame | None = None
) -> DataFrame:
    """File contents. `path` may be a glob; `fmt` is parquet, orc, json or, with the external
    spark-avro module on the class path, avro. With `lang` the folder is one partitioned by `lang`; where
    that is a table (lang), the folders of its languages are read and the column `lang` is kept."""
    return _read(spark, path, fmt, CONTENTS, lang)


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", lang: str | DataFrame | None = None
) -> DataFrame:
    """Where each content lies: repository and path. Arguments as in `read_contents`."""
    return _read(spark, path, fmt, FILES, lang)


def read_repos(spark: SparkSession, path: str, lang: str, mode: str = "FAILFAST") -> DataFrame:
    """Repositories from CSV with a header row that is skipped; columns go by position.

    A row that does not fit, by its number of fields or by stars that are no number, fails the job,
    also where only some columns are used; with another `mode` it is kept with nulls (PERMISSIVE) or
    left out (DROPMALFORMED). Blanks around a field are cut off.
    """
    lang = check_language(lang)
    schema = REPOS_PYTHON if lang == "python" else REPOS_GO
    reader = spark.read.option("columnPruning", False)
    return reader.csv(
        path,
        schema=schema,
        header=True,
        escape='"',
        mode=mode,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )


def split_repos(
    spark: SparkSession, path: str, lang: str, stage: Callable[[str, DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """(repositories, rejected): the rows of `read_repos` that fit, and (file, record, reason) of those
    that don't. The reason is `fields` where their number is another one, and else `value`.

    The files are read once: `stage` writes all rows, and both tables are read from there.
    """
    lang = check_language(lang)
    schema = REPOS_PYTHON if lang == "python" else REPOS_GO
    record = T.StructField("_record", T.StringType())
    options = {
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": record.name,
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    }
    reader = spark.read.schema(T.StructType([*schema.fields, record])).options(**options)
    rows = reader.csv(path, header=True).select("*", F.col("_metadata.file_path").alias("_file"))
    # A record that fits when all its fields are texts has a field that is none of its type.
    texts = ", ".join(f"`{name}` string" for name in (*schema.names, record.name))
    of_texts = F.from_csv(record.name, texts, options)[record.name]
    reason = F.when(of_texts.isNotNull(), "fields").otherwise("value")
    read = stage(
        "repos_read", rows.withColumn("_reason", F.when(F.col(record.name).isNotNull(), reason))
    )
    rejected = read.where(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), F.col(record.name).alias("record"), F.col("_reason").alias("reason")
    )
    return read.where(F.col("_reason").isNull()).select(schema.names), rejected


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """(name) from text files that hold names parted by commas or line ends."""
    lines = spark.read.text(path)
    names = lines.select(F.explode(F.split("value", ",")).alias("name"))
    return names.where(F.col("name") != "").distinct()


def stopwords_from_names(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(name) from a list in the program, such as `sys.stdlib_module_names`."""
    return spark.createDataFrame([(name,) for name in sorted(set(names))], STOPWORDS)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Makes every table known to SQL under its key."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
