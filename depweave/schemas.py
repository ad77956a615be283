"""Column layouts of the input tables. Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

CONTENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("binary", T.BooleanType()),
        T.StructField("copies", T.LongType()),
    ]
)

FILES = T.StructType(
    [
        T.StructField("repo_name", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("symlink_target", T.StringType()),
    ]
)

REPOS_GO = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("num_bytes", T.LongType()),
    ]
)

REPOS_PYTHON = T.StructType(
    REPOS_GO.fields
    + [
        T.StructField("stars", T.IntegerType()),
        T.StructField("fork", T.IntegerType()),
    ]
)

STOPWORDS = T.StructType([T.StructField("name", T.StringType())])

LANGUAGES = ("python", "go")


def check_language(lang: str) -> str:
    """The language in lower case; anything but Python and Go is refused before a plan exists."""
    lang = lang.lower()
    if lang not in LANGUAGES:
        raise ValueError(f"language must be one of {', '.join(LANGUAGES)}, not {lang!r}")
    return lang
