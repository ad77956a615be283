"""From file contents to the names they import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    GO_HOST,
    go_import_repos,
    path_tokens,
    python_import_text,
    split_names,
)


def evaluated_once(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """`keep` and `value AS name`, with `value` computed one time per row.

    A filter on a plain projected column is pushed below the projection, and the expression then
    runs in the filter and in the projection again. It is not pushed below a generator, so a
    one-element explode keeps an expensive regular expression to a single run.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def _with_imports(contents: DataFrame, strip_cr: bool) -> DataFrame:
    text = evaluated_once(contents, "names", python_import_text("content", strip_cr), "id")
    return text.where(F.col("names") != "")


def python_imports(contents: DataFrame, strip_cr: bool = False) -> DataFrame:
    """(id, deps): one row per file with at least one import, `deps` distinct within the file.

    An empty name, as in `import a, b`, stays in `deps`: a file whose only import is nameless still
    is a file with imports.
    """
    names = F.array_distinct(split_names("names"))
    return _with_imports(contents, strip_cr).select("id", names.alias("deps"))


def python_deps(contents: DataFrame, strip_cr: bool = False) -> DataFrame:
    """(id, dep): one row per imported name, as often as it is imported, without empty names."""
    flat = _with_imports(contents, strip_cr).select("id", F.explode(split_names("names")).alias("dep"))
    return flat.where(F.col("dep") != "")


def go_deps(contents: DataFrame) -> DataFrame:
    """(id, deps): repositories in the first import declaration, in order, duplicates kept; only
    files that import at least one.

    Files without the host in their text are passed over before the patterns run.
    """
    hosted = contents.where(F.contains("content", F.lit(GO_HOST)))
    found = evaluated_once(hosted, "deps", go_import_repos("content"), "id")
    return found.where(F.size("deps") > 0)


def path_names(file_imports: DataFrame, suffix_len: int = 2) -> DataFrame:
    """(repo, name): distinct folder and file names of the files that have imports."""
    names = path_tokens("path", suffix_len)
    return file_imports.select("repo", F.explode(names).alias("name")).distinct()
