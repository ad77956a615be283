"""From imported names to public repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import full_name, is_ascii, not_fork, popularity


def repo_dimension(repos: DataFrame, stopwords: DataFrame | None = None) -> DataFrame:
    """(user, repo_name, stars, notfork): the repositories names are looked up in.

    Stop words are names no import may resolve to, such as built-in modules.
    """
    dim = repos.select("user", "repo_name", "stars", not_fork("fork").alias("notfork"))
    if stopwords is not None:
        names = stopwords.select(F.col("name").alias("repo_name"))
        dim = dim.join(names, "repo_name", "left_anti")
    return dim.select("user", "repo_name", "stars", "notfork")


def go_repo_dimension(repos: DataFrame) -> DataFrame:
    """(user, repo_name): Go repositories carry no score and no stop words apply."""
    return repos.select("user", "repo_name")


def best_repo(dim: DataFrame) -> DataFrame:
    """(dep, dst): the most popular repository of each name, by user among equals.

    One row per name, so a join with it cannot fan out.
    """
    order = W.partitionBy("repo_name").orderBy(F.desc("score"), "user")
    scored = dim.select("user", "repo_name", popularity().alias("score"))
    return (
        scored.withColumn("row", F.row_number().over(order))
        .where(F.col("row") == 1)
        .select(F.col("repo_name").alias("dep"), full_name().alias("dst"))
    )


def resolve(repo_deps: DataFrame, best: DataFrame) -> DataFrame:
    """(repo, dep, dst): dependencies whose name is that of a known repository.

    Edges and known dependencies both follow from this one join. Whether `best` is broadcast is
    left to its measured size: it grows with the number of repositories.
    """
    return repo_deps.join(best, "dep", "inner").select("repo", "dep", "dst")


def edges_of(resolved: DataFrame, drop_self: bool = True) -> DataFrame:
    """(dst, src). Distinct because (repo, dep) is, and a name has one best repository."""
    if drop_self:
        resolved = resolved.where(F.col("repo") != F.col("dst"))
    return resolved.select("dst", F.col("repo").alias("src"))


def known_deps_of(resolved: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(repo, dep)."""
    known = resolved.select("repo", "dep")
    return known.where(is_ascii("dep")) if ascii_only else known


def resolve_edges(repo_deps: DataFrame, best: DataFrame, drop_self: bool = True) -> DataFrame:
    return edges_of(resolve(repo_deps, best), drop_self)


def known_deps(repo_deps: DataFrame, best: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(repo, dep): dependencies that some repository is named after, as a semi join."""
    known = repo_deps.join(best.select("dep"), "dep", "left_semi").select("repo", "dep")
    return known.where(is_ascii("dep")) if ascii_only else known
