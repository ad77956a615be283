"""Expressions over the repository table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(user: str = "user", repo_name: str = "repo_name") -> Column:
    """`user/repo_name`; an empty CSV field comes as null and is an empty part."""
    parts = [F.coalesce(F.col(name), F.lit("")) for name in (user, repo_name)]
    return F.concat(parts[0], F.lit("/"), parts[1])


def not_fork(fork: str = "fork") -> Column:
    """1 for an original, 0 for a fork; unknown stays null."""
    return F.when(F.col(fork) == 0, 1).when(F.col(fork).isNotNull(), 0)


def popularity(stars: str = "stars", notfork: str = "notfork") -> Column:
    """Stars times not-a-fork; a missing factor counts as 1."""
    factor = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(1).cast("long"))
    return factor(stars) * factor(notfork)


def is_ascii(name: str) -> Column:
    return F.col(name).rlike(r"\A[\x00-\x7F]*\z")
