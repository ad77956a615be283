"""Shapes of the exported records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def node_record(repo: str | Column, degree: str | Column) -> Column:
    repo = F.col(repo) if isinstance(repo, str) else repo
    degree = F.col(degree) if isinstance(degree, str) else degree
    return F.struct(repo.alias("id"), degree.alias("group"))


def link_record(source: str | Column, target: str | Column) -> Column:
    source = F.col(source) if isinstance(source, str) else source
    target = F.col(target) if isinstance(target, str) else target
    return F.struct(source.alias("source"), target.alias("target"))


def pair_label(cnt: str = "cnt", dep1: str = "dep1", dep2: str = "dep2") -> Column:
    return F.format_string("%d: %s, %s", F.col(cnt), F.col(dep1), F.col(dep2))
