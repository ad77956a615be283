"""Input tables."""

from .corpus import corpus
from .export import write_inputs, write_repo_lines, write_sources
from .readers import (
    read_contents,
    read_files,
    read_repos,
    read_stopwords,
    register_views,
    split_repos,
    stopwords_from_names,
)

__all__ = [
    "corpus",
    "read_contents",
    "read_files",
    "read_repos",
    "read_stopwords",
    "register_views",
    "split_repos",
    "stopwords_from_names",
    "write_inputs",
    "write_repo_lines",
    "write_sources",
]
