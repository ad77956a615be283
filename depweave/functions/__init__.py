"""Column expressions: everything here is a built-in Spark expression, no UDF."""

from .imports import GO_HOST, go_import_repos, path_tokens, python_import_text, split_names
from .records import link_record, node_record, pair_label
from .repos import full_name, is_ascii, not_fork, popularity

__all__ = [
    "GO_HOST",
    "full_name",
    "go_import_repos",
    "is_ascii",
    "link_record",
    "node_record",
    "not_fork",
    "pair_label",
    "path_tokens",
    "popularity",
    "python_import_text",
    "split_names",
]
