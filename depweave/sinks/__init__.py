"""Destinations of results."""

from .results import KEYS, Results, by_language, replace_file, replace_languages, write_document

__all__ = ["KEYS", "Results", "by_language", "replace_file", "replace_languages", "write_document"]
