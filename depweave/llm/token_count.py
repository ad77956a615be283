"""Token counts of whole texts, huge ones by overlapping chunks.

A huge text is encoded in chunks that overlap, with offsets. In the overlap of two chunks a place is
looked for where a token ends in both encodings and the tokenizer's split is proven not to depend on
what lies on either side (`text.stable`). There the two are spliced. Where an overlap has no such
place it is widened, in the end to the rest of the text. Memory for encodings is thus that of a chunk, not of
the text. Other texts are cut at all their stable places, and each distinct piece is encoded once
per worker; a text with unusual white space is encoded whole.

Special strings inside a text are handled as the tokenizer does by default; none are added. The
stable places hold for tokenizers with the byte-level pattern and no normaliser, and special strings
without blanks, which is checked. Null texts count as empty; columns other than those read are
carried along.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .text import Memo, pieces, stable

CHUNK = 32_768
OVERLAP = 256


@cache
def tokenizer(name: str) -> Tokenizer:
    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    splitter = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or splitter.get("type") != "ByteLevel" or not splitter["use_regex"]:
        raise ValueError(f"{name}: only byte-level tokenizers without a normaliser")
    for token in parts["added_tokens"]:
        if token["lstrip"] or token["rstrip"] or any(c.isspace() for c in token["content"]):
            raise ValueError(f"{name}: a special token takes in white space")
    return Tokenizer.from_file(path)


def _ends(model: Tokenizer, text: str) -> list[int]:
    return [end for _, end in model.encode(text, add_special_tokens=False).offsets]


def seam(text: str, end: int, stop: int, left: list[int], right: list[int], start: int) -> int | None:
    """The first stable place after `end` and up to `stop` at which tokens of both chunks end: the
    left one starts at `start`, the right one at `end`."""
    ends = {end + x for x in right}
    for x in left:
        at = start + x
        if end < at <= stop and at in ends and stable(text, at):
            return at
    return None


def spliced(model: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of `text`, never encoding more than a chunk and an overlap at once."""
    total, start, cut = 0, 0, 0
    left = _ends(model, text[: chunk + overlap])
    while start + chunk + overlap < len(text):
        end, wide = start + chunk, overlap
        while True:
            stop = end + wide
            right = _ends(model, text[end : max(stop, end + chunk + overlap)])
            at = seam(text, end, stop, left, right, start)
            if at is not None or stop >= len(text):
                break
            wide *= 2
            left = _ends(model, text[start : end + wide])
        if at is None:
            break
        total += bisect_right(left, at - start) - bisect_right(left, cut - start)
        # A right chunk that was widened is longer than the next step needs; that does no harm.
        start, cut, left = end, at, right
    return total + len(left) - bisect_right(left, cut - start)


class Counter:
    def __init__(self, name: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.model, self.chunk, self.overlap = tokenizer(name), chunk, overlap
        self.known = Memo(64 << 20)

    def count(self, text: str) -> int:
        if len(text) > 2 * self.chunk:
            return spliced(self.model, text, self.chunk, self.overlap)
        parts = pieces(text)
        if parts is None:
            return len(self.model.encode(text, add_special_tokens=False))
        new = self.known.missing(parts)
        if new:
            encoded = self.model.encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, map(len, encoded), strict=True))
        total = sum(map(self.known.__getitem__, parts))
        self.known.forget_long(new)
        return total


def n_tokens(name: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """The number of tokens as a column. `name` is a file of `public_tokenizers`."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(name, chunk, overlap)
        for batch in batches:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    return counted(F.coalesce(F.col(text), F.lit("")))


def token_counts(docs: DataFrame, name: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of `docs`."""
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(name).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
