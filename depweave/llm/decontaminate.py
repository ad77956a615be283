"""Benchmark passages in documents, by an Aho-Corasick automaton over words.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased. A window is `size`
consecutive words of an item; an item of fewer words, but not none, is one window. The automaton holds
all windows, as sequences of word numbers. A document's words run through it once, and each
occurrence marks the words it covers. Hits are given as spans of characters of the original text.

The windows are cut into blocks of at most `block` distinct ones, which bounds what the driver builds, what is
broadcast and the automaton of a worker; a document is scanned once per block, and with one block
(200,000 windows) just once.

Defined cases: null and empty texts have no words and no hits; a null item_id counts as the item
named by the empty string; repeated items or rows with one item_id are one item; an empty benchmark hits nothing.
Repeated documents each have a row. Other columns are not read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import folded

SIZE = 10
BLOCK = 200_000

_WORD = re.compile(rb"[^ ]+")


def windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """(window, ids): each distinct window, words joined by blanks, with the sorted item_ids."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            # Only the blanks of `folded` part words; str.split() knows others, as U+00A0.
            words = [word.decode() for word in folded(text).split()]
            last = max(len(words) - size, 0) if words else -1
            out.append([" ".join(words[i : i + size]) for i in range(last + 1)])
        return pd.Series(out)

    name = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    return (
        items.select(name, F.explode(cut(F.coalesce("text", F.lit("")))).alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    )


class Scanner:
    """The automaton of a block."""

    def __init__(self, block: list[tuple[str, list[str]]]):
        self.words: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, ids in block:
            numbers = tuple(
                self.words.setdefault(w, len(self.words) + 1) for w in window.encode().split()
            )
            self.automaton.add_word(numbers, (len(numbers), ids))
        if block:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged spans of hit words, items with a window in the text."""
        numbers = [self.words.get(w, 0) for w in folded(text).split()]
        spans: list[list[int]] = []
        items: set[str] = set()
        # Without windows there is no automaton.
        for end, (length, ids) in self.automaton.iter(tuple(numbers)) if self.words else ():
            start = end - length + 1
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, end + 1])
            items.update(ids)
        return len(numbers), [tuple(s) for s in spans], items


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of characters of the text."""
    if not spans:
        return []
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(folded(text))]
    cuts = sorted({x for a, b in spans for x in (places[a][0], places[b - 1][1])})
    chars, at, last = {}, 0, 0
    for cut in cuts:
        at += len(raw[last:cut].decode())
        chars[cut], last = at, cut
    return [(chars[places[a][0]], chars[places[b - 1][1]]) for a, b in spans]


def _blocks(table: DataFrame, block: int) -> Iterator[list[tuple[str, list[str]]]]:
    rows: list[tuple[str, list[str]]] = []
    for row in table.toLocalIterator():
        rows.append((row["window"], row["ids"]))
        if len(rows) == block:
            yield rows
            rows = []
    if rows:
        yield rows


HITS = "n_words long, spans array<struct<first: long, last: long>>, items array<string>"


def _scanned(docs: DataFrame, rows: list[tuple[str, list[str]]]) -> DataFrame:
    """`docs` with a column `hit` (HITS)."""
    packed = zlib.compress(pickle.dumps(rows), 1)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf(HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(pickle.loads(zlib.decompress(shared.value)))
        for batch in batches:
            found = [scanner.scan(text) for text in batch]
            yield pd.DataFrame(
                {
                    "n_words": [n for n, _, _ in found],
                    "spans": [[{"first": a, "last": b} for a, b in s] for _, s, _ in found],
                    "items": [sorted(x) for _, _, x in found],
                }
            )

    return docs.withColumn("hit", scan(F.coalesce(F.col("text"), F.lit(""))))


def _union(lists: pd.Series) -> pd.Series:
    """Overlapping spans merged."""
    out = []
    for spans in lists:
        merged: list[list[int]] = []
        for a, b in sorted((s["first"], s["last"]) for s in spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        out.append([{"first": a, "last": b} for a, b in merged])
    return pd.Series(out)


def scan(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """(doc_id, text, n_words, spans, items): per row of `docs` the merged spans of hit words, as
    numbers of the first word and of the one after the last, and the sorted item_ids found."""
    rows = docs.select("doc_id", "text")
    parts = [_scanned(rows, b) for b in _blocks(windows(benchmark, size), block)]
    if not parts:
        parts = [_scanned(rows, [])]
    if len(parts) == 1:
        return parts[0].select("doc_id", "text", "hit.*")
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    # A row meets its rows of the other blocks; copies with one doc_id and text are counted.
    met = together.groupBy("doc_id", "text").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("hit.n_words").alias("n_words"),
        F.flatten(F.collect_list("hit.spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit.items")))).alias("items"),
    )
    copies = F.explode(F.sequence(F.lit(1), (F.col("n") / len(parts)).cast("int")))
    union = F.pandas_udf(_union, "array<struct<first: long, last: long>>")
    return met.select("*", copies.alias("copy")).select(
        "doc_id", "text", "n_words", union("spans").alias("spans"), "items"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of `docs`."""
    hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]
    ).alias("n_hit")
    return scan(docs, benchmark, size, block).select(
        "doc_id",
        "n_words",
        hit,
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def passages(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, start, end, passage): each hit passage by characters of the original text."""

    @F.pandas_udf("array<struct<start: long, end: long>>")
    def located(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"start": a, "end": b}
                    for a, b in original_spans(t, [(s["first"], s["last"]) for s in found])
                ]
                for t, found in zip(texts, spans, strict=True)
            ]
        )

    hits = scan(docs, benchmark, size).where(F.size("spans") > 0)
    places = hits.select("doc_id", "text", F.explode(located("text", "spans")).alias("at"))
    return places.select(
        "doc_id",
        F.col("at.start").alias("start"),
        F.col("at.end").alias("end"),
        F.substring("text", F.col("at.start").cast("int") + 1, (F.col("at.end") - F.col("at.start")).cast("int")).alias("passage"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """The rows of `docs` without any hit, with all their columns. No row is shuffled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole).withColumn("text", F.col("row.text"))
    for found in _blocks(windows(benchmark, size), block):
        rows = _scanned(rows, found).where(F.size("hit.spans") == 0).drop("hit")
    return rows.select("row.*")
