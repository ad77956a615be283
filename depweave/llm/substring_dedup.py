"""Repeated byte strings across all documents, by suffix arrays.

A byte is removed if a string of LENGTH bytes over it also starts earlier: in a document of smaller
doc_id, or earlier in the same one. Strings are judged on the input and never cross documents.

* Of equal texts only the first is looked into; all of the others is repeated.
* Each string belongs to an anchor, the 40-byte gram of least hash in it, so equal strings have equal
  anchors. The strings of an anchor's place lie in one stretch of text. A stretch whose strings all
  start again one period later (a run of one character, say) is repeated throughout and goes no
  further. A Bloom filter over the anchors of the others finds those that may occur again; the digests
  of their stretches are grouped, without the bytes.
* Of equal stretches, all but the first are repeated throughout. Texts meet the list of their first
  stretches, so a stretch that is shared and not in the list is such a copy. Bytes move once, and only
  those of first stretches whose anchor has several different ones: these are put into blocks, and a
  block's suffix array with adjacent common prefixes gives its repeated strings.
* An anchor with more stretches than a block holds is spread over several blocks; strings that are
  first in theirs then meet by digest.

Defined cases: a null text is empty; texts shorter than LENGTH keep all; an empty table gives an empty
one. A null doc_id comes last.
Rows with the same doc_id and text have equal results; different texts of one doc_id go by their
digest. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .suffix_array import same_prefix, suffix_array, words

LENGTH, GRAM = 100, 40
STRETCHES = 32_768
BLOCK = 1 << 20
BITS = bloom.BITS

Stage = Callable[[str, DataFrame], DataFrame]

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20
_PLACE = _U(_PIECE - 1)
_TOGETHER = 1 << 15  # Bytes of short texts that are looked at in one step; arrays of this size stay in a cache.


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base), _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_UP, _DOWN = _powers(_BASE, _PIECE), _powers(_INVERSE, _PIECE)


@dataclass
class Stretches:
    """Stretches of some texts or of a piece of one: for each the place of its piece in `pieces` (text
    number, start of the piece, bytes), the hash of its anchor, its first and last start in the piece,
    and whether all its strings start earlier in the piece too, one period before."""

    pieces: list[tuple[int, int, bytes]]
    piece: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    periodic: np.ndarray

    def numbers(self) -> np.ndarray:
        return np.array([number for number, _, _ in self.pieces])[self.piece]

    def starts(self) -> np.ndarray:
        return np.array([at for _, at, _ in self.pieces])[self.piece] + self.first

    def bytes_of(self, which: np.ndarray) -> Iterator[bytes]:
        ends = (self.last[which] + LENGTH).tolist()
        for k, a, b in zip(self.piece[which].tolist(), self.first[which].tolist(), ends, strict=True):
            yield self.pieces[k][2][a:b]


def _anchored(pieces: list[tuple[int, int, bytes]]) -> Stretches:
    """Of pieces of LENGTH bytes or more each, up to 2**20 together."""
    raw = np.frombuffer(b"".join(piece for _, _, piece in pieces), np.uint8)
    lengths = np.array([len(piece) for _, _, piece in pieces])
    begins = np.cumsum(lengths) - lengths
    n, grams, width = len(raw), len(raw) - GRAM + 1, LENGTH - GRAM + 1
    total = np.concatenate([np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * _UP[:n], dtype=_U)])
    h = (total[GRAM:] - total[:grams]) * _DOWN[:grams]
    h = (h ^ (h >> _U(31))) * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    # The least hash and of equal ones the leftmost place.
    least, span = (h & ~_PLACE) | np.arange(grams, dtype=_U), 1
    while span * 2 <= width:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    rest = width - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & _PLACE).astype(np.int64)
    fresh = np.append(True, at[1:] != at[:-1])
    # Starts over the border of two pieces are cut off and left out.
    fresh[begins] = True
    fresh[(begins + lengths - LENGTH + 1)[:-1]] = True
    first = np.flatnonzero(fresh)
    last = np.append(first[1:] - 1, len(at) - 1)
    piece = np.searchsorted(begins, first, "right") - 1
    whole = first <= (begins + lengths)[piece] - LENGTH
    first, last, piece = first[whole], last[whole], piece[whole]
    anchors = at[first]
    hashes = h[anchors].view(np.int64)
    begin = begins[piece]
    periodic = _periodic(raw, hashes, anchors, first, last, begin)
    return Stretches(pieces, piece, hashes, first - begin, last - begin, periodic)


def _periodic(raw: np.ndarray, hashes: np.ndarray, anchors: np.ndarray, first: np.ndarray, last: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """In a run of period p neighbouring stretches have equal anchors, p apart; the bytes tell. Such a
    stretch is no string's first place, so leaving it out of all comparisons loses nothing."""
    own = np.zeros(len(first), bool)
    like = np.flatnonzero((hashes[1:] == hashes[:-1]) & (begin[1:] == begin[:-1])) + 1
    periods = anchors[like] - anchors[like - 1]
    for p in np.unique(periods):
        which = like[(periods == p) & (first[like] - p >= begin[like])]
        differ = np.append(0, np.cumsum(raw[p:] != raw[:-p]))
        own[which] = differ[last[which] + LENGTH - p] == differ[first[which] - p]
    return own


def stretches(raws: Iterable[bytes]) -> Iterator[Stretches]:
    """Short texts are taken together, long ones in pieces, which overlap so that each string is in
    one."""
    held: list[tuple[int, int, bytes]] = []
    size, step = 0, _PIECE - LENGTH + 1
    for number, raw in enumerate(raws):
        if len(raw) >= _TOGETHER:
            for k in range(0, len(raw) - LENGTH + 1, step):
                yield _anchored([(number, k, raw[k : k + _PIECE])])
        elif len(raw) >= LENGTH:
            held.append((number, 0, raw))
            size += len(raw)
            if size >= _TOGETHER:
                yield _anchored(held)
                held, size = [], 0
    if held:
        yield _anchored(held)


def _encoded(texts: pd.Series) -> Iterator[bytes]:
    return (text.encode() for text in texts)


def _anchors(frame: pd.DataFrame) -> Iterator[np.ndarray]:
    """The hashes of the anchors of the texts, of some pieces at a time."""
    held: list[np.ndarray] = []
    for found in stretches(_encoded(frame["text"])):
        held.append(found.hashes[~found.periodic])
        if len(held) >= 16:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


class _Block:
    """Stretches gathered until they fill a block."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.size += len(row[-1])

    def repeats(self) -> list[tuple]:
        """(no, doc_id, tie, start, end, digest): repeated runs, and with a digest the strings that
        are first in a block of a split anchor."""
        if not self.rows:
            return []
        text = np.frombuffer(b"".join(r[-1] for r in self.rows), np.uint8)
        lengths = np.array([len(r[-1]) for r in self.rows])
        begins = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(self.rows)), lengths)
        inside = np.arange(len(text)) - begins[owner]
        whole = inside <= lengths[owner] - LENGTH

        keys = words(text, LENGTH + 8)
        order = suffix_array(text, keys, LENGTH)
        order = order[whole[order]]
        run = np.cumsum(np.append(True, ~same_prefix(order, keys, LENGTH)))
        ranks = {key: k for k, key in enumerate(sorted({r[1:4] for r in self.rows}))}
        rank = np.array([ranks[r[1:4]] for r in self.rows])[owner[order]]
        start = np.array([r[4] for r in self.rows])[owner[order]] + inside[order]
        by = np.lexsort((start, rank, run))
        first = np.zeros(len(order), bool)
        first[by[np.append(True, run[by][1:] != run[by][:-1])]] = True

        out = []
        again = np.sort(order[~first])
        if len(again):
            cut = np.append(True, (again[1:] != again[:-1] + 1) | (owner[again[1:]] != owner[again[:-1]]))
            heads = np.flatnonzero(cut)
            tails = np.append(heads[1:] - 1, len(again) - 1)
            for a, b in zip(again[heads], again[tails], strict=True):
                row = self.rows[owner[a]]
                begin = row[4] + int(inside[a])
                out.append((*row[1:4], begin, begin + int(b - a) + LENGTH, None))
        split = np.array([r[0] for r in self.rows])
        for p in order[first & split[owner[order]]] if split.any() else ():
            row = self.rows[owner[p]]
            begin = row[4] + int(inside[p])
            digest = hashlib.blake2b(text[p : p + LENGTH].tobytes(), digest_size=16).digest()
            out.append((*row[1:4], begin, begin + LENGTH, digest))
        return out


KEY = ["no", "doc_id", "tie"]
FOUND = "no boolean, doc_id long, tie long, start long, end long, digest binary"


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor and block; whole groups are packed together."""
    names = [part.split()[0] for part in FOUND.split(",")]
    block, last = _Block(), None
    for frame in frames:
        columns = ["anchor", "part", "split", *KEY, "start", "bytes"]
        for anchor, part, *row in zip(*[frame[c] for c in columns], strict=True):
            if (anchor, part) != last and block.size >= BLOCK:
                yield pd.DataFrame(block.repeats(), columns=names)
                block = _Block()
            last = anchor, part
            block.add(tuple(row))
    yield pd.DataFrame(block.repeats(), columns=names)


CUT = "n_removed long, n_spans long, kept_sha256 string"


def _cut(text: str, spans: list) -> tuple[int, int, str]:
    raw, kept, at, count = text.encode(), hashlib.sha256(), 0, 0
    end = -1
    removed = 0
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if a > end:
            kept.update(raw[max(end, 0) : a])
            count += 1
            removed += b - a
            end = b
        elif b > end:
            removed += b - end
            end = b
    kept.update(raw[max(end, 0) :])
    return removed, count, kept.hexdigest()


_CODE = 31  # Bits below a start: 0 for a stretch that stays, or 1 + the part of its anchor's blocks.
MOVED = "anchor long, part int, no boolean, doc_id long, tie long, start long, end long, bytes binary"


def _runs(flags: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values within a piece."""
    at = np.flatnonzero(flags)
    fresh = (at[1:] != at[:-1] + 1) | (piece[at[1:]] != piece[at[:-1]])
    return at[np.append(True, fresh)[: len(at)]], at[np.append(fresh, True)[: len(at)]]


class _Table:
    """Rows gathered as arrays until they fill a frame."""

    def __init__(self, names: list[str]) -> None:
        self._names = names
        self._parts: list[list] = []
        self._size = 0

    def add(self, *columns: np.ndarray) -> None:
        self._parts.append(columns)
        self._size += len(columns[0])

    def full(self) -> bool:
        return self._size >= 20_000

    def frame(self) -> pd.DataFrame:
        columns = zip(*self._parts, strict=True)
        out = {name: np.concatenate(parts) for name, parts in zip(self._names, columns, strict=bool(self._parts))}
        self._parts, self._size = [], 0
        return pd.DataFrame(out, columns=self._names)


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def repeated(bodies: DataFrame, stage: Stage, bits: int = BITS) -> DataFrame:
    """(no, doc_id, tie, start, end): repeated runs of bytes of `bodies` (no, doc_id, tie, text), which
    are different texts. Runs may overlap."""
    again = bloom.repeats(bodies.select("text"), _anchors, bits)
    shared = bloom.Filter(bodies.sparkSession, again, bits)

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _Table(["anchor", "content", *KEY, "start"])
        for frame in frames:
            keys = [frame[c].to_numpy() for c in KEY]
            for found in stretches(_encoded(frame["text"])):
                hit = np.flatnonzero(shared.test(found.hashes) & ~found.periodic)
                contents = [xxhash.xxh3_64_intdigest(stretch) for stretch in found.bytes_of(hit)]
                number = found.numbers()[hit]
                content = np.array(contents, _U).view(np.int64)
                table.add(found.hashes[hit], content, *[key[number] for key in keys], found.starts()[hit])
                if table.full():
                    yield table.frame()
        yield table.frame()

    place = F.struct(*KEY, "start")
    parts = bodies.mapInPandas(digests, "anchor long, content long, no boolean, doc_id long, tie long, start long")
    contents = stage(
        "contents", parts.groupBy("anchor", "content").agg(F.min(place).alias("first")).select("anchor", "content", "first.*")
    )
    several = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1)
    several = stage(
        "several", several.select("anchor", F.ceil(F.col("k") / STRETCHES).cast("int").alias("parts"))
    )
    # Only stretches whose anchor has several go to the join.
    kept = contents.withColumn("maybe", bloom.maybe_in(contents, "anchor", several.select("anchor"), bits))
    code = F.when(
        F.col("parts").isNotNull(), F.lit(1) + F.pmod("content", "parts").cast("long")
    ).otherwise(F.lit(0))
    entry = (F.shiftleft("start", _CODE) + code.cast("long")).alias("entry")
    listed = kept.where(~F.col("maybe")).select(*KEY, F.shiftleft("start", _CODE).alias("entry")).unionByName(
        kept.where("maybe").join(several, "anchor", "left").select(*KEY, entry)
    )
    lists = listed.groupBy(*KEY).agg(F.collect_list("entry").alias("entries"))

    def moved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _Table([part.split()[0] for part in MOVED.split(", ")])
        for frame in frames:
            keys, entries = [frame[c].to_numpy() for c in KEY], frame["entries"].tolist()
            for found in stretches(_encoded(frame["text"])):
                # Each piece has its list of first stretches; all of them as one sorted array.
                lists = [entries[number] for number, _, _ in found.pieces]
                lists = [np.sort(np.asarray([] if e is None else e, np.int64)) for e in lists]
                known = np.concatenate(lists)
                owner = np.repeat(np.arange(len(lists)), [len(e) for e in lists])
                start, number = found.starts(), found.numbers()
                places, wanted = (owner << 32) | (known >> _CODE), (found.piece << 32) | start
                at = np.minimum(np.searchsorted(places, wanted), max(len(places) - 1, 0))
                head = places[at] == wanted if len(places) else np.zeros(len(wanted), bool)
                a, b = _runs((shared.test(found.hashes) & ~head) | found.periodic, found.piece)
                none = np.zeros(len(a), np.int64)
                ends = start + found.last - found.first + LENGTH
                own = [key[number[a]] for key in keys]
                table.add(none, none, *own, start[a], ends[b], _objects([None] * len(a)))
                heads = np.flatnonzero(head)
                part = (known[at[heads]] & ((1 << _CODE) - 1)) - 1 if len(places) else heads
                heads, part = heads[part >= 0], part[part >= 0]
                own = [key[number[heads]] for key in keys]
                held = _objects(list(found.bytes_of(heads)))
                table.add(found.hashes[heads], part, *own, start[heads], ends[heads], held)
                if table.full():
                    yield table.frame()
        yield table.frame()

    met = bodies.join(lists, KEY, "left").select(*KEY, "text", "entries")
    pieces = stage("pieces", met.mapInPandas(moved, MOVED))
    copies = pieces.where(F.col("bytes").isNull())
    split = several.where(F.col("parts") > 1).select("anchor", F.lit(True).alias("split"))
    placed = pieces.where(F.col("bytes").isNotNull()).join(split, "anchor", "left").select(
        "anchor", "part", F.coalesce("split", F.lit(False)).alias("split"), *KEY, "start", "bytes"
    )
    sorted_ = placed.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    found = stage("found", sorted_.mapInPandas(_blocks, FOUND))
    firsts = found.where(F.col("digest").isNotNull())
    least = stage("least", firsts.groupBy("digest").agg(F.min(place).alias("least")))
    met = firsts.join(least, "digest").where(place != F.col("least"))
    columns = [*KEY, "start", "end"]
    inside = found.where(F.col("digest").isNull()).select(columns)
    return copies.select(columns).unionByName(inside).unionByName(met.select(columns))


def decisions(docs: DataFrame, stage: Stage, bits: int = BITS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of `docs`."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").isNull().alias("no"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("sha"),
        text.alias("text"),
    ).withColumn("tie", F.xxhash64("sha"))
    long = rows.where(F.col("n_bytes") >= LENGTH)
    marked = long.withColumn("maybe", bloom.maybe_repeated(long, "tie"))
    columns = ["no", "doc_id", "tie", "sha", "text"]
    grouped = marked.where("maybe").groupBy("sha", "tie").agg(
        F.min(F.struct("no", "doc_id")).alias("least"), F.first("text").alias("text")
    )
    grouped = grouped.select("least.*", "tie", "sha", "text")
    bodies = stage(
        "bodies",
        marked.where(~F.col("maybe")).select(columns).unionByName(grouped.select(columns)),
    )
    runs = stage("runs", repeated(bodies.select(*KEY, "text"), stage, bits))
    spans = stage(
        "spans", runs.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )

    @F.pandas_udf(CUT)
    def cut(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        cuts = [_cut(text, list(found)) for text, found in zip(texts, lists, strict=True)]
        return pd.DataFrame(cuts, columns=["n_removed", "n_spans", "kept_sha256"])

    near = bodies.where(bloom.maybe_in(bodies, "tie", spans.select("tie")))
    results = stage(
        "results",
        near.join(spans, KEY).select("sha", cut("text", "spans").alias("c")).select("sha", "c.*"),
    )
    heads = bodies.select("sha", F.struct("no", "doc_id").alias("head")).join(results, "sha", "left")
    # One join on written tables, so that adaptive execution can split many equal texts.
    digests = stage("digests", rows.select("no", "doc_id", "n_bytes", "sha"))
    own = digests.join(stage("heads", heads), "sha", "left")
    later = F.col("head").isNotNull() & (F.struct("no", "doc_id") != F.col("head"))
    zero = F.lit(0).cast("long")
    return own.select(
        F.when(~F.col("no"), F.col("doc_id")).alias("doc_id"),
        "n_bytes",
        F.when(later, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(later, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(later, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept_sha256", "sha"))
        .alias("kept_sha256"),
    )
