"""Near duplicates by SuperMinHash, banding, verification and union-find grouping.

Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased; a document's set is its distinct
`width`-word shingles (fewer words: the whole sequence as one). Documents are linked if the Jaccard
similarity of their sets is at least `percent` / 100; every link counts that is confirmed on the full
sets (of 64-bit hashes of shingles). Groups are the connected components of the links.

* Documents with the same set are one class, and only one of a class goes on.
* SuperMinHash: each shingle gives the slots ranks of one random permutation of its own, step by
  step; a text is done as soon as no later step can lower a slot. BANDS bands of ROWS slots make
  buckets; a pair at the threshold 0.8 shares none with a chance of 3 in a million. A Bloom filter drops buckets
  of one class before anything is shuffled.
* Candidates, in place of all pairs of a bucket: first each class with one hub, the class of its
  buckets that shares most buckets in all. What is confirmed is grouped. Then, in buckets whose classes
  are still in different groups, the members outside the bucket's largest group are compared by their
  sketches with all members, in cells of bounded size, and likely pairs of different groups are
  confirmed there; only links come out, and join groups. So no link between groups is lost, whatever
  the size of a bucket, and pairs within a group are never listed.

Defined cases: a null or empty text or one without words has an empty set and is linked with
nothing. A null doc_id comes last: a group of nulls alone has a null component_id and its `kept` is
true. Repeated rows of one doc_id have rows of their own with the same flags if the texts are alike.
Columns other than doc_id and text are not read by `decisions`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .components import components
from .text import Memo

BANDS, ROWS = 42, 6
SLOTS = BANDS * ROWS
CELL = 500_000
# Of SLOTS bytes of two sketches so many are equal if the similarity is 0.8, less six deviations.
LIKELY = 160

Stage = Callable[[str, DataFrame], DataFrame]

_U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_LOW = _U(0xFFFFFFFF)
# Odd factors that tell apart the places of words in a shingle and of slots in a band.
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25], _U,
)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


class Shingler:
    """Sets of shingle hashes of texts."""

    def __init__(self, width: int):
        if not 1 <= width <= len(_FACTORS):
            raise ValueError("width")
        self.width, self.known = width, Memo(48 << 20)

    def set_of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, _U)
        for word in self.known.missing(words):
            self.known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(self.known.__getitem__, words), _U, len(words))
        width = min(self.width, len(hashes))
        total = np.full(len(hashes) - width + 1, _U(width), _U)
        for k in range(width):
            total += hashes[k : k + len(total)] * _FACTORS[k]
        return np.unique(_mixed(total))


def super_min_hash(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The signature of a non-empty set of hashes; step number and rank in the high and low 32 bits.
    """
    best = np.full(slots, ~_U(0), _U)
    rows, places, first = np.arange(len(elements)), None, None
    for step in range(slots):
        z = _mixed(elements + _U((step + 1) * _GOLDEN & (2**64 - 1)))
        rank = (z >> _U(32)) | (_U(step) << _U(32))
        pick = (((z & _LOW) * _U(slots - step)) >> _U(32)).astype(np.int64) + step
        if step == 0:
            first = slot = pick
        else:
            if places is None:
                places = np.tile(np.arange(slots, dtype=np.int16), (len(elements), 1))
                places[rows, first] = 0
                places[:, 0] = first
            slot = places[rows, pick]
            places[rows, pick] = places[:, step]
            places[:, step] = slot
        np.minimum.at(best, slot, rank)
        if best.max() < _U(step + 1) << _U(32):
            break
    return best


def buckets(signature: np.ndarray) -> np.ndarray:
    parts = (signature.reshape(BANDS, ROWS) * _FACTORS[:ROWS]).sum(axis=1, dtype=_U)
    return _mixed(parts + np.arange(BANDS, dtype=_U) * _FACTORS[7]).view(np.int64)


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(one) + len(two) - both)


PRINT = "n long, node binary, buckets array<long>, sketch binary"


def _prints(docs: DataFrame, width: int) -> DataFrame:
    """(uid, doc_id, place, n, node, buckets, sketch): `node` is the digest of the set, null if empty,
    and `place` a hash of the text."""

    @F.pandas_udf(PRINT)
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(width)
        for batch in batches:
            rows = []
            for text in batch:
                own = shingler.set_of(text)
                if len(own):
                    sign = super_min_hash(own)
                    node = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    sketch = (sign & _U(255)).astype(np.uint8).tobytes()
                    rows.append((len(own), node, buckets(sign), sketch))
                else:
                    rows.append((0, None, None, None))
            yield pd.DataFrame(rows, columns=["n", "node", "buckets", "sketch"])

    return docs.select(
        "uid", "doc_id", F.xxhash64("text").alias("place"), printed(F.col("text")).alias("p")
    ).select("uid", "doc_id", "place", "p.*")


def _stars(members: DataFrame, stage: Stage, percent: int) -> tuple[DataFrame, DataFrame]:
    """`members` (bucket, node, n) of buckets with several, and candidates (a, b): each node with the
    hub of its buckets."""
    counts = stage("sizes", members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")))
    shared = members.join(counts.where(F.col("size") > 1), "bucket")
    shared = stage("shared", shared)
    mass = stage("mass", shared.groupBy("node").agg(F.sum("size").alias("mass")))
    weighed = stage("weighed", shared.join(mass, "node").select("bucket", "node", "n", "mass"))
    hub = F.struct("mass", "node", "n")
    hubs = stage("hubs", weighed.groupBy("bucket").agg(F.max(hub).alias("hub")))
    alike = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    near = weighed.join(hubs, "bucket").where((F.col("node") != F.col("hub.node")) & alike)
    best = near.groupBy(F.col("node").alias("a")).agg(F.max("hub").alias("hub"))
    return weighed, stage("first", best.select("a", F.col("hub.node").alias("b")))


def _cell_links(
    bucket: int, held: list[dict], shingler: Shingler, percent: int
) -> list[tuple[bytes, bytes]]:
    """Confirmed links of the cell's probes to members of other groups: of each probe one link to a
    group. A pair is dealt with in the first of the buckets it shares."""
    probes = [r for r in held if r["probe"]]
    members = [r for r in held if not r["probe"]]
    if not probes or not members:
        return []
    sets: dict[bytes, np.ndarray] = {}

    def set_of(row: dict) -> np.ndarray:
        if row["node"] not in sets:
            sets[row["node"]] = shingler.set_of(row["text"])
        return sets[row["node"]]

    table = np.frombuffer(b"".join(r["sketch"] for r in members), np.uint8).reshape(-1, SLOTS)
    places = np.stack([r["buckets"] for r in members])
    sizes = np.array([r["n"] for r in members])
    links = []
    for probe in probes:
        n = probe["n"]
        near = 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)
        near &= (table == np.frombuffer(probe["sketch"], np.uint8)).sum(axis=1) >= LIKELY
        joined = {probe["comp"]}
        for k in np.flatnonzero(near):
            other = members[k]
            if other["comp"] in joined:
                continue
            shared = places[k] == probe["buckets"]
            if places[k][shared.argmax()] != bucket:
                continue
            if linked(set_of(probe), set_of(other), percent):
                joined.add(other["comp"])
                links.append((probe["node"], other["node"]))
    return links


def _rest(
    weighed: DataFrame, groups: DataFrame, texts: DataFrame, width: int, percent: int, stage: Stage
) -> DataFrame:
    """Links (a, b) between different groups whose members share a bucket."""
    grouped = stage(
        "grouped",
        weighed.join(groups, "node", "left").select(
            "bucket", "node", "n", F.coalesce("comp", "node").alias("comp")
        ),
    )
    per_group = grouped.groupBy("bucket", "comp").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")
    )
    main = F.max(F.struct("k", "comp", "n")).alias("main")
    mixed = stage(
        "mixed",
        per_group.groupBy("bucket")
        .agg(main, F.sum("n").alias("total"), F.count(F.lit(1)).alias("groups"))
        .where(F.col("groups") > 1)
        .select(
            "bucket",
            F.col("main.comp").alias("main"),
            F.ceil(F.col("total") / CELL).cast("int").alias("blocks"),
            F.ceil((F.col("total") - F.col("main.n")) / CELL).cast("int").alias("chunks"),
        ),
    )
    # A cell holds about CELL shingles of all members and as many of those outside the largest group.
    placed = grouped.join(mixed, "bucket").withColumn("spread", F.xxhash64("node"))
    columns = ["bucket", "node", "comp", "n"]
    everyone = placed.select(
        *columns,
        F.lit(False).alias("probe"),
        F.pmod("spread", "blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"),
    )
    probes = placed.where(F.col("comp") != F.col("main")).select(
        *columns,
        F.lit(True).alias("probe"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
        F.pmod("spread", "chunks").cast("int").alias("j"),
    )
    cells = everyone.unionByName(probes).join(texts, "node").repartition("bucket", "i", "j")
    ordered = cells.sortWithinPartitions("bucket", "i", "j")

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by cell; one cell is held at a time."""
        shingler = Shingler(width)
        cell, held = None, []
        for frame in frames:
            links = []
            for row in frame.to_dict("records"):
                key = row["bucket"], row["i"], row["j"]
                if key != cell:
                    if held:
                        links += _cell_links(cell[0], held, shingler, percent)
                    cell, held = key, []
                held.append(row)
            yield pd.DataFrame(links, columns=["a", "b"])
        if held:
            links = _cell_links(cell[0], held, shingler, percent)
            yield pd.DataFrame(links, columns=["a", "b"])

    return stage("more", ordered.mapInPandas(compared, "a binary, b binary"))


def _confirmed(
    pairs: DataFrame, texts: DataFrame, width: int, percent: int, name: str, stage: Stage
) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets. Texts, not sets, are moved."""

    @F.pandas_udf("boolean")
    def confirm(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingler = Shingler(width)
        last: list = [None, None]
        for ones, twos in batches:
            out = []
            for one, two in zip(ones, twos, strict=True):
                if two != last[0]:
                    last = [two, shingler.set_of(two)]
                out.append(linked(shingler.set_of(one), last[1], percent))
            yield pd.Series(out, dtype=bool)

    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("one")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("two")), "b")
    return stage(name, two.where(confirm("one", "two")).select("a", "b"))


def _headed(docs: DataFrame, stage: Stage, width: int, percent: int, bits: int) -> DataFrame:
    """(uid, doc_id, n, node, head), one row per row of `docs` (uid, doc_id, text): `head` is the first
    row of the group, with its doc_id and uid; null if the set is empty."""
    if percent < 80:
        raise ValueError("the bands are made for similarities of 0.8 and more")
    prints = stage("prints", _prints(docs, width))
    sets = prints.where(F.col("node").isNotNull())
    classes = stage(
        "classes",
        sets.groupBy("node").agg(
            # Nulls last among doc_ids.
            F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "place", "uid")).alias(
                "least"
            ),
            F.first("n").alias("n"),
            F.first("buckets").alias("buckets"),
            F.first("sketch").alias("sketch"),
        ),
    )
    banded = classes.select("node", "n", F.explode("buckets").alias("bucket"))
    members = stage(
        "members", banded.where(bloom.maybe_repeated(banded, "bucket", bits))
    )
    weighed, first = _stars(members, stage, percent)

    involved = weighed.select("node").distinct()
    wanted = stage(
        "wanted",
        classes.join(involved, "node", "left_semi").select(
            "node", "least.place", "buckets", "sketch"
        ),
    )
    # A text is moved only if its place may be wanted.
    placed = docs.select("text", F.xxhash64("text").alias("place"))
    near = placed.where(bloom.maybe_in(placed, "place", wanted.select("place"), bits))
    texts = stage(
        "texts",
        wanted.join(near, "place")
        .groupBy("node")
        .agg(*[F.first(c).alias(c) for c in ("text", "buckets", "sketch")]),
    )

    links = _confirmed(first, texts, width, percent, "links", stage)
    groups = stage("groups", components(links, stage))
    more = _rest(weighed, groups, texts, width, percent, stage)
    groups = stage("all_groups", components(links.unionByName(more), stage))

    least = classes.select("node", "least").join(groups, "node")
    heads = stage("heads", least.groupBy("comp").agg(F.min("least").alias("head")))
    of_node = groups.join(heads, "comp").select("node", "head")
    of_class = stage(
        "of_class",
        classes.join(of_node, "node", "left").select(
            "node", F.coalesce("head", "least").alias("head")
        ),
    )
    return prints.join(of_class, "node", "left").select("uid", "doc_id", "n", "node", "head")


def decisions(
    docs: DataFrame, stage: Stage, width: int = 4, percent: int = 80, bits: int = bloom.BITS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs`. `percent` is 80 or more:
    the bands are made for that."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    return _headed(rows, stage, width, percent, bits).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias(
            "component_id"
        ),
        F.when(F.col("node").isNull(), F.lit(True))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("head.doc_id")))
        .alias("kept"),
    )


def keep_one(
    docs: DataFrame, stage: Stage, width: int = 4, percent: int = 80, bits: int = bloom.BITS
) -> DataFrame:
    """The rows of `docs` without those that are in a group and not its first row, with all their
    columns: one row of each group stays, that of the smallest doc_id, nulls last; of rows alike in
    doc_id and text any one. Rows are told apart by a number, written once with them. Rows that a Bloom
    filter clears of being dropped are not shuffled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = stage("rows", docs.select(F.monotonically_increasing_id().alias("uid"), whole))
    headed = _headed(rows.select("uid", "row.doc_id", "row.text"), stage, width, percent, bits)
    dropped = stage("dropped", headed.where(F.col("uid") != F.col("head.uid")).select("uid"))
    maybe = bloom.maybe_in(rows, "uid", dropped, bits)
    marked = rows.withColumn("maybe", maybe)
    clear = marked.where(~F.col("maybe")).select("row")
    rest = marked.where("maybe").join(dropped, "uid", "left_anti").select("row")
    return clear.unionByName(rest).select("row.*")
