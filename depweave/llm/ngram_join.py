"""N-gram Jaccard join as a blocked sparse matrix product.

Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased; a document's set is its distinct
`width`-word shingles (fewer words: the whole sequence as one), as 64-bit hashes. Two documents are
linked if 100 times the size of the intersection of their sets is at least `percent` times that of the
union; groups are the connected components of the links.

The incidence matrix has a row for each distinct set and a column for each shingle; the product of the
matrix and its transpose holds all overlaps. It is computed in blocks, and only where a link may be:

* Columns are put in one order for all documents, rare ones first: by the magnitude of a count of
  all shingles in 2**SLOT_BITS slots, then by hash. A partner has at least ceil(percent * n / 100) of n
  shingles in common, so two linked sets share a column among their first n - ceil(percent * n / 100) + 1.
  Only these columns select blocks. A Bloom filter drops columns of one row before they are shuffled,
  and columns with the same rows are one.
* First each row is multiplied with one other, the hub of its columns: the row that has most in common with
  most. What is linked is grouped. Then each column whose rows are still in different groups is a block
  of its rows outside the column's largest group times all its rows, cut into cells of bounded size. No
  pair within a group is looked at, so large groups of copies cost no more than their size.
* A pair is only needed in the block of its first common column. There the overlap is at most what either
  set has from that column on, so sizes and the column's place in each row tell which rows have no link
  in a cell, before anything else is moved there.
* Before texts are moved to a cell, its rows' sketches are: how many shingles are in each of about n / 6 bins.
  The sum over bins of the smaller of two counts is never less than the overlap, so a row whose sketch lets
  no other of the cell reach the bound below has no link there and isn't moved. The others fall into
  parts that may be linked; the same part of several blocks is one, and texts move once for each part.
* In a cell the rows' whole sets are a sparse matrix by columns. A row's overlaps with all others are
  accumulated in one array over its shingles. Pairs are discarded before that by size (the smaller set has
  at least `percent` hundredths of the larger one's size) and after it by the bound on the overlap that
  follows from both sizes, percent * (m + n) / (100 + percent). Overlaps are exact, so what is left is linked.

No link between different groups is lost and none is doubtful, but for equal 64-bit hashes.

Defined cases: a null or empty text or one without words has an empty set and is linked with nothing. A
null doc_id comes last: a group of nulls alone has a null component_id. Repeated rows of one doc_id have
rows of their own. An empty table gives an empty result. Columns other than doc_id and text aren't read.
A very long text is one cell by itself at worst: the cell's size is then that of the text's set.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .components import components
from .near_dedup import Shingler
from .shared import Shared

WIDTH, PERCENT = 4, 85
SLOT_BITS = 22
#: Shingles on either side of a cell.
CELL = 500_000
_CUT = 1 << 16
#: Sides of a cell that a row is on.
PROBE, OTHER = 1, 2

Stage = Callable[[str, DataFrame], DataFrame]


def shared_at_least(n: int, percent: int) -> int:
    """What a set of `n` has in common with any set it is linked with, at least."""
    return -(-percent * n // 100)


def overlap_bound(m, n, percent: int):  # noqa: ANN001, ANN201
    """The least overlap of linked sets of sizes `m` and `n` (numbers or arrays)."""
    return -(-percent * (m + n) // (100 + percent))


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def magnitudes(docs: DataFrame, width: int) -> np.ndarray:
    """The logarithm (base 2, rounded up) of how many shingles of all documents are in each slot; one byte a slot,
    whatever the data. Tasks send their counts in pieces, which meet per piece."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, total = Shingler(width), np.zeros(1 << SLOT_BITS, np.uint32)
        for frame in batches:
            for text in frame["text"]:
                np.add.at(total, _slots(shingler.set_of(text)), np.uint32(1))
        for k in range(0, len(total), _CUT):
            if total[k : k + _CUT].any():
                packed = zlib.compress(total[k : k + _CUT].tobytes(), 1)
                yield pd.DataFrame({"piece": [k // _CUT], "packed": [packed]})

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for piece, packed in zip(frame["piece"], frame["packed"], strict=True):
                own = np.frombuffer(zlib.decompress(packed), np.uint32)
                sums.setdefault(piece, np.zeros(_CUT, np.int64))
                sums[piece] += own
        for piece, total in sums.items():
            size = np.ceil(np.log2(np.maximum(total, 1))).astype(np.uint8)
            yield pd.DataFrame({"piece": [piece], "packed": [zlib.compress(size.tobytes(), 1)]})

    kind = "piece long, packed binary"
    parts = docs.select("text").mapInPandas(counted, kind)
    sums = parts.repartition("piece").mapInPandas(added, kind)
    whole = np.zeros(1 << SLOT_BITS, np.uint8)
    for row in sums.collect():
        at = row["piece"] * _CUT
        whole[at : at + _CUT] = np.frombuffer(zlib.decompress(row["packed"]), np.uint8)
    return whole


def first_columns(shingles: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """The columns of a set that select blocks, by the order that `size` gives."""
    keep = len(shingles) - shared_at_least(len(shingles), percent) + 1
    order = np.lexsort((shingles, size[_slots(shingles)]))
    return shingles[order[:keep]]


def sketch_of(shingles: np.ndarray) -> bytes:
    """How many of a non-empty set are in each of a power of two of bins, one byte each; neighbouring
    bins of a longer sketch added up are the bins of a shorter one."""
    bits = max(5, (len(shingles) // 6).bit_length())
    while True:
        count = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if count.max() < 256:
            return count.astype(np.uint8).tobytes()
        bits += 1


def _folded(table: np.ndarray, bins: int) -> np.ndarray:
    """Sketches (rows) cut down to `bins` bins."""
    return table.reshape(len(table), bins, -1).sum(axis=2, dtype=np.int32)


def near(m, i, n, j, percent: int):  # noqa: ANN001, ANN201
    """Whether sets of sizes `m` and `n` (numbers or arrays) may be linked whose first common column has
    the places `i` and `j` in them."""
    least = overlap_bound(m, n, percent)
    sizes = 100 * np.minimum(m, n) >= percent * np.maximum(m, n)
    return sizes & (m - i >= least) & (n - j >= least)


def _numbers(probes: list[tuple], others: list[tuple]) -> list[np.ndarray]:
    """The groups of some rows (group, …) and of others as numbers."""
    number: dict[bytes, int] = {}
    return [np.array([number.setdefault(r[0], len(number)) for r in side]) for side in (probes, others)]


def may_meet(probes: list[tuple], others: list[tuple], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each of some rows (group, size, place), and of each of others, whether it may be linked with
    one of another group on the other side."""
    own, groups = _numbers(probes, others)
    n, j = (np.array([r[k] for r in probes]) for k in (1, 2))
    m, i = (np.array([r[k] for r in others]) for k in (1, 2))
    one, two = np.zeros(len(probes), bool), np.zeros(len(others), bool)
    step = max(1, _CUT // len(others))
    for k in range(0, len(probes), step):
        at = slice(k, k + step)
        hit = near(m, i, n[at, None], j[at, None], percent) & (groups != own[at, None])
        one[at] = hit.any(axis=1)
        two |= hit.any(axis=0)
    return one, two


def may_link(probes: list[tuple], others: list[tuple], percent: int) -> list[list[int]]:
    """Of some rows (group, size, place, node, sketch) and of others the parts that may be linked across
    sides, each as numbers of rows: first those of `probes`, then those of `others`. A node is in one part."""
    rows = [*probes, *others]
    number: dict[bytes, int] = {}
    nodes = np.array([number.setdefault(r[3], len(number)) for r in rows])
    parent = np.arange(len(number))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    hit = np.zeros(len(rows), bool)
    own, groups = _numbers(probes, others)
    sizes, places = (np.array([r[k] for r in others]) for k in (1, 2))
    lengths = np.array([len(r[4]) for r in others])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        table = np.frombuffer(b"".join(others[k][4] for k in at), np.uint8).reshape(len(at), -1)
        m, i, at_bins = sizes[at], places[at], {}
        for k, (_, n, j, _, sketch) in enumerate(probes):
            found = np.flatnonzero(near(m, i, n, j, percent) & (groups[at] != own[k]))
            if not len(found):
                continue
            bins = min(len(sketch), int(length))
            if bins not in at_bins:
                at_bins[bins] = _folded(table, bins)
            mine = _folded(np.frombuffer(sketch, np.uint8)[None], bins)
            most = np.minimum(at_bins[bins][found], mine).sum(axis=1)
            found = at[found[most >= overlap_bound(m[found], n, percent)]] + len(probes)
            if len(found):
                hit[k] = hit[found] = True
                top = root(nodes[k])
                for x in np.unique(nodes[found]):
                    parent[root(x)] = top
    parts: dict[int, list[int]] = {}
    for k in np.flatnonzero(hit):
        parts.setdefault(root(nodes[k]), []).append(int(k))
    return list(parts.values())


PRINT = "n long, node binary, sketch binary, columns array<long>"


def _place() -> Column:
    return F.xxhash64("text", "doc_id")


def _prints(docs: DataFrame, width: int, percent: int, size: np.ndarray) -> DataFrame:
    """(doc_id, place, n, node, sketch, columns): `node` is the digest of the set, null if empty, and `place` a
    hash of the row."""
    shared = Shared(docs.sparkSession, size)

    @F.pandas_udf(PRINT)
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler, sizes = Shingler(width), shared.value
        for batch in batches:
            rows = []
            for text in batch:
                own = shingler.set_of(text)
                if len(own):
                    node = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    first = first_columns(own, sizes, percent).view(np.int64)
                    rows.append((len(own), node, sketch_of(own), first))
                else:
                    rows.append((0, None, None, None))
            yield pd.DataFrame(rows, columns=["n", "node", "sketch", "columns"])

    return docs.select("doc_id", _place().alias("place"), printed(F.col("text")).alias("p")).select(
        "doc_id", "place", "p.*"
    )


def _columns(rows: DataFrame, stage: Stage, bits: int) -> DataFrame:
    """(col, node, n, pos): the columns with several rows and their places in them; of columns with the
    same rows only the first one."""
    entries = rows.select("node", "n", F.posexplode("columns").alias("pos", "col"))
    maybe = stage("entries", entries.where(bloom.maybe_repeated(entries, "col", bits)))
    one, two = F.xxhash64("node"), F.xxhash64("node", F.lit(1))
    sums = maybe.groupBy("col").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum("pos").alias("places"),
        F.bit_xor(one).alias("one"),
        F.bit_xor(two).alias("two"),
    )
    several = sums.where(F.col("size") > 1)
    # The first one has lower places than the others in all of the rows.
    first = F.min(F.struct("places", "col"))["col"].alias("col")
    chosen = stage("chosen", several.groupBy("size", "one", "two").agg(first))
    near = maybe.where(bloom.maybe_in(maybe, "col", chosen.select("col"), bits))
    return stage("columns", near.join(chosen.select("col", "size"), "col"))


def _hubs(columns: DataFrame, percent: int, stage: Stage) -> DataFrame:
    """(node, hub): each row with the hub of its columns, where sizes let them be linked."""
    mass = stage("mass", columns.groupBy("node").agg(F.sum("size").alias("mass")))
    weighed = stage("weighed", columns.join(mass, "node").select("col", "node", "n", "mass"))
    hub = F.struct("mass", "node", "n")
    hubs = stage("hubs", weighed.groupBy("col").agg(F.max(hub).alias("hub")))
    alike = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    near = weighed.join(hubs, "col").where((F.col("node") != F.col("hub.node")) & alike)
    best = near.groupBy("node").agg(F.max("hub").alias("hub"), F.first("n").alias("n"))
    return stage("hubbed", best.select("node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")))


class Cell:
    """Sparse rows and their product with others, one at a time."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self.values = every[order]
        self.rows = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def overlaps(self, own: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.values, own, "left")
        high = np.searchsorted(self.values, own, "right")
        length = high - low
        ends = np.cumsum(length)
        # The places low[k], …, high[k] - 1 of all k, one after another.
        at = np.arange(ends[-1]) + np.repeat(low - ends + length, length)
        return np.bincount(self.rows[at], minlength=len(self.sizes))

    def linked(self, own: np.ndarray) -> np.ndarray:
        """The numbers of the rows that `own` is linked with."""
        n, p = len(own), self.percent
        if not (100 * np.minimum(self.sizes, n) >= p * np.maximum(self.sizes, n)).any():
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.overlaps(own) >= overlap_bound(self.sizes, n, p))


def _cell_links(held: list[dict], shingler: Shingler, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between groups, as many as join those of the cell that are linked: fewer than it has groups."""
    probes = [r for r in held if r["side"] & PROBE]
    others = [r for r in held if r["side"] & OTHER]
    if not probes or not others:
        return []
    sets = {r["node"]: r["packed"] for r in held}
    sets = {node: shingler.set_of(zlib.decompress(packed).decode()) for node, packed in sets.items()}
    cell = Cell([sets[r["node"]] for r in others], percent)
    parent: dict[bytes, bytes] = {}

    def root(group: bytes) -> bytes:
        while (above := parent.setdefault(group, group)) != group:
            parent[group] = group = parent[above]
        return group

    links = []
    for probe in probes:
        for k in cell.linked(sets[probe["node"]]):
            other = others[k]
            one, two = root(probe["comp"]), root(other["comp"])
            if one != two:
                parent[one] = two
                links.append((probe["node"], other["node"]))
    return links


CELL_ROW = "col long, i int, j int, probe boolean, node binary, comp binary, n long, pos int"
_CELL_NAMES = ("col", "i", "j", "probe", "node", "comp", "n", "pos")


def _by_cell(cells: DataFrame, names: tuple, kind: str, chosen: Callable[[list, list], list[tuple]]) -> DataFrame:
    """What `chosen` makes of the rows of each cell, those that are probes and the others; one cell is
    held at a time."""

    def made(held: list[tuple]) -> list[tuple]:
        sides = [[r for r in held if r[3] == probe] for probe in (True, False)]
        return chosen(*sides) if all(sides) else []

    columns = [part.split()[0] for part in kind.split(", ")]

    def filtered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []
        for frame in frames:
            done: list[tuple] = []
            for row in zip(*(frame[c] for c in names), strict=True):
                if row[:3] != cell:
                    done += made(held)
                    cell, held = row[:3], []
                held.append(row)
            if done:
                yield pd.DataFrame(done, columns=columns)
        yield pd.DataFrame(made(held), columns=columns)

    dealt = cells.select(*names).repartition("col", "i", "j").sortWithinPartitions("col", "i", "j")
    return dealt.mapInPandas(filtered, kind)


def _meeting(cells: DataFrame, percent: int) -> DataFrame:
    """The rows of cells (col, i, j, probe, node, comp, n, pos) that by size and place may be linked across
    the cell with another group."""

    def chosen(*sides: list[tuple]) -> list[tuple]:
        rows = [[r[5:] for r in side] for side in sides]
        found = zip(sides, may_meet(*rows, percent), strict=True)
        return [r for side, hit in found for r, yes in zip(side, hit, strict=True) if yes]

    return _by_cell(cells, _CELL_NAMES, CELL_ROW, chosen)


def _promising(cells: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(part, node, comp, side): the parts of cells (col, i, j, probe, node, comp, n, pos) that by their sketches
    may be linked across the cell with another group; `sketches` is (node, sketch). A part is named by
    its nodes, so that what several cells have is there once."""

    def chosen(*sides: list[tuple]) -> list[tuple]:
        probes, others = ([(r[5], r[6], r[7], r[4], r[8]) for r in side] for side in sides)
        rows, made = [*probes, *others], []
        for part in may_link(probes, others, percent):
            side: dict[bytes, int] = {}
            for k in part:
                side[rows[k][3]] = side.get(rows[k][3], 0) | (PROBE if k < len(probes) else OTHER)
            comp = {rows[k][3]: rows[k][0] for k in part}
            key = hashlib.blake2b(b"".join(sorted(side)), digest_size=8).digest()
            key = int.from_bytes(key, "little", signed=True)
            made += [(key, node, comp[node], s) for node, s in side.items()]
        return made

    kind = "part long, node binary, comp binary, side int"
    parts = _by_cell(cells.join(sketches, "node"), (*_CELL_NAMES, "sketch"), kind, chosen)
    return parts.groupBy("part", "node").agg(F.min("comp").alias("comp"), F.bit_or("side").alias("side"))


def _product(parts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) within the parts of (part, node, comp, side, packed)."""
    names = ("part", "node", "comp", "side", "packed")
    dealt = parts.select(*names).repartition("part").sortWithinPartitions("part")

    def multiplied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by part; one part is held at a time."""
        shingler = Shingler(width)
        now, held, seen = None, [], set()
        for frame in frames:
            links = []
            for part, node, comp, side, packed in zip(*(frame[c] for c in names), strict=True):
                if part != now:
                    links += _cell_links(held, shingler, percent)
                    now, held, seen = part, [], set()
                # Repeated rows of one document have brought the text more than once.
                if node not in seen:
                    seen.add(node)
                    held.append({"node": node, "comp": comp, "side": side, "packed": packed})
            yield pd.DataFrame(links, columns=["a", "b"])
        yield pd.DataFrame(_cell_links(held, shingler, percent), columns=["a", "b"])

    return dealt.mapInPandas(multiplied, "a binary, b binary")


def _packed(column: str) -> Column:
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([None if text is None else zlib.compress(text.encode()) for text in texts])

    return packed(F.col(column))


def _star_cells(hubbed: DataFrame, stage: Stage) -> DataFrame:
    """Cells of a hub and about CELL shingles of the rows it is to be multiplied with. A hub stands for
    the column of a cell."""
    loads = stage("loads", hubbed.groupBy("hub").agg(F.sum("n").alias("load"), F.first("hub_n").alias("n")))
    cuts = F.ceil(F.col("load") / CELL).cast("int")
    column = F.xxhash64("hub").alias("col")
    placed = hubbed.join(loads.select("hub", cuts.alias("cuts")), "hub")
    i = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    probes = placed.select(column, i.alias("i"), F.lit(0).alias("j"), F.lit(True).alias("probe"), "node", F.col("node").alias("comp"), "n", F.lit(0).alias("pos"))
    others = loads.select(
        column,
        F.explode(F.sequence(F.lit(0), cuts - 1)).alias("i"),
        F.lit(0).alias("j"),
        F.lit(False).alias("probe"),
        F.col("hub").alias("node"),
        F.col("hub").alias("comp"),
        "n",
        F.lit(0).alias("pos"),
    )
    return probes.unionByName(others)


def _block_cells(columns: DataFrame, groups: DataFrame, stage: Stage) -> DataFrame:
    """Cells of the columns whose rows are in different groups: rows outside the largest group times
    all rows, cut into `cuts` times `blocks`."""
    grouped = stage(
        "grouped",
        columns.join(groups, "node", "left").select(
            "col", "node", "n", "pos", F.coalesce("comp", "node").alias("comp")
        ),
    )
    per_group = grouped.groupBy("col", "comp").agg(F.sum("n").alias("n"))
    load = F.ceil(F.col("total") / CELL).cast("int")
    outside = F.ceil((F.col("total") - F.col("main.n")) / CELL).cast("int")
    mixed = stage(
        "mixed",
        per_group.groupBy("col")
        .agg(
            F.max(F.struct("n", "comp")).alias("main"),
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("groups"),
        )
        .where(F.col("groups") > 1)
        .select("col", F.col("main.comp").alias("main"), load.alias("blocks"), outside.alias("cuts")),
    )
    placed = grouped.join(mixed, "col").withColumn("spread", F.xxhash64("node"))
    others = placed.select(
        "col",
        F.pmod("spread", "blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("j"),
        F.lit(False).alias("probe"),
        "node",
        "comp",
        "n",
        "pos",
    )
    probes = placed.where(F.col("comp") != F.col("main")).select(
        "col",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
        F.pmod("spread", "cuts").cast("int").alias("j"),
        F.lit(True).alias("probe"),
        "node",
        "comp",
        "n",
        "pos",
    )
    return others.unionByName(probes)


def join_groups(
    docs: DataFrame,
    stage: Stage,
    width: int = WIDTH,
    percent: int = PERCENT,
    bits: int = bloom.BITS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs`: `component_id` is the smallest
    doc_id reachable by links, the own one included."""
    if not 1 <= percent <= 100:
        raise ValueError("percent")
    docs = docs.select("doc_id", "text")
    prints = stage("prints", _prints(docs, width, percent, magnitudes(docs, width)))
    sets = prints.where(F.col("node").isNotNull())
    first = (F.col("doc_id").isNull().alias("no"), "doc_id", "place")
    # Exact copies are one row of the matrix.
    rows = stage(
        "rows",
        sets.groupBy("node").agg(
            F.min(F.struct(*first)).alias("least"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("columns").alias("columns"),
        ),
    )
    columns = _columns(rows.select("node", "n", "columns"), stage, bits)
    sketches = stage(
        "sketches",
        rows.select("node", "sketch").join(
            columns.select("node").distinct(), "node", "left_semi"
        ),
    )

    where = rows.select("node", "least.place", F.col("least.doc_id").alias("id"))

    def product(name: str, cells: DataFrame) -> DataFrame:
        """Only texts of rows that the sketches leave are moved, packed; of copies that of the first document,
        and a text whose place isn't wanted isn't shuffled."""
        promising = stage(f"{name}_cells", _promising(cells, sketches, percent))
        wanted = stage(f"{name}_wanted", promising.join(where, "node"))
        placed = docs.select("text", F.col("doc_id").alias("own"), _place().alias("place"))
        near = placed.where(bloom.maybe_in(placed, "place", wanted.select("place"), bits))
        near = near.select("own", "place", _packed("text").alias("packed"))
        same = (near["place"] == wanted["place"]) & near["own"].eqNullSafe(wanted["id"])
        return stage(name, _product(near.join(wanted, same), width, percent))

    links = product("links", _star_cells(_hubs(columns, percent, stage), stage))
    groups = stage("groups", components(links, stage))
    more = product("more", _meeting(_block_cells(columns, groups, stage), percent))
    groups = stage("all_groups", components(links.unionByName(more), stage))

    least = rows.select("node", "least").join(groups, "node")
    heads = stage("heads", least.groupBy("comp").agg(F.min("least").alias("head")))
    of_group = groups.join(heads, "comp").select("node", "head")
    of_row = stage(
        "of_row",
        rows.join(of_group, "node", "left").select("node", F.coalesce("head", "least").alias("head")),
    )
    empty = F.col("node").isNull()
    return prints.join(of_row, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
    )
