"""Steps whose work for each row was too much: what they read, compare and sort, and their results."""

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from __spark_entry__ import _Inputs, flower_documents
from depweave.operators import cooccur, flowers
from depweave.operators.known_names import NameFilter
from depweave.plans.stages import Stages
from depweave.sources.corpus import _lines_of

LISTS = "repo string, n long, deps array<struct<dep: int, df: long>>"


def plan(table):
    mode = table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return table._jdf.queryExecution().explainString(mode)


def tables(spark, folder):
    """The tables of a corpus of three repositories that import each other."""
    schemas = {
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_returnflag string", [(9 * o + 8, p, "A") for o in range(9) for p in (1, 2, 3, 4)]),
        "customer": ("c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string", [(c, 1, 5.0, "x") for c in (1, 2, 3)]),
        "supplier": ("s_suppkey bigint, s_nationkey int, s_acctbal double", [(4, 1, 1.0)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(9 * o + 8, 1 + o % 3) for o in range(9)]),
        "part": ("p_partkey bigint", [(p,) for p in (1, 2, 3, 4)]),
    }
    for name, (schema, rows) in schemas.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_documents_are_parsed_once(spark, tmp_path):
    found = flower_documents(_Inputs(spark, tables(spark, tmp_path), "test_documents"))
    assert found.columns == ["root", "source", "target", "id", "group"]
    assert plan(found).count("Scan parquet  (") == 1
    rows = found.collect()
    assert {r.source is None for r in rows} == {True, False}
    assert all((r.source is None) == (r.target is None) == (r.id is not None) for r in rows)


def test_filter_of_names_copies_no_map(spark):
    names = spark.range(5).select(F.concat(F.lit("n"), "id").alias("name"))
    kept = NameFilter(names, Stages(spark).write)
    assert kept.maps.schema["map"].dataType == T.ArrayType(T.LongType())
    assert kept.maybe_known(names, "name").count() == 5


def test_lines_move_as_items(spark):
    """Lines aren't gathered before the shuffle, and are made behind it."""
    items = spark.createDataFrame([(1, 3), (1, 2), (1, 2), (None, 7), (None, None), (2, None)], "id long, item int")
    found = _lines_of(items, F.concat(F.lit("line "), F.col("item").cast("string")))
    assert "ObjectHashAggregate" not in plan(found) and "SortAggregate" not in plan(found)
    assert {(r.id, r.content) for r in found.collect()} == {(1, "line 2\nline 2\nline 3"), (None, "line 7"), (2, "")}
    assert found.count() == 3


def test_flowers_remove_what_comes_again(spark):
    """A root among its own dependents, a leaf of two hops, the root as a leaf, and a hop that comes twice."""
    leaf = "dst string, leaves array<struct<rank: long, src: string, degree: long>>"
    rows = {
        "a": [(0, "a", 3), (1, "b", 2), (2, "c", 1)],
        "b": [(0, "a", 3), (1, "c", 1)],
        "c": [(0, "x", 0)],
        "d": [(0, "e", 0), (1, "e", 0)],
        "f": [(0, "c", 1), (1, "g", 0)],
    }
    degrees = spark.createDataFrame([(r, len(x)) for r, x in rows.items()], "dst string, degree long")
    found = flowers.flowers(spark.createDataFrame([*rows.items()], leaf), degrees).collect()
    for flower in found:
        hops = [(s, d) for _, s, d in rows[flower.root]]
        nodes = [(flower.root, len(rows[flower.root])), *hops]
        links = [(flower.root, s) for s, _ in hops]
        for hop, _ in hops:
            nodes += [(s, d) for _, s, d in rows.get(hop, [])]
            links += [(hop, s) for _, s, _ in rows.get(hop, [])]
        assert [tuple(x) for x in flower.nodes] == [*dict.fromkeys(nodes)]
        assert [tuple(x) for x in flower.links] == [*dict.fromkeys(links)]
    assert len(found) == len(rows)


def test_partners_of_small_cells_are_sorted_as_numbers(spark, monkeypatch):
    """Best partners of the small repositories are exact, and no array of theirs can hold a null."""
    deps = {r: [d for d in range(12) if (d * r + d // 3) % 4 < 2] for r in range(1, 8)}
    df = Counter(d for x in deps.values() for d in x)
    rows = [(str(r), len(x), [(d, df[d]) for d in x]) for r, x in deps.items()]
    cells, lists, gathered = spark.createDataFrame(rows, LISTS), [], cooccur._gathered

    def watched(table, *args):
        lists.append(table)
        return gathered(table, *args)

    monkeypatch.setattr(cooccur, "_gathered", watched)
    pairs = Counter((a, b) for x in deps.values() for a in x for b in x if a != b)
    for first in (1, 3, 20):
        found = cooccur._small_counts(cells, first, True).collect()
        assert len(found) == len({(r.dep1, r.dep2) for r in found})
        for one in df:
            best = sorted((-n, b) for (a, b), n in pairs.items() if a == one)[:first]
            assert sorted((-r.cnt, r.dep2) for r in found if r.dep1 == one) == best
    assert all(not table.schema["twos"].dataType.containsNull for table in lists)
    halves = cooccur._small_counts(cells, 50, False).collect()
    assert {(r.dep1, r.dep2): r.cnt for r in halves} == {p: n for p, n in pairs.items() if p[0] < p[1]}
