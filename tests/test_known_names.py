"""The filter of known names, and the partners that leave a cell."""

import re

from pyspark.sql import functions as F

from depweave.operators import cooccur, extract, graph, resolve
from depweave.operators.known_names import NameFilter
from depweave.plans.stages import Stages


def plan(table):
    mode = table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return table._jdf.queryExecution().explainString(mode)


def test_no_known_name_is_dropped(spark):
    names = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("name"))
    rows = spark.range(40_000).select(F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("map"))
    stage = Stages(spark).write
    kept = NameFilter(names, stage).maybe_known(rows, "name")
    assert kept.columns == rows.columns
    assert kept.where("map < 20000").count() == 20_000
    # False alarms are few.
    assert kept.where("map >= 20000").count() < 600
    assert NameFilter(names.limit(0), stage).maybe_known(rows, "name").count() == 0
    odd = spark.createDataFrame([("é漢",), ("",), (None,)], "name string")
    assert sorted(r.name for r in NameFilter(odd, stage).maybe_known(odd, "name").collect()) == ["", "é漢"]


def test_unknown_names_are_dropped_before_the_shuffle(spark):
    stage = Stages(spark).write
    contents = spark.range(300).select(
        F.col("id"),
        F.concat(F.lit("import known"), F.col("id") % 7, F.lit("\nimport unknown"), "id", F.lit("\n")).alias("content"),
    )
    files = spark.range(300).select(
        F.col("id"), F.concat(F.lit("u/r"), F.col("id") % 20).alias("repo_name"), F.concat(F.lit("a/known"), F.col("id") % 3, F.lit("/m.py")).alias("path")
    )
    best = spark.range(7).select(F.concat(F.lit("known"), "id").alias("dep"), F.lit("x/y").alias("dst"))
    imports = extract.python_imports(contents)
    known = NameFilter(best.select("dep"), stage)
    filtered = graph.external_deps(files, imports, known=known)
    text = plan(filtered)
    # The test of the bits stands below the aggregate's exchange, and in generated code.
    assert re.search(r"getbit|bit_get", text) and "BroadcastHashJoin" in text and "Python" not in text
    tree = text[: text.index("(1) ")]
    # Read from above: the exchange of the aggregate comes before the join with the maps.
    assert tree.index("Exchange") < tree.index("BroadcastHashJoin")
    rows = resolve.resolve(filtered, best)
    assert sorted(rows.collect()) == sorted(resolve.resolve(graph.external_deps(files, imports), best).collect())
    assert filtered.where("dep LIKE 'unknown%'").count() < 15


def test_few_pairs_of_a_large_cell_are_looked_at(spark):
    """1,000 names that the same two repositories have."""
    known = spark.range(2000).select(
        F.concat(F.lit("r"), F.col("id") % 2).alias("repo"),
        F.concat(F.lit("d"), F.floor(F.col("id") / 2)).alias("dep"),
    )
    made = {}
    b = 20
    stage = Stages(spark)

    def write(name, table):
        made[name] = stage.write(name, table)
        return made[name]

    best = cooccur.top_partners(known, b, stage=write)
    near, sized = made["pair_bounds"], made["pair_sized"]
    floors = near.where(F.col("row") == b).select(
        F.col("dep1").alias("dep"), F.col("cnt").alias("floor"), F.col("dep2").alias("last")
    )
    pairs = cooccur._hopeful_pairs(sized.join(floors, "dep", "left"), made["large_repos"], 1_000)
    assert 0 < pairs.count() < 2 * 1000 * 999 / 10
    counts = cooccur.both_ways(cooccur.pair_counts(known))
    order = sorted((r.dep1, -r.cnt, r.dep2) for r in counts.where("dep1 < 'd11'").collect())
    expected, seen = [], {}
    for one, cnt, two in order:
        seen[one] = seen.get(one, -1) + 1
        if seen[one] < b:
            expected.append((one, two, -cnt, seen[one]))
    assert sorted(tuple(r) for r in best.where("dep1 < 'd11'").collect()) == sorted(expected)
