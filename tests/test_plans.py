"""Shapes of plans: what is pushed down, what is kept out of Python, what happens to hot keys."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import _Inputs, queries
from depweave.operators import cooccur, extract, flowers, graph, resolve
from depweave.plans.stages import LatestStages, Stages, shared_folder

SMALL = "/root/testdata/sf0.001"


def plan(table):
    return table._jdf.queryExecution().explainString(
        table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def skewed_session(spark):
    """Joins are sort merge joins, and a small partition already counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.shuffle.partitions": "8",
        # Several scan tasks: a partition is split by the tasks that wrote it.
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.files.openCostInBytes": "32KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(table):
    """The plan after the run, with what adaptive execution made of it."""
    table._jdf.collectToPython()
    return table._jdf.queryExecution().executedPlan().toString()


def splits_hot_key(table):
    return "skew=true" in final_plan(table)


def many(spark, rows, expressions, parts=8):
    return spark.range(0, rows, 1, parts).selectExpr(*expressions)


def test_hot_content(skewed_session):
    files = many(
        skewed_session,
        40_000,
        ["if(id % 3 = 0, 7, id) id", "concat('u/', id) repo_name", "concat('src/', id, '.py') path"],
    )
    contents = many(skewed_session, 40_000, ["id", "concat('import m', id % 50) content"])
    stage = Stages(skewed_session).write
    joined = graph.external_deps(stage("f", files), extract.python_imports(stage("c", contents)))
    assert splits_hot_key(joined)


def test_hot_content_in_outer_join(skewed_session):
    files = many(
        skewed_session, 40_000, ["if(id % 3 = 0, 7, id) id", "concat('u/', id) repo_name"]
    )
    deps = many(skewed_session, 40_010, ["id", "array('u/a', concat('u/', id)) deps"])
    stage = Stages(skewed_session).write
    joined = graph.go_file_deps(stage("f", files), stage("d", deps))
    assert splits_hot_key(joined)
    # Contents 0, 3, 6, … have given their files to content 7.
    assert joined.where("repo IS NULL").count() == 13_334 + 10
    assert joined.count() == 40_000 + 13_334 + 10


def test_hot_name(skewed_session):
    stage = Stages(skewed_session).write
    deps = many(
        skewed_session, 40_000, ["concat('u/', id) repo", "if(id % 3 = 0, 'numpy', concat('m', id)) dep"]
    )
    best = many(skewed_session, 40_000, ["concat('m', id) dep", "concat('v/m', id) dst"])
    best = best.union(skewed_session.sql("SELECT 'numpy', 'v/numpy'"))
    resolved = resolve.resolve(stage("deps", deps), stage("best", best))
    assert splits_hot_key(resolved)
    assert resolved.count() == 40_000


def test_hot_dependent(skewed_session):
    """One repository depends on a third of all: it is hot in the look-up of degrees and in the
    second hop."""
    stage = Stages(skewed_session).write
    edges = stage(
        "edges",
        many(
            skewed_session,
            60_000,
            ["concat('d', id div 2) dst", "if(id % 3 = 0, 'all', concat('d', id * 7 % 30000)) src"],
        )
        .distinct()
        .repartition(8),
    )
    degrees = stage("degrees", graph.degree(edges))
    neighbors = graph.top_neighbors(edges, degrees, 2)
    assert splits_hot_key(neighbors)
    petals = stage("petals", flowers.petals(neighbors).repartition(8))
    assert splits_hot_key(flowers.flowers(petals, degrees))


def test_hot_repository(skewed_session):
    """The pairs of one large repository are made in several tasks."""
    stage = Stages(skewed_session).write
    known = stage(
        "known",
        many(skewed_session, 3_000, ["if(id % 3 = 0, 'hot', concat('r', id % 400)) repo", "concat('m', id) dep"]),
    )
    large = stage("large", cooccur._large(known, 50))
    pairs = cooccur._pairs(known.select("repo", "dep"), large, 50)
    made = pairs.withColumn("task", F.spark_partition_id())
    assert pairs.count() > 1000 * 999 // 2
    assert made.groupBy("task").count().where("count > 20000").count() == 8


def test_no_python_in_any_plan(spark):
    # The operators for training text may use Python.
    names = [name for name in queries() if not re.match(r"op\d+_|pipeline$", name)]
    for name in names:
        text = plan(queries()[name](spark, SMALL))
        for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "ExistingRDD"):
            assert word not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_top_k_plans(spark):
    x = _Inputs(spark, SMALL)
    edges = x.stage("edges", x.py_edges())
    degrees = graph.degree(edges)
    assert "TakeOrderedAndProject" in plan(graph.top_repos(degrees))
    assert "WindowGroupLimit" in plan(graph.top_neighbors(edges, degrees))
    assert "WindowGroupLimit" in plan(cooccur.top_partners(x.known()))
    assert "WindowGroupLimit" in plan(resolve.best_repo(x.dimension()))
    assert "TakeOrderedAndProject" in plan(cooccur.top_pairs(x.known()))


def test_scans_read_what_is_needed(spark, tmp_path):
    contents = spark.createDataFrame(
        [("1", 1, "import os", False, 1)],
        "id string, size long, content string, binary boolean, copies long",
    )
    contents.write.parquet(str(tmp_path / "c"))
    text = plan(extract.python_deps(spark.read.parquet(str(tmp_path / "c"))))
    assert "ReadSchema: struct<id:string,content:string>" in text
    # The pattern runs once per file: a filter has not copied it.
    assert text.count("regexp_extract_all") == 1
    text = plan(extract.go_deps(spark.read.parquet(str(tmp_path / "c"))))
    assert "ReadSchema: struct<id:string,content:string>" in text
    assert text.count("regexp_extract_all") == 1


def test_results_do_not_depend_on_order_or_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    x = _Inputs(spark, SMALL)
    edges = x.stage("edges", x.py_edges())
    petals = lambda table: flowers.petals(graph.top_neighbors(table, graph.degree(table), 3))
    expected = sorted(petals(edges).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sorted(petals(edges.orderBy(F.rand(1)).repartition(5)).collect()) == expected
    spark.conf.set("spark.sql.shuffle.partitions", before)


class _Session:
    """The part of a session that `shared_folder` asks for."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_shared_folder():
    settings = {"spark_sql_warehouse_dir": "hdfs://n/w/", "spark_master": "yarn"}
    named = _Session(spark_checkpoint_dir="hdfs://n/c", **settings)
    assert shared_folder(named) == "hdfs://n/c"
    assert shared_folder(_Session(**settings)) == "hdfs://n/w/stages"


def test_a_call_removes_what_the_last_one_of_its_query_wrote(spark):
    latest = LatestStages()
    first = latest.of(spark, "q")
    table = first.write("x", spark.range(3))
    other = latest.of(spark, "other").write("x", spark.range(4))
    assert table.count() == 3
    latest.of(spark, "q")
    assert not Path(first.path).exists()
    assert other.count() == 4


def test_stages_write_to_the_folder_of_the_session(spark):
    stages = Stages(spark)
    table = stages.write("x", spark.range(3))
    assert table.count() == 3
    assert all(shared_folder(spark) in file for file in table.inputFiles())
    assert stages.write("x", spark.range(4)).count() == 4
    other = Stages(spark).write("x", spark.range(5))
    stages.remove()
    assert not Path(stages.path).exists()
    assert other.count() == 5
