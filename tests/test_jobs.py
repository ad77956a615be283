"""Readers, result tables and the command line, end to end on files."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import _Inputs
from depweave import cli
from depweave.operators import flowers, graph, resolve
from depweave.plans.stages import Stages
from depweave.schemas import CONTENTS, FILES
from depweave.sinks import Results, by_language, replace_languages
from depweave.sources import (
    read_contents,
    read_files,
    read_repos,
    read_stopwords,
    register_views,
    split_repos,
    stopwords_from_names,
)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The corpus as files: contents and files by language, repositories as CSV."""
    root = tmp_path_factory.mktemp("input")
    x = _Inputs(spark, SMALL).tables
    for lang, contents in (("python", x.py_contents), ("go", x.go_contents)):
        whole = contents.select(
            F.col("id").cast("string").alias("id"),
            F.length("content").cast("long").alias("size"),
            "content",
            F.lit(False).alias("binary"),
            F.lit(1).cast("long").alias("copies"),
        )
        whole.write.parquet(f"{root}/contents/lang={lang}")
    placed = x.files.select(
        "repo_name",
        F.lit("refs/heads/main").alias("ref"),
        "path",
        F.lit("33188").alias("mode"),
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("symlink_target"),
    )
    placed.write.parquet(f"{root}/files/lang=python")
    placed.write.parquet(f"{root}/files/lang=go")
    columns = ["user", "repo_name", "num_bytes", "stars", "fork"]
    rows = [tuple(row) for row in x.repos.select(columns).collect()]
    for lang, width in (("python", 5), ("go", 3)):
        with (root / f"{lang}_repos.csv").open("w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(["any", "names", "here", "x", "y"][:width])
            writer.writerows(row[:width] for row in rows)
    (root / "stop.txt").write_text(",".join(row["name"] for row in x.stopwords.collect()))
    return root


def test_readers(spark, folder):
    contents = read_contents(spark, f"{folder}/contents/lang=python")
    assert contents.schema == CONTENTS
    assert read_contents(spark, f"{folder}/contents", lang="Go").schema == CONTENTS
    assert read_files(spark, f"{folder}/files/lang=*").schema == FILES
    one = read_files(spark, f"{folder}/files", lang="go")
    assert one.count() * 2 == read_files(spark, f"{folder}/files/lang=*").count()
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lang" in text
    repos = read_repos(spark, f"{folder}/python_repos.csv", "python")
    assert repos.columns == ["user", "repo_name", "num_bytes", "stars", "fork"]
    assert repos.count() == _Inputs(spark, SMALL).tables.repos.count()
    assert read_repos(spark, f"{folder}/go_repos.csv", "go").columns == repos.columns[:3]
    for call in (
        lambda: read_repos(spark, "x", "rust"),
        lambda: read_files(spark, "x", lang="rust"),
        lambda: cli.check_language("rust"),
    ):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("row", ["b,y,1,2", "c,z,1", "d,w,1,2,0,9"])
def test_csv_rows_of_other_lengths_fail_where_columns_are_pruned(spark, tmp_path, row):
    (tmp_path / "r.csv").write_text(f"user,repo_name,n,stars,fork\na,x,1,2,0\n{row}\n")
    repos = read_repos(spark, str(tmp_path / "r.csv"), "python")
    with pytest.raises(Exception, match="(?i)malformed"):
        resolve.best_repo(resolve.repo_dimension(repos)).collect()


def test_blank_padded_and_empty_csv_fields(spark, tmp_path):
    (tmp_path / "r.csv").write_text('user,repo_name,n,stars,fork\n,y,1, 3,0\n')
    repos = read_repos(spark, str(tmp_path / "r.csv"), "python")
    assert [r.stars for r in repos.collect()] == [3]
    best = resolve.best_repo(resolve.repo_dimension(repos)).collect()
    assert [r.dst for r in best] == ["/y"]


def test_bad_csv_row_fails(spark, tmp_path):
    (tmp_path / "r.csv").write_text('user,repo_name,n,stars,fork\na,"x, ""y""",1,2,0\nb,z,1,many,0\n')
    with pytest.raises(Exception, match="(?i)malformed|cannot be parsed|NumberFormat"):
        read_repos(spark, str(tmp_path / "r.csv"), "python").collect()
    kept = read_repos(spark, str(tmp_path / "r.csv"), "python", mode="DROPMALFORMED").collect()
    assert [row["repo_name"] for row in kept] == ['x, "y"']


def test_bad_csv_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'user,repo_name,n,stars,fork\na,"x, ""y""",1,2,0\nb,z,1,many,0\nc,"u,v",1,2\nd,w,,,\ne,w,1,2,0,9\n'
    )
    (tmp_path / "empty.csv").write_text("user,repo_name,n,stars,fork\n")
    stages = Stages(spark, str(tmp_path / "shared"))
    repos, rejected = split_repos(spark, str(tmp_path / "*.csv"), "python", stages.write)
    assert sorted(tuple(r) for r in repos.collect()) == [("a", 'x, "y"', 1, 2, 0), ("d", "w", None, None, None)]
    assert repos.schema == read_repos(spark, str(tmp_path / "r.csv"), "python").schema
    rows = {r["record"]: (Path(r["file"]).name, r["reason"]) for r in rejected.collect()}
    assert rows == {
        "b,z,1,many,0": ("r.csv", "value"),
        'c,"u,v",1,2': ("r.csv", "fields"),
        "e,w,1,2,0,9": ("r.csv", "fields"),
    }
    # Both come from one scan of the files.
    for table in (repos, rejected):
        assert "FileScan csv" not in table._jdf.queryExecution().executedPlan().toString()
    go, none = split_repos(spark, str(tmp_path / "empty.csv"), "go", stages.write)
    assert go.count() == none.count() == 0


def test_index_keeps_bad_rows(spark, tmp_path, capsys, monkeypatch):
    (tmp_path / "r.csv").write_text("user,repo_name,n\na,x,1\nb,y,much\nc,z\n")
    out = str(tmp_path / "out")
    run("index", "--lang", "go", "--out", out, "--repos", str(tmp_path / "r.csv"), "--reject")
    assert capsys.readouterr().out == "rejected: 2\nrepositories: 1\n"
    results = Results(spark, out, "go")
    assert sorted(r["reason"] for r in results.read("rejected").collect()) == ["fields", "value"]
    assert results.rows("repos") == 1


def test_stopwords(spark, tmp_path):
    (tmp_path / "s.txt").write_text("os,sys\nre\n\nos\n")
    assert {row["name"] for row in read_stopwords(spark, str(tmp_path / "s.txt")).collect()} == {
        "os",
        "sys",
        "re",
    }
    assert stopwords_from_names(spark, ["b", "a", "b"]).count() == 2


def test_views(spark):
    register_views({"nums": spark.range(3)})
    assert spark.sql("SELECT sum(id) s FROM nums").collect()[0]["s"] == 3


def run(*words):
    cli.main(list(words))


def test_whole_job(spark, folder, tmp_path, capsys, monkeypatch):
    # The command line ends with the session of the tests.
    out, site = str(tmp_path / "out"), str(tmp_path / "site")
    for lang in ("python", "go"):
        base = ["--lang", lang, "--out", out]
        run("index", *base, "--repos", f"{folder}/{lang}_repos.csv", "--stopwords", f"{folder}/stop.txt")
        inputs = ["--contents", f"{folder}/contents/lang={lang}", "--files", f"{folder}/files/lang={lang}"]
        run("batch", *base, *inputs)
        # A second run, over folders by language, replaces the first.
        run("batch", *base, "--contents", f"{folder}/contents", "--files", f"{folder}/files", "--by-lang")
        run("refresh", *base, "--site", site)
    assert "repositories:" in capsys.readouterr().out

    x = _Inputs(spark, SMALL)
    results = Results(spark, out, "python")
    edges = x.stage("edges", x.py_edges())
    written = results.read("neighbors")
    assert sorted(written.collect()) == sorted(edges.collect())
    degrees = graph.degree(edges)
    assert results.read("flowers").count() == degrees.count()
    top = graph.top_repos(degrees)
    found = results.read("top_flowers").orderBy("rank").collect()
    assert [(row["rank"], row["root"]) for row in found] == [
        (row["rank"], row["dst"]) for row in top.orderBy("rank").collect()
    ]
    counts = {row["name"]: row["n"] for row in results.read("counts").collect()}
    assert counts == {"K": 5, "B": 20}
    assert {row["name"] for row in Results(spark, out, "go").read("counts").collect()} == {"K"}
    assert results.read("top_cooccurs").count() == 20
    assert by_language(spark, out, "neighbors").columns == ["dst", "src", "lang"]

    def document(name):
        return json.loads(Path(site, f"{name}.json").read_text())

    graphs = document("python_top_K")
    merged = flowers.merged_nodes(results.read("top_flowers"))
    assert len(graphs["nodes"]) == merged.count()
    assert len(document("python_top_B")["cooccurs"]) == 20
    assert document("go_top_K")["links"] and not Path(site, "go_top_B.json").exists()

    capsys.readouterr()
    run("flower", "--lang", "python", "--out", out, found[0]["root"])
    shown = json.loads(capsys.readouterr().out)
    assert shown["nodes"][0] == {"id": found[0]["root"], "group": top.orderBy("rank").first()["degree"]}
    dep = results.read("top_cooccurs").orderBy("rank").first()
    run("cooccurs", "--lang", "python", "--out", out, dep["dep1"])
    assert [dep["dep2"], dep["cnt"]] in json.loads(capsys.readouterr().out)["cooccurs"]
    run("flower", "--lang", "python", "--out", out, "no/one")
    assert capsys.readouterr().out == "not found\n"
    run("cooccurs", "--lang", "go", "--out", out, dep["dep1"])
    assert capsys.readouterr().out == "not found\n"


def test_batch_options(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    base = ["--lang", "go", "--out", out]
    inputs = ["--contents", f"{folder}/contents/lang=go", "--files", f"{folder}/files/lang=go"]
    run("batch", *base, *inputs, "--keep-orphans", "--drop-self")
    edges = Results(spark, out, "go").read("neighbors")
    assert edges.where("src IS NULL").count() > 0
    assert edges.where("src = dst").count() == 0


def test_a_table_of_languages_prunes_folders(spark, folder, tmp_path):
    spark.createDataFrame([("go", 1), ("python", 0)], "lang string, run int").write.parquet(f"{tmp_path}/langs")
    langs = spark.read.parquet(f"{tmp_path}/langs").where("run = 1")
    contents = read_contents(spark, f"{folder}/contents", lang=langs)
    assert contents.columns == [*CONTENTS.names, "lang"]
    plan = contents._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    rows = contents.groupBy("lang").count().collect()
    one = read_contents(spark, f"{folder}/contents", lang="go")
    assert [tuple(r) for r in rows] == [("go", one.count())]


def test_files_of_other_languages_are_untouched(spark, tmp_path):
    path = tmp_path / "edges"

    def files(lang):
        return sorted((f.name, f.read_bytes()) for f in (path / f"lang={lang}").glob("*.parquet"))

    both = spark.createDataFrame([("go", "a", "b"), ("python", "c", "d")], "lang string, dst string, src string")
    replace_languages(both, str(path), "dst", "src")
    before = files("python")
    replace_languages(both.where("lang = 'go'").withColumn("src", F.lit("e")), str(path), "dst", "src")
    assert files("python") == before
    rows = spark.read.parquet(str(path)).select("lang", "dst", "src").collect()
    assert sorted(map(tuple, rows)) == [("go", "a", "e"), ("python", "c", "d")]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats_hold_the_same_rows(spark, folder, tmp_path, fmt):
    contents = read_contents(spark, f"{folder}/contents", lang="go")
    path = f"{tmp_path}/contents"
    contents.withColumn("lang", F.lit("go")).write.format(fmt).partitionBy("lang").save(path)
    read = read_contents(spark, path, fmt=fmt, lang="go")
    assert read.schema == CONTENTS
    assert read.exceptAll(contents).isEmpty() and contents.exceptAll(read).isEmpty()
