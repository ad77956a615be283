"""The queries of the engine, each over all rows of the tables in a folder, and their SQL."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from depweave.functions import full_name  # noqa: E402
from depweave.operators import cooccur, extract, flowers, graph, lookup, resolve  # noqa: E402
from depweave.plans import batch  # noqa: E402
from depweave.plans.stages import LatestStages  # noqa: E402
from depweave.sinks import Results, replace_languages  # noqa: E402
from depweave.sources import (  # noqa: E402
    corpus,
    read_contents,
    read_files,
    read_repos,
    read_stopwords,
    split_repos,
    write_inputs,
    write_repo_lines,
    write_sources,
)
from oracle_queries import ORACLE_SQL  # noqa: E402

# The operators for training text and their pipeline can be taken away as a whole.
try:
    import corpus_pipeline
    from depweave.llm import queries as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "depweave.llm"):
        raise
    corpus_pipeline = llm = None

K, N, B = 5, 5, 20


_LATEST = LatestStages()


class _Inputs:
    """The corpus of a folder and the steps that several queries share. What the same query's last
    call has written is removed."""

    def __init__(self, spark: SparkSession, sf_dir: str, query: str = "shared"):
        self.spark = spark
        self.tables = corpus(spark, sf_dir)
        self.stages = _LATEST.of(spark, query)
        self.stage = self.stages.write

    @property
    def files(self) -> DataFrame:
        return self.tables.files

    def imports(self) -> DataFrame:
        return extract.python_imports(self.tables.py_contents)

    def dimension(self) -> DataFrame:
        return resolve.repo_dimension(self.tables.repos, self.tables.stopwords)

    def resolved(self) -> DataFrame:
        return batch.python_resolved(
            self.tables.py_contents,
            self.files,
            self.dimension(),
            self.stage,
            stopwords=self.tables.stopwords,
        )

    def py_edges(self) -> DataFrame:
        return resolve.edges_of(self.resolved())

    def py_graph(self) -> batch.Graph:
        return batch.graph_of(self.stage("edges", self.py_edges()), self.stage, N)

    def known(self) -> DataFrame:
        return self.stage("known", resolve.known_deps_of(self.resolved()))

    def published(self, name: str, table: DataFrame) -> DataFrame:
        """The result table `name`, written, published and read by another reader."""
        folder = f"{self.stages.path}/results"
        results = Results(self.spark, folder, "python")
        results.write(name, table)
        results.publish()
        return Results(self.spark, folder, "python").read(name)

    def go_deps(self) -> DataFrame:
        return extract.go_deps(self.tables.go_contents)

    def go_edges(self) -> DataFrame:
        return graph.go_edges(self.files, self.go_deps())

    def go_graph(self) -> batch.Graph:
        return batch.graph_of(self.stage("edges", self.go_edges()), self.stage, N)


def _top_flowers(g: batch.Graph) -> DataFrame:
    """Only the flowers of the top repositories are made."""
    top = graph.top_repos(g.degrees, K)
    return flowers.top_flowers(top, flowers.flowers(g.petals, g.degrees, roots=top))


def py_import_lines(x: _Inputs) -> DataFrame:
    return extract.python_deps(x.tables.py_contents)


def py_path_names(x: _Inputs) -> DataFrame:
    return extract.path_names(graph.join_files(x.files, x.imports()))


def py_repo_deps(x: _Inputs) -> DataFrame:
    return graph.repo_deps(x.files, x.imports())


def py_external_deps(x: _Inputs) -> DataFrame:
    return graph.external_deps(x.files, x.imports())


def py_external_deps_by_file_name(x: _Inputs) -> DataFrame:
    return graph.external_deps(x.files, x.imports(), suffix_len=3)


def repo_dimension(x: _Inputs) -> DataFrame:
    return x.dimension()


def best_repo_per_name(x: _Inputs) -> DataFrame:
    return resolve.best_repo(x.dimension())


def py_edges(x: _Inputs) -> DataFrame:
    return x.py_edges()


def _adjacency(x: _Inputs, edges: DataFrame) -> DataFrame:
    edges = x.stage("edges", edges)
    degrees = x.stage("degrees", graph.degree(edges))
    parts = graph.adjacency(edges, degrees, part_size=50)
    return parts.select("dst", "part", F.array_join("srcs", ",").alias("srcs"), "degree")


def py_adjacency(x: _Inputs) -> DataFrame:
    return _adjacency(x, x.py_edges())


def go_adjacency(x: _Inputs) -> DataFrame:
    return _adjacency(x, x.go_edges())


def py_top_repos(x: _Inputs) -> DataFrame:
    return graph.top_repos(graph.degree(x.py_edges()), K)


def py_top_neighbors(x: _Inputs) -> DataFrame:
    edges = x.stage("edges", x.py_edges())
    return graph.top_neighbors(edges, x.stage("degrees", graph.degree(edges)), N)


def py_flower_nodes(x: _Inputs) -> DataFrame:
    g = x.py_graph()
    return flowers.flower_nodes(flowers.flowers(g.petals, g.degrees))


def py_flower_links(x: _Inputs) -> DataFrame:
    g = x.py_graph()
    return flowers.flower_links(flowers.flowers(g.petals, g.degrees))


def py_top_flowers(x: _Inputs) -> DataFrame:
    return _top_flowers(x.py_graph()).select("rank", F.inline("links"))


def py_merged_nodes(x: _Inputs) -> DataFrame:
    return flowers.merged_nodes(_top_flowers(x.py_graph()))


def py_merged_links(x: _Inputs) -> DataFrame:
    return flowers.merged_links(_top_flowers(x.py_graph()))


def py_known_deps(x: _Inputs) -> DataFrame:
    best = x.stage("best_repo", resolve.best_repo(x.dimension()))
    return resolve.known_deps(graph.external_deps(x.files, x.imports()), best)


def py_known_ascii_deps(x: _Inputs) -> DataFrame:
    return resolve.known_deps_of(x.resolved(), ascii_only=True)


def py_pair_counts(x: _Inputs) -> DataFrame:
    return cooccur.pair_counts(x.known(), stage=x.stage)


def py_pair_maps(x: _Inputs) -> DataFrame:
    """The maps of partners in small parts, with a row for each entry."""
    pairs = cooccur.pair_counts(x.known(), stage=x.stage, both=True, nested=True)
    maps = cooccur.partner_maps(pairs, part_size=50)
    return maps.select("dep1", "part", F.explode("partners").alias("dep2", "cnt"))


def py_top_partners(x: _Inputs) -> DataFrame:
    return cooccur.top_partners(x.known(), B, stage=x.stage)


def py_top_partners_split(x: _Inputs) -> DataFrame:
    """As `py_top_partners`, with repositories cut into small blocks."""
    return cooccur.top_partners(x.known(), B, block=16, stage=x.stage)


def py_top_pairs(x: _Inputs) -> DataFrame:
    return cooccur.top_pairs(x.known(), B, stage=x.stage)


def go_imports(x: _Inputs) -> DataFrame:
    return x.go_deps().select("id", F.explode("deps").alias("dst"))


def go_outer_join(x: _Inputs) -> DataFrame:
    # Written once: the join and what is left over read the names, not the texts again.
    joined = graph.go_file_deps(x.files, x.stage("go_deps", x.go_deps()))
    return joined.select("id", "repo", F.array_size("deps").cast("long").alias("n_deps"))


def go_edges(x: _Inputs) -> DataFrame:
    return x.go_edges()


def go_edges_with_orphans(x: _Inputs) -> DataFrame:
    return graph.go_edges(x.files, x.stage("go_deps", x.go_deps()), keep_orphans=True)


def go_top_repos(x: _Inputs) -> DataFrame:
    return graph.top_repos(graph.degree(x.go_edges()), K)


def go_flower_links(x: _Inputs) -> DataFrame:
    g = x.go_graph()
    return flowers.flower_links(flowers.flowers(g.petals, g.degrees))


def go_top_flowers(x: _Inputs) -> DataFrame:
    return _top_flowers(x.go_graph()).select("rank", F.inline("links"))


def flower_lookup(x: _Inputs) -> DataFrame:
    """The flowers of the suppliers' repositories that have one."""
    g = x.py_graph()
    table = x.published("flowers", flowers.flowers(g.petals, g.degrees))
    roots = x.tables.rivals.select(full_name().alias("root"))
    return flowers.flower_links(lookup.flower_of(table, roots))


def cooccur_lookup(x: _Inputs) -> DataFrame:
    """The partners of the names of the suppliers' repositories."""
    table = x.published("cooccurs", cooccur.top_partners(x.known(), B, stage=x.stage))
    found = lookup.cooccurs_of(table, x.tables.rivals.select("repo_name"))
    return found.select("dep1", "dep2", "cnt")


def flower_documents(x: _Inputs) -> DataFrame:
    """The links and nodes that the documents of all flowers hold when they are read back."""
    g = x.py_graph()
    documents = flowers.flower_documents(flowers.flowers(g.petals, g.degrees))
    layout = (
        "nodes array<struct<id string, `group` bigint>>,"
        " links array<struct<source string, target string>>"
    )
    read = x.stage("documents", documents).select("root", F.from_json("document", layout).alias("d"))
    # One list of both kinds, so that a document is read and parsed once.
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("long")

    def record(source=no_text, target=no_text, id=no_text, group=no_number) -> Column:
        return F.struct(
            source.alias("source"), target.alias("target"), id.alias("id"), group.alias("group")
        )

    links = F.transform("d.links", lambda x: record(x["source"], x["target"]))
    nodes = F.transform("d.nodes", lambda x: record(id=x["id"], group=x["group"]))
    return read.select("root", F.inline(F.concat(links, nodes)))


def partner_documents(x: _Inputs) -> DataFrame:
    return cooccur.partner_documents(cooccur.top_partners(x.known(), B, stage=x.stage))


def _rows_of(results: Results) -> DataFrame:
    """(name, a, b, n, rank): the result tables of a job, read back from their files."""
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("long")

    def rows(name: str, a="", b="", n="", rank="", table: DataFrame | None = None) -> DataFrame:
        table = results.read(name) if table is None else table
        texts = [F.col(c).alias(to) if c else no_text.alias(to) for c, to in ((a, "a"), (b, "b"))]
        numbers = [
            F.col(c).cast("long").alias(to) if c else no_number.alias(to)
            for c, to in ((n, "n"), (rank, "rank"))
        ]
        return table.select(F.lit(name).alias("name"), *texts, *numbers)

    links = flowers.flower_links(results.read("flowers"))
    links = links.withColumn("link", F.concat("source", F.lit(" "), "target"))
    top = results.read("top_flowers").select("rank", F.inline("links"))
    tables = [
        rows("neighbors", "dst", "src"),
        rows("top_repos", "dst", n="degree", rank="rank"),
        rows("flowers", "root", "link", table=links),
        rows("top_flowers", "source", "target", rank="rank", table=top),
        rows("counts", "name", n="n"),
    ]
    if results.lang == "python":
        tables += [
            rows("repos", "user", "repo_name", "stars", "notfork"),
            rows("cooccurs", "dep1", "dep2", "cnt", "rank"),
            rows("top_cooccurs", "dep1", "dep2", "cnt", "rank"),
        ]
    else:
        tables.append(rows("repos", "user", "repo_name"))
    return reduce(DataFrame.unionByName, tables)


def python_job(x: _Inputs) -> DataFrame:
    """The whole job from files to result tables: readers, repository table, batch."""
    folder = f"{x.stages.path}/job"
    write_inputs(x.tables, folder, "python")
    results = Results(x.spark, f"{folder}/out", "python")
    stop = read_stopwords(x.spark, f"{folder}/stopwords")
    repos = read_repos(x.spark, f"{folder}/repos", "python")
    results.write("repos", resolve.repo_dimension(repos, stop))
    contents = read_contents(x.spark, f"{folder}/contents", lang="python")
    files = read_files(x.spark, f"{folder}/files", lang="python")
    batch.python_batch(
        contents,
        files,
        results.read("repos"),
        x.stage,
        results.write,
        K,
        N,
        B,
        stopwords=stop,
        rows=results.rows,
    )
    results.publish()
    return _rows_of(Results(x.spark, f"{folder}/out", "python"))


def go_job(x: _Inputs) -> DataFrame:
    """As `python_job`, and run twice: the second run's tables replace the first's."""
    folder = f"{x.stages.path}/job"
    write_inputs(x.tables, folder, "go")
    results = Results(x.spark, f"{folder}/out", "go")
    contents = read_contents(x.spark, f"{folder}/contents", lang="go")
    files = read_files(x.spark, f"{folder}/files", lang="go")
    for _ in range(2):
        results.write("repos", resolve.go_repo_dimension(read_repos(x.spark, f"{folder}/repos", "go")))
        batch.go_batch(contents, files, x.stage, results.write, K, N, rows=results.rows)
        results.publish()
        results.prune()
    return _rows_of(Results(x.spark, f"{folder}/out", "go"))


def language_edges(x: _Inputs) -> DataFrame:
    """One job for the languages of a table, run for both and then for Go alone, whose edges it replaces."""
    folder = f"{x.stages.path}/languages"
    for lang in ("python", "go"):
        write_sources(x.tables, folder, lang)
    # A table of its own: which folders are read is known only when it has been read.
    listed = x.stage("listed", x.spark.sql("SELECT * FROM VALUES ('python', 1), ('go', 2) AS t (lang, run)"))
    dim = x.stage("dim", x.dimension())
    for run in (1, 2):
        langs = listed.where(F.col("run") >= run)
        contents, files = (
            read(x.spark, f"{folder}/{name}", lang=langs)
            for read, name in ((read_contents, "contents"), (read_files, "files"))
        )
        edges = batch.edges_by_language(contents, files, dim, x.stage)
        replace_languages(edges, f"{folder}/edges", "dst", "src")
    return x.spark.read.schema("dst string, src string, lang string").parquet(f"{folder}/edges")


def result_counts(x: _Inputs) -> DataFrame:
    """The numbers of rows that are observed while the tables are written."""
    resolved = x.stage("resolved", x.resolved())
    known = resolve.known_deps_of(resolved)
    degrees = graph.degree(resolve.edges_of(resolved))
    results = Results(x.spark, f"{x.stages.path}/results", "python")
    results.write("top_repos", graph.top_repos(degrees, K))
    results.write("top_cooccurs", cooccur.top_pairs(known, B, stage=x.stage))
    results.write("repos", x.dimension())
    rows = results.rows
    return batch.known_counts(
        x.spark, K=rows("top_repos"), B=rows("top_cooccurs"), repos=rows("repos")
    )


def _split_repos(x: _Inputs) -> tuple[DataFrame, DataFrame]:
    folder = f"{x.stages.path}/repo_lines"
    write_repo_lines(x.tables, folder)
    return split_repos(x.spark, folder, "python", x.stage)


def repos_accepted(x: _Inputs) -> DataFrame:
    return _split_repos(x)[0]


def repos_rejected(x: _Inputs) -> DataFrame:
    return _split_repos(x)[1].select("record", "reason")


def graph_json(x: _Inputs) -> DataFrame:
    return batch.site_documents(x.stage("top_flowers", _top_flowers(x.py_graph())))["top_K"]


def pairs_json(x: _Inputs) -> DataFrame:
    return cooccur.pairs_document(cooccur.top_pairs(x.known(), B, stage=x.stage))


_QUERIES = (
    py_import_lines,
    py_path_names,
    py_repo_deps,
    py_external_deps,
    py_external_deps_by_file_name,
    repo_dimension,
    best_repo_per_name,
    py_edges,
    py_adjacency,
    py_top_repos,
    py_top_neighbors,
    py_flower_nodes,
    py_flower_links,
    py_top_flowers,
    py_merged_nodes,
    py_merged_links,
    py_known_deps,
    py_known_ascii_deps,
    py_pair_counts,
    py_pair_maps,
    py_top_partners,
    py_top_partners_split,
    py_top_pairs,
    go_imports,
    go_outer_join,
    go_edges,
    go_adjacency,
    go_edges_with_orphans,
    go_top_repos,
    go_flower_links,
    go_top_flowers,
    flower_lookup,
    cooccur_lookup,
    flower_documents,
    partner_documents,
    python_job,
    go_job,
    language_edges,
    result_counts,
    repos_accepted,
    repos_rejected,
    graph_json,
    pairs_json,
)


def entry(spark: SparkSession) -> DataFrame:
    """The five repositories most others depend on."""
    return queries()["py_top_repos"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Callable[[_Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(_Inputs(spark, sf_dir, query.__name__))

    found = {query.__name__: bound(query) for query in _QUERIES}
    if llm:
        found |= {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    return {**ORACLE_SQL, **(llm.ORACLE_SQL if llm else {})}
