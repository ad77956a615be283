"""The batch job of each language, from tables of files to result tables.

`stage(name, table)` writes an intermediate table that is used several times and gives it back, see
`Stages`. `result(name, table)` does the same for a result, see `Results`; left out, results stay
lazy. Files are read once: all results follow from the staged dependencies. `rows(name)` tells how
many rows of a result were written, as `Results.rows` does; left out, results are counted by a scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cooccur, extract, flowers, graph, resolve
from ..operators.known_names import NameFilter

Write = Callable[[str, DataFrame], DataFrame]
Rows = Callable[[str], int]


def _lazy(name: str, table: DataFrame) -> DataFrame:
    return table


@dataclass
class Graph:
    """Edges with the two tables that everything about neighbourhoods is computed from."""

    edges: DataFrame
    degrees: DataFrame
    petals: DataFrame


def graph_of(edges: DataFrame, stage: Write, n: int = 5) -> Graph:
    """`edges` should be a written table: it is read several times."""
    degrees = stage("degrees", graph.degree(edges))
    neighbors = graph.top_neighbors(edges, degrees, n)
    return Graph(edges, degrees, stage("petals", flowers.petals(neighbors)))


def python_resolved(
    contents: DataFrame,
    files: DataFrame,
    dim: DataFrame,
    stage: Write,
    suffix_len: int = 2,
    strip_cr: bool = False,
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """(repo, dep, dst): outside dependencies that name a repository of `dim`.

    `stopwords` are names that `dim` is known to have none of; given here too, they are dropped
    early. The result is the same without them. The table of best repositories is staged so that its size
    is known before the join, and a filter of its names keeps names that nothing is called out of the
    shuffle by repository.
    """
    best = stage("best_repo", resolve.best_repo(dim))
    imports = extract.python_imports(contents, strip_cr)
    known = NameFilter(best.select("dep"), stage)
    deps = graph.external_deps(files, imports, suffix_len, unresolvable=stopwords, known=known)
    return resolve.resolve(deps, best)


def counts_of(**tables: DataFrame) -> DataFrame:
    """(name, n): the number of rows of each table."""
    rows = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def known_counts(spark: SparkSession, **counts: int) -> DataFrame:
    """(name, n), of numbers that are known."""
    rows = [F.struct(F.lit(name).alias("name"), F.lit(n).cast("long").alias("n")) for name, n in counts.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _counts(results: dict[str, DataFrame], rows: Rows | None, **names: str) -> DataFrame:
    """As `counts_of` of some results, each given by its name."""
    if rows is None:
        return counts_of(**{to: results[name] for to, name in names.items()})
    spark = next(iter(results.values())).sparkSession
    return known_counts(spark, **{to: rows(name) for to, name in names.items()})


def _graph_results(g: Graph, k: int, result: Write) -> dict[str, DataFrame]:
    top = result("top_repos", graph.top_repos(g.degrees, k))
    all_flowers = result("flowers", flowers.flowers(g.petals, g.degrees))
    top_flowers = result("top_flowers", flowers.top_flowers(top, all_flowers))
    return {
        "neighbors": g.edges,
        "top_repos": top,
        "flowers": all_flowers,
        "top_flowers": top_flowers,
    }


def python_batch(
    contents: DataFrame,
    files: DataFrame,
    dim: DataFrame,
    stage: Write,
    result: Write = _lazy,
    k: int = 5,
    n: int = 5,
    b: int = 20,
    suffix_len: int = 2,
    strip_cr: bool = False,
    ascii_only: bool = False,
    stopwords: DataFrame | None = None,
    rows: Rows | None = None,
) -> dict[str, DataFrame]:
    """Neighbours, top repositories, flowers, co-occurrences and the counts of top rows.

    `dim` is the result of `repo_dimension`; `stopwords`, those it was made with, may be given to
    drop them early.
    """
    resolved = stage(
        "resolved",
        python_resolved(contents, files, dim, stage, suffix_len, strip_cr, stopwords),
    )
    edges = result("neighbors", resolve.edges_of(resolved))
    results = _graph_results(graph_of(edges, stage, n), k, result)
    known = resolve.known_deps_of(resolved, ascii_only)
    results["cooccurs"] = result("cooccurs", cooccur.top_partners(known, b, stage=stage))
    results["top_cooccurs"] = result("top_cooccurs", cooccur.top_pairs_of(results["cooccurs"], b))
    counts = _counts(results, rows, K="top_repos", B="top_cooccurs")
    return {**results, "counts": result("counts", counts)}


def go_batch(
    contents: DataFrame,
    files: DataFrame,
    stage: Write,
    result: Write = _lazy,
    k: int = 5,
    n: int = 5,
    keep_orphans: bool = False,
    drop_self: bool = False,
    rows: Rows | None = None,
) -> dict[str, DataFrame]:
    """As `python_batch` without resolution and co-occurrence: import paths name repositories."""
    edges = graph.go_edges(files, extract.go_deps(contents), keep_orphans, drop_self)
    if result is _lazy:
        edges = stage("edges", edges)
    else:
        edges = result("neighbors", edges)
    results = _graph_results(graph_of(edges, stage, n), k, result)
    return {**results, "counts": result("counts", _counts(results, rows, K="top_repos"))}


def edges_by_language(
    contents: DataFrame, files: DataFrame, dim: DataFrame, stage: Write
) -> DataFrame:
    """(lang, dst, src): the edges of several languages by one job. `contents` and `files` have a column
    `lang`, as the readers give it for a table of languages; `dim` is Python's."""

    def of(table: DataFrame, lang: str) -> DataFrame:
        return table.where(F.col("lang") == lang).drop("lang")

    python = resolve.edges_of(
        python_resolved(of(contents, "python"), of(files, "python"), dim, stage)
    )
    go = graph.go_edges(of(files, "go"), extract.go_deps(of(contents, "go")))
    tables = [(lang, t.select("dst", "src")) for lang, t in (("python", python), ("go", go))]
    return reduce(
        DataFrame.unionByName, [t.select(F.lit(lang).alias("lang"), "*") for lang, t in tables]
    )


def site_documents(
    top_flowers: DataFrame, top_cooccurs: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The one-row JSON documents of a front page: the merged top flowers, and the top pairs of a
    language that has them."""
    nodes, links = flowers.merged_nodes(top_flowers), flowers.merged_links(top_flowers)
    documents = {"top_K": flowers.graph_document(nodes, links)}
    if top_cooccurs is not None:
        documents["top_B"] = cooccur.pairs_document(top_cooccurs)
    return documents
