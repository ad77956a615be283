"""Command line for spark-submit.

    cli.py index   --lang python --repos repos.csv --stopwords stop.txt --out results
    cli.py batch   --lang python --contents 'c/*' --files 'f/*' --out results
    cli.py refresh --lang python --out results --site site
    cli.py flower  --lang python --out results user/name
    cli.py cooccurs --lang python --out results name

`index` writes the repository table, `batch` reads it and writes the result tables, `refresh` makes
the front-page documents. The last two print one document. Stop words are those of `index`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from depweave.operators import cooccur, flowers, lookup, resolve
from depweave.plans.batch import go_batch, python_batch, site_documents
from depweave.plans.stages import Stages
from depweave.schemas import check_language
from depweave.sinks import Results, write_document
from depweave.sources import read_contents, read_files, read_repos, read_stopwords, split_repos


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="depweave")
    commands = root.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--lang", required=True, type=check_language)
        sub.add_argument("--out", required=True)
        for option in options:
            sub.add_argument(option, required=True)
        return sub

    index = command("index", "--repos")
    index.add_argument("--stopwords")
    index.add_argument(
        "--reject", action="store_true", help="rows that don't fit go to the table `rejected`"
    )
    batch = command("batch", "--contents", "--files")
    batch.add_argument("--format", default="parquet")
    batch.add_argument("--by-lang", action="store_true", help="the folders are partitioned by lang")
    batch.add_argument("--suffix-len", type=int, default=2, help="Python")
    batch.add_argument("--strip-cr", action="store_true", help="Python")
    batch.add_argument("--ascii-only", action="store_true", help="Python")
    batch.add_argument("--keep-orphans", action="store_true", help="Go")
    batch.add_argument("--drop-self", action="store_true", help="Go")
    batch.add_argument("-k", type=int, default=5)
    batch.add_argument("-n", type=int, default=5)
    batch.add_argument("-b", type=int, default=20)
    command("refresh", "--site")
    command("flower").add_argument("key")
    command("cooccurs").add_argument("key")
    return root


def index(spark: SparkSession, args: argparse.Namespace) -> None:
    """The repository table. Stop words apply to Python only."""
    results, stages = Results(spark, args.out, args.lang), Stages(spark)
    try:
        if args.reject:
            repos, rejected = split_repos(spark, args.repos, args.lang, stages.write)
            results.write("rejected", rejected)
            print(f"rejected: {results.rows('rejected')}")
        else:
            repos = read_repos(spark, args.repos, args.lang)
        results.write("repos", _dimension(spark, args, repos))
        print(f"repositories: {results.rows('repos')}")
        results.publish()
    finally:
        stages.remove()


def _dimension(spark: SparkSession, args: argparse.Namespace, repos: DataFrame) -> DataFrame:
    if args.lang == "python":
        stopwords = read_stopwords(spark, args.stopwords) if args.stopwords else None
        return resolve.repo_dimension(repos, stopwords)
    return resolve.go_repo_dimension(repos)


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    lang = args.lang if args.by_lang else None
    contents = read_contents(spark, args.contents, args.format, lang)
    files = read_files(spark, args.files, args.format, lang)
    results, stages = Results(spark, args.out, args.lang), Stages(spark)
    try:
        if args.lang == "python":
            python_batch(
                contents,
                files,
                results.read("repos"),
                stages.write,
                results.write,
                k=args.k,
                n=args.n,
                b=args.b,
                suffix_len=args.suffix_len,
                strip_cr=args.strip_cr,
                ascii_only=args.ascii_only,
                rows=results.rows,
            )
        else:
            go_batch(
                contents,
                files,
                stages.write,
                results.write,
                k=args.k,
                n=args.n,
                keep_orphans=args.keep_orphans,
                drop_self=args.drop_self,
                rows=results.rows,
            )
        # All results are written, and become visible together.
        results.publish()
    finally:
        stages.remove()


def refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    results = Results(spark, args.out, args.lang)
    pairs = results.read("top_cooccurs") if args.lang == "python" else None
    for name, document in site_documents(results.read("top_flowers"), pairs).items():
        write_document(document, f"{args.site}/{args.lang}_{name}.json")


def show(document: list) -> None:
    """At most one row: the key is unique."""
    print(document[0]["document"] if document else "not found")


def flower(spark: SparkSession, args: argparse.Namespace) -> None:
    table = Results(spark, args.out, args.lang).read("flowers")
    show(flowers.flower_documents(lookup.flower_of(table, args.key)).take(1))


def cooccurs(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.lang != "python":
        # Only Python has such a table.
        return show([])
    table = Results(spark, args.out, args.lang).read("cooccurs")
    show(cooccur.partner_documents(lookup.cooccurs_of(table, args.key)).take(1))


COMMANDS = {f.__name__: f for f in (index, batch, refresh, flower, cooccurs)}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    COMMANDS[args.command](SparkSession.builder.appName("depweave").getOrCreate(), args)


if __name__ == "__main__":
    main()
