"""The corpus as the files that a job reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from .corpus import Corpus


def write_repo_lines(tables: Corpus, folder: str) -> None:
    """`repo_lines` as CSV files with a header row."""
    header = "user,repo_name,num_bytes,stars,fork"
    # One column whose separator is in no line, so lines stay as they are.
    lines = tables.repo_lines.select(F.col("line").alias(header))
    lines.write.csv(folder, header=True, sep="\u0001", quote="")


def write_sources(tables: Corpus, folder: str, lang: str) -> None:
    """Contents and files of one language as Parquet, added to the subfolders of `folder`, which are
    partitioned by language, with all columns of their layouts."""
    contents = tables.py_contents if lang == "python" else tables.go_contents
    language = F.lit(lang).alias("lang")
    contents.select(
        F.col("id").cast("string").alias("id"),
        F.length("content").cast("long").alias("size"),
        "content",
        F.lit(False).alias("binary"),
        F.lit(1).cast("long").alias("copies"),
        language,
    ).write.mode("append").partitionBy("lang").parquet(f"{folder}/contents")
    tables.files.select(
        "repo_name",
        F.lit("refs/heads/main").alias("ref"),
        "path",
        F.lit("33188").alias("mode"),
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("symlink_target"),
        language,
    ).write.mode("append").partitionBy("lang").parquet(f"{folder}/files")


def write_inputs(tables: Corpus, folder: str, lang: str) -> None:
    """All that a job of one language reads: `write_sources`, repositories as CSV and stop words as text."""
    write_sources(tables, folder, lang)
    columns = ["user", "repo_name", "num_bytes", "stars", "fork"]
    repos = tables.repos.select(columns if lang == "python" else columns[:3])
    repos.write.csv(f"{folder}/repos", header=True, escape='"')
    tables.stopwords.select("name").write.text(f"{folder}/stopwords")
