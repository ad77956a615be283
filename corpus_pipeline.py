"""A training corpus from `documents`: language, exact copies, near copies, benchmark passages, ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet and read back. All stages but the last return the columns of their input.

Defined cases: an empty table stays empty; nulls, repeated rows and further columns are dealt with as
the operators say, and columns that a stage doesn't read are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depweave.llm import byte_bpe, decontaminate, exact_dedup, language, near_dedup
from depweave.plans.stages import LatestStages, Stages

_LATEST = LatestStages()


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return language.keep_identified(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts stays."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, similarity 0.8."""
    return near_dedup.keep_one(docs, _LATEST.of(spark, "near_dedup").write, width=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of `benchmark` go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of what is left."""
    return byte_bpe.encode_and_decode(docs, "byte_bpe_multi_50k.tiktoken", with_ids=True)


STAGES = [
    ("language", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", byte_bpe_stage),
]

# Support vector machines and byte-pair encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for `documents`; each stage's result is written and read back."""
    stages: Stages = _LATEST.of(spark, "run")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.write(name, stage(spark, docs, sf_dir))
    return docs
