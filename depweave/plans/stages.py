"""Intermediate tables that several results are computed from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Stages:
    """Writes intermediate tables to the shared folder and reads them back.

    A written table is computed once however many results use it, survives lost executors, and has
    a known size: a join with it is broadcast only if it is really small, and is otherwise a sort
    merge join straight on two shuffles, the shape whose skewed keys adaptive execution splits.

    The folder is `folder` or else `shared_folder(spark)`; each instance has its own subfolder.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{(folder or shared_folder(spark)).rstrip('/')}/depweave-{uuid.uuid4().hex}"
        self._written = 0

    def write(self, name: str, table: DataFrame) -> DataFrame:
        self._written += 1
        path = f"{self.path}/{self._written:03d}-{name}"
        table.write.parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def remove(self) -> None:
        """Deletes the subfolder of this instance, once no table in it is read any more."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, or where that is unset a folder in the warehouse: both lie where all
    executors of a cluster see them."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"


class LatestStages:
    """The `Stages` of each query's latest call. Results are read after a query returns, so what a
    call has written goes when the same query is called again, or by `remove`."""

    def __init__(self) -> None:
        self._latest: dict[str, Stages] = {}

    def of(self, spark: SparkSession, query: str) -> Stages:
        self.remove(query)
        self._latest[query] = Stages(spark)
        return self._latest[query]

    def remove(self, query: str) -> None:
        old = self._latest.pop(query, None)
        if old is not None and old.spark.getActiveSession() is not None:
            old.remove()
