"""Writing, publishing and reading result tables."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANGUAGES, check_language

# The order rows are written in; the first column is the key of reads.
KEYS = {
    "repos": ("repo_name", "user"),
    "rejected": ("file", "record"),
    "neighbors": ("dst", "src"),
    "top_repos": ("rank",),
    "flowers": ("root",),
    "top_flowers": ("rank",),
    "cooccurs": ("dep1", "rank"),
    "top_cooccurs": ("rank",),
    "counts": ("name",),
}
#: Tables that are looked up by key, with a bounded number of rows for each key. Their rows are in buckets of
#: the key. Other tables, in which a hub may have any number of rows, go to files by ranges.
BUCKETED = ("flowers", "cooccurs")


class Results:
    """The result tables of one language under one folder, in versions.

    `write` puts a table into a version of its own, `<folder>/versions/<version>/<name>/lang=<lang>`,
    where no reader sees it. `publish` makes all tables written since the last time the current ones at
    once, by replacing one small file, `<folder>/current/<lang>.json`, which names the version of each
    table. So readers find the former tables, all of one state, while a job runs and after one that
    failed at whatever place. `read` gives what this object has written and else what is published.
    Versions that are no longer current stay, for readers that still use them, until `prune`.

    Replacing the file is one rename, which is atomic on file systems such as HDFS. Jobs of different
    languages don't touch each other's files; of two jobs of one language that publish at the same time,
    the tables are those of the later one.
    """

    def __init__(self, spark: SparkSession, folder: str, lang: str, buckets: int = 16):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.lang = check_language(lang)
        self.buckets = buckets
        self.version = uuid.uuid4().hex
        self._written: dict[str, dict] = {}

    def write(self, name: str, table: DataFrame) -> DataFrame:
        """Writes the table into this object's version and gives it back as read from its files.

        Rows are in key order. Those of a table that is looked up are in buckets, so one key is in one
        file, and a join by key shuffles nothing of it. Those of other tables go to files by ranges of
        the key columns, so a hub's many neighbours are spread over several. Rows are counted as they are
        written, see `rows`.
        """
        keys = KEYS[name]
        entry = {"version": self.version, "buckets": 0, "schema": table.schema.jsonValue()}
        path = self._path(name, entry)
        # Behind the last shuffle: there each row passes once, and of a task's attempts one counts.
        written, count = Observation(), F.count(F.lit(1)).alias("n")
        if name in BUCKETED:
            entry["buckets"] = self.buckets
            dealt = table.repartition(self.buckets, keys[0]).observe(written, count)
            writer = dealt.write.bucketBy(self.buckets, keys[0]).sortBy(*keys)
            writer.mode("overwrite").option("path", path).saveAsTable(self._catalog_name(name, entry))
        else:
            ordered = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
            ordered = ordered.observe(written, count)
            ordered.write.mode("overwrite").parquet(path)
        # A plan that is known to be empty before it runs may observe nothing.
        entry["rows"] = written.get.get("n") or 0
        self._written[name] = entry
        return self._table(name, entry)

    def publish(self) -> None:
        """Makes what was written since the last time the current tables."""
        current = self.published() | self._written
        replace_file(self.spark, self._pointer, json.dumps(current, indent=1))
        self._written = {}
        self.version = uuid.uuid4().hex

    def published(self) -> dict[str, dict]:
        """The current version of each table, with what is needed to read it."""
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(self._pointer)
        system = target.getFileSystem(context._jsc.hadoopConfiguration())
        if not system.exists(target):
            return {}
        lines = self.spark.read.text(self._pointer, wholetext=True).collect()
        return json.loads(lines[0]["value"])

    def read(self, name: str) -> DataFrame:
        return self._table(name, self._entry(name))

    def rows(self, name: str) -> int:
        """The number of rows of a table, counted when it was written: no scan."""
        return self._entry(name)["rows"]

    def _entry(self, name: str) -> dict:
        entry = self._written.get(name) or self.published().get(name)
        if entry is None:
            raise ValueError(f"no table {name} of {self.lang} in {self.folder}")
        return entry

    def prune(self) -> None:
        """Deletes the language's tables that are neither current nor written by this object."""
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        kept = {self._path(name, entry) for t in (self.published(), self._written) for name, entry in t.items()}
        kept = {hadoop.Path(path).toUri().getPath() for path in kept}
        pattern = hadoop.Path(f"{self.folder}/versions/*/*/lang={self.lang}")
        system = pattern.getFileSystem(context._jsc.hadoopConfiguration())
        for status in system.globStatus(pattern) or []:
            if status.getPath().toUri().getPath() not in kept:
                system.delete(status.getPath(), True)

    @property
    def _pointer(self) -> str:
        return f"{self.folder}/current/{self.lang}.json"

    def _path(self, name: str, entry: dict) -> str:
        return f"{self.folder}/versions/{entry['version']}/{name}/lang={self.lang}"

    def _catalog_name(self, name: str, entry: dict) -> str:
        return f"depweave_{self.lang}_{name}_{entry['version']}"

    def _table(self, name: str, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        path = self._path(name, entry)
        if not entry["buckets"]:
            return self.spark.read.schema(schema).parquet(path)
        # Buckets are known to the catalog only, so a session that hasn't the table there takes it up.
        table = self._catalog_name(name, entry)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            key, order = KEYS[name][0], ", ".join(KEYS[name])
            location = path.replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key})"
                f" SORTED BY ({order}) INTO {entry['buckets']} BUCKETS LOCATION '{location}'"
            )
        return self.spark.table(table)


def by_language(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The published table `name` of all languages that have one, with a column `lang`."""
    tables = []
    for lang in LANGUAGES:
        results = Results(spark, folder, lang)
        if name in results.published():
            tables.append(results.read(name).withColumn("lang", F.lit(lang)))
    if not tables:
        raise ValueError(f"no table {name} in {folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def replace_languages(table: DataFrame, path: str, *keys: str) -> None:
    """Replaces the folders `<path>/lang=<lang>` of those languages that `table` has rows of; the files of
    others aren't touched. Rows go to files by ranges of the key columns.

    For tables of one job that nobody reads meanwhile; `Results` publishes several at once.
    """
    order = ("lang", *keys)
    dealt = table.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("lang").parquet(path)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside `path` and renames it, so readers find the former one or this one."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    target, beside = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    conf = context._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = context._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(target.toUri(), conf)
    files.rename(files.makeQualified(beside), files.makeQualified(target), options)


def write_document(document: DataFrame, path: str) -> None:
    """Replaces the file `path` by the text of the one-row (document), which holds top rows only."""
    replace_file(document.sparkSession, path, document.select("document").first()["document"])
