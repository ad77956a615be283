"""Source-code tables derived from order tables.

An order is a source file, its customer is the repository that holds it and its line items are the
imports in it; see FIXTURES.md for the mapping.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _lines_of(items: DataFrame, line: Column, *keys: str) -> DataFrame:
    """(id, keys, content): the lines of each id, sorted and joined. Items move, which are
    short, and lines are made where they are sorted."""
    lines = items.repartition("id").select("id", *keys, line.alias("line"))
    in_order = W.partitionBy("id", *keys).orderBy("line")
    whole = in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    gathered = lines.select(
        "id",
        *keys,
        F.collect_list("line").over(whole).alias("lines"),
        F.row_number().over(in_order).alias("row"),
    )
    return gathered.where(F.col("row") == 1).select(
        "id", *keys, F.array_join("lines", "\n").alias("content")
    )


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


# Only the columns that are used; a declared schema also spares a job that would look it up.
_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_returnflag string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint",
}


class Corpus:
    """The derived tables over one folder, each planned when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        path = f"{self._sf_dir}/{name}.parquet"
        return self._spark.read.schema(_SCHEMAS[name]).parquet(path)

    @cached_property
    def _items(self) -> DataFrame:
        """(id, kind, form, l_partkey, l_returnflag): the line items of each order, those of every
        97th order once more under an id that no file has. `kind` tells apart the forms of a file
        and `form` those of a line."""
        key = F.col("l_orderkey")
        ids = F.when(key % 97 == 0, F.array(key, -1 - key)).otherwise(F.array(key))
        return self._table("lineitem").select(
            F.explode(ids).alias("id"),
            (key % 8).alias("kind"),
            ((key + F.col("l_partkey")) % 20).alias("form"),
            "l_partkey",
            "l_returnflag",
        )

    @cached_property
    def _blank(self) -> DataFrame:
        """(id, content): a null content per customer and an empty one per supplier."""
        null = self._table("customer").select(
            (F.lit(-(2**40)) - F.col("c_custkey")).alias("id"),
            F.lit(None).cast("string").alias("content"),
        )
        return null.unionByName(
            self._table("supplier").select(
                (F.lit(-(2**41)) - F.col("s_suppkey")).alias("id"), F.lit("").alias("content")
            )
        )

    @cached_property
    def py_contents(self) -> DataFrame:
        """(id, content): imports in many forms, and lines that are none."""
        part, form, flag = F.col("l_partkey"), F.col("form"), F.col("l_returnflag")
        name = _text("m", part)
        line = (
            F.when(form == 0, _text("import ", name, ", m", part + 1))
            .when(form == 1, _text("from . import ", name))
            .when(form == 2, _text("\timport ", name))
            .when(form == 3, _text("from the docs of ", name))
            .when(form == 4, _text("import\t", name))
            .when(form == 5, _text("import ", name, "\r"))
            .when(form == 6, _text("# import ", name))
            .when(form == 7, _text("import m\u00fc", part))
            .when(flag == "A", _text("import ", name))
            .when(flag == "N", _text("from ", name, ".sub import f"))
            .otherwise(_text("import ", name, ",m", part + 1))
        )
        return _lines_of(self._items, line).unionByName(self._blank)

    @cached_property
    def go_contents(self) -> DataFrame:
        """(id, content): single imports and blocks, with comments, other hosts and other line ends;
        a part that is no customer's is outside the corpus."""
        kind, form, flag = F.col("kind"), F.col("form"), F.col("l_returnflag")
        owner = F.when(F.col("c_custkey").isNull(), "ext").otherwise(_text("u", F.col("c_nationkey")))
        path = _text(
            F.when(flag == "N", "x ").otherwise(""),
            F.when(form == 0, '"gopkg.in/').otherwise('"github.com/'),
            owner,
            "/m",
            F.col("l_partkey"),
            F.when(flag == "A", "/sub").otherwise(""),
            '"',
        )
        line = (
            F.when(kind == 0, _text("import ", path))
            .when((kind == 1) & (form == 1), _text("\t// ", path))
            .when(kind == 1, _text("\t", path, ' // (as "github.com/a/b")'))
            .otherwise(_text("\t", path))
        )
        owned = self._items.join(
            self._table("customer"), F.col("c_custkey") == F.col("l_partkey"), "left"
        )
        items = owned.select("id", "kind", "form", "l_partkey", "l_returnflag", "c_custkey", "c_nationkey")
        body = _lines_of(items, line, "kind")
        block = _text("package m\nimport (\n", F.col("content"), "\n)")
        content = (
            F.when(kind == 0, _text("package m\n", F.col("content"), '\nvar q = "github.com/q/q"'))
            .when(
                kind == 2,
                _text(
                    "package m\nimport (",
                    F.col("content"),
                    ')\nvar q = "github.com/q/q/r"\nfoo()\nbar("github.com/no/no")',
                ),
            )
            .when(kind == 3, F.replace(block, F.lit("\n"), F.lit("\r\n")))
            .when(kind == 4, _text("package m\nvar q = (\n", F.col("content"), "\n)"))
            .otherwise(block)
        )
        return body.select("id", content.alias("content")).unionByName(self._blank)

    @cached_property
    def files(self) -> DataFrame:
        """(id, repo_name, path): all orders; every fifth file is named as a part may be."""
        key = F.col("o_orderkey")
        placed = self._table("orders").join(
            self._table("customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        file = F.when(key % 5 == 0, _text("m", key * 7 % 2000)).otherwise(_text("f", key))
        return placed.select(
            key.alias("id"),
            _text("u", F.col("c_nationkey"), "/m", F.col("c_custkey")).alias("repo_name"),
            _text("src/m", key % 2000, "/", file, ".py").alias("path"),
        )

    def _repos_of(self, table: str, user: str, column: str, key: str, fork: Column, name: str) -> DataFrame:
        return self._table(table).select(
            _text(user, F.col(f"{column}_nationkey")).alias("user"),
            _text(name, F.col(key)).alias("repo_name"),
            F.lit(0).cast("long").alias("num_bytes"),
            F.floor(F.abs(f"{column}_acctbal")).cast("int").alias("stars"),
            fork.cast("int").alias("fork"),
        )

    @cached_property
    def rivals(self) -> DataFrame:
        """(user, repo_name, num_bytes, stars, fork): two for each supplier, one of them named
        beyond ASCII."""
        plain, other = (
            self._repos_of("supplier", "s", "s", "s_suppkey", F.lit(0), name)
            for name in ("m", "m\u00fc")
        )
        return plain.unionByName(other)

    @cached_property
    def repos(self) -> DataFrame:
        """(user, repo_name, num_bytes, stars, fork): customers and their rivals."""
        household = F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(0)
        customers = self._repos_of("customer", "u", "c", "c_custkey", household, "m")
        return customers.unionByName(self.rivals)

    @cached_property
    def repo_lines(self) -> DataFrame:
        """(line): `repos` as the lines of a CSV file, some with stars that are no number, some with a
        field too few or too many."""
        form = F.col("stars") % 10
        start = F.concat_ws(",", "user", "repo_name", "num_bytes")
        line = (
            F.when(form == 3, _text(start, ",many,", F.col("fork")))
            .when(form == 5, _text(start, ",", F.col("stars")))
            .when(form == 7, _text(start, ",", F.col("stars"), ",", F.col("fork"), ",x"))
            .otherwise(_text(start, ",", F.col("stars"), ",", F.col("fork")))
        )
        return self.repos.select(line.alias("line"))

    @cached_property
    def stopwords(self) -> DataFrame:
        """(name)."""
        part = self._table("part").where(F.col("p_partkey") % 101 == 7)
        return part.select(F.concat(F.lit("m"), "p_partkey").alias("name"))


def corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    return Corpus(spark, sf_dir)
