"""Repository dependencies and the graph made of them.

An edge `(dst, src)` says that repository `src` depends on repository `dst`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import path_tokens
from .known_names import NameFilter


def join_files(files: DataFrame, imports: DataFrame) -> DataFrame:
    """(id, repo, path, deps): files joined with the imports of their content.

    `imports` has one row per content, so a content copied into very many files is skewed on the
    files side only, and adaptive execution splits it. Imports travel as one array per content:
    the shuffle moves no row per imported name.
    """
    located = files.select("id", F.col("repo_name").alias("repo"), "path")
    return located.join(imports, "id", "inner")


def repo_deps(files: DataFrame, imports: DataFrame) -> DataFrame:
    """(repo, dep): distinct imported names per repository."""
    flat = join_files(files, imports).select("repo", F.explode("deps").alias("dep"))
    return flat.where(F.col("dep") != "").distinct()


def external_deps(
    files: DataFrame,
    imports: DataFrame,
    suffix_len: int = 2,
    unresolvable: DataFrame | None = None,
    known: NameFilter | None = None,
) -> DataFrame:
    """(repo, dep): imported names that are not also a folder or file name of the same repository.

    Imports and names go through one aggregation on (repo, token) instead of two distincts and an
    anti join: the join with the files is read once and shuffled once, and the partial aggregate
    collapses the copies of a folder name before the shuffle. Path tokens with a dot or a space are
    dropped first, since an imported name holds neither; with the default suffix length these are
    all the file names. With `known`, names that it can't hold are dropped before the shuffle too, and
    the result has only names that may be known.
    """

    def tag(tokens: Column, imported: bool) -> Column:
        return F.struct(tokens.alias("tokens"), F.lit(imported).alias("imported"))

    tagged = join_files(files, imports).select(
        "repo",
        F.inline(
            F.array(tag(F.col("deps"), True), tag(path_tokens("path", suffix_len), False))
        ),
    )
    tokens = tagged.select("repo", "imported", F.explode("tokens").alias("token")).where(
        (F.col("token") != "")
        & (F.col("imported") | ~(F.contains("token", F.lit(".")) | F.contains("token", F.lit(" "))))
    )
    if unresolvable is not None:
        useless = unresolvable.select(F.col("name").alias("token"), F.lit(True).alias("imported"))
        tokens = tokens.join(useless, ["token", "imported"], "left_anti")
    if known is not None:
        tokens = known.maybe_known(tokens, "token")
    return (
        tokens.groupBy("repo", "token")
        .agg(F.bool_and("imported").alias("external"))
        .where("external")
        .select("repo", F.col("token").alias("dep"))
    )


def _orphans(deps: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of `deps` whose content lies in no file."""
    return deps.join(files.select("id").distinct(), "id", "left_anti")


def go_file_deps(files: DataFrame, deps: DataFrame) -> DataFrame:
    """(id, repo, deps): full outer join. A file without imports has null `deps`, a content without
    a file a null `repo`.

    Made of a left join and the contents left over: of a full join, the files of a content with
    very many copies could not be split.
    """
    located = files.select("id", F.col("repo_name").alias("repo"))
    no_repo = F.lit(None).cast("string").alias("repo")
    left_over = _orphans(deps, files).select("id", no_repo, "deps")
    return located.join(deps, "id", "left").unionByName(left_over)


def go_edges(
    files: DataFrame, deps: DataFrame, keep_orphans: bool = False, drop_self: bool = False
) -> DataFrame:
    """(dst, src): distinct edges. With `keep_orphans` imports of contents that belong to no file
    give edges with a null `src`."""
    located = files.select("id", F.col("repo_name").alias("src"))
    named = deps.select("id", F.array_distinct("deps").alias("deps"))
    joined = located.join(named, "id", "inner").select("deps", "src")
    if keep_orphans:
        no_repo = F.lit(None).cast("string").alias("src")
        joined = joined.unionByName(_orphans(named, files).select("deps", no_repo))
    edges = joined.select(F.explode("deps").alias("dst"), "src")
    if drop_self:
        edges = edges.where(~F.col("dst").eqNullSafe(F.col("src")))
    return edges.distinct()


def degree(edges: DataFrame) -> DataFrame:
    """(dst, degree): number of dependents, of repositories that have any. Edges are distinct."""
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("degree"))


def adjacency(edges: DataFrame, degrees: DataFrame, part_size: int = 10_000) -> DataFrame:
    """(dst, part, srcs, degree): dependents as sorted arrays of about `part_size`.

    `degrees` is `degree(edges)`. Every repository's dependents are spread by a hash over
    `ceil(degree / part_size)` parts, so the list of a hub is never gathered in one task or one row.
    The key of the result is (dst, part); the parts together hold every dependent once, and a part
    that no dependent falls into has no row.
    """
    # The first 32 bits of the digest.
    spread = F.conv(F.substring(F.md5("src"), 1, 8), 16, 10).cast("long")
    part = F.pmod(spread, F.ceil(F.col("degree") / part_size))
    placed = edges.join(degrees, "dst").select("dst", part.cast("long").alias("part"), "src", "degree")
    # Without this the rows stay where the join put them: all of a hub in one task.
    return (
        placed.repartition("dst", "part")
        .groupBy("dst", "part", "degree")
        .agg(F.sort_array(F.collect_list("src")).alias("srcs"))
        .select("dst", "part", "srcs", "degree")
    )


def top_repos(degrees: DataFrame, k: int = 5) -> DataFrame:
    """(rank, dst, degree): the `k` repositories with most dependents, from rank 0."""
    best = degrees.orderBy(F.desc("degree"), "dst").limit(k)
    # Only the k rows that are left are numbered.
    rank = F.row_number().over(W.orderBy(F.desc("degree"), "dst")) - 1
    return best.select(rank.cast("long").alias("rank"), "dst", "degree")


def top_neighbors(edges: DataFrame, degrees: DataFrame, n: int = 5) -> DataFrame:
    """(dst, src, degree, rank): per repository its `n` dependents with most dependents of their
    own, from rank 0; `degree` is that of `src`, 0 if nothing depends on it.

    Each task keeps `n` rows per repository before the shuffle, so a hub sends few rows.
    """
    looked_up = edges.join(
        degrees.select(F.col("dst").alias("src"), "degree"), "src", "left"
    ).select("dst", "src", F.coalesce("degree", F.lit(0).cast("long")).alias("degree"))
    order = W.partitionBy("dst").orderBy(F.desc("degree"), "src")
    return (
        looked_up.withColumn("row", F.row_number().over(order))
        .where(F.col("row") <= n)
        .select("dst", "src", "degree", (F.col("row") - 1).cast("long").alias("rank"))
    )
