"""Bounded two-hop neighbourhoods ("flowers").

The flower of a root links it to its top `n` dependents, and each of those to its own top `n`. It
holds at most 1 + n + n² repositories, whatever the degrees in the graph are, so all arrays
gathered here are bounded by the parameter and not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import link_record, node_record


def petals(neighbors: DataFrame) -> DataFrame:
    """(dst, leaves): the rows of `top_neighbors` with one row per repository, by rank.

    Written as a table, it is both sides of the second hop.
    """
    leaf = F.struct("rank", "src", "degree")
    return neighbors.groupBy("dst").agg(F.sort_array(F.collect_list(leaf)).alias("leaves"))


def neighbors_of(petals: DataFrame) -> DataFrame:
    """(dst, src, degree, rank): `top_neighbors` from `petals`."""
    rows = petals.select("dst", F.inline("leaves"))
    return rows.select("dst", "src", "degree", "rank")


def flowers(petals: DataFrame, degrees: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, nodes, links): one row per repository that has dependents.

    `petals` is the result of that function, `degrees` that of `degree`. Nodes are (repo, degree),
    links (source, target), both distinct, in the order of first appearance. `roots` (dst) limits
    the work to these roots before the second hop.
    """
    centers = petals
    if roots is not None:
        centers = petals.join(roots.select("dst"), "dst", "left_semi")
        degrees = degrees.join(roots.select("dst"), "dst", "left_semi")
    # The hop goes by a dependent that may be in a great many lists; its leaves are one row.
    leaves = petals.select(F.col("dst").alias("src"), "leaves")
    hops = neighbors_of(centers).join(leaves, "src", "left").select(
        F.col("dst").alias("root"), F.struct("rank", "src", "degree", "leaves").alias("hop")
    )
    center = degrees.select(F.col("dst").alias("root"), F.col("degree").alias("root_degree"))
    gathered = hops.groupBy("root").agg(F.sort_array(F.collect_list("hop")).alias("hops"))

    def members(of: Column) -> Column:
        return F.arrays_zip(of["src"].alias("repo"), of["degree"].alias("degree"))

    def links(source: Column, targets: Column) -> Column:
        return F.transform(targets, lambda target: link_record(source, target))

    no_leaves = F.array()
    outer_nodes = F.transform("hops", lambda h: F.coalesce(members(h["leaves"]), no_leaves))
    outer_links = F.transform(
        "hops", lambda h: F.coalesce(links(h["src"], h["leaves"]["src"]), no_leaves)
    )
    root = F.struct(F.col("root").alias("repo"), F.col("root_degree").alias("degree"))
    hops_col = F.col("hops")
    every = gathered.join(center, "root").select(
        "root",
        "hops",
        F.concat(F.array(root), members(hops_col), F.flatten(outer_nodes)).alias("nodes"),
        F.concat(links(F.col("root"), hops_col["src"]), F.flatten(outer_links)).alias("links"),
    )

    # Records are compared each with each, names by their hashes. So names tell first where there is
    # nothing to remove: nodes of different names, links of different sources or targets.
    def differ(names: Column) -> Column:
        return F.size(F.array_distinct(names)) == F.size(names)

    sources = F.concat(F.array("root"), hops_col["src"])
    targets = F.forall("hops", lambda h: h["leaves"].isNull() | differ(h["leaves"]["src"]))
    plain = every.select(
        "root",
        "nodes",
        "links",
        differ(F.col("nodes.repo")).alias("other_nodes"),
        (differ(sources) & targets).alias("other_links"),
    )
    return plain.select(
        "root",
        *[
            F.when(F.col(f"other_{name}"), F.col(name)).otherwise(F.array_distinct(name)).alias(name)
            for name in ("nodes", "links")
        ],
    )


def flower_nodes(flowers: DataFrame) -> DataFrame:
    """(root, repo, degree), each repository once per root."""
    return flowers.select("root", F.inline("nodes"))


def flower_links(flowers: DataFrame) -> DataFrame:
    """(root, source, target), each link once per root."""
    return flowers.select("root", F.inline("links"))


def top_flowers(top: DataFrame, flowers: DataFrame) -> DataFrame:
    """(rank, root, nodes, links): the flowers of the top repositories.

    `top` is the result of `top_repos`; its k rows are the one side that is broadcast by hint.
    """
    keyed = F.broadcast(top.select("rank", F.col("dst").alias("root")))
    return flowers.join(keyed, "root").select("rank", "root", "nodes", "links")


def merged_nodes(top_flowers: DataFrame) -> DataFrame:
    """(id, group): the repositories of all given flowers, once each."""
    nodes = top_flowers.select(F.inline("nodes"))
    return nodes.select(F.col("repo").alias("id"), F.col("degree").alias("group")).distinct()


def merged_links(top_flowers: DataFrame) -> DataFrame:
    """(source, target): the links of all given flowers, once each."""
    return top_flowers.select(F.inline("links")).distinct()


def flower_documents(flowers: DataFrame) -> DataFrame:
    """(root, document): each flower as the JSON text {"nodes": …, "links": …}."""
    nodes = F.transform("nodes", lambda x: node_record(x["repo"], x["degree"]))
    body = F.struct(nodes.alias("nodes"), F.col("links"))
    return flowers.select("root", F.to_json(body).alias("document"))


def graph_document(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(document): one graph as the JSON text {"nodes": …, "links": …}, both lists sorted.

    For merged top flowers, which hold at most k·(1 + n + n²) repositories.
    """
    node, link = node_record("id", "group"), link_record("source", "target")
    rows = nodes.select(node.alias("node")).unionByName(
        links.select(link.alias("link")), allowMissingColumns=True
    )
    lists = rows.agg(
        F.sort_array(F.collect_list("node")).alias("nodes"),
        F.sort_array(F.collect_list("link")).alias("links"),
    )
    return lists.select(F.to_json(F.struct("nodes", "links")).alias("document"))
