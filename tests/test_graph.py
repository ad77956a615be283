"""Graph, flowers and co-occurrence on small graphs against plain Python."""

import json
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from depweave.operators import cooccur, flowers, graph, lookup, resolve

EDGE = "dst string, src string"
KNOWN = "repo string, dep string"


def random_edges(seed, repos, count, hub=0):
    """`hub` edges lead to or from one repository."""
    dice = random.Random(seed)
    pick = lambda: f"r{dice.randrange(repos):03d}"
    edges = {(pick(), pick()) for _ in range(count)}
    edges |= {("r000", f"r{i:03d}") for i in range(hub)} | {(f"r{i:03d}", "r001") for i in range(hub)}
    return sorted(edges)


def brute_flowers(edges, n):
    dependents = defaultdict(list)
    for dst, src in edges:
        dependents[dst].append(src)
    size = {repo: len(of) for repo, of in dependents.items()}
    best = {
        repo: sorted(of, key=lambda s: (-size.get(s, 0), s))[:n] for repo, of in dependents.items()
    }
    result = {}
    for root in dependents:
        links = [(root, one) for one in best[root]]
        links += [(one, two) for one in best[root] for two in best.get(one, [])]
        repos = {root} | {target for _, target in links}
        result[root] = ({(repo, size.get(repo, 0)) for repo in repos}, set(links))
    return result


@pytest.mark.parametrize("edges", [random_edges(1, 30, 90), random_edges(2, 60, 80, hub=50)])
def test_flowers(spark, edges):
    table = spark.createDataFrame(edges, EDGE)
    degrees = graph.degree(table)
    petals = flowers.petals(graph.top_neighbors(table, degrees, 3))
    found = flowers.flowers(petals, degrees).collect()
    expected = brute_flowers(edges, 3)
    assert len(found) == len(expected)
    for row in found:
        nodes, links = [tuple(x) for x in row["nodes"]], [tuple(x) for x in row["links"]]
        assert len(nodes) == len(set(nodes)) <= 1 + 3 + 9
        assert len(links) == len(set(links))
        assert nodes[0][0] == row["root"]
        assert (set(nodes), set(links)) == expected[row["root"]]
    assert sum(row["degree"] for row in degrees.collect()) == len(edges)

    top = graph.top_repos(degrees, 4)
    some = flowers.flowers(petals, degrees, roots=top)
    assert some.count() == 4
    assert some.exceptAll(flowers.flowers(petals, degrees)).count() == 0

    merged = flowers.merged_nodes(some).collect()
    roots = [row["root"] for row in some.select("root").collect()]
    assert {tuple(row) for row in merged} == set().union(*(expected[r][0] for r in roots))
    document = flowers.graph_document(flowers.merged_nodes(some), flowers.merged_links(some))
    parsed = json.loads(document.collect()[0]["document"])
    assert {(x["source"], x["target"]) for x in parsed["links"]} == set().union(
        *(expected[r][1] for r in roots)
    )
    one = flowers.flower_documents(lookup.flower_of(some, roots[0])).collect()
    assert {(x["id"], x["group"]) for x in json.loads(one[0]["document"])["nodes"]} == expected[
        roots[0]
    ][0]
    assert lookup.flower_of(some, "missing").count() == 0


def test_adjacency_splits_hubs(spark):
    edges = random_edges(3, 60, 100, hub=50)
    table = spark.createDataFrame(edges, EDGE)
    found = graph.adjacency(table, graph.degree(table), part_size=10).collect()
    rebuilt = Counter((row["dst"], src) for row in found for src in row["srcs"])
    assert rebuilt == Counter(edges)
    assert {row["dst"]: row["degree"] for row in found} == Counter(dst for dst, _ in edges)
    assert len([row for row in found if row["dst"] == "r000"]) > 2
    assert all(row["srcs"] == sorted(row["srcs"]) for row in found)


def brute_pairs(known):
    by_repo = defaultdict(set)
    for repo, dep in known:
        by_repo[repo].add(dep)
    return Counter(pair for deps in by_repo.values() for pair in combinations(sorted(deps), 2))


def brute_partners(pairs, b):
    partners = defaultdict(list)
    for (one, two), n in pairs.items():
        partners[one].append((-n, two))
        partners[two].append((-n, one))
    return {
        (dep, other, -n, rank)
        for dep, of in partners.items()
        for rank, (n, other) in enumerate(sorted(of)[:b])
    }


def random_known(seed):
    """A few repositories hold most of the rows, and many dependencies occur only there."""
    dice = random.Random(seed)
    known = set()
    for repo in range(12):
        known |= {(f"big{repo:02d}", f"d{i:03d}") for i in range(150) if dice.random() < 0.4}
    for repo in range(40):
        known |= {(f"s{repo:02d}", f"d{dice.randrange(200):03d}") for _ in range(dice.randint(1, 9))}
    return sorted(known)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [1_000, 7])
def test_partners_do_not_depend_on_blocks(spark, seed, block):
    known = random_known(seed)
    table = spark.createDataFrame(known, KNOWN).cache()
    pairs = brute_pairs(known)
    for b in (3, 400):
        found = cooccur.top_partners(table, b, block).collect()
        assert {tuple(row) for row in found} == brute_partners(pairs, b)
        assert len(found) == len(brute_partners(pairs, b))
    best = sorted(pairs, key=lambda pair: (-pairs[pair], pair))[:10]
    expected = [(rank, *pair, pairs[pair]) for rank, pair in enumerate(best)]
    found = cooccur.top_pairs(table, 10, block).orderBy("rank").collect()
    assert [tuple(row)[:4] for row in found] == expected
    if seed == 1:
        counted = cooccur.pair_counts(table, block).collect()
        assert {(row["dep1"], row["dep2"]): row["cnt"] for row in counted} == pairs
        assert len(counted) == len(pairs)
    table.unpersist()


def power_law_known(seed):
    """A few names are nearly everywhere, most in one or two repositories."""
    dice = random.Random(seed)
    name = lambda: f"d{int(200 / (1 + 199 * dice.random())) + dice.randrange(3):03d}"
    known = {(f"r{repo:02d}", name()) for repo in range(60) for _ in range(dice.randint(1, 40))}
    return sorted(known | {(f"r{repo:02d}", f"own{repo}x{i}") for repo in range(9) for i in range(9)})


@pytest.mark.parametrize("b", [1, 2, 5, 30])
def test_partners_of_a_power_law(spark, b):
    known = power_law_known(b)
    table = spark.createDataFrame(known, KNOWN)
    pairs = brute_pairs(known)
    found = cooccur.top_partners(table, b).collect()
    assert {tuple(row) for row in found} == brute_partners(pairs, b)
    best = sorted(pairs, key=lambda pair: (-pairs[pair], pair))[:b]
    found = cooccur.top_pairs(table, b).orderBy("rank").collect()
    assert [tuple(row)[1:4] for row in found] == [(*pair, pairs[pair]) for pair in best]


@pytest.mark.parametrize("names", ["same", "own"])
def test_pairs_made_grow_with_repositories(spark, names, monkeypatch):
    """Large repositories are all dealt with alike: what is paired grows in proportion."""
    made, pairs_of = [], cooccur._pairs

    def watched(*args):
        made.append(pairs_of(*args))
        return made[-1]

    monkeypatch.setattr(cooccur, "_pairs", watched)
    for repos in (8, 12):
        own = "r.id" if names == "own" else "0"
        table = spark.sql(
            f"SELECT concat('r', r.id) AS repo, concat('d', {own}, 'x', d.id) AS dep"
            f" FROM range({repos}) r CROSS JOIN range(300) d"
        )
        cooccur.top_partners(table, 3, block=100)
    assert made[0].count() <= 8 * 300 * 4
    assert made[1].count() * 8 <= made[0].count() * 12


def test_no_pairs(spark):
    for known in ([], [("a", "x"), ("b", "x")]):
        table = spark.createDataFrame(known, KNOWN)
        assert cooccur.top_partners(table).count() == cooccur.top_pairs(table).count() == 0


def test_documents_of_pairs(spark):
    known = spark.createDataFrame([("a", 'x"y'), ("a", "z"), ("b", "z"), ("b", 'x"y')], KNOWN)
    partners = cooccur.top_partners(known, 5)
    documents = cooccur.partner_documents(lookup.cooccurs_of(partners, "z")).collect()
    assert json.loads(documents[0]["document"]) == {"cooccurs": [['x"y', 2]]}
    whole = cooccur.pairs_document(cooccur.top_pairs_of(partners, 5)).collect()
    assert json.loads(whole[0]["document"]) == {"cooccurs": ['2: x"y, z']}
    asked = spark.createDataFrame([("z",), ("none",)], "name string")
    assert lookup.cooccurs_of(partners, asked).count() == 1


def test_best_repo_and_stop_words(spark):
    repos = spark.createDataFrame(
        [
            ("b", "x", 0, 5, 0),
            ("a", "x", 0, 5, 0),
            ("c", "x", 0, 9, 1),
            ("d", "y", 0, None, 0),
            ("e", "y", 0, 0, 0),
            ("f", "os", 0, 99, 0),
            ("g", "z", 0, 1, None),
        ],
        "user string, repo_name string, num_bytes long, stars int, fork int",
    )
    stop = spark.createDataFrame([("os",)], "name string")
    best = resolve.best_repo(resolve.repo_dimension(repos, stop)).collect()
    assert {tuple(row) for row in best} == {("x", "a/x"), ("y", "d/y"), ("z", "g/z")}

    deps = spark.createDataFrame([("a/x", "x"), ("q/q", "x"), ("q/q", "os"), ("q/q", "z")], KNOWN)
    table = resolve.best_repo(resolve.repo_dimension(repos, stop))
    edges = resolve.resolve_edges(deps, table).collect()
    assert {tuple(row) for row in edges} == {("a/x", "q/q"), ("g/z", "q/q")}
    assert resolve.resolve_edges(deps, table, drop_self=False).count() == 3
    assert resolve.known_deps(deps, table).count() == 3
    assert resolve.known_deps(deps.selectExpr("repo", "'é' dep"), table, ascii_only=True).count() == 0


def test_go_edge_options(spark):
    files = spark.createDataFrame(
        [(1, "u/a", "x.go"), (2, "u/b", "y.go")], "id long, repo_name string, path string"
    )
    deps = spark.createDataFrame(
        [(1, ["u/a", "u/b", "u/b"]), (3, ["u/c"])], "id long, deps array<string>"
    )
    rows = lambda table: {tuple(row) for row in table.collect()}
    assert rows(graph.go_edges(files, deps)) == {("u/a", "u/a"), ("u/b", "u/a")}
    assert rows(graph.go_edges(files, deps, drop_self=True)) == {("u/b", "u/a")}
    assert ("u/c", None) in rows(graph.go_edges(files, deps, keep_orphans=True, drop_self=True))
    joined = graph.go_file_deps(files, deps)
    assert {(row["id"], row["repo"]) for row in joined.collect()} == {
        (1, "u/a"),
        (2, "u/b"),
        (3, None),
    }
