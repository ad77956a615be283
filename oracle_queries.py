"""For each query the same result in DuckDB SQL, written apart from the Spark code.

Go imports are found line by line here, with lists, where the Spark code matches whole texts.
"""

from __future__ import annotations

# Each step is (name, steps it reads, SQL).
_STEPS = {
    "items": (
        (),
        """
        SELECT unnest(CASE WHEN l_orderkey % 97 = 0 THEN [l_orderkey, -1 - l_orderkey]
                 ELSE [l_orderkey] END) AS id,
               l_orderkey % 8 AS kind, (l_orderkey + l_partkey) % 20 AS form, l_partkey, l_returnflag
        FROM lineitem""",
    ),
    "blank": (
        (),
        """
        SELECT -1099511627776 - c_custkey AS id, CAST(NULL AS VARCHAR) AS content FROM customer
        UNION ALL SELECT -2199023255552 - s_suppkey, '' FROM supplier""",
    ),
    "py_contents": (
        ("items", "blank"),
        """
        SELECT id, string_agg(line, chr(10) ORDER BY line) AS content
        FROM (SELECT id, CASE
                  WHEN form = 0 THEN concat('import m', l_partkey, ', m', l_partkey + 1)
                  WHEN form = 1 THEN concat('from . import m', l_partkey)
                  WHEN form = 2 THEN concat(chr(9), 'import m', l_partkey)
                  WHEN form = 3 THEN concat('from the docs of m', l_partkey)
                  WHEN form = 4 THEN concat('import', chr(9), 'm', l_partkey)
                  WHEN form = 5 THEN concat('import m', l_partkey, chr(13))
                  WHEN form = 6 THEN concat('# import m', l_partkey)
                  WHEN form = 7 THEN concat('import m', chr(252), l_partkey)
                  WHEN l_returnflag = 'A' THEN concat('import m', l_partkey)
                  WHEN l_returnflag = 'N' THEN concat('from m', l_partkey, '.sub import f')
                  ELSE concat('import m', l_partkey, ',m', l_partkey + 1) END AS line
              FROM items) l
        GROUP BY id
        UNION ALL SELECT id, content FROM blank""",
    ),
    "go_contents": (
        ("items", "blank"),
        """
        SELECT id, CASE kind
            WHEN 0 THEN concat('package m', chr(10), body, chr(10), 'var q = "github.com/q/q"')
            WHEN 2 THEN concat('package m', chr(10), 'import (', body, ')', chr(10),
              'var q = "github.com/q/q/r"', chr(10), 'foo()', chr(10), 'bar("github.com/no/no")')
            WHEN 3 THEN replace(block, chr(10), chr(13) || chr(10))
            WHEN 4 THEN concat('package m', chr(10), 'var q = (', chr(10), body, chr(10), ')')
            ELSE block END AS content
        FROM (SELECT *, concat('package m', chr(10), 'import (', chr(10), body, chr(10), ')') AS block
          FROM (SELECT id, kind, string_agg(line, chr(10) ORDER BY line) AS body
            FROM (SELECT id, kind, CASE
                    WHEN kind = 0 THEN concat('import ', path)
                    WHEN kind = 1 AND form = 1 THEN concat(chr(9), '// ', path)
                    WHEN kind = 1 THEN concat(chr(9), path, ' // (as "github.com/a/b")')
                    ELSE concat(chr(9), path) END AS line
                  FROM (SELECT id, kind, form,
                          concat(CASE l_returnflag WHEN 'N' THEN 'x ' ELSE '' END,
                            CASE form WHEN 0 THEN '"gopkg.in/' ELSE '"github.com/' END,
                            CASE WHEN c_custkey IS NULL THEN 'ext' ELSE concat('u', c_nationkey) END,
                            '/m', l_partkey, CASE l_returnflag WHEN 'A' THEN '/sub' ELSE '' END,
                            '"') AS path
                        FROM items LEFT JOIN customer ON c_custkey = l_partkey) p) l
            GROUP BY id, kind) b) c
        UNION ALL SELECT id, content FROM blank""",
    ),
    "files": (
        (),
        """
        SELECT o_orderkey AS id, concat('u', c_nationkey, '/m', c_custkey) AS repo_name,
               concat('src/m', o_orderkey % 2000, '/', CASE WHEN o_orderkey % 5 = 0
                 THEN concat('m', o_orderkey * 7 % 2000) ELSE concat('f', o_orderkey) END, '.py') AS path
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "rivals": (
        (),
        """
        SELECT concat('s', s_nationkey) AS "user", concat(prefix, s_suppkey) AS repo_name,
               CAST(0 AS BIGINT) AS num_bytes, CAST(floor(abs(s_acctbal)) AS INT) AS stars, 0 AS fork
        FROM supplier, (VALUES ('m'), ('m' || chr(252))) n(prefix)""",
    ),
    "repos": (
        ("rivals",),
        """
        SELECT concat('u', c_nationkey) AS "user", concat('m', c_custkey) AS repo_name,
               CAST(0 AS BIGINT) AS num_bytes, CAST(floor(abs(c_acctbal)) AS INT) AS stars,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS fork
        FROM customer
        UNION ALL SELECT * FROM rivals""",
    ),
    "repo_lines": (
        ("repos",),
        """
        SELECT *, CASE stars % 10
            WHEN 3 THEN concat("user", ',', repo_name, ',0,many,', fork)
            WHEN 5 THEN concat("user", ',', repo_name, ',0,', stars)
            WHEN 7 THEN concat("user", ',', repo_name, ',0,', stars, ',', fork, ',x') END AS record,
          CASE stars % 10 WHEN 3 THEN 'value' ELSE 'fields' END AS reason
        FROM repos""",
    ),
    "stopwords": (
        (),
        "SELECT concat('m', p_partkey) AS name FROM part WHERE p_partkey % 101 = 7",
    ),
    "py_captures": (
        ("py_contents",),
        """
        SELECT id, name FROM (
          SELECT id, regexp_extract(line, '^(?:import|from)[\t ]+([^. ]+)', 1) AS name
          FROM (SELECT id, unnest(string_split(content, chr(10))) AS line FROM py_contents) l) c
        WHERE name <> ''""",
    ),
    "py_deps": (
        ("py_captures",),
        """
        SELECT id, dep FROM (SELECT id, unnest(string_split(name, ',')) AS dep FROM py_captures) d
        WHERE dep <> ''""",
    ),
    "py_names": (
        ("files", "py_captures"),
        """
        SELECT DISTINCT repo_name AS repo,
               unnest(string_split(substr(path, 1, length(path) - 2), '/')) AS name
        FROM files WHERE id IN (SELECT id FROM py_captures)""",
    ),
    "repo_deps": (
        ("files", "py_deps"),
        "SELECT DISTINCT repo_name AS repo, dep FROM files JOIN py_deps USING (id)",
    ),
    "external": (
        ("repo_deps", "py_names"),
        "SELECT repo, dep FROM repo_deps EXCEPT SELECT repo, name FROM py_names",
    ),
    "dim": (
        ("repos", "stopwords"),
        """
        SELECT "user", repo_name, stars, CASE WHEN fork = 0 THEN 1 ELSE 0 END AS notfork
        FROM repos WHERE repo_name NOT IN (SELECT name FROM stopwords)""",
    ),
    "best": (
        ("dim",),
        """
        SELECT repo_name AS dep, concat("user", '/', repo_name) AS dst FROM (
          SELECT "user", repo_name, row_number() OVER (PARTITION BY repo_name ORDER BY
            CAST(coalesce(stars, 1) AS BIGINT) * coalesce(notfork, 1) DESC, "user") AS place
          FROM dim) r
        WHERE place = 1""",
    ),
    "py_edges": (
        ("external", "best"),
        "SELECT dst, repo AS src FROM external JOIN best USING (dep) WHERE repo <> dst",
    ),
    "known": (
        ("external", "best"),
        "SELECT repo, dep FROM external WHERE dep IN (SELECT dep FROM best)",
    ),
    "pairs": (
        ("known",),
        """
        SELECT a.dep AS dep1, b.dep AS dep2, count(*) AS cnt
        FROM known a JOIN known b ON a.repo = b.repo AND a.dep < b.dep GROUP BY 1, 2""",
    ),
    "partners": (
        ("pairs",),
        """
        SELECT dep1, dep2, cnt, place - 1 AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY dep1 ORDER BY cnt DESC, dep2) AS place
          FROM (SELECT dep1, dep2, cnt FROM pairs
                UNION ALL SELECT dep2, dep1, cnt FROM pairs) d) p
        WHERE place <= 20""",
    ),
    "top_pairs": (
        ("pairs",),
        """
        SELECT row_number() OVER (ORDER BY cnt DESC, dep1, dep2) - 1 AS rank, dep1, dep2, cnt,
               concat(cnt, ': ', dep1, ', ', dep2) AS label
        FROM pairs ORDER BY cnt DESC, dep1, dep2 LIMIT 20""",
    ),
    "go_lines": (
        ("go_contents",),
        r"""
        SELECT id, lines, list_position(
            list_transform(lines, lambda x: regexp_matches(x, '^[ \t\v\f]*import')), true) AS first
        FROM (SELECT id, list_filter(regexp_split_to_array(content, '[\r\n]'), lambda x: x <> '')
                AS lines FROM go_contents) l""",
    ),
    "go_items": (
        ("go_lines",),
        r"""
        SELECT id, CASE WHEN block THEN
            list_concat([opener], CASE WHEN stop > 0 THEN rest[:stop] ELSE rest END)
          ELSE [split_part(opener, '(', 1)] END AS items
        FROM (SELECT *, list_position(list_transform(rest, lambda x: suffix(x, ')')), true) AS stop
          FROM (SELECT id, regexp_matches(lines[first], '^[ \t\v\f]*import[ \t\v\f]*\(') AS block,
              split_part(regexp_extract(lines[first], '^[ \t\v\f]*import[ \t\v\f]*\(?(.*)$', 1),
                '//', 1) AS opener,
              list_transform(lines[first + 1:], lambda x:
                regexp_replace(split_part(x, '//', 1), '[ \t\v\f]+$', '')) AS rest
            FROM go_lines WHERE first > 0) a) b""",
    ),
    "go_deps": (
        ("go_items",),
        r"""
        SELECT id, dst FROM (
          SELECT id, regexp_extract(regexp_extract(item, '.*"(.*)"', 1),
            '^github\.com/([^/]*/[^/]*)', 1) AS dst
          FROM (SELECT id, unnest(items) AS item FROM go_items) i) d
        WHERE dst <> ''""",
    ),
    "go_edges": (
        ("files", "go_deps"),
        "SELECT DISTINCT dst, repo_name AS src FROM files JOIN go_deps USING (id)",
    ),
}

_GRAPH = {
    "degrees": (("edges",), "SELECT dst, count(*) AS degree FROM edges GROUP BY dst"),
    "neighbors": (
        ("edges", "degrees"),
        """
        SELECT dst, src, degree, place - 1 AS rank FROM (
          SELECT e.dst, e.src, coalesce(d.degree, 0) AS degree, row_number() OVER (
            PARTITION BY e.dst ORDER BY coalesce(d.degree, 0) DESC, e.src) AS place
          FROM edges e LEFT JOIN degrees d ON d.dst = e.src) n
        WHERE place <= 5""",
    ),
    "links": (
        ("neighbors",),
        """
        SELECT dst AS root, dst AS source, src AS target FROM neighbors
        UNION
        SELECT a.dst, b.dst, b.src FROM neighbors a JOIN neighbors b ON a.src = b.dst""",
    ),
    "nodes": (
        ("neighbors", "degrees"),
        """
        SELECT dst AS root, dst AS repo, degree FROM degrees
        UNION
        SELECT dst, src, degree FROM neighbors
        UNION
        SELECT a.dst, b.src, b.degree FROM neighbors a JOIN neighbors b ON a.src = b.dst""",
    ),
    "top": (
        ("degrees",),
        """
        SELECT row_number() OVER (ORDER BY degree DESC, dst) - 1 AS rank, dst, degree
        FROM degrees ORDER BY degree DESC, dst LIMIT 5""",
    ),
    "top_links": (
        ("links", "top"),
        "SELECT rank, source, target FROM links JOIN top ON root = dst",
    ),
    "merged_nodes": (
        ("nodes", "top"),
        """SELECT DISTINCT repo AS id, nodes.degree AS "group" FROM nodes JOIN top ON root = dst""",
    ),
    "merged_links": (("top_links",), "SELECT DISTINCT source, target FROM top_links"),
}


def _sql(body: str, *steps: str, edges: str | None = None) -> str:
    """`body` with the steps it reads, and theirs, as common table expressions."""
    known = {**_STEPS, **_GRAPH}
    if edges is not None:
        known["edges"] = ((edges,), f"SELECT dst, src FROM {edges}")
    ordered: list[str] = []

    def add(step: str) -> None:
        for needed in known[step][0]:
            add(needed)
        if step not in ordered:
            ordered.append(step)

    for step in steps:
        add(step)
    listed = ",\n".join(f"{step} AS MATERIALIZED ({known[step][1]})" for step in ordered)
    return f"WITH {listed}\n{body}"


def _table(step: str, columns: str, edges: str | None = None) -> str:
    return _sql(f"SELECT {columns} FROM {step}", step, edges=edges)


_ADJACENCY = """
SELECT dst, part, string_agg(src, ',' ORDER BY src) AS srcs, degree FROM (
  SELECT e.dst, e.src, d.degree, CAST('0x' || substr(md5(e.src), 1, 8) AS BIGINT)
    % CAST(ceil(d.degree / 50.0) AS BIGINT) AS part
  FROM edges e JOIN degrees d USING (dst)) p
GROUP BY dst, part, degree"""

# The result tables of a job in one: (name, a, b, n, rank).
_GRAPH_ROWS = """
        SELECT 'neighbors' AS name, dst AS a, src AS b, CAST(NULL AS BIGINT) AS n,
               CAST(NULL AS BIGINT) AS rank FROM edges
        UNION ALL SELECT 'top_repos', dst, NULL, degree, rank FROM top
        UNION ALL SELECT 'flowers', root, concat(source, ' ', target), NULL, NULL FROM links
        UNION ALL SELECT 'top_flowers', source, target, NULL, rank FROM top_links
        UNION ALL SELECT 'counts', 'K', NULL, count(*), NULL FROM top"""

ORACLE_SQL = {
    "py_import_lines": _table("py_deps", "id, dep"),
    "py_path_names": _table("py_names", "repo, name"),
    "py_repo_deps": _table("repo_deps", "repo, dep"),
    "py_external_deps": _table("external", "repo, dep"),
    "py_external_deps_by_file_name": _sql(
        """
        SELECT repo, dep FROM repo_deps EXCEPT
        SELECT repo_name, unnest(string_split(substr(path, 1, length(path) - 3), '/')) FROM files
        WHERE id IN (SELECT id FROM py_captures)""",
        "repo_deps",
    ),
    "repo_dimension": _table("dim", '"user", repo_name, stars, notfork'),
    "best_repo_per_name": _table("best", "dep, dst"),
    "py_edges": _table("py_edges", "dst, src"),
    "py_adjacency": _sql(_ADJACENCY, "edges", "degrees", edges="py_edges"),
    "py_top_repos": _table("top", "rank, dst, degree", edges="py_edges"),
    "py_top_neighbors": _table("neighbors", "dst, src, degree, rank", edges="py_edges"),
    "py_flower_nodes": _table("nodes", "root, repo, degree", edges="py_edges"),
    "py_flower_links": _table("links", "root, source, target", edges="py_edges"),
    "py_top_flowers": _table("top_links", "rank, source, target", edges="py_edges"),
    "py_merged_nodes": _table("merged_nodes", 'id, "group"', edges="py_edges"),
    "py_merged_links": _table("merged_links", "source, target", edges="py_edges"),
    "py_known_deps": _table("known", "repo, dep"),
    "py_pair_counts": _table("pairs", "dep1, dep2, cnt"),
    "py_pair_maps": _sql(
        """
        SELECT dep1, CAST('0x' || substr(md5(dep2), 1, 8) AS BIGINT) % CAST(ceil(n / 50.0) AS BIGINT) AS part,
               dep2, cnt
        FROM (SELECT *, count(*) OVER (PARTITION BY dep1) AS n FROM (
          SELECT dep1, dep2, cnt FROM pairs UNION ALL SELECT dep2, dep1, cnt FROM pairs) b) p""",
        "pairs",
    ),
    "py_top_partners": _table("partners", "dep1, dep2, cnt, rank"),
    "py_top_partners_split": _table("partners", "dep1, dep2, cnt, rank"),
    "py_top_pairs": _table("top_pairs", "rank, dep1, dep2, cnt, label"),
    "go_imports": _table("go_deps", "id, dst"),
    "go_outer_join": _sql(
        """
        SELECT coalesce(f.id, d.id) AS id, f.repo_name AS repo, d.n_deps
        FROM files f FULL JOIN (SELECT id, count(*) AS n_deps FROM go_deps GROUP BY id) d
        ON f.id = d.id""",
        "files",
        "go_deps",
    ),
    "go_edges": _table("go_edges", "dst, src"),
    "go_edges_with_orphans": _sql(
        "SELECT DISTINCT dst, repo_name AS src FROM go_deps LEFT JOIN files USING (id)",
        "files",
        "go_deps",
    ),
    "go_top_repos": _table("top", "rank, dst, degree", edges="go_edges"),
    "go_flower_links": _table("links", "root, source, target", edges="go_edges"),
    "go_top_flowers": _table("top_links", "rank, source, target", edges="go_edges"),
    "flower_lookup": _sql(
        """
        SELECT root, source, target FROM links
        WHERE root IN (SELECT concat(r."user", '/', r.repo_name) FROM rivals r)""",
        "links",
        "rivals",
        edges="py_edges",
    ),
    "cooccur_lookup": _sql(
        "SELECT dep1, dep2, cnt FROM partners WHERE dep1 IN (SELECT repo_name FROM rivals)",
        "partners",
        "rivals",
    ),
    "flower_documents": _sql(
        """
        SELECT root, source, target, NULL AS id, CAST(NULL AS BIGINT) AS "group" FROM links
        UNION ALL SELECT root, NULL, NULL, repo, degree FROM nodes""",
        "links",
        "nodes",
        edges="py_edges",
    ),
    "partner_documents": _sql(
        """
        SELECT dep1, concat('{"cooccurs":[', string_agg(
          concat('[', CAST(to_json(dep2) AS VARCHAR), ',', cnt, ']'), ',' ORDER BY rank), ']}') AS document
        FROM partners GROUP BY dep1""",
        "partners",
    ),
    "py_known_ascii_deps": _sql(
        "SELECT repo, dep FROM known WHERE strlen(dep) = length(dep)", "known"
    ),
    "go_adjacency": _sql(_ADJACENCY, "edges", "degrees", edges="go_edges"),
    "python_job": _sql(
        _GRAPH_ROWS
        + """
        UNION ALL SELECT 'repos', "user", repo_name, stars, notfork FROM dim
        UNION ALL SELECT 'cooccurs', dep1, dep2, cnt, rank FROM partners
        UNION ALL SELECT 'top_cooccurs', dep1, dep2, cnt, rank FROM top_pairs
        UNION ALL SELECT 'counts', 'B', NULL, count(*), NULL FROM top_pairs""",
        "edges", "top", "links", "top_links", "dim", "partners", "top_pairs",
        edges="py_edges",
    ),
    "go_job": _sql(
        _GRAPH_ROWS
        + """
        UNION ALL SELECT 'repos', "user", repo_name, NULL, NULL FROM repos""",
        "edges", "top", "links", "top_links", "repos",
        edges="go_edges",
    ),
    "result_counts": _sql(
        """
        SELECT 'K' AS name, count(*) AS n FROM top
        UNION ALL SELECT 'B', count(*) FROM top_pairs
        UNION ALL SELECT 'repos', count(*) FROM dim""",
        "top",
        "top_pairs",
        "dim",
        edges="py_edges",
    ),
    "language_edges": _sql(
        """
        SELECT 'python' AS lang, dst, src FROM py_edges
        UNION ALL SELECT 'go', dst, src FROM go_edges""",
        "py_edges",
        "go_edges",
    ),
    "repos_accepted": _sql(
        """SELECT "user", repo_name, num_bytes, stars, fork FROM repo_lines WHERE record IS NULL""",
        "repo_lines",
    ),
    "repos_rejected": _sql(
        "SELECT record, reason FROM repo_lines WHERE record IS NOT NULL", "repo_lines"
    ),
    "graph_json": _sql(
        """
        SELECT CAST(to_json(struct_pack(
          nodes := (SELECT list(struct_pack(id := id, "group" := "group") ORDER BY id, "group")
                    FROM merged_nodes),
          links := (SELECT list(struct_pack(source := source, target := target)
                    ORDER BY source, target) FROM merged_links))) AS VARCHAR) AS document""",
        "merged_nodes",
        "merged_links",
        edges="py_edges",
    ),
    "pairs_json": _sql(
        """
        SELECT CAST(to_json(struct_pack(cooccurs := list(label ORDER BY rank))) AS VARCHAR)
          AS document FROM top_pairs""",
        "top_pairs",
    ),
}
