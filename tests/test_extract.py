"""Names found in literal lines and files, and random files against line-by-line SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from depweave.functions import path_tokens
from depweave.operators import extract, graph
from oracle_queries import _STEPS

CONTENT = "id long, content string"

PYTHON_LINES = {
    "import os": ["os"],
    "import os.path": ["os"],
    "import a,b": ["a", "b"],
    "import a, b": ["a"],
    "from x.y import z": ["x"],
    "from the docs": ["the"],
    "from . import q": [],
    " import os": [],
    "importx": [],
    "import os\r": ["os\r"],
    "import\tos\t#c": ["os\t#c"],
    "": [],
    "import": [],
    "import été.x": ["été"],
    "import a\N{NO-BREAK SPACE}b": ["a\N{NO-BREAK SPACE}b"],
}

GO_FILES = {
    'package m\nimport (\n\t"fmt"\n\tx "github.com/u/a/sub" // c\n\t"github.com/u/b"\n)\n'
    'func f() { y("github.com/z/z") }': ["u/a", "u/b"],
    'package m\r\nimport "github.com/u/a"\r\nimport "github.com/u/b"': ["u/a"],
    'import ("github.com/u/a")\nvar q = "github.com/q/q/r"\nfoo()\nbar("github.com/no/no")': [
        "u/a",
        "q/q",
    ],
    'import (\n"github.com/u/a"': ["u/a"],
    'import (\n"github.com/onlyuser"\n"gopkg.in/x/y")': [],
    'import (\n\t// "github.com/u/c"\n\t_ "github.com/u/d/e/f")': ["u/d"],
    'import ( "github.com/u/a"\n"github.com/u/a/two"\n)': ["u/a", "u/a"],
    'importX "github.com/u/a"': ["u/a"],
    "package m": [],
    "": [],
    'import (\n"github.com/u/a"\n)\xa0\n"github.com/u/late"\n)': ["u/a"],
    'import (\n"github.com/u/a" "x"\n"x" "github.com/u/b"\n)': ["u/b"],
    'import (\n"github.com/u//late"\n"github.com/u/"\n)': ["u/"],
}


@pytest.fixture(scope="module")
def python_contents(spark):
    rows = [*enumerate(PYTHON_LINES), (100, None), (101, "x = 1\nimport os\n\nimport sys\nimport os")]
    return spark.createDataFrame(rows, CONTENT)


def names_by_id(flat, column):
    found = {}
    for row in flat.collect():
        found.setdefault(row["id"], []).append(row[column])
    return found


def test_python_lines(python_contents):
    found = names_by_id(extract.python_deps(python_contents), "dep")
    expected = {i: names for i, names in enumerate(PYTHON_LINES.values()) if names}
    assert found == {**expected, 101: ["os", "sys", "os"]}


def test_python_imports_are_distinct_and_keep_nameless_files(spark):
    rows = [(1, "import a\nimport a"), (2, "import , a"), (3, "x = 1")]
    found = extract.python_imports(spark.createDataFrame(rows, CONTENT)).collect()
    assert {row["id"]: row["deps"] for row in found} == {1: ["a"], 2: [""]}


def test_strip_cr(spark):
    rows = spark.createDataFrame([(1, "import os\r\nimport a,b\r\n")], CONTENT)
    assert names_by_id(extract.python_deps(rows, strip_cr=True), "dep") == {1: ["os", "a", "b"]}


def test_go_files(spark):
    contents = spark.createDataFrame([*enumerate(GO_FILES), (100, None)], CONTENT)
    found = {row["id"]: row["deps"] for row in extract.go_deps(contents).collect()}
    assert found == {i: deps for i, deps in enumerate(GO_FILES.values()) if deps}


def test_random_files_equal_line_by_line_sql(spark):
    pieces = [
        "import (",
        "import",
        " import",
        "\timport(",
        '"github.com/u/a"',
        'x "github.com/u/b/c"',
        '"github.com/only"',
        '"fmt"',
        "// note",
        ")",
        ") ",
        "f()",
        "package m",
        "from p.q import r",
        "import a,b",
        "import a, b",
        "import os.path",
        "from . import q",
    ]
    dice = random.Random(7)

    def text():
        ends = ["\n", "\n", "\n", "\r\n", "\r", "\n\n"]
        lines = (
            dice.choice(["", "", " "]).join(dice.choices(pieces, k=dice.randint(1, 3)))
            for _ in range(dice.randint(0, 9))
        )
        return "".join(line + dice.choice(ends) for line in lines)

    rows = [(i, text()) for i in range(3000)]
    contents = spark.createDataFrame(rows, CONTENT)
    connection = duckdb.connect()
    for name in ("py_contents", "go_contents"):
        connection.execute(f"CREATE TABLE {name} (id BIGINT, content VARCHAR)")
        connection.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    for name in ("py_captures", "py_deps", "go_lines", "go_items", "go_deps"):
        connection.execute(f"CREATE VIEW {name} AS {_STEPS[name][1]}")
    ours = extract.python_deps(contents).collect()
    theirs = connection.execute("SELECT id, dep FROM py_deps").fetchall()
    assert sorted(tuple(row) for row in ours) == sorted(theirs) and theirs
    ours = extract.go_deps(contents).select("id", F.explode("deps")).collect()
    theirs = connection.execute("SELECT id, dst FROM go_deps").fetchall()
    assert sorted(tuple(row) for row in ours) == sorted(theirs) and theirs


def test_long_lines_and_many_quotes(spark):
    """Deep recursion or quadratic search in a pattern would show here."""
    million = 1_000_000
    rows = [
        (1, "x" * million + "\nimport os\n" + "import " + "y" * million),
        (2, 'import (\n"github.com/u/a"\n' + '"' * million + "\n" + "(" * million + "\n)"),
        (3, "import (\n" + '"github.com/u/a"\n' * 50_000 + ")"),
        (4, " " * million + "\n" + "/" * million + '\nimport "github.com/u/a"' + ")" * million),
    ]
    contents = spark.createDataFrame(rows, CONTENT)
    assert extract.python_deps(contents).where("id = 1").count() == 2
    sizes = extract.go_deps(contents).select("id", F.size("deps").alias("n")).collect()
    assert {row["id"]: row["n"] for row in sizes} == {2: 1, 3: 50_000, 4: 1}


def test_path_tokens(spark):
    paths = spark.createDataFrame([("src/m/f.py",), ("f.py",), ("a",), ("",)], "path string")
    two = [row[0] for row in paths.select(path_tokens("path")).collect()]
    assert two == [["src", "m", "f."], ["f."], [""], [""]]
    three = [row[0] for row in paths.select(path_tokens("path", 3)).collect()]
    assert three[0] == ["src", "m", "f"]


def test_outside_names_only(spark):
    """A name is inside when a file with imports of the same repository lies under it."""
    files = spark.createDataFrame(
        [(1, "r", "pkg/a.py"), (2, "r", "other/b.py"), (1, "s", "x.py"), (3, "s", "pkg/c.py")],
        "id long, repo_name string, path string",
    )
    contents = spark.createDataFrame(
        [(1, "import pkg\nimport other\nimport a"), (2, "pass"), (3, "import ,")], CONTENT
    )
    imports = extract.python_imports(contents)
    found = sorted(tuple(row) for row in graph.external_deps(files, imports).collect())
    # The nameless import of content 3 makes its folder count, the file without imports does not.
    assert found == [("r", "a"), ("r", "other"), ("s", "a"), ("s", "other")]
    stop = spark.createDataFrame([("a",), ("pkg",)], "name string")
    fewer = graph.external_deps(files, imports, unresolvable=stop).collect()
    assert sorted(tuple(row) for row in fewer) == [("r", "other"), ("s", "other")]
    by_name = graph.external_deps(files, imports, suffix_len=3).collect()
    assert sorted(tuple(row) for row in by_name) == [("r", "other"), ("s", "a"), ("s", "other")]
