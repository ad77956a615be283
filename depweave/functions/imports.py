"""Import extraction as regular expressions over the whole text of a file.

A file is never cut into an array of lines: one pass of a compiled pattern inside the generated
code reads it, so a megabyte of source costs no per-line row and no per-line object. All patterns
repeat single characters only, which the JVM matches in a loop, not by recursion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an import in a Python file. An import stands in column 0 of a line
# ending with \n, and its name runs to the first dot or space.
_PY_IMPORT = r"(?md)^(?:import|from)[\t ]+([^. \n]+)"
_PY_IMPORT_NO_CR = r"(?md)^(?:import|from)[\t ]+([^. \r\n]+)"

# Characters of a Go file. Lines end with \r or \n. _BLANK is white space before a
# keyword; _TRAILING is all Unicode white space (but line ends) that may follow the last
# character of a line.
_BLANK = r"[ \t\x0B\f]*"
_TRAILING = (
    r"[ \t\x0B\f\x1C-\x1F\x85\xA0\x{1680}\x{180E}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*"
)
_LINE_END = r"(?:[\r\n]|\z)"

_GO_COMMENT = r"//[^\r\n]*"

# The first line that starts with `import`. Followed by a parenthesis it opens a block, which
# holds the rest of that line and all later lines through the first one ending with a closing
# parenthesis (or to the end of the file); otherwise it is the one line, up to a parenthesis.
_GO_DECLARATION = (
    rf"(?:\A|[\r\n]){_BLANK}import"
    rf"({_BLANK}\([^\r\n]*(?:[\r\n](?s:.*?)(?:\){_TRAILING}{_LINE_END}|\z))?"
    r"|[^(\r\n]*)"
)

GO_HOST = "github.com/"

# Text between the last two quotes of a line, cut to the two path parts after the host.
_GO_REPO = r'"github\.com/([^/"\r\n]*/[^/"\r\n]*)[^"\r\n]*"[^"\r\n]*(?=[\r\n]|\z)'


def python_import_text(content: str, strip_cr: bool = False) -> Column:
    """The names imported by a Python file as one text, parted by commas; empty when there are none.

    `import a, b` captures `a,` and so ends in an empty name.
    """
    pattern = _PY_IMPORT_NO_CR if strip_cr else _PY_IMPORT
    return F.array_join(F.regexp_extract_all(content, F.lit(pattern), F.lit(1)), ",")


def split_names(import_text: str) -> Column:
    """The names in a non-empty `python_import_text`, empty ones too, as an array."""
    return F.split(import_text, ",")


def go_import_repos(content: str) -> Column:
    """Repositories `user/name` in the first import declaration of a Go file, in order, as an
    array with its duplicates. Paths on other hosts are left out."""
    has_comment = F.contains(F.col(content), F.lit("//"))
    code = F.when(has_comment, F.regexp_replace(content, _GO_COMMENT, "")).otherwise(F.col(content))
    declaration = F.regexp_extract(code, _GO_DECLARATION, 1)
    return F.regexp_extract_all(declaration, F.lit(_GO_REPO), F.lit(1))


def path_tokens(path: str, suffix_len: int = 2) -> Column:
    """Folder and file names on a path after its last `suffix_len` characters are cut off.

    With 2 a name `x.py` keeps its dot and so never equals an import, and only folders count;
    with 3 file names count as well.
    """
    length = F.greatest(F.length(path) - F.lit(suffix_len), F.lit(0))
    return F.split(F.substring(F.col(path), F.lit(1), length), "/")
