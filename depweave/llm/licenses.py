"""Licence texts by canonical digest.

A text is put in canonical form: lower case, copyright lines left out, equivalent spellings made one,
and all but letters and digits dropped. Whole canonical texts are then looked up by SHA-256 among the
digests of known licences, in hash joins. Everything is built of SQL functions.

Three forms are looked up, the first that is known counts: the canonical one, whose digest is a column
of the result; the body, without what stands before it (titles and copyright notices, each up to the
end of its sentence or line, whatever follows); and the plain text with nothing left out. The last two
don't depend on how a text is broken into lines, but for a notice that goes over a line's end.

Defined cases: a null or empty text, or one with nothing but copyright notices, has no licence (the
digest of such lines is that of the empty text). A text that is equal in one form to several known
ones gets the smallest name. Repeated rows each have a row. A licence inside a longer text is not a
whole text and is not found.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that the licence-matching guidelines of SPDX take as equal.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("whilst", "while"),
    ("http://", "https://"),
)
COPYRIGHT_LINE = "(?m)^[^\\n\\p{L}\\p{N}]*(?:copyright|\\(c\\)|©)[^\\n]*$"
OTHER = "[^\\p{L}\\p{N}]+"

# How bodies begin; a notice ends there at the latest, and at a full stop that ends no abbreviation.
_START = (
    r"\s*(?:permission\s+(?:is\s+hereby|to\s+use)|redistribution\s+and\s+use|licensed\s+under"
    r"|this\s+(?:software|program|library)\s+is|everyone\s+is\s+permitted|all\s+rights\s+reserved)\b"
)
_STOP = r"(?<=[\p{L}\p{N})>\]]{2})(?<!\b(?:inc|ltd|llc|corp|co|jr|sr|al))\.(?=\s|$)"
# A year, or both the word and the sign, makes a notice: no "copyright holders", no item "(c)".
_NOTICE = (
    r"(?:copyright[ \t]*+(?:\(c\)|©)(?![\p{L}\p{N}])|(?:copyright|\(c\)|©)"
    r"(?=[ \t:]*+[<\[(]?+(?:\p{N}{4}|yyyy|year)))"
    rf"[^\n]*?(?:{_STOP}|(?=\n|$|{_START}))"
)
_RESERVED = r"all\s+rights\s+reserved\b"
_TITLE = (
    r"(?:(?:the\s+)?(?:(?:mit|expat|x11|isc|0bsd|bsd\s+zero[\s-]+clause"
    r"|(?:(?:new|modified|revised|simplified)\s+)?bsd(?:\s+[23][\s-]+clause)?)\s+licen[sc]e"
    r"(?:\s*\((?:mit|expat|x11|mit/x11|isc|0bsd)\))?|unlicense)"
    r"|apache\s+license,?\s+version\s+2\.0(?:,\s+january\s+2004)?(?:\s+https?://www\.apache\.org/licenses/?)?"
    r"|gnu\s+(?:(?:lesser|library)\s+)?general\s+public\s+license\s+version\s+[0-9.]+,\s+(?:[0-9]+\s+)?[a-z]+\s+[0-9]{4}"
    r"|mozilla\s+public\s+license,?\s+version\s+[0-9.]+)(?![\p{L}\p{N}])"
)
# At most 200 of them, so that the matcher's stack is bounded.
BEFORE_BODY = rf"\A(?:[^\p{{L}}\p{{N}}(©]++|{_TITLE}|{_NOTICE}|{_RESERVED}){{0,200}}+"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.regexp_replace(out, OTHER, "")


def _letters(lowered: Column) -> Column:
    """Letters and digits in one spelling, also of words that a line's end or a hyphen parts."""
    out = F.replace(lowered, F.lit("http://"), F.lit("https://"))
    out = F.regexp_replace(out, OTHER, "")
    for one, other in SPELLINGS:
        one, other = (re.sub("[^a-z]", "", spelling) for spelling in (one, other))
        if one not in other:
            out = F.replace(out, F.lit(one), F.lit(other))
    return out


def body(text: Column) -> Column:
    return _letters(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BEFORE_BODY, ""))


def plain(text: Column) -> Column:
    return _letters(F.lower(F.coalesce(text, F.lit(""))))


FORMS = (canonical, body, plain)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(texts: DataFrame) -> DataFrame:
    """(digest, license) of known licences (name, text) in all forms; empty ones are no licence."""
    forms = F.explode(F.array(*[form(F.col("text")) for form in FORMS])).alias("form")
    return (
        texts.where(F.col("name").isNotNull())
        .select("name", forms)
        .where(F.col("form") != "")
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("name").alias("license"))
    )


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, license), one row per row of `docs`; license is null if the text is none of
    the known ones (digest, license) in any form. Whether `known` is broadcast is left to its size."""
    rows = docs.select(
        "doc_id", *[F.sha2(form(F.col("text")), 256).alias(f"_{form.__name__}") for form in FORMS]
    )
    for form in FORMS:
        name = f"_{form.__name__}"
        found = known.select(F.col("digest").alias(name), F.col("license").alias(f"{name}_license"))
        rows = rows.join(found, name, "left")
    license_ = F.coalesce(*[f"_{form.__name__}_license" for form in FORMS])
    return rows.select("doc_id", F.col("_canonical").alias("digest"), license_.alias("license"))


# Short public licences and the usual one-line notices.
TEXTS = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "notice: Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "notice: CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "notice: GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "notice: MIT": "Released under the MIT License.",
}


_END = "END OF TERMS AND CONDITIONS"


def whole_texts() -> list[tuple[str, str]]:
    """(name, text) of the files in `license_texts`, named by their SPDX identifiers without "only"
    or "or later". What comes after the terms, and numbers of list items in BSD, may be left out."""
    out = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        name, text = file.stem.split(" (")[0], file.read_text(encoding="utf-8")
        out.append((name, text))
        if _END in text:
            out.append((name, text[: text.index(_END) + len(_END)]))
            out.append((name, text[: text.index(_END)]))
        if name.startswith("BSD"):
            out.append((name, re.sub(r"(?m)^\s*\d\.\s", "", text)))
    return out


def built_in(spark: SparkSession) -> DataFrame:
    """(name, text) of `TEXTS` and `whole_texts`; other lists are passed to `known_digests` in the
    same form."""
    rows = sorted(TEXTS.items()) + whole_texts()
    return spark.createDataFrame(rows, "name string, text string")
