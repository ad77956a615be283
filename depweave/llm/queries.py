"""The operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stages import LatestStages
from . import (
    byte_bpe,
    chat,
    decontaminate,
    exact_dedup,
    importance,
    language,
    licenses,
    near_dedup,
    ngram_join,
    substring_dedup,
    token_count,
    toxicity,
    vector_codes,
)

_LATEST = LatestStages()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    stage = _LATEST.of(spark, "op1").write
    return toxicity.scores(docs, toxicity.fit(docs, labels, stage))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return substring_dedup.decisions(docs, _LATEST.of(spark, "op2").write)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_bpe.encode_and_decode(docs, "byte_bpe_multi_50k.tiktoken")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select(more.columns).unionByName(more)
    return chat.read_back(chat.format_events(chat.events_of(rows)))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = licenses.known_digests(licenses.built_in(spark))
    return licenses.scan(_table(spark, sf_dir, "documents"), known)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return near_dedup.decisions(docs, _LATEST.of(spark, "op8").write)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return exact_dedup.decisions(docs, _LATEST.of(spark, "op9").write)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contamination(docs, benchmark)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ngram_join.join_groups(docs, _LATEST.of(spark, "op11").write)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vector_codes.code_table(vectors, _LATEST.of(spark, "op12").write)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return importance.resampled(docs, benchmark, _LATEST.of(spark, "op13").write)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_substring_dedup,
        op3_token_counts,
        op4_language,
        op5_byte_bpe,
        op6_chat,
        op7_licenses,
        op8_near_dedup,
        op9_exact_dedup,
        op10_decontamination,
        op11_ngram_join,
        op12_vector_codes,
        op13_importance,
    )
}

_ESCAPED = "replace({}, chr(92), chr(92) || chr(92))"
for _control in chat.CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}' || chr(92) || '{_control[1:]}')"

_CANONICAL = f"regexp_replace(lower(coalesce(text, '')), '{licenses.COPYRIGHT_LINE}', '', 'g')"
for _one, _other in licenses.SPELLINGS:
    _CANONICAL = f"replace({_CANONICAL}, '{_one}', '{_other}')"
_CANONICAL = f"regexp_replace({_CANONICAL}, '{licenses.OTHER}', '', 'g')"
_KNOWN = ", ".join(f"('{name}', '{text}')" for name, text in sorted(licenses.TEXTS.items()))

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)



def _vector_codes_sql() -> str:
    """Eight parts, sixteen entries, six rounds, one after another."""
    steps = []
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, p, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT v.r, v.p, c.e,
      list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d
    FROM parts v JOIN book{k} c ON v.p = c.p) GROUP BY r, p)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""
new{k} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT p, e, i, CAST(floor(CAST(sum(y) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM (
      SELECT p, n.best.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y
      FROM parts JOIN near{k} n USING (r, p)) GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.x, b.x) AS x FROM book{k} b LEFT JOIN new{k} n USING (p, e))""")
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, list_slice(x, p * (len(x) // 8) + 1, (p + 1) * (len(x) // 8)) AS x
  FROM (SELECT r, x, unnest(range(8)) AS p FROM kept)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 16),
{",".join(steps)},
codes AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', n.best.e), '' ORDER BY p) AS code, CAST(sum(n.best.d) AS BIGINT) AS error
  FROM near{last} n GROUP BY r),
digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256 FROM kept JOIN codes USING (r), digest"""


def _groups_sql(percent: int, columns: str) -> str:
    """Groups of documents by Jaccard similarity of four-word shingles; sets that are alike are one."""
    return f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
runs AS (
  SELECT r, array_to_string(list_slice(w, k, k + 3), ' ') AS s FROM (
    SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM docs WHERE len(w) > 0)),
shingles AS MATERIALIZED (SELECT DISTINCT r, s FROM runs),
sets AS MATERIALIZED (
  SELECT r, count(*) AS n, min(r) OVER (PARTITION BY string_agg(s, chr(10) ORDER BY s)) AS c
  FROM shingles GROUP BY r),
rows_ AS MATERIALIZED (SELECT s, r, n FROM shingles JOIN sets USING (r) WHERE r = c),
pairs AS (
  SELECT a.r AS a, b.r AS b, a.n AS m, b.n AS n, count(*) AS k
  FROM rows_ a JOIN rows_ b ON a.s = b.s AND a.r < b.r
    AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n),
links AS MATERIALIZED (
  SELECT a, b FROM pairs WHERE 100 * k >= {percent} * (m + n - k)
  UNION SELECT b, a FROM pairs WHERE 100 * k >= {percent} * (m + n - k)),
reach AS (
  SELECT r AS a, r AS b FROM sets WHERE r = c
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT c, min(doc_id) AS least FROM sets JOIN docs USING (r) GROUP BY c),
groups AS (SELECT a AS c, min(least) AS component_id FROM reach JOIN least_of ON c = b GROUP BY a)
SELECT {columns} FROM (
  SELECT doc_id, coalesce(n, 0) AS n_shingles,
    CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
  FROM docs LEFT JOIN sets USING (r) LEFT JOIN groups USING (c))"""


_CRC = (
    "xor(list_reduce(list_transform(range(octet_length(encode(word))),"
    " lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),"
    " lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
)

ORACLE_SQL: dict[str, str] = {
    "op8_near_dedup": _groups_sql(80, "*, doc_id = component_id AS kept"),
    "op11_ngram_join": _groups_sql(85, "*"),
    "op12_vector_codes": _vector_codes_sql(),
    "op13_importance": f"""
WITH steps_ AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
doc_words AS MATERIALIZED (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM docs) GROUP BY r, word),
item_words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY word),
placed AS MATERIALIZED (
  SELECT word, {_CRC} % 10000 AS bucket
  FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words), steps_),
s AS (SELECT bucket, sum(n) AS s FROM doc_words JOIN placed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM item_words JOIN placed USING (word) GROUP BY bucket),
gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(
    (CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST((SELECT coalesce(sum(n), 0) FROM doc_words) AS DOUBLE) + 10000)
    / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (CAST((SELECT coalesce(sum(n), 0) FROM item_words) AS DOUBLE) + 10000)))) AS gain
  FROM s FULL JOIN t USING (bucket)),
weights AS (
  SELECT r, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM doc_words JOIN placed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN weights USING (r)),
noisy AS (
  SELECT doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k,
    count(*) FILTER (n_features >= 20) OVER () AS n FROM noisy)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM ranked""",
    "op6_chat": f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
made AS (
  SELECT *, {_ESCAPED.format("role")} AS r, {_ESCAPED.format("text")} AS t FROM rows_)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('{chat.OPEN}' || r || '{chat.MIDDLE}' || t || '{chat.CLOSE}')) AS BIGINT) AS formatted_chars
FROM made GROUP BY conv_id""",
    "op7_licenses": f"""
WITH known AS (
  SELECT sha256({_CANONICAL}) AS digest, min(name) AS license FROM (VALUES {_KNOWN}) k(name, text)
  GROUP BY 1),
docs AS (SELECT doc_id, sha256({_CANONICAL}) AS digest FROM documents)
SELECT doc_id, digest, license FROM docs LEFT JOIN known USING (digest)""",
    "op9_exact_dedup": """
WITH docs AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER best = 1 AS kept, text_sha256
FROM docs WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""",
    "op10_decontamination": f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
cut AS (
  SELECT item_id, w, least(len(w), 10) AS size,
    unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS pos FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS win FROM cut),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos FROM docs, sizes),
hits AS (
  SELECT p.doc_id, p.pos, p.size, x.item_id FROM places p
  JOIN windows x ON x.size = p.size AND x.win = array_to_string(list_slice(p.w, p.pos, p.pos + p.size - 1), ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (
    SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
}
