"""Fits that don't depend on the order of rows, and cases that lost rows or failed before."""

import random

import duckdb
from pyspark.sql import functions as F

from depweave.llm import chat, components, exact_dedup, language, queries, toxicity
from depweave.plans.stages import Stages


def prose(seed, letters, n=12):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_a_language_under_one_doc_id_is_learned(spark):
    rows = [(7, prose(k, "abcde"), "fr") for k in range(1500)]
    rows += [(100 + k, prose(k, "vwxyz"), "en") for k in range(1500)]
    rows += [(9, prose(1, "ñóúíá"), "es")] * 700
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    said = docs.select("lang", language.lang_and_score(docs, model).alias("p"))
    wrong = said.where(F.col("lang") != F.col("p.lang_pred")).count()
    assert wrong < 30


def test_a_fit_of_toxicity_can_be_repeated(spark):
    bad, rows, labels = prose(5, "klmn", 15), [], []
    for k in range(120):
        text = prose(k, "abcdef", 60)
        rows.append((k, text + " " + bad if k % 3 == 0 else text))
        rows.append((k, prose(1000 + k, "abcdef", 40)))
        labels.append((k, 1, int(k % 3 == 0)))
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(1 + len(models) * 4)
        models.append(toxicity.fit(docs, label, Stages(spark).write))
    one, two = models
    assert (one.odds == two.odds).all()
    assert (one.rate, one.log_k, one.offset, one.slope) == (two.rate, two.log_k, two.offset, two.slope)


def brute_segments(scores):
    """Maximal scoring segments by their definition: the best subarray, then those on either side."""
    if not any(s > 0 for s in scores):
        return []
    sums = [(sum(scores[i:j]), i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    _, _, i, j = max(sums, key=lambda s: (s[0], s[1], -s[2]))
    left = brute_segments(scores[:i])
    right = [(a + j, b + j) for a, b in brute_segments(scores[j:])]
    return [*left, (i, j), *right]


def test_segments_are_the_maximal_ones():
    import numpy as np

    for seed in range(60):
        rng = random.Random(seed)
        scores = [rng.uniform(-1, 0.9) for _ in range(rng.randint(0, 25))]
        found = [(a, b) for a, b, _ in toxicity.segments(np.array(scores))]
        assert found == brute_segments(scores)


def test_keep_one_carries_maps_and_arrays(spark):
    docs = spark.createDataFrame(
        [(1, "a b", {"x": 1}, [1]), (2, "ab", {"y": 2}, [2]), (2, "ab", {"y": 2}, [2]), (3, None, None, None), (4, "c", {}, [])],
        "doc_id long, text string, tags map<string,int>, parts array<int>",
    )
    kept = exact_dedup.keep_one(docs, 1 << 16)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_chat_with_a_null_turn_is_as_in_its_sql(spark):
    rows = [(1, None, "user", "later?"), (1, 0, "user", "one"), (1, 1, "assistant", None), (1, None, "assistant", "x\\</s>")]
    rows += [(2, 5, None, "é漢" * 400), (2, 5, "assistant", "same turn")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_events(chat.events_of(table))).collect()
    conversations = table.toArrow()  # noqa: F841
    sql = duckdb.sql(queries.ORACLE_SQL["op6_chat"])
    expected = {r[0]: dict(zip(sql.columns, r, strict=True)) for r in sql.fetchall() if r[0] > 0}
    assert {r.conv_id: r.asDict() for r in got} == expected


def test_components_of_a_hub_and_a_path(spark):
    edges = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(9)
    got = {r.node: r.comp for r in components.components(table, Stages(spark).write).collect()}
    assert got == {k: 0 for k in range(300)} | {1000 + k: 1000 for k in range(61)}
