"""The operators on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import random
import re
import textwrap
import zlib

import duckdb
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from depweave.llm import (
    byte_bpe,
    chat,
    components,
    decontaminate,
    exact_dedup,
    language,
    licenses,
    near_dedup,
    queries,
    substring_dedup,
    token_count,
    toxicity,
)
from depweave.llm.suffix_array import suffix_array, words
from depweave.plans.stages import Stages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, keep_id long, row string, maybe long, hit int"


def table(spark, rows):
    """Documents with further columns that have names the operators use."""
    full = [(i, t, lang, "s", 1, None, 7, "x", 3, None) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n=300):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    a, b = prose(1), prose(2)
    rows = [
        (1, a, "en"), (2, a, "en"), (2, a, "en"), (3, a.replace(" ", "\n", 5), "en"),
        (4, a + " one more word here", "en"), (5, None, None), (6, "", "en"), (7, " \n", "de"),
        (None, a, "en"), (None, None, None), (8, b, "de"), (9, b[:150] + a[50:260], "de"),
        (10, "x" * 70_000, "en"), (11, "1234 !!", None), (12, "one two", "en"),
        (13, "one two", "en"), (14, "é漢😀</s>\\ " * 30, "fr"),
    ]
    return table(spark, rows).cache()


def test_every_operator_takes_odd_and_empty_tables(spark, odd):
    empty = odd.limit(0)
    stage = Stages(spark).write
    bench = spark.createDataFrame([(1, "one two"), (None, None)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (8, 1, 0), (None, 0, None)], "doc_id long, quality int, toxic int")
    for docs in (odd, empty):
        n = docs.count()
        results = [
            toxicity.scores(docs, toxicity.fit(docs, labels, stage)),
            substring_dedup.decisions(docs, stage, 1 << 16),
            token_count.token_counts(docs, "byte_bpe_50k.json"),
            language.identify(docs),
            byte_bpe.encode_and_decode(docs, "byte_bpe_multi_50k.tiktoken"),
            licenses.scan(docs, licenses.known_digests(licenses.built_in(spark))),
            near_dedup.decisions(docs, stage, bits=1 << 16),
            exact_dedup.decisions(docs, stage, 1 << 16),
            decontaminate.contamination(docs, bench),
            decontaminate.contamination(docs, bench.limit(0)),
        ]
        for result in results:
            assert len(result.collect()) == n


def test_exact_dedup(spark, odd):
    rows = exact_dedup.decisions(odd, Stages(spark).write, 1 << 16).collect()
    groups = {}
    for r in odd.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        groups.setdefault(hashlib.sha256(key.encode()).hexdigest(), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    for r in rows:
        group = groups[r.text_sha256]
        best = min(group)
        assert r.group_size == len(group) and r.keep_id == (None if best[1] else best[2])
    assert sum(r.kept for r in rows) == len(groups)
    kept = exact_dedup.keep_one(odd, 1 << 16)
    assert kept.columns == odd.columns and kept.count() == len(groups)


def brute_groups(rows, width, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_near_dedup_finds_every_link(spark):
    rng, rows = random.Random(5), []
    for k in range(8):
        base = prose(100 + k, rng.choice([3, 12, 60, 150])).split()
        for copy in range(25):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = f"w{rng.randrange(9999)}"
            rows.append((k * 100 + copy, " ".join(text), "en"))
    got = near_dedup.decisions(table(spark, rows), Stages(spark).write, bits=1 << 18).collect()
    expected = brute_groups([(i, t) for i, t, _ in rows], 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    """Groups by row, whatever the doc_ids: null, repeated over groups and within one."""
    bases = [prose(200 + k, 60) for k in range(6)]
    rows = [
        (1, bases[0], "en"), (None, bases[0] + " more", "en"), (None, bases[1], "en"), (None, None, "en"),
        (2, bases[2], "en"), (3, bases[2] + " more", "en"), (3, bases[3], "en"), (None, "", "en"),
        (4, bases[4], "en"), (4, bases[4] + " more", "en"), (None, bases[5], "en"), (None, bases[5] + " more", "en"),
    ]
    groups = brute_groups(list(enumerate(t for _, t, _ in rows)), 4, 80)
    order = {k: (groups[k][1], i is None, i or 0) for k, (i, _, _) in enumerate(rows)}
    firsts = {group: min(v for v in order.values() if v[0] == group) for _, group in groups.values()}
    docs = table(spark, rows)
    kept = near_dedup.keep_one(docs, Stages(spark).write, bits=1 << 18)
    assert kept.columns == docs.columns
    number = {t: k for k, (_, t, _) in enumerate(rows)}
    found = sorted(number[r.text] for r in kept.collect())
    assert sorted(groups[k][1] for k in found) == sorted(firsts)
    assert all(order[k] == firsts[groups[k][1]] for k in found)


def test_super_min_hash_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 1500).astype(np.uint64)
    one, two = near_dedup.super_min_hash(pool[:1000]), near_dedup.super_min_hash(pool[100:1100])
    assert abs((one == two).mean() - 900 / 1100) < 0.08


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 340)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
        low, high = sorted((label[a], label[b]))
        label = {k: low if v == high else v for k, v in label.items()}
    found = components.components(spark.createDataFrame(edges, "a long, b long"), Stages(spark).write).collect()
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.comp for r in found} == {k: v for k, v in label.items() if k not in loops}


def test_suffix_array():
    rng = np.random.default_rng(1)
    for k in range(200):
        text = rng.integers(97, 98 + k % 4, k % 60).astype(np.uint8)
        data = text.tobytes()
        assert suffix_array(text, words(text, 64), 64).tolist() == sorted(range(len(data)), key=lambda i: data[i:])


@pytest.mark.parametrize("stretches", [32_768, 2])
def test_substring_dedup(spark, monkeypatch, stretches):
    """With 2 stretches to a block most anchors are split over blocks."""
    monkeypatch.setattr(substring_dedup, "STRETCHES", stretches)
    rng, a = random.Random(2), prose(7, 80)
    rows = [(k, prose(50 + k, 30) + " " + a[rng.randrange(200) : rng.randrange(200, 400)] + "é" * (k % 3) + prose(90 + k % 4, 40), "en") for k in range(40)]
    rows += [(100, a, "en"), (101, a, "en"), (102, "z" * 500, "en"), (103, "z" * 99, "en"), (104, None, "en")]
    got = substring_dedup.decisions(table(spark, rows), Stages(spark).write, 1 << 18).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removed(rows)


def removed(rows):
    """The results of substring_dedup by sets of strings, for rows in the order of documents."""
    seen, expected = set(), {}
    for i, text, _ in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if raw else 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        expected[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return expected


def test_substring_dedup_of_periodic_and_huge_texts(spark):
    """Runs of many periods, alone, between prose and across documents; a passage over the border of
    two pieces of 2**20 bytes; a null doc_id last."""
    a, rng = prose(3, 60), random.Random(5)
    huge = "".join(rng.choice("abcdefghijklmnop") for _ in range((1 << 20) - 150)) + a + "." * 3_000
    rows = [(1, huge, "en"), (2, "z" * 200_000, "en"), (3, "y" + "z" * 400 + "x", "en"), (4, a[:250] + "z" * 150 + a, "en")]
    for k, period in enumerate([2, 7, 39, 40, 41, 60, 61, 62, 100, 150]):
        unit = "".join(rng.choice("ab") for _ in range(period))
        rows += [(10 + 2 * k, unit * 30 + a[k : k + 130], "en"), (11 + 2 * k, "q" + (unit * 30)[k : 20 * period], "en")]
    rows.append((None, a + huge[1_000:2_000] + "." * 120, "en"))
    got = substring_dedup.decisions(table(spark, rows), Stages(spark).write, 1 << 20).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removed(rows)
    moved = sum(int((~found.periodic).sum()) for found in substring_dedup.stretches([b"z" * 5_000_000]))
    assert moved <= 5, "a run of one character moves one stretch of each piece"


ALPHABET = ["a", "the", " ", "  ", "\n", "é", "'s", "1", ".", "!!", "\xa0", "\x0b", "<|endoftext|>", "😀", "\t", "漢", "000"]


def test_token_counts_and_splices():
    model, rng = token_count.tokenizer("byte_bpe_50k.json"), random.Random(4)
    counter = token_count.Counter("byte_bpe_50k.json")
    for _ in range(400):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60)))
        n = len(model.encode(text, add_special_tokens=False))
        assert counter.count(text) == n
        assert token_count.spliced(model, text, 7, 2) == n


def test_byte_bpe_encodes_appends_and_edits():
    bpe, rng = byte_bpe.model("byte_bpe_multi_50k.tiktoken"), random.Random(6)
    other = tiktoken.Encoding("own", pat_str=bpe.pattern.pattern, mergeable_ranks=bpe.ranks, special_tokens={})
    for _ in range(400):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 60)))
        ids = other.encode_ordinary(text)
        assert bpe.encode(text) == ids and bpe.decode(ids) == text.encode()
        i = rng.randrange(len(text) + 1)
        j, new = rng.randrange(i, len(text) + 1), rng.choice(ALPHABET)
        changed, found = bpe.edit(text, ids, i, j, new)
        assert found == other.encode_ordinary(changed)
        assert bpe.append(text, ids, new)[1] == other.encode_ordinary(text + new)
        table_ = byte_bpe.PrefixTable(bpe, text.encode())
        table_.edit(len(text[:i].encode()), len(text[:j].encode()), new.encode())
        assert table_.last == byte_bpe.PrefixTable(bpe, changed.encode()).last


def test_chat_folds_edits_and_regenerations(spark):
    log = [
        (1, 1, 0, "message", "user", "hi <s>"), (1, 2, 1, "message", "assistant", "a"),
        (1, 3, 1, "delta", None, "b\\"), (1, 4, 2, "message", "user", "gone"),
        (1, 5, 1, "regenerate", "assistant", None), (1, 6, 1, "delta", None, "new"),
        (1, 7, 1, "delta", None, "</s>"), (1, 8, 0, "edit", "user", "hello"),
        (1, 9, 2, None, None, None), (None, None, None, "delta", "user", "x"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, turn long, kind string, role string, text string")
    folded = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.fold(events).collect()}
    assert folded == {(1, 0): ("user", "hello"), (1, 1): ("assistant", "new</s>"), (1, 2): ("", ""), (None, None): ("user", "x")}
    digest = {r.conv_id: r for r in chat.read_back(chat.format_events(events)).collect()}
    assert digest[1].n_turns == 3 and digest[1].loss_chars == 7
    assert digest[1].turns_sha256 == hashlib.sha256(b"user\nhello\nassistant\nnew</s>\n\n\n").hexdigest()
    assert chat.read_back(chat.format_events(events.limit(0))).count() == 0


def test_decontamination_in_blocks_and_spans(spark, odd):
    item = " ".join(prose(1).split()[20:40])
    bench = spark.createDataFrame([(1, item), (2, "ONE, two"), (3, "")], "item_id long, text string")
    whole = sorted(map(str, decontaminate.contamination(odd, bench).collect()))
    assert sorted(map(str, decontaminate.contamination(odd, bench, block=3).collect())) == whole
    hits = {r.doc_id: r for r in decontaminate.contamination(odd, bench).collect()}
    assert hits[1].n_hit == 20 and hits[1].n_items == 1 and hits[12].n_hit == 2 and hits[5].n_words == 0
    found = {r.doc_id: r for r in decontaminate.passages(odd, bench).collect()}
    assert found[1].passage == item and prose(1)[found[1].start : found[1].end] == item
    clean = decontaminate.keep_clean(odd, bench, block=3)
    rows = decontaminate.contamination(odd, bench).collect()
    assert clean.columns == odd.columns and clean.count() == sum(not r.contaminated for r in rows)


def by_sql(name, **tables):
    """The rows of a query's SQL over small tables (columns, rows)."""
    con = duckdb.connect()
    for table_, (columns, rows) in tables.items():
        con.execute(f"CREATE TABLE {table_} ({columns})")
        con.executemany(f"INSERT INTO {table_} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con.execute(queries.ORACLE_SQL[name]).fetchall()


def test_decontamination_keeps_other_blanks_inside_words(spark):
    blanks = "\x85\xa0\u1680\u2000\u2028\u2029\u202f\u205f\u3000"
    words = [f"a{k}{blanks[k % len(blanks)]}b{k}" for k in range(14)]
    items = [(1, "prix\xa0: dix"), (2, "\u6f22\u3000\u5b57"), (3, " ".join(words))]
    docs = [
        (1, "le Prix\xa0: dix"), (2, "\u6f22\u3000\u5b57"), (3, "x " + " ".join(words[2:13]) + " y"),
        (4, "le prix : dix"), (5, "\u6f22 \u5b57"), (6, " ".join(words).replace("\xa0", " ")),
    ]
    expected = by_sql(
        "op10_decontamination",
        documents=("doc_id BIGINT, text VARCHAR", docs),
        benchmark=("item_id BIGINT, text VARCHAR", items),
    )
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert {r[0] for r in expected if r[5]} == {1, 2, 3}


def test_licenses(spark):
    mit = licenses.TEXTS["MIT"]
    rows = [(1, "Copyright (c) 2020 A. Author\n\n" + mit.upper(), None), (2, mit + " more", None), (3, None, None)]
    found = licenses.scan(table(spark, rows), licenses.known_digests(licenses.built_in(spark))).collect()
    assert {r.doc_id: r.license for r in found} == {1: "MIT", 2: None, 3: None}


def found_licenses(spark, texts):
    rows = [(k, text, None) for k, text in enumerate(texts)]
    known = licenses.known_digests(licenses.built_in(spark))
    found = {r.doc_id: r.license for r in licenses.scan(table(spark, rows), known).collect()}
    return [found[k] for k in range(len(rows))]


def test_licenses_on_one_line_after_notices_and_at_any_width(spark):
    mit = " ".join(licenses.TEXTS["MIT"].split())
    notices = [
        "Copyright (c) 2020 A. Author.", "Copyright 2019-2021 Foo, Inc. All rights reserved.",
        "\u00a9 1999 B. Other", "(c) 2001, 2003 C and D.\nCopyright (C) E.", "Copyright <YEAR> <HOLDER>",
    ]
    texts = [f"{notice} {mit}" for notice in notices]
    texts += [textwrap.fill(mit, width) for width in range(40, 121)]
    texts += [textwrap.fill(f"{notices[0]} {mit}", width) for width in range(60, 101)]
    assert found_licenses(spark, texts) == ["MIT"] * len(texts)
    others = ["Copyright (c) 2020 A. Author. All of it.", "copyright holders " + mit, "(c) " * 9000, "Copyright 2020 A\n" * 9000]
    assert found_licenses(spark, others) == [None] * len(others)


def test_licenses_knows_common_whole_texts(spark):
    names, texts = zip(*licenses.whole_texts(), strict=True)
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense"} <= set(names)
    assert found_licenses(spark, texts) == list(names)
    # Each text on one line, re-wrapped, and spelled otherwise.
    for change in (lambda t: " ".join(t.split()), lambda t: textwrap.fill(" ".join(t.split()), 63), lambda t: "\ufeff" + t.upper().replace("\n", "\r\n")):
        assert found_licenses(spark, [change(t) for t in texts]) == list(names)
    of = dict(reversed(licenses.whole_texts()))
    notice = "Copyright (c) 2020, A. Author and contributors\nAll rights reserved."
    mit, isc = licenses.TEXTS["MIT"], of["ISC"]
    titled = {
        f"MIT License\n\n{notice}\n\n{mit}": "MIT", f"The MIT License (MIT)\n{mit}": "MIT",
        f"MIT License Copyright (c) 2020 A. Author. {mit}": "MIT", f"ISC License\n\n{notice}\n{isc}": "ISC",
        f"BSD 3-Clause License\n\n{notice}\n\n{of['BSD-3-Clause']}": "BSD-3-Clause",
        f"{notice}\n\n{of['BSD-2-Clause']}": "BSD-2-Clause", "MIT License": None,
        of["Apache-2.0"].split("licenses/\n", 1)[1]: "Apache-2.0", "Apache License\nVersion 2.0": None,
        of["GPL-3.0"] + " more": None,
    }
    assert found_licenses(spark, list(titled)) == list(titled.values())
    given = licenses.known_digests(spark.createDataFrame([("Own", "Do as you like.")], "name string, text string"))
    docs = table(spark, [(1, "Copyright 2021 B. Other. Do as you like!", None)])
    assert [r.license for r in licenses.scan(docs, given).collect()] == ["Own"]


def test_segments_are_maximal():
    scores = np.array([1, -5, 4, -3, 5, -6, 3, -1, 2.0, -9])
    assert toxicity.segments(scores) == [(0, 1, 1.0), (2, 5, 6.0), (6, 9, 4.0)]


def test_pipeline_stages_keep_columns(spark, odd, tmp_path):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, texts = odd, [5, 6, 7, 11]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns, name
        docs = Stages(spark).write(name, docs)
    ids = {r.doc_id for r in docs.collect()}
    assert {4, 8, 10, 14} <= ids or {3, 8, 10, 14} <= ids or {1, 8, 10, 14} <= ids
    assert not ids & {*texts, 12, 13}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_held_out_folds(spark):
    rows = language.identify(table(spark, [(k, "the cat", "en") for k in range(40)])).collect()
    assert {r.doc_id: r.held_out for r in rows} == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in range(40)}
    assert all(r.lang_pred == "en" for r in rows)
