"""N-gram join, vector codes and importance resampling against brute force on small odd tables."""

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from depweave.llm import importance, ngram_join, vector_codes
from depweave.plans.stages import Stages

DOCS = "doc_id long, text string, node string, place int, rank int, hub string, comp int, col long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, None, 3, 4) for i, t in rows], DOCS).repartition(5)


def prose(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def near_copies(seed, sizes, copies):
    rng, texts = random.Random(seed), []
    for k, size in enumerate(sizes):
        base = prose(seed * 100 + k, size)
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 60))):
                words[rng.randrange(size)] = f"w{rng.randrange(9999)}"
            texts.append(" ".join(words))
    return texts


def brute_join(texts, width, percent):
    """(size, index of the group's first text) of each text."""
    sets = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set())
    label = list(range(len(sets)))
    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if both and 100 * both >= percent * len(one | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if v == b else v for v in label]
    return [(len(s), k) for s, k in zip(sets, label, strict=True)]


@pytest.mark.parametrize("cell", [60, 500_000])
def test_join_finds_every_link(spark, monkeypatch, cell):
    monkeypatch.setattr(ngram_join, "CELL", cell)
    texts = near_copies(3, [4, 5, 8, 14, 40, 90, 200], 14)
    # A passage that all share, and one that makes most of some texts.
    passage = " ".join(prose(9, 30))
    texts += [passage + " " + " ".join(prose(500 + k, 60)) for k in range(20)]
    texts += [passage + f" end{k}" for k in range(10)] + [passage.upper()]
    rows = list(enumerate(texts))
    got = ngram_join.join_groups(documents(spark, rows), Stages(spark).write, bits=1 << 18).collect()
    expected = brute_join(texts, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(expected))
    assert len({k for _, k in expected}) < len(texts)


def test_join_of_odd_rows(spark):
    a = " ".join(prose(1, 80))
    rows = [
        (5, a), (3, a + " more"), (None, a + " more words"), (7, None), (8, ""), (9, " \n\t"), (None, None),
        (10, "one two"), (11, "ONE\ntwo"), (11, "one two three"), (None, "alone here"), (12, "é漢 é漢 " * 200), (13, "x" * 90_000),
    ]
    docs = documents(spark, rows)
    got = ngram_join.join_groups(docs, Stages(spark).write, bits=1 << 16).collect()
    sizes = brute_join([t for _, t in rows], 4, 85)
    groups = {}
    for (i, _), (_, k) in zip(rows, sizes, strict=True):
        groups.setdefault(k, []).append((i is None, i or 0))
    heads = {k: None if min(v)[0] else min(v)[1] for k, v in groups.items()}
    expected = [(i, n, heads[k]) for (i, _), (n, k) in zip(rows, sizes, strict=True)]
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(str, expected))
    assert ngram_join.join_groups(docs.limit(0), Stages(spark).write, bits=1 << 16).count() == 0


def test_join_emits_no_pair_within_a_group(spark):
    """A large group of near copies, linked by one of them only, gives fewer links than its columns
    have rows, and not the pairs."""
    texts = near_copies(4, [60], 300)
    made = {}

    def stage(name, table, write=Stages(spark).write):
        made[name] = write(name, table)
        return made[name]

    ngram_join.join_groups(documents(spark, list(enumerate(texts))), stage, bits=1 << 18).count()
    n, entries = len(set(texts)), made["columns"].count()
    assert made["links"].count() < n and made["more"].count() < entries < 10 * n


def test_join_names_a_part_once(spark):
    """Rows that several blocks have together are one part, and go on only where they may first meet."""
    rng = random.Random(7)
    own = sorted(rng.sample(range(1 << 60), 100))
    sets = {b"a": [x << 4 for x in own], b"b": [x << 4 for x in own[:99] + [1]], b"c": [16 * k + 5 for k in range(100)]}
    sets = {node: np.array(sorted(x), np.uint64) for node, x in sets.items()}
    sketches = [(node, bytearray(ngram_join.sketch_of(x))) for node, x in sets.items()]
    cells = [
        (col, 0, 0, node == b"a", bytearray(node), bytearray(node), 100, col) for col in range(15) for node in sets
    ]
    cells = spark.createDataFrame(cells, ngram_join.CELL_ROW).repartition(4)
    # Of 100 shingles 92 must be common, so the first common column is no later than the ninth.
    met = ngram_join._meeting(cells, 85)
    assert {r.col for r in met.select("col").distinct().collect()} == set(range(9))
    parts = ngram_join._promising(met, spark.createDataFrame(sketches, "node binary, sketch binary"), 85).collect()
    assert sorted((bytes(r.node), r.side) for r in parts) == [(b"a", ngram_join.PROBE), (b"b", ngram_join.OTHER)]
    assert len({r.part for r in parts}) == 1


VECTORS = "vec_id long, embedding array<float>, label int, code string, error int, book string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, "y") for i, v, k in rows], VECTORS).repartition(3)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [
        (i, [math.floor(4096 * x) for x in v], k)
        for i, v, k in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            held = [[] for _ in books[p]]
            for c in cut:
                held[nearest(p, c[p])[1]].append(c[p])
            new.append([[sum(x) // len(h) for x in zip(*h, strict=True)] if h else e for h, e in zip(held, books[p], strict=True)])
        books = new
    out, sums = [], {}
    for (i, _, label), c in zip(kept, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        error = error if error < 2**63 else None
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
        known = [e for e in (sums.get(label), error) if e is not None]
        sums[label] = sum(known) if known else None
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str((i, code, e, sums[label], digest)) for i, code, e, label in out))


def rows_of(table):
    names = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(str(tuple(r[n] for n in names)) for r in table.collect())


def f32(x):
    import numpy as np

    return float(np.float32(x))


@pytest.mark.parametrize("large", [1.0, 3e4, 1e30])
def test_vector_codes_are_exact(spark, large):
    """Also where squares and sums leave 64 bits, and for values that no dictionary has twice."""
    rng = random.Random(7)
    rows = [(k if k % 11 else 7, [f32(rng.gauss(0, 0.3)) for _ in range(16)], k % 3 or None) for k in range(90)]
    rows += [rows[5], rows[5], (None, [f32(0.25)] * 16, 1)]
    rows += [(200 + k, [f32(large * rng.uniform(-1, 1)) for _ in range(16)], 9) for k in range(4)]
    bad = [(-1, None, 1), (-2, [0.5] * 15 + [None], 1), (-3, [0.5] * 15 + [float("nan")], 1), (-4, [float("inf")] * 16, 2)]
    got = vector_codes.code_table(vectors(spark, rows + bad), Stages(spark).write)
    assert rows_of(got) == brute_codes(rows)


def test_vector_codes_of_odd_tables(spark):
    stage = Stages(spark).write
    few = [(k, [f32(k / 7 - j / 5) for j in range(8)], None) for k in range(5)]
    assert rows_of(vector_codes.code_table(vectors(spark, few), stage)) == brute_codes(few)
    assert vector_codes.code_table(vectors(spark, few).limit(0), stage).count() == 0
    ragged = vector_codes.code_table(vectors(spark, [*few, (9, [1.0] * 9, None), (10, [], 4)]), stage)
    assert sorted((r.vec_id, r.code, r.error) for r in ragged.collect() if r.vec_id > 8) == [(9, None, None), (10, None, None)]
    uncut = vector_codes.code_table(vectors(spark, [(1, [1.0] * 9, 1)]), stage)
    assert [(r.vec_id, r.code, r.error) for r in uncut.collect()] == [(1, None, None)]
    small = vector_codes.compress(vectors(spark, few), stage, block=8)
    whole = vector_codes.compress(vectors(spark, few), stage)
    assert sorted(small.rows.collect()) == sorted(whole.rows.collect())


@pytest.mark.parametrize("digit_bits,chunk_bits", [(3, 2), (12, 18)])
def test_radix_ranks(spark, digit_bits, chunk_bits):
    """Ties, a score that a third has, both signs, the ends of long and nulls."""
    rng = random.Random(2)
    keys = [-(2**63), 2**63 - 1, None, None, 0, -1] + [rng.randrange(-50, 50) for _ in range(150)]
    rows = [(rng.choice([7, rng.randrange(-3000, 3000)]), k) for k in keys]
    table = spark.createDataFrame(rows, "score long, key long").repartition(4)
    ranked, n = importance.radix_ranked(table, "score", "key", Stages(spark).write, digit_bits, chunk_bits)
    got = sorted(ranked.collect(), key=lambda r: r["rank"])
    assert n == len(rows) and [r["rank"] for r in got] == list(range(1, n + 1))
    expected = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert [(r.score, r.key) for r in got] == expected


def brute_sample(rows, target, order, buckets, least, percent, seed):
    def words(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    def hashes(text):
        w = words(text)
        runs = [" ".join(w[k : k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1)]
        return [crc32(r.encode()) % buckets for r in runs]

    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for b in hashes(text):
            s[b] += 1
    for text in target:
        for b in hashes(text):
            t[b] += 1
    gain = [
        math.floor(1000 * math.log((a + 1) * (sum(s) + buckets) / ((b + 1) * (sum(t) + buckets))))
        for a, b in zip(t, s, strict=True)
    ]
    out = []
    for i, text in rows:
        found = hashes(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        key = f"{seed}:{'' if i is None else i}".encode()
        h = int(hashlib.sha256(key).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(found), weight, score, None, len(words(text)) >= least])
    enough = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(enough[: percent * len(enough) // 100]):
        r[4] = rank + 1
    return sorted(str(tuple(r[:5])) for r in out)


@pytest.mark.parametrize("order,buckets", [(1, 10_000), (3, 50)])
def test_resampling(spark, order, buckets):
    rng = random.Random(8)
    rows = [(k, " ".join(prose(k, rng.randint(1, 70)))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\x00 ,"), (None, " ".join(prose(1, 40))), (203, "É漢 é漢 A " * 300)]
    rows += [(204, "word " * 30_000)]
    target = [" ".join(prose(k, 50)) for k in range(20)] + [None, ""]
    docs = documents(spark, rows)
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resampled(docs, bench, Stages(spark).write, order, buckets, percent=30, chunk_bits=4)
    names = ("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(str(tuple(r[n] for n in names)) for r in got.collect()) == brute_sample(
        rows, target, order, buckets, 20, 30, 2024
    )


def test_resampling_of_empty_tables(spark):
    docs = documents(spark, [(1, "a " * 30), (1, "a " * 30), (2, None)])
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = importance.resampled(docs, bench, Stages(spark).write, percent=100).collect()
    assert sorted(str((r.doc_id, r["rank"])) for r in rows) == ["(1, 1)", "(1, 2)", "(2, None)"]
    assert importance.resampled(docs.limit(0), bench, Stages(spark).write).count() == 0
