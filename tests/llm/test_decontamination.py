"""Latent retrieval: planted passages and paraphrases are found, clean documents stay."""

import random

from daypanel.llm import decontamination as D

SCHEMA = "doc_id long, text string, item_id string, cosine int, answer string"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def corpus():
    rng = random.Random(11)
    vocab = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("ba", "do", "fi", "gu", "le") for c in ("na", "po", "si", "tu", "we", "zo")]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = {i: words(30) + ["."] + words(8) for i in range(12)}
    docs = {i: words(rng.randint(5, 200)) for i in range(300)}
    planted = {}
    for i in range(12):
        docs[1000 + i] = words(60) + items[i] + words(50)
        planted[1000 + i] = i
        near = [w for k, w in enumerate(items[i]) if k % 7]  # every seventh word is gone
        docs[2000 + i] = words(33) + near + words(20)
        planted[2000 + i] = i
    return items, {k: " ".join(v) for k, v in docs.items()}, planted


def test_common_subsequence_equals_the_table():
    rng = random.Random(2)
    for _ in range(60):
        a = [bytes([97 + rng.randrange(4)]) for _ in range(rng.randint(1, 40))]
        b = [bytes([97 + rng.randrange(5)]) for _ in range(rng.randint(0, 60))]
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        assert D.common_subsequence(masks, len(a), b) == longest(a, b)


def test_planted_passages_are_found_in_blocks(spark):
    items, docs, planted = corpus()
    table = spark.createDataFrame([(k, v, "x", 1, "y") for k, v in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(k, " ".join(v), "x") for k, v in items.items()] + [(50, None, "x"), (51, "", "x"), (52, "too short", "x")], "item_id long, text string, cosine string")
    found = {(r.doc_id, r.item_id) for r in D.find(table, bench).collect()}
    assert found == set(planted.items())
    assert {(r.doc_id, r.item_id) for r in D.search(table, bench, D.embedding(table), block=5).collect()} == found
    kept = D.clean(table, bench, block=5)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == set(docs) - set(planted)


def test_nulls_repeats_long_and_empty(spark):
    items, docs, _ = corpus()
    text = docs[1003]
    rows = [(None, None, None, None, None), (1, "", "", 1, ""), (2, text, "", 1, ""), (2, text, "", 1, ""), (None, text, "", 1, ""), (3, "plain words here " * 30_000, "", 1, "")]
    table = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame([(3, " ".join(items[3]))], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in D.find(table, bench).collect()), key=str) == [(2, 3), (2, 3), (None, 3)]
    assert D.clean(table, bench).count() == 3
    assert D.find(table.limit(0), bench).count() == 0 and D.find(table, bench.limit(0)).count() == 0
    assert D.clean(table, bench.limit(0)).count() == 6


def test_short_items_stand_whole(spark):
    items = [(1, "red green blue"), (2, "what is the Answer?"), (3, "zzz"), (4, ""), (5, None), (6, "one two")]
    docs = [(1, "a red, green blue b"), (2, "red green and blue"), (3, "so what is the answer then"), (4, "zzz"), (5, "zzz zzz"), (6, "one two"), (7, "one two three"), (8, None), (9, "red green"), (10, "x " * 5000 + "red green blue " + "y " * 5000)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = {(r.doc_id, r.item_id) for r in D.find(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert got == {(1, 1), (3, 2), (4, 3), (6, 6), (10, 1)}
    left = D.clean(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    assert {r.doc_id for r in left} == {2, 5, 7, 8, 9}


def test_recall_of_the_cosine_filter(spark):
    """Against the same word checks without the filter, on the given prose and at two corpus sizes."""
    rng = random.Random(3)
    sf = "/root/testdata/sf0.01"
    prose = [r.text.split() for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(600).collect() if r.text]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    vocab = [w for t in prose[:50] for w in t]
    for n in (120, len(prose)):
        docs = [(i, " ".join(t[:400])) for i, t in enumerate(prose[:n])]
        for i in range(80):
            item = bench[i % len(bench)][1].split()
            share = (0.0, 0.1, 0.2, 0.3)[i % 4]
            near = [rng.choice(vocab) if rng.random() < share else w for w in item]
            host = prose[rng.randrange(n)][:150]
            docs.append((10_000 + i, " ".join(host[:70] + near + host[70:])))
        d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
        vectors = D.embedding(d)
        with_filter, without = ({(r.doc_id, r.item_id) for r in D.search(d, b, vectors, cosine=c).collect()} for c in (D.COSINE, -2.0))
        assert len(without) >= 40 and with_filter <= without
        assert len(with_filter) >= 0.98 * len(without)


def test_columns_are_gathered_without_the_range_check(monkeypatch):
    import numpy as np
    from daypanel.llm import decontamination

    modes, take = [], np.take
    monkeypatch.setattr(np, "take", lambda *a, **k: modes.append(k.get("mode")) or take(*a, **k))
    x = np.arange(12, dtype=np.float32).reshape(3, 4)
    assert np.array_equal(decontamination.columns_at(x, np.array([3, 0, 0])), x[:, [3, 0, 0]]) and modes == ["clip"]
