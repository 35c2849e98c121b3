"""The Jaccard join against all pairs."""

import random

import numpy as np
from daypanel.llm import jaccard_join as J
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, k string, n string, whole int"


def brute(rows):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    by = {}
    for i in ids:
        for s in sets[i]:
            by.setdefault(s, []).append(i)
    pairs = {(a, b) for v in by.values() for x, a in enumerate(v) for b in v[x + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    bases = [[rng.choice(vocab) for _ in range(rng.randint(1, 120))] for _ in range(20)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, max(1, len(w) // 12))):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < 0.3:
            w = w + passage
        if rng.random() < 0.1:
            w = passage[: rng.randint(40, 60)] + [rng.choice(vocab) for _ in range(rng.randint(0, 8))]
        out.append((i, " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    return out


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_components_equal_all_pairs(spark):
    rows = corpus(1) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b"), (1004, "A b")]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    assert result(J.near_duplicates(docs)) == brute(rows)


def test_tiles_split_large_lists(spark, monkeypatch):
    rows = corpus(2, 120)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    monkeypatch.setattr(J.residual_links, "__defaults__", (4,))
    assert result(J.near_duplicates(docs)) == brute(rows)


def test_hot_passage_over_many_components(spark, monkeypatch):
    """Texts that share a long passage but mostly do not link, in many components; chains of near copies among them."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(240):
        own = [f"o{i}x{j}" for j in range(rng.randint(3, 16))]
        text = passage[: rng.randint(30, 40)] + own
        rows.append((2 * i, " ".join(text)))
        if rng.random() < 0.3:
            rows.append((2 * i + 1, " ".join(text[:-1] + ["other"])))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    want = brute(rows)
    for tile in (512, 16):
        monkeypatch.setattr(J.residual_links, "__defaults__", (tile,))
        assert result(J.near_duplicates(docs)) == want


def reach(pairs, root):
    """Components of roots under pairs of members."""
    groups = [{r} for r in set(root.tolist())]
    for i, j in pairs:
        a, b = (next(g for g in groups if root[k] in g) for k in (i, j))
        if a is not b:
            groups.remove(b)
            a |= b
    return sorted(map(sorted, groups))


def test_forest_of_links_joins_what_all_links_join():
    rng = np.random.default_rng(2)
    for _ in range(20):
        root = rng.integers(0, 8, 12)
        linked = np.triu(rng.random((12, 12)) < 0.15, 1)
        x, y = J.joining(linked, root)
        assert len(x) < 8 and all(linked[i, j] for i, j in zip(x, y, strict=True))
        assert reach(list(zip(x, y, strict=True)), root) == reach(list(zip(*np.nonzero(linked), strict=True)), root)


def test_nulls_repeats_and_empty_table(spark):
    same = "one two three four five six seven"
    rows = [(None, same, "", "", 1), (5, same, "", "", 1), (5, same, "", "", 1), (3, same.upper(), "", "", 1), (None, None, "", "", 1)]
    got = sorted(map(tuple, J.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(None, 3, 3), (5, 3, 3), (5, 3, 3), (3, 3, 3), (None, 0, None)], key=str)
    assert J.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(50_000)}" for _ in range(120_000)]
    near = [w if i % 60 else "other" for i, w in enumerate(long)]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[:60_000])), (4, "short text of six words here")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert result(J.near_duplicates(docs)) == brute(rows)


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(QUERIES["op9_jaccard_join"](spark, sf)) == brute(rows)
