"""Spelling variants against a plain count and a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from daypanel.llm import spelling as S
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, n int, node string, size int"


def plain_words(docs):
    counts = Counter()
    lower = str.maketrans(S.UPPER, S.LOWER)
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs):
    counts = plain_words(docs)
    near = {w: [o for o in counts if abs(len(w) - len(o)) < 2 and one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def documents():
    rnd = random.Random(7)
    base = ["".join(rnd.choice("etaoinshrdlé") for _ in range(rnd.randint(6, 9))) for _ in range(60)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbbbb", "listen", "silent", "tinsel", "ÀÉÿöüß", "àéÿöüß"]
    words = []
    for w in base:
        words += [w] * rnd.choice([5, 30, 200])
        for _ in range(4):
            i, kind = rnd.randrange(len(w)), rnd.randrange(3)
            words += [w[:i] + (rnd.choice("etaxq") * (kind > 0)) + w[i + (kind < 2) :]] * rnd.choice([4, 5, 6, 30])
    rnd.shuffle(words)
    docs = [(i, " ".join(words[i * 40 : i * 40 + 40]).replace("e", "E", 3), "x", 1, None, 2) for i in range(len(words) // 40 + 1)]
    long = " ".join(words) + "\n" + "z" * 5000 + " " + "ab1cd" * 50
    return docs + docs[:5] + [(None, "Listen listen", None, None, None, None), (900, None, "x", 1, "n", 3), (901, "", "x", 1, "n", 3), (902, long, "x", 1, "n", 3)]


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("node", [2_000, 3, 0])
def test_small_texts(spark, monkeypatch, node):
    docs = documents()
    monkeypatch.setattr(S, "NODE", node)  # fewer words a node: more upper levels, at last all groups
    assert got(S.variants(spark.createDataFrame(docs, SCHEMA))) == plain(docs)


def test_leaf_with_many_words():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.sample("abcdefgh", 8)) for _ in range(300)} | {"abcdefgh", "abcdefgx"})
    leaf = S.Leaf([w for w in words if len(w) == 8])
    for query in [*words, *(w[:i] + w[i + 1 :] for w in words for i in (0, 4, 7))]:
        assert {o for o in leaf.candidates(query) if S.near(query, o)} == {o for o in words if one_edit(query, o)}


def test_empty_table(spark):
    assert got(S.variants(spark.createDataFrame([], SCHEMA))) == set()


def test_chains_end_in_one_root(spark):
    words = [("abcdef", 5), ("abcdefg", 30), ("abcdefgh", 200), ("abcdefghi", 1200), ("abcdefghij", 7000)]
    found = spark.createDataFrame([(w, n, words[i + 1][0] if i < 4 else None) for i, (w, n) in enumerate(words)], "word string, n long, form string")
    assert {r.word: r.root for r in S.rooted(found).collect()} == {w: "abcdefghij" for w, _ in words}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_on_whole_documents(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_spelling_variants"](spark, f"/root/testdata/{sf}")) == plain(docs)
