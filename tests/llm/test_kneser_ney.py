"""Modified Kneser-Ney tables against a recursive definition, and the verdict's defined cases."""

import math
from collections import Counter, defaultdict

import numpy as np
from daypanel.llm import kneser_ney as K
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, model string, n_chars int"


def plain_model(texts):
    """Probability of a class after three classes, by the textbook recursion over plain dictionaries."""
    grams = Counter()
    for t in texts:
        c = [39] * 3 + K.classes(t).tolist()
        grams.update(tuple(c[i : i + 4]) for i in range(len(c) - 3))
    levels = {}
    for order in (4, 3, 2, 1):
        n = {k: sum(v == k for v in grams.values()) for k in (1, 2, 3, 4)}
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = {k: min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) if n[k] and n[1] else k / 2 for k in (1, 2, 3)}
        total, mass = Counter(), defaultdict(float)
        for g, c in grams.items():
            total[g[:-1]] += c
            mass[g[:-1]] += d[min(c, 3)]
        levels[order] = (dict(grams), d, total, mass)
        grams = Counter(g[1:] for g in grams)

    def p(g):
        if not g:
            return 1 / K.A
        c, d, total, mass = levels[len(g)]
        if g[:-1] not in total:
            return p(g[1:])
        own = c.get(g, 0)
        return max(own - d[min(own, 3)], 0) / total[g[:-1]] + mass[g[:-1]] / total[g[:-1]] * p(g[1:]) if own else mass[g[:-1]] / total[g[:-1]] * p(g[1:])

    return p


def test_probabilities_equal_the_recursion(spark):
    texts = ["the cat sat on the mat.", "A dog, a cat; 12 mice!", "the the THE end\n\nof it", "zebra"]
    trusted = spark.createDataFrame([("en", t) for t in texts] + [("de", "ganz anders")], "lang string, text string")
    model = K.models(trusted)
    table = K.log_table(model.where("lang = 'en'").collect())
    assert abs(np.exp(table.reshape(-1, K.A)).sum(1) - 1).max() < 1e-4
    p = plain_model(texts)
    for t in [*texts, "a new dog sat there.", "Q?"]:
        c = [39] * 3 + K.classes(t).tolist()
        want = [math.log(p(tuple(c[i : i + 4]))) for i in range(len(c) - 3)]
        assert np.allclose(table[K.codes(t)], want, atol=1e-4)


def test_bad_text_goes_and_good_text_stays(spark):
    good = [f"the quick brown fox number {i} jumps over the lazy dog and runs into the green forest again" for i in range(60)]
    rows = [(i, t, "en", "x", 1) for i, t in enumerate(good)] + [(100, "#%$ @@ x9q zzkq #### 77$$ &&^ qqx|| ~~ {{}} <<" * 5, "en", "x", 1), (101, None, "en", "", 0), (102, "", None, None, None), (103, good[0], None, None, None), (None, good[1], "xx", "", 1), (5, good[5], "en", "x", 1)]
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(100, 0), (None, 1), (51, None)], "doc_id long, quality int")
    got = K.judge(spark.createDataFrame(rows, SCHEMA), labels).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.kept} == {100, 101, 102}
    assert all((r.perplexity is None) == (r.n_chars == 0) for r in got)


def test_no_trusted_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some words", "en", "", 1), (2, "", "en", "", 1)], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: (r.perplexity, r.kept) for r in K.judge(docs, labels).collect()} == {1: (None, True), 2: (None, False)}
    assert K.judge(docs.limit(0), labels).count() == 0


def test_very_long_text(spark):
    good = [f"the quick brown fox number {i} jumps over the lazy dog" for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "", 1) for i, t in enumerate(good)] + [(99, " ".join(good) * 500, "en", "", 1)], SCHEMA)
    got = {r.doc_id: r for r in K.judge(docs, spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")).collect()}
    assert got[99].kept and got[99].n_chars == len(" ".join(good)) * 500


def test_query_keeps_trusted_documents(spark):
    sf = "/root/testdata/sf0.001"
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    got = {r.doc_id: r.kept for r in QUERIES["op8_kneser_ney"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert np.mean([got[i] for i in good]) >= 0.95


def test_scores_equal_the_recursion_over_whole_characters(spark, monkeypatch):
    texts = ["the cat sat on the mat.", "A dog, a cat; 12 mice!", "the the THE end\n\nof it", "zebra", "бета БетА \U0001d400"]
    new = [*texts, "a new dog sat there.", "Q?", "дум 345 \U0001d401", "#%$ @@"]
    monkeypatch.setattr(K, "classes", lambda t: np.frombuffer(t.encode("utf-16-le"), "<u2").astype(np.int64))
    monkeypatch.setattr(K, "A", 1 << 16)
    p = plain_model(texts)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(new)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in K.perplexities(docs, *K.char_models(docs.where(f"doc_id < {len(texts)}").select("lang", "text"))).collect()}
    for i, t in enumerate(new):
        c = [39] * 3 + K.classes(t).tolist()
        want = -sum(math.log(p(tuple(c[j : j + 4]))) for j in range(len(c) - 3)) / (len(c) - 3)
        assert abs(got[i].log_ppl - want) < 1e-5 and got[i].n_chars == len(t) and got[i].model == "en"


def test_characters_of_one_class_are_told_apart(spark):
    good = [f"the quick brown fox number {i} jumps over the lazy dog" for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "", 1) for i, t in enumerate(good)] + [(99, good[3].upper().swapcase().replace("3", "٣"), "en", "", 1), (100, good[3], "en", "", 1)], SCHEMA)
    got = {r.doc_id: r.perplexity for r in K.judge(docs, spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")).collect()}
    assert got[100] == got[3] < got[99]
