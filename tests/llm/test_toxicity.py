"""Weak supervision: held-out quality, labels kept out of scores, defined cases."""

import zlib

import numpy as np
from daypanel.llm import toxicity as T
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, votes int, features string"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op7_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    score, y = np.array([s for s, _ in held]), np.array([t for _, t in held])
    assert auc(score, y) >= 0.9 and np.mean((score >= 0.5) == y) >= 0.9


def test_held_out_labels_do_not_matter(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    scores = lambda x: {r.doc_id: round(r.score, 9) for r in T.score(docs, x).collect()}
    assert scores(labels) == scores(turned)


def votes_table(spark, rows):
    return spark.createDataFrame(rows, "votes long, toxic int, n long").repartition(3)


def test_label_model_finds_the_better_voter(spark):
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    votes = np.where(y, rng.random(4000) < 0.9, rng.random(4000) < 0.02) + 2 * np.where(y, rng.random(4000) < 0.5, rng.random(4000) < 0.3)
    known = [int(t) if k else None for t, k in zip(y, rng.random(4000) < 0.2, strict=True)]
    model = T.fit_labels(votes_table(spark, [(int(v), t, 1) for v, t in zip(votes, known, strict=True)]), 2)
    p = model.posterior(np.array([[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]))
    assert p[0] > 0.5 > p[1] and p[0] > p[1] >= p[2]


def test_rare_patterns_count(spark):
    """Counts of equal patterns and one row each give the same model, and no pattern is left out, however rare."""
    rng = np.random.default_rng(4)
    rows = [(int(v), None if k < 2 else int(k == 2), int(n)) for v, k, n in zip(rng.integers(0, 1 << 12, 600), rng.integers(0, 4, 600), rng.integers(1, 4, 600), strict=True)]
    a = T.fit_labels(votes_table(spark, rows), 12, 6)
    b = T.fit_labels(votes_table(spark, [(v, t, 1) for v, t, n in rows for _ in range(n)]), 12, 6)
    assert np.allclose(a.rates, b.rates, atol=1e-9) and abs(a.prior - b.prior) < 1e-9 and np.allclose(a.share, b.share, atol=1e-6)


def test_toxic_texts_without_votes_are_reached(spark):
    """Abuse in words that no voter knows is learned from the labels."""
    rng = np.random.default_rng(6)
    calm = [f"wort{i}" for i in range(300)]
    rude = [f"grobian{i}" for i in range(60)]  # many different words, each too rare for a voter
    pick = lambda words, n: [str(w) for w in rng.choice(words, n)]
    rows, truth = [], []
    for i in range(600):
        toxic = i % 4 == 0
        rows.append((i, " ".join(pick(calm, 30) + (pick(rude, 3) if toxic else [])), "de", "s", 0, ""))
        truth.append((i, int(toxic)))
    got = T.score(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(truth, "doc_id long, toxic int")).collect()
    held = [(r.predicted, dict(truth)[r.doc_id]) for r in got if r.held_out]
    assert np.mean([p == 1 for p, t in held if t]) >= 0.9 and np.mean([p == 0 for p, t in held if not t]) >= 0.95


def test_nulls_repeats_long_and_empty(spark):
    rows = [(None, None, "x", "y", 1, "z"), (1, "", None, None, None, None), (2, "you are a stupid idiot and a pathetic loser", "en", "s", 0, ""), (2, "you are a stupid idiot and a pathetic loser", "en", "s", 0, ""), (3, "a calm and kind word " * 10_000, "en", "s", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        got = T.score(docs, known).collect()
        by = {r.doc_id: r.score for r in got}
        assert len(got) == 5 and by[None] == by[1] and by[2] > by[3]
    assert T.score(docs.limit(0), labels).count() == 0


def test_a_text_is_split_into_words_once(monkeypatch):
    from daypanel.llm import toxicity

    seen, split = [], toxicity._words
    monkeypatch.setattr(toxicity, "_words", lambda t: seen.append(t) or split(t))
    got = [words for words, _ in toxicity.looked(["You Idiot, go", ""], ["idiot", "idi*"])]
    assert got == [["you", "idiot", "go"], []] and seen == ["you idiot, go", ""]
