"""The conditional random field: forward-backward against all paths, held-out accuracy, defined cases."""

import time
import zlib
from itertools import product

import numpy as np
from daypanel.llm import language_crf as L
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score string, words int"


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 4, 2, 5])
    scores, moves = rng.normal(size=(12, 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    got, moved = L.posteriors(scores, lengths, moves)
    want, want_moved, at = np.zeros((12, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        paths = list(product(range(3), repeat=int(n)))
        weight = np.array([np.exp(sum(scores[at + t, z] for t, z in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths])
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            for t, z in enumerate(p):
                want[at + t, z] += w
            for a, b in zip(p, p[1:], strict=False):
                want_moved[a, b] += w
        at += n
    assert np.allclose(got, want, atol=1e-4) and np.allclose(moved, want_moved, atol=1e-3)


def test_held_out_accuracy_and_score_range(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op10_language_crf"](spark, sf).collect()
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and truth[r.doc_id] is not None]
    assert np.mean(held) >= 0.95


def test_words_of_two_languages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    crf = L.fit(docs.where(~L.is_held_out(docs["doc_id"])))
    texts = {lang: docs.where(f"lang = '{lang}' and crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").first().text.split()[:40] for lang in ("en", "de")}
    mixed = spark.createDataFrame([(1, " ".join(texts["en"] + texts["de"]), None, None, None)], SCHEMA)
    r = L.label(mixed, crf, words=True).first()
    half = len(L.words_of(" ".join(texts["en"])))
    assert np.mean([x == "en" for x in r.word_langs[:half]]) > 0.8 and np.mean([x == "de" for x in r.word_langs[half:]]) > 0.8


def test_nulls_repeats_long_and_empty(spark):
    rows = [(None, None, "en", "x", 1), (1, "", "en", "x", 1), (2, "12 + 3 !", None, None, None), (3, "the words of it " * 20_000, "en", "x", 1), (4, "die Wörter", "de", "", 0), (4, "die Wörter", "de", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    crf = L.fit(docs.where("doc_id in (3, 4)"))
    got = sorted(((r.doc_id, r.lang_pred) for r in L.label(docs, crf).collect()), key=str)
    assert got == sorted([(None, "und"), (1, "und"), (2, "und"), (3, "en"), (4, "de"), (4, "de")], key=str)
    assert [r.lang_pred for r in L.label(docs, L.fit(docs.where("doc_id < 0"))).collect()] == ["und"] * 6
    assert L.label(docs.limit(0), crf).count() == 0


def test_sample_keeps_languages_of_many_copies(spark):
    rows = [(lang, f"{lang} text number {i % 10}") for lang in ("aa", "bb", "cc") for i in range(4000)] + [("dd", f"text {i}") for i in range(4000)]
    drawn = L.training_sample(spark.createDataFrame(rows, "lang string, text string"), 300).collect()
    by = {lang: [r.text for r in drawn if r.lang == lang] for lang in ("aa", "bb", "cc", "dd")}
    assert all(sorted(by[x]) == sorted(f"{x} text number {i}" for i in range(10)) for x in ("aa", "bb", "cc"))
    assert len(by["dd"]) == len(set(by["dd"])) == 300


def test_long_runs_are_several_elements():
    run = "漢字仮名" * 100 + "x" * 100
    assert "".join(L.words_of(run)) == run and max(map(len, L.words_of(run))) <= L.LONGEST


def test_pieces_of_a_long_text_equal_the_whole():
    rng = np.random.default_rng(8)
    lengths = np.array([3, 2500, 1, 700, 90, 1024, 1025])
    scores, moves = rng.normal(size=(lengths.sum(), 3)).astype(np.float32) * 2, np.log(np.full((3, 3), 0.02) + np.eye(3) * 0.94)
    want = L.posteriors(scores, lengths, moves)[0]
    for piece in (50, 200, 1024):
        assert np.abs(L.long_posteriors(scores, lengths, moves, piece, 64) - want).max() < 1e-4


def test_one_very_long_text(spark):
    text = "the reading of these words is plain english " * 150_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    crf = L.fit(spark.createDataFrame([(i, f"the words number {i} are plain", "en") for i in range(20)] + [(100 + i, f"die wörter nummer {i} sind klar", "de") for i in range(20)], "doc_id long, text string, lang string"))
    row = L.label(docs, crf).first()
    assert row.n_words == 8 * 150_000 and row.lang_pred == "en"


def test_posteriors_without_moves_are_the_same():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 1, 7, 7, 2])
    scores, moves = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    with_moves, moved = L.posteriors(scores, lengths, moves)
    without, none = L.posteriors(scores, lengths, moves, moving=False)
    assert np.array_equal(with_moves, without) and moved.any() and not none.any()


def test_features_hashed_together_are_those_of_each_word():
    words = ["a", "é", "漢", "𐐀", "ab", "éa", "abc", "ǆx", "漢字仮名", "𐐀𐐀x", "straße", "the", "x" * L.LONGEST]
    lexicon = {"the": 2, "a": 0, "漢字仮名": 11}
    rows, sizes = L.feature_rows(words, lexicon)
    want = [L.features(w, lexicon) for w in words]
    assert sizes.tolist() == list(map(len, want)) and rows.tolist() == [i for x in want for i in x]


def test_scores_of_new_words_cost_less_than_hashing_each_feature():
    letters = np.random.default_rng(5).integers(97, 123, (20_000, 9), dtype=np.uint8)
    words = list({w.tobytes().decode() for w in letters})
    weights = np.random.default_rng(6).normal(size=(L.BUCKETS, 4)).astype(np.float32)
    crf = L.Crf(list("abcd"), {words[0]: 1}, weights, np.zeros((4, 4), np.float32))
    start = time.process_time()
    got = L.emissions(words, crf)
    fast = time.process_time() - start
    each = [L.features(w, crf.lexicon) for w in words]
    slow = time.process_time() - start - fast
    assert np.allclose(got, [weights[x].sum(0) for x in each], atol=1e-3) and len(L.emissions([], crf)) == 0
    assert fast < slow / 2
