"""The pipeline's rows against plain versions of its stages on the smallest tables."""

import base64
import hashlib

import corpus_pipeline as P
import numpy as np
import public_tokenizers
import tiktoken
from test_credentials import brute as brute_spans
from test_jaccard_join import brute as brute_components

SF = "/root/testdata/sf0.001"


def masked(text):
    spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in brute_spans(text)[1].split(",") if s))
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[removed]"
        at = max(at, b)
    return out + text[at:]


def test_run_equals_plain_stages(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text.split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 8]) for w in items for i in range(len(w) - 7)}
    kept = {i: t for i, t in docs.items() if any(c.isalpha() for c in t)}
    parts = brute_components(list(kept.items()))
    kept = {i: t for i, t in kept.items() if parts[i][1] == i}
    kept = {i: t for i, t in kept.items() if not any(tuple(w) in grams for w in windows(t.split()))}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in kept.items():
        text = masked(t)
        ids = own.encode_ordinary(text)
        want[i] = (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.run(spark, SF).collect()}
    assert got == want


def windows(words):
    return [words[i : i + 8] for i in range(len(words) - 7)]


def test_stages_take_nulls_repeats_and_extra_columns(spark):
    text = "the reading of these words is plain english for anyone who looks at it once more"
    long = " ".join(f"word{i} reading plain" for i in range(30_000))
    rows = [(None, None, None, None, 1, "x"), (1, "", "en", "a", 0, None), (2, text, "en", "a", 1, "k"), (2, text, "en", "a", 1, "k"), (None, text, None, None, None, None), (3, "password=abcdefgh1 " + text[:30], "en", "b", 5, "n"), (4, long, "en", "c", 7, "l")]
    own = ["_key", "_id", "_spans", "key", "id", "spans", "chosen_id", "row", "k"]
    docs = spark.createDataFrame([(*r, *(f"{c} of {r[5]}" for c in own)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, mine string, " + ", ".join(f"{c} string" for c in own))
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    got = {tuple(r) for r in docs.collect()}
    rest = lambda mine: tuple(f"{c} of {mine}" for c in own)
    assert got == {(2, text, "en", "a", len(text), "k", *rest("k")), (3, "[removed] " + text[:30], "en", "b", 40, "n", *rest("n")), (4, long, "en", "c", len(long), "l", *rest("l"))}


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs_out = stage(spark, docs, SF)
        assert docs_out.count() == 0
