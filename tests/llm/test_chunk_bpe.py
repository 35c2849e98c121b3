"""Chunked byte-level BPE against the tokenizer library, and round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from daypanel.llm import chunk_bpe as B
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, piece string, row int, ids binary"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    pieces = ["word", " and", "\n\n", "   ", "12345", "'s", "漢字", "😀", "…!!", "\t", " über", "x" * 40, "\r\n", "é"]
    return ["".join(rng.choice(pieces) for _ in range(n)) for n in (1, 5, 40, 400, 3000)] + ["q" * 900, " " * 700, None, "", " ", "a b" * 333]


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 512), (64, 16), (7, 3)])
def test_chunks_equal_whole_texts(spark, library, chunk, overlap):
    rows = [(i, t, "x", 1, b"") for i, t in enumerate(texts())] + [(None, "a b" * 50, None, None, None), (2, texts()[2], "x", 1, b"")]
    got = B.encode(spark.createDataFrame(rows, SCHEMA), PATH, chunk=chunk, overlap=overlap).collect()
    want = []
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), np.asarray(ids, "<u4").tobytes(), (t or "").encode()))
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert B.digests(B.encode(spark.createDataFrame([], SCHEMA), PATH)).count() == 0


def test_query_on_whole_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op5_byte_bpe"](spark, sf).collect()} == want


def test_one_very_long_text(spark):
    text = "naïve words, 123 and 漢字…  " * 400_000
    row = B.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    assert bytes(row.decoded).decode() == text and row.n_tokens * 4 == len(row.ids)


def test_few_megabytes_of_texts_are_encoded_at_a_time(spark, monkeypatch):
    from daypanel.llm import chunk_bpe

    seen, batches = [], chunk_bpe.in_batches
    monkeypatch.setattr(chunk_bpe, "in_batches", lambda df, work, schema, *step: seen.append(step) or batches(df, work, schema, *step))
    chunk_bpe.encode_pieces(spark.createDataFrame([(1, "a b")], "doc_id long, piece string"), None, "x")
    assert seen == [(2 << 20,)]
