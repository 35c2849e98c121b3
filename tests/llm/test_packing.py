"""Packing: pieces against the tokenizer library, laws of the placement, and the number of sequences against plain best fit."""

import os
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
import public_tokenizers
from daypanel.llm import packing as P
from daypanel.llm.queries import QUERIES
from daypanel.llm.word_bpe import chunks, encoder
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, length string, slice int, place string, sequence_id int"


def library(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def cut(docs, limit):
    out = []
    for doc, text in docs:
        ids = library(text)
        for i, at in enumerate(range(0, len(ids), limit)):
            part = ids[at : at + limit]
            out.append((doc, i, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    return Counter(out)


def check(rows, limit):
    """Every sequence is gapless from 0 and no longer than the limit; the number of sequences comes back."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= limit
    return len(by)


def best_fit(lengths, limit):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect_left(gaps, length)
        if i == len(gaps):
            n += 1
            room = limit
        else:
            room = gaps.pop(i)
        if room > length:
            insort(gaps, room - length)
    return n


@pytest.mark.parametrize("kind", ["short", "mixed", "halves", "equal", "thirds", "long"])
def test_as_few_sequences_as_best_fit(spark, kind):
    rnd = random.Random(4)
    limit = 512
    lengths = {
        "short": [rnd.randint(1, 9) for _ in range(3000)], "mixed": [min(limit, int(rnd.paretovariate(0.7)) * 3) for _ in range(2500)],
        "halves": [rnd.randint(240, 270) for _ in range(400)], "equal": [100] * 1000, "thirds": [rnd.randint(150, 190) for _ in range(500)] + [40] * 30,
        "long": [limit] * 50 + [limit - 1] * 10 + [1] * 4,
    }[kind]
    pieces = spark.createDataFrame([(i % 50, i, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length int")
    rows = P.pack(pieces, limit).collect()
    assert sorted((r.piece, r.length) for r in rows) == list(enumerate(lengths))
    least = max(-(-sum(lengths) // limit), sum(n > limit // 2 for n in lengths))
    assert least <= check(rows, limit) <= best_fit(lengths, limit) * 1.01 + 1


def test_pieces_equal_the_library(spark):
    texts = [None, "", " ", "Hello WORLD", "x", "don't 12½ ΑΣ ΑΣΑ İstanbul", "<|endoftext|> a <|startoftext|>b", "漢字かな 😀👩‍👩‍👧 𝐀𝐁", "é à́ \x85\xa0z", "word " * 3000, "q" * 9000, "1" * 400]
    docs = [*enumerate(texts), (None, "hello world"), (3, "Hello WORLD"), (3, "Hello WORLD")]
    rows = [(i, t, "a", "b", 1, "c", 2) for i, t in docs]
    pieces = P.token_pieces(spark.createDataFrame(rows, SCHEMA), PATH, limit=100)
    packed = P.pack(pieces, 100).collect()
    check(packed, 100)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == cut(docs, 100)


def test_long_text_in_chunks():
    text = "naïve Σίσυφος’s  costs 1234, " * 300
    assert "".join(chunks(text, 50)) == text and len(list(chunks(text, 50))) > 100
    assert list(chunks("x" * 500, 50)) == ["x" * 500]
    ids = b"".join(encoder(PATH)([c for c in chunks(text, 50)]))
    assert np.frombuffer(ids, "<u4").tolist() == library(text)[:-1]


def test_sequences_hold_the_ids(spark):
    docs = [(i, f"text no {i} " * (i % 7)) for i in range(40)]
    pieces = P.token_pieces(spark.createDataFrame(docs, "doc_id long, text string"), PATH, limit=30, with_ids=True)
    packed = P.pack(pieces, 30)
    rows = packed.collect()
    for s in P.sequences(packed).collect():
        ids = np.frombuffer(s.ids, "<u4").tolist()
        assert len(ids) == s.length
        for r in rows:
            if r.sequence_id == s.sequence_id:
                assert ids[r.offset : r.offset + r.length] == library(docs[r.doc_id][1])[r.start : r.start + r.length]


def test_empty_table(spark):
    packed = P.pack(P.token_pieces(spark.createDataFrame([], SCHEMA), PATH))
    assert packed.count() == 0 and packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op12_best_fit_packing"](spark, sf).collect()
    want = cut(docs, 4096)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    lengths = [k[3] for k in want.elements()]
    assert check(rows, 4096) <= best_fit(lengths, 4096) + 1
