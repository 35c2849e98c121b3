"""Token counts against the tokenizer library."""

import public_tokenizers
from daypanel.llm import token_counts as T
from daypanel.llm.bpe import merge, splitter, tokenizer_json
from daypanel.llm.queries import QUERIES
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, n_tokens string, _text int"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark):
    special = sorted(tokenizer_json(PATH)[2])
    texts = [None, "", " ", "\n\n \t x", "hello world", "It's  a test…\r\n", "漢字かな交じり文 😀👩‍👩‍👧", "été", "z" * 5000, "ab " * 20_000, "12345678901234567890"]
    texts += [f"a{s}b {s}{s}" for s in special] + ["<|not special|>"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "hello", None, None), (4, "hello world", "x", 1)]
    got = T.count_tokens(spark.createDataFrame(rows, SCHEMA), PATH).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    want = [(i, len((t or "").encode()), library(t), library(t) > 512) for i, t, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_whole_tokens_encode_alone():
    ids, ranks, _ = tokenizer_json(PATH)
    found = T.whole_tokens(ids, ranks)
    tokenizer = Tokenizer.from_file(PATH)
    assert len(found) > len(ids) // 2
    for s in sorted(found)[::97]:
        assert len(tokenizer.encode(s, add_special_tokens=False).ids) == 1 and splitter()(s) == [s] and merge(s.encode(), ranks) == [s.encode()]


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = {r.doc_id: (len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in QUERIES["op2_token_counts"](spark, sf).collect()} == want
