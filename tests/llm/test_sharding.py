"""Shards: exact counts, gapless slots, few cut links."""

import zlib

from daypanel.llm import sharding as S
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, shard string, size string, row int"


def checked(placed, n, shards=8):
    assert len(placed) == n
    by = {}
    for r in placed:
        by.setdefault(r.shard, []).append(r.slot)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_groups_stay_together(spark):
    rows = [(i, f"text {i // 3}" if i < 300 else f"single {i}", "x", "y", 1) for i in range(1000)]
    placed = S.assign(spark.createDataFrame(rows, SCHEMA))
    checked(placed.collect(), 1000)
    r = S.cut_links(placed).first()
    assert r.links == 300 and r.cut <= 30


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "same" if i % 3 == 0 else f"own {i}", None, None, 0) for i in range(3000)]
    placed = S.assign(spark.createDataFrame(rows, SCHEMA))
    checked(placed.collect(), 3000)


def test_only_one_group_nulls_repeats_empty(spark):
    rows = [(None, None, None, None, None)] * 41 + [(7, "", "a", "b", 1)] * 40
    got = S.assign(spark.createDataFrame(rows, SCHEMA)).collect()
    checked(got, 81)
    assert {r.size for r in got} == {1} and {r.text_crc32 for r in got} == {0}
    assert S.assign(spark.createDataFrame([], SCHEMA)).count() == 0
    checked(S.assign(spark.createDataFrame([(1, "a", "", "", 1)], SCHEMA)).collect(), 1)


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op6_label_propagation"](spark, sf).collect()
    checked(got, len(texts))
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_very_long_texts_and_a_third_of_equal_rows(spark):
    rows = [(i, "same text", "a", "b", 1) for i in range(100)] + [(1000 + i, f"{i} " + "long " * 200_000, "a", "b", 1) for i in range(5)] + [(2000 + i, f"one {i}", None, None, None) for i in range(195)]
    placed = S.assign(spark.createDataFrame(rows, SCHEMA)).collect()
    checked(placed, 300)
    assert {r.doc_id: r.size for r in placed if 1000 <= r.doc_id < 1005} == {1000 + i: 1_000_003 for i in range(5)}
