"""The rule ledger against a plain reading of the rules."""

import re
from collections import Counter

from daypanel.llm import quality_rules as Q
from daypanel.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, fail_bits string, n_words int, _text string"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(repeated))


def failed(m):
    n_words, chars, symbols, lines, dup, repeated = m
    return [n_words < 50, 100 * repeated > 50 * n_words, 100 * symbols > 10 * chars, 100 * dup > 30 * lines, chars < 2 * n_words, chars > 20 * n_words]


TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "a", "a b c a b c", "a b c\na b c\n\n \n", "#$% <a> ü ß 漢字 \x1f x\x85y", "x " * 3000, "y" * 200_000,
    "one two three four five six seven eight nine ten " * 20, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(49)),
    " ".join(f"w{i}" for i in range(50)) + "\r\nnext", "line\n" * 100, "😀 😀 😀 😀 😀",
]


def test_measures_and_bits(spark):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(TEXTS)] + [(0, None, None, None, None), (None, "a b", "", 0, "")]
    got = Q.ledger(Q.measure(spark.createDataFrame(rows, SCHEMA))).collect()
    want = Counter((i, *brute(t), sum(1 << k for k, f in enumerate(failed(brute(t))) if f)) for i, t, *_ in rows)
    assert Counter((r.doc_id, *(r[c] for c in MEASURES), r.fail_bits) for r in got) == want


def test_ablation_equals_a_second_look(spark):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(TEXTS)]
    led = Q.ledger(Q.measure(spark.createDataFrame(rows, SCHEMA)))
    bits = [{r.name for r, f in zip(Q.RULES, failed(brute(t)), strict=True) if f} for t in TEXTS]
    want = set()
    for p in Q.POLICIES:
        for rule in p.rules:
            own = [b & set(p.rules) for b in bits]
            want.add((p.version, rule, sum(rule in b for b in own), sum(b == {rule} for b in own), sum(not b for b in own), sum(not b - {rule} for b in own)))
    assert {tuple(r) for r in Q.ablation(led).select("policy", "rule", "failed", "failed_alone", "kept", "kept_without").collect()} == want


def test_empty_table(spark):
    led = Q.ledger(Q.measure(spark.createDataFrame([], SCHEMA)))
    assert Q.apply(led).count() == 0 and Q.ablation(led).count() == 0


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_quality_rules"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        m = brute(texts[r.doc_id])
        f = failed(m)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (*m[:3], *m[4:])
        assert (r.base_failed, r.kept) == (f[0] or f[1], not any(f))
