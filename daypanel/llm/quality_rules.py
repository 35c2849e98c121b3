"""Quality rules as a bitmask ledger.

``measure`` reads every text once and returns measurements; ``ledger`` evaluates every rule once on them and stores
one bit per failed rule.  Policies are versions: named sets of rules whose failure removes a document.  ``apply``
and ``ablation`` need only the bits, so a new policy costs no second look at the texts.

Defined results: a null or empty text has no words (it fails ``few_words``); repeated rows give repeated rows; any
further columns are ignored, whatever their names; an empty table gives an empty ledger; a very long text is one row, measured in
one pass over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, utf8

# ASCII white space of the word pattern, and what counts as a symbol.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurements; ``bit`` never changes its meaning once used."""

    name: str
    bit: int
    fails: str


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


RULES = [
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", 2, "100 * n_symbols > 10 * word_chars"),
    Rule("repeated_lines", 3, "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
]

POLICIES = [
    Policy("base", ("few_words", "repeated_words")),
    Policy("v1", ("few_words", "repeated_words", "many_symbols")),
    Policy("v2", ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words")),
]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    m = len(ids)
    pair = w[:-1] * m + w[1:]
    if m > 2_000_000:  # three ids no longer fit 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * m + w[2:]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def measure(docs: DataFrame, text: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row of measurements per document; ``keys`` are carried along."""
    kinds = dict(docs.dtypes)
    picked = docs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], utf8(text).alias("_text"))
    carried = [f"_k{i}" for i in range(len(keys))]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")}
        for t in batch.column(len(carried)).to_pylist():
            words = t.split()
            n_lines, n_dup = repeated_lines(t)
            for c, v in zip(out, (len(words), len(t.translate(None, SPACES + CONTINUATION)), len(t) - len(t.translate(None, SYMBOLS)), n_lines, n_dup, repeated_words(words)), strict=True):
                out[c].append(v)
        yield {c: batch.column(i) for i, c in enumerate(carried)} | out

    schema = ", ".join([f"_k{i} {kinds[k]}" for i, k in enumerate(keys)] + [MEASURES])
    measured = in_batches(picked, work, schema)
    return measured.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *[c for c in measured.columns if c not in carried])


def bits_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    at = {r.name: r.bit for r in rules}
    return sum(1 << at[n] for n in names)


def ledger(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements with ``fail_bits``: every rule is evaluated once."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(bits_of(policy.rules, rules)).cast("long")) == 0


def apply(led: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One boolean column ``keep_<version>`` per policy."""
    return led.withColumns({f"keep_{p.version}": passes(p, rules) for p in policies})


def ablation(led: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy and rule: documents that fail it, that fail it alone, and that the policy keeps without it.

    The ledger is first reduced to counts per bit pattern (at most 2 to the number of rules, and combined before the
    shuffle); the rest is bit arithmetic over those counts.
    """
    patterns = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    at = {r.name: r.bit for r in rules}
    grid = F.array(*[
        F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.lit(bits_of(p.rules, rules)).cast("long").alias("mask"), F.lit(1 << at[name]).cast("long").alias("bit"))
        for p in policies for name in p.rules
    ])
    cells = patterns.select("fail_bits", "n", F.inline(grid))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    others = hit.bitwiseAND(F.bitwise_not("bit"))
    n_if = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return cells.groupBy("policy", "rule").agg(
        n_if(hit.bitwiseAND(F.col("bit")) != 0).alias("failed"),
        n_if((hit == F.col("bit"))).alias("failed_alone"),
        n_if(hit == 0).alias("kept"),
        n_if(others == 0).alias("kept_without"),
    )
