"""Spelling variants: words one edit apart, found by a trie of letter-group counts, and grouped under their commonest form.

A word's frequency vector counts its letters in ``GROUPS`` groups.  One inserted code point raises one count by one (surplus), one
deleted lowers one (deficit), one replaced does both or, inside a group, neither.  The words stand in a trie by length and then by the
counts of one group after the other.  A depth-first search from a word spends at most one surplus and one deficit on its way down;
the words of the leaves it reaches are verified code point by code point.

The trie is dealt over tasks by its upper levels: a node (length, counts of the first groups) is one group of rows, and each word is
also sent to the nodes that its budget reaches.  Only the upward half is sent (longer words, or equally long and later in the
order of nodes), so each pair meets once.  The number of upper levels is chosen from the counted words, such that no node holds more than
``NODE`` words, or all groups are used up.  Words of one vector can be many even so; inside a leaf only those are compared that share
their first or second half, as one edit leaves one of them alone.

Defined results: a null text has no words; a null ``doc_id`` is written as nothing before the colon; repeated rows count each; ties in a
form go to the first word in code-point order; a very long text is one row's run of words, exploded like any other; further columns are not
read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Runs, shortest word, least count, ratio of a form, and the rule that deletes a code point of some runs.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, TIMES, SLIP = 6, 5, 5, 199

# Letters dealt to groups of similar weight in European text; any other code point is in the last group.
GROUPS = ("e", "a", "i", "n", "t", "s", "r", "o", "lcd", "umh", "pgbv")
NODE = 2_000  # words of a node of the upper trie


def words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: all words of whole texts and how often they occur, counted before the exchange."""
    runs = docs.select(F.col("doc_id").cast("string").alias("d"), F.explode(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    size = F.length("run")
    mark = F.crc32(F.concat(F.coalesce("d", F.lit("")), F.lit(":"), "run").cast("binary"))
    at = (mark % size).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    word = F.when(mark % SLIP == 0, slipped).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def vector(word: str = "word") -> list[Column]:
    """Counts of each group's letters; the last group's count follows from the length."""
    return [(F.length(word) - F.length(F.translate(word, letters, ""))).cast("int").alias(f"c{i}") for i, letters in enumerate(GROUPS)]


def upper_levels(vectors: DataFrame) -> int:
    """The fewest upper levels whose largest node holds at most ``NODE`` words; all groups if none does.

    One number for each depth comes back: words are counted by whole vector first, then by its beginnings.
    """
    columns = [f"c{i}" for i in range(len(GROUPS))]
    whole = vectors.groupBy("size", *columns).agg(F.count(F.lit(1)).alias("k"))
    by_depth = whole.rollup("size", *columns).agg(F.sum("k").alias("k"), F.grouping_id().alias("g")).groupBy("g").agg(F.max("k").alias("most")).collect()
    # A rollup's id has one bit for every column left out, counted from the last.
    most = {len(columns) - int(r.g).bit_length(): r.most for r in by_depth}
    return next((d for d in range(1, len(columns)) if most.get(d, 0) <= NODE), len(columns))


def dealt(vectors: DataFrame, levels: int) -> DataFrame:
    """Rows ``node, word, n, up, down, home``: each word at its node, and at the nodes upward that one surplus and one deficit reach.

    ``up`` and ``down`` say what of the budget is left below the node.  The counts below the upper levels are one more
    entry of the node's vector here, so surplus and deficit may also lie there.
    """
    upper = [f"c{i}" for i in range(levels)]
    node = lambda size, counts: F.array(size, *counts)
    stay = [F.col(c) for c in upper]
    moved = lambda up, down: [F.col(c) + (1 if i == up else 0) - (1 if i == down else 0) for i, c in enumerate(upper)]
    below = levels  # the place of everything below
    size = F.col("size")
    steps = [F.struct(node(size, stay).alias("node"), F.lit(1).alias("up"), F.lit(1).alias("down"), F.lit(True).alias("home"))]
    # One code point longer: a surplus in an upper group, or below.
    for up in range(levels + 1):
        steps.append(F.struct(node(size + 1, moved(up, -1)).alias("node"), F.lit(int(up == below)).alias("up"), F.lit(0).alias("down"), F.lit(False).alias("home")))
    # Equally long and later in order: the surplus lies before the deficit.
    for up, down in combinations(range(levels + 1), 2):
        steps.append(F.struct(node(size, moved(up, down)).alias("node"), F.lit(0).alias("up"), F.lit(int(down == below)).alias("down"), F.lit(False).alias("home")))
    return vectors.select("word", F.explode(F.array(*steps)).alias("at")).select("at.node", "word", "at.up", "at.down", "at.home").where(~F.exists("node", lambda c: c < 0))


def counts_of(word: str) -> tuple[int, ...]:
    return tuple(sum(map(word.count, letters)) for letters in GROUPS)


def trie_of(found: list[str], levels: int) -> dict | list[str]:
    """The lower trie: counts of one group after the other; its leaves are lists of words."""
    root: dict = {}
    if levels == len(GROUPS):
        return found
    for word in found:
        counts, here = counts_of(word), root
        for c in counts[levels:-1]:
            here = here.setdefault(c, {})
        here.setdefault(counts[-1], []).append(word)
    return root


def reached(here: dict | list[str], counts: tuple[int, ...], at: int, up: int, down: int) -> Iterator[list[str]]:
    """Depth-first: the leaves whose counts differ from ``counts`` by at most the budget."""
    if at == len(counts):
        yield here
        return
    c = counts[at]
    if (child := here.get(c)) is not None:
        yield from reached(child, counts, at + 1, up, down)
    if up and (child := here.get(c + 1)) is not None:
        yield from reached(child, counts, at + 1, up - 1, down)
    if down and (child := here.get(c - 1)) is not None:
        yield from reached(child, counts, at + 1, up, down - 1)


def near(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Leaf:
    """The words of a leaf, by first and by second half once there are many of them."""

    FEW = 16

    def __init__(self, found: list[str]):
        self.found = found
        self.halves: dict[tuple, list[str]] = defaultdict(list)
        if len(found) > self.FEW:
            for w in found:
                # One edit leaves the first or the last so many code points alone; the second size serves words one shorter.
                for size in {(len(w) - 1) // 2, (len(w) - 2) // 2}:
                    self.halves[size, 0, w[:size]].append(w)
                    self.halves[size, 1, w[len(w) - size :]].append(w)

    def candidates(self, word: str) -> set[str] | list[str]:
        if not self.halves:
            return self.found
        k = (min(len(word), len(self.found[0])) - 1) // 2
        return {*self.halves.get((k, 0, word[:k]), ()), *self.halves.get((k, 1, word[len(word) - k :]), ())}


def near_pairs(vectors: DataFrame, levels: int) -> DataFrame:
    """``a, b``: every pair of near words once."""
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])

    def run(t: pa.Table) -> pa.Table:
        rows = list(zip(*(t.column(c).to_pylist() for c in ("word", "up", "down", "home")), strict=True))
        trie = trie_of([w for w, _, _, home in rows if home], levels)
        leaves: dict[int, Leaf] = {}
        a, b = [], []
        for word, up, down, home in rows if trie else []:
            for found in reached(trie, counts_of(word)[levels:], 0, up, down):
                leaf = leaves.get(id(found))
                if leaf is None:
                    leaf = leaves[id(found)] = Leaf(found)
                for other in leaf.candidates(word):
                    # At home two words meet in both directions; the smaller one keeps the pair.
                    if (not home or word < other) and near(word, other):
                        a.append(word)
                        b.append(other)
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())}, schema=schema)

    return dealt(vectors, levels).groupBy("node").applyInArrow(run, "a string, b string")


def forms(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``word, n, form, form_n, n_near``: the near word of largest count, if that is large enough."""
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other")), F.struct(F.col("b").alias("word"), F.col("a").alias("other")))).alias("p")).select("p.word", "p.other")
    counted = both.join(found.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    large = -F.col("best.less") >= TIMES * F.col("n")
    return found.join(best, "word", "left").select(
        "word", "n", F.when(large, F.col("best.other")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )


def rooted(found: DataFrame) -> DataFrame:
    """With ``root``: the last of a word's chain of forms, by doubling steps until no chain goes on.

    Counts grow fivefold along a chain, so five doublings reach the end for any count of 64 bits.
    """
    links = stored(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "links")
        links = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of the texts."""
    found = stored(words(docs, text), "words")
    vectors = stored(found.select("word", F.length("word").alias("size"), *vector()), "vectors")
    pairs = near_pairs(vectors, upper_levels(vectors))
    return rooted(stored(forms(found, pairs), "forms")).select("word", "form", "root", "n", "n_near", "form_n")
