"""Repair of conversation structure: the cheapest edits that make roles read ``(s?(ua)+)?``, and their audit.

``marked`` finds each row's first fault (blank, duplicate, truncated), ``audits`` the cheapest edits of every conversation, and
``repaired`` or ``digests`` replay them over the texts.

A conversation's edits form an acyclic graph: nodes are (rows done, place in the pattern), edges are edits.  An edge's weight is one
integer: its high digits carry the cost, and below them is one base-8 digit for every place of the audit, the first place highest, filled
with zeros at the end.  Putting an edit before the rest moves the rest's digits one place down, so the ordinary minimum of
integers decides cost first, then the ASCII order of the audits (their zero padding makes a prefix the smaller one).

Defined results: null roles and texts count as one space; rows go by turn (nulls first), then role, then SHA-256 of the text; equal
rows of a turn are one row and its repeats; rows without a conversation id are one conversation; a conversation without rows
has zeros, an empty audit and the hash of nothing; further columns are not read, whatever their names; an empty table gives no rows.
Texts of any length: they are hashed or written one after the other and never held together.  Duplicates are found by an aggregate and
a join that can be split, so only marks of rows, some bytes each, meet by conversation; a conversation's audit and hash
are one value each and thus the work of one task.  Its time grows with the square of the rows of one conversation over the word size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Costs, letters in ASCII order, and what may follow in the pattern.
RETYPE, DELETE, INSERT, CUT = 3, 4, 3, 3
LETTERS = "DIKR"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
FOLLOWS = {"su", "ua", "au"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
BITS = 3

SUMMARY = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` with planted faults, decided by a checksum of conversation and turn."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("_kind")
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("_kind")).where(kind != 0)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def collapsed(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with their number ``n`` and the hash ``mark`` of the text."""
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    return plain.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("mark", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def marked(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, mark, n, blank, seen, cut`` of collapsed rows: marks of the faults in place of the text."""
    marks = rows.select(
        "conv_id", "turn", "role", "mark", "n", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    first = F.min(F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))).alias("first")
    firsts = marks.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m")).agg(first)
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    seen = ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return marks.join(firsts, same).select("conv_id", "turn", "role", "mark", "n", "blank", seen.alias("seen"), "cut")


@lru_cache(maxsize=100_000)
def _short(rows: tuple) -> tuple[int, str]:
    return solve(rows)


def cheapest(rows: tuple) -> tuple[int, str]:
    """Cost and audit of a conversation; short ones are remembered."""
    return _short(rows) if len(rows) <= 10 else solve(rows)


def solve(rows: tuple) -> tuple[int, str]:
    """Integer-minimum over the graph of edits; a row is (initial of its role, must go, is cut)."""
    # All rows deleted and two inserted is always a way, so no cheapest way inserts more than this allows.
    places = len(rows) + (DELETE * len(rows) + 2 * INSERT) // INSERT + 1
    width = BITS * places
    low = (1 << width) - 1
    digit = {c: (i + 1) << (width - BITS) for i, c in enumerate(LETTERS)}
    never = (1 << 62) << width

    def before(letter: str, cost: int, rest: int) -> int:
        digits = rest & low
        return rest - digits + (digits >> BITS) + digit[letter] + (cost << width)

    def with_inserts(best: list[int]) -> list[int]:
        for _ in range(3):  # an insert more would meet a place of the pattern again
            for place in NEXT:
                best[place] = min(best[place], before("I", INSERT, best[NEXT[place]]))
        return best

    best = with_inserts([0 if place in ENDS else never for place in NEXT])
    for initial, must_go, cut in reversed(rows):
        edits = []
        for place in NEXT:
            weight = before("D", DELETE, best[place])
            if not must_go:
                weight = min(weight, before("R", RETYPE + CUT * cut, best[NEXT[place]]))
                if (place, initial) in KEPT:
                    weight = min(weight, before("K", CUT * cut, best[KEPT[place, initial]]))
            edits.append(weight)
        best = with_inserts(edits)
    digits = f"{best[START] & low:0{places}o}".rstrip("0")
    return best[START] >> width, "".join(LETTERS[int(d) - 1] for d in digits)


def summary(batch: pa.Table) -> pa.Table:
    """One conversation's counts and cheapest edits from its marks; a row with ``n`` = 0 only names the conversation."""
    t = batch.sort_by([("turn", "ascending"), ("role", "ascending"), ("mark", "ascending")])
    turns, roles, numbers, blanks, seens, cuts = (t.column(c).to_pylist() for c in ("turn", "role", "n", "blank", "seen", "cut"))
    rows: list[tuple] = []
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    # Arrow sorts nulls last; rows without a turn come first.
    dated = [i for i in range(len(turns)) if turns[i] is not None]
    for i in [i for i in range(len(turns)) if turns[i] is None] + dated:
        for copy in range(numbers[i]):
            fault = "blank" if blanks[i] else "duplicate" if seens[i] or copy else "truncated" if cuts[i] else None
            if fault:
                count[fault] += 1
            rows.append((roles[i][:1], fault in ("blank", "duplicate"), fault == "truncated"))
    days = [turns[i] for i in dated]
    gaps = max(days) - min(days) + 1 - len(set(days)) if days else 0
    illegal = sum(a[0] + b[0] not in FOLLOWS for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = cheapest(tuple(rows))
    row = (t.column("conv_id")[0].as_py(), gaps, *count.values(), illegal, cost, audit)
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, SUMMARY_ARROW, strict=True)], schema=SUMMARY_ARROW)


SUMMARY_ARROW = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split(" ") for c in SUMMARY.split(", "))])


def audits(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of all ids in ``conversations`` from collapsed rows."""
    marks = marked(rows)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("mark"), F.lit(0).cast("long").alias("n"),
        F.lit(False).alias("blank"), F.lit(False).alias("seen"), F.lit(False).alias("cut"),
    )
    return marks.unionByName(ids).groupBy("conv_id").applyInArrow(summary, SUMMARY)


class Replay:
    """The edits of one audit, row after row; each call returns the rows (role, text) of the repaired conversation that it settles."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def inserts(self) -> list[tuple[str, str]]:
        out = []
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.place = NEXT[self.place]
            out.append((ROLES[self.place], ""))
        return out

    def row(self, role: str, text: str) -> list[tuple[str, str]]:
        out = self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.place = KEPT[self.place, role[:1]]
            out.append((role, text))
        elif letter == "R":
            self.place = NEXT[self.place]
            out.append((ROLES[self.place], text))
        return out


def in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Audits, each followed by the rows of its conversation, in slices dealt by conversation."""
    nothing = lambda kind: F.lit(None).cast(kind)
    heads = found.select("conv_id", F.lit(0).alias("kind"), nothing("long").alias("turn"), nothing("string").alias("role"), nothing("string").alias("text"), nothing("binary").alias("mark"), nothing("long").alias("n"), F.struct(*(c for c in found.columns if c != "conv_id")).alias("head"))
    bodies = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "mark", "n", nothing(heads.schema["head"].dataType).alias("head"))
    return heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "mark")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the rows of the repaired conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, replay, place = None, None, 0
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        out: list[tuple] = []

        def give(settled: list[tuple[str, str]]) -> None:
            nonlocal place
            for role, text in settled:
                out.append((conv, place, role, text))
                place += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            return made

        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == 0:
                    if replay:
                        give(replay.inserts())
                    conv, replay, place = r["conv_id"], Replay(r["head"]["audit"]), 0
                else:
                    for _ in range(r["n"]):
                        give(replay.row(r["role"], r["text"]))
            yield flushed()
        if replay:
            give(replay.inserts())
        yield flushed()

    return in_order(rows, found).mapInArrow(run, "conv_id long, place long, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``found`` with ``repaired_sha256``, the hash of ``role:text`` of all repaired rows, joined by newlines."""
    columns = [c.split(" ")[0] for c in SUMMARY.split(", ")]
    schema = SUMMARY_ARROW.append(pa.field("repaired_sha256", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, replay, sha, any_yet = None, None, None, False

        def take(settled: list[tuple[str, str]]) -> None:
            nonlocal any_yet
            for role, text in settled:
                sha.update(f"{chr(10) * any_yet}{role}:{text}".encode())
                any_yet = True

        def ended() -> Iterator[tuple]:
            if replay:
                take(replay.inserts())
                yield (*head, sha.hexdigest())

        def batch(done: list[tuple]) -> pa.RecordBatch:
            parts = list(zip(*done, strict=True)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(parts, schema, strict=True)], schema=schema)

        for b in batches:
            done = []
            for r in b.to_pylist():
                if r["kind"] == 0:
                    done += ended()
                    values = r["head"] | {"conv_id": r["conv_id"]}
                    head, replay, sha, any_yet = [values[c] for c in columns], Replay(values["audit"]), hashlib.sha256(), False
                else:
                    for _ in range(r["n"]):
                        take(replay.row(r["role"], r["text"]))
            yield batch(done)
        yield batch(list(ended()))

    return in_order(rows, found).mapInArrow(run, SUMMARY + ", repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Collapsed rows and the audits of all conversations, both written once."""
    rows = stored(collapsed(rows), "turns")
    return rows, stored(audits(rows, conversations), "audits")
