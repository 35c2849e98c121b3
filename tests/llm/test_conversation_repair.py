"""Conversation repair against a search over all edits, and the query against a plain version on whole tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from daypanel.llm import conversation_repair as C
from daypanel.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, n int, mark string, kind int"
PATTERN = re.compile(r"(s?(ua)+)?")


def searched(rows):
    """All edits by growing cost: the first cost with a way, and the least audit among all its ways."""
    best = None
    n = len(rows)
    for inserts in range(n + 3):
        for places in itertools.combinations_with_replacement(range(n + 1), inserts):
            for edits in itertools.product("KRD", repeat=n):
                cost, sets, audit = 3 * inserts, [], ""
                for i in range(n + 1):
                    for _ in range(places.count(i)):
                        audit += "I"
                        sets.append("ua")
                    if i < n:
                        initial, must_go, cut = rows[i]
                        e = edits[i]
                        if must_go and e != "D":
                            break
                        audit += e
                        cost += {"K": 0, "R": 3, "D": 4}[e] + 3 * (cut and e != "D")
                        if e != "D":
                            sets.append(initial if e == "K" else "ua")
                else:
                    if (best is None or (cost, audit) < best) and fits(sets):
                        best = cost, audit
    return best


def fits(sets):
    """Whether some choice of the free roles makes the pattern."""
    return any(PATTERN.fullmatch("".join(c)) for c in itertools.product(*sets)) if sets else True


def test_every_short_conversation():
    kinds = [(c, g, t) for c in "suax" for g, t in ((False, False), (True, False), (False, True))]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert C.solve(rows) == searched(rows), rows


def test_longer_conversations():
    rnd = random.Random(5)
    kinds = [("s", False, False), ("u", False, False), ("a", False, False), ("u", False, False), ("a", False, False), ("u", True, False), ("a", False, True), ("t", False, False)]
    for _ in range(25):
        rows = tuple(rnd.choice(kinds) for _ in range(rnd.randint(3, 4)))
        assert C.solve(rows) == searched(rows), rows


def replayed(audit, rows):
    """The repaired rows, by the pattern alone."""
    rows, out, expected = iter(rows), [], "u"
    for e in audit:
        role, text = (None, "") if e == "I" else next(rows)
        if e == "D":
            continue
        if e == "K":
            out.append((role, text))
            expected = "u" if role[0] in "sa" else "a"
        else:
            out.append(("user" if expected == "u" else "assistant", text))
            expected = "a" if expected == "u" else "u"
    return out


def plain(rows):
    """The query's rows by plain loops; rows are (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        here = by[conv]
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, here in by.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        count, seen, marks = [0, 0, 0], set(), []
        for _, role, text in here:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last[0] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                count[fault] += 1
            marks.append((role[:1], fault in (0, 1), fault == 2))
        turns = [t for t, *_ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:], strict=False))
        cost, audit = C.solve(tuple(marks))
        text = "\n".join(f"{r}:{t}" for r, t in replayed(audit, [(r, t) for _, r, t in here]))
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def run(df):
    rows, found = C.repair(C.damage(df), df)
    return rows, found, {r.conv_id: tuple(r)[1:] for r in C.digests(rows, found).collect()}


def test_nulls_ties_repeats_long_texts(spark):
    rnd = random.Random(3)
    rows = []
    for conv in [None, *range(60)]:
        for turn in [None, *range(rnd.randint(0, 9))]:
            for _ in range(rnd.choice([1, 1, 1, 2])):
                rows.append((conv, turn, rnd.choice(["user", "assistant", "system", None, "tool"]), rnd.choice(["Hi.", "Hi.", "so", "", None, " \t", "Why?  ", "é" * 3000 + "!", f"t{rnd.random()}."])))
    rows += rows[:20] + [(100, None, "user", "x.")] + [(200, t, "user" if t % 2 == 0 else "assistant", f"No. {t}.") for t in range(600)]
    _, _, got = run(spark.createDataFrame([(*r, 1, "m", 0) for r in rows], SCHEMA))
    assert got == plain(rows)


def test_repaired_rows_follow_the_pattern(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows, found, got = run(df)
    by = defaultdict(list)
    for r in C.repaired(rows, found).orderBy("conv_id", "place").collect():
        by[r.conv_id].append((r.role, r.text))
    assert all(PATTERN.fullmatch("".join(r[0] for r, _ in v)) for v in by.values())
    assert all(hashlib.sha256("\n".join(f"{r}:{t}" for r, t in by[c]).encode()).hexdigest() == v[-1] for c, v in got.items())


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA))[2] == {}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_whole_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op13_conversation_repair"](spark, f"/root/testdata/{sf}")
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in df.collect()} == plain(rows)
