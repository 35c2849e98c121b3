"""Secret scans with multipart credential linking, in DataFrame functions only.

Every text is scanned once.  Matches of a pattern and the gaps between them alternate, so lengths of both give the
positions; the table of lengths is written without the texts, and all that follows works on it.  Strong parts (assigned
secrets, access identifiers, long hex runs) are always reported.  Weak parts (loose random-looking strings, login names,
endpoints) are reported only where a complementary part lies within ``scope`` code points, counted between the nearer ends of the
two intervals, however long either is: a secret needs an identifier or an endpoint, these need a secret.

The interval join goes by blocks of ``scope`` code points.  Per block and role only the first start and the last stop of the
parts that reach into it matter, so a part meets four summary rows and one for each further block it reaches, however many parts a
text has.

Defined results: a null text is empty and has no spans; repeated rows are scanned each; columns besides ``doc_id`` and
the text are ignored, whatever their names; an empty table gives an empty result.  Parts with equal bounds of different kinds are
reported each; a very long text is one row with the lengths of its matches and gaps, and its links go by blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, unused

SCOPE = 256
MASK = "[removed]"


def either_case(words: str) -> str:
    """ASCII letters of a pattern in either case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Kind:
    """``group`` must have ``least`` code points, and match each of ``also``; ``role`` decides which parts complete it."""

    name: str
    pattern: str
    group: int
    least: int
    role: str
    strong: bool
    also: tuple[str, ...] = ()


# The three base kinds, in the order in which equal starts are listed; then the weak kinds.
KINDS = [
    Kind("assign", rf"""({either_case('password|passwd|secret|token')}|{either_case('api')}_?{either_case('key')})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, "secret", True),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16, "id", True),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, "secret", True),
    Kind("loose", r"[A-Za-z0-9+/_-]{20,}", 0, 20, "secret", False, ("[0-9]", "[A-Z]", "[a-z]")),
    Kind("login", rf"""({either_case('username|user|login|account|client_?id')})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]+)""", 2, 3, "id", False),
    Kind("endpoint", rf"""({either_case('https|http|ftp|ssh|postgresql|postgres|mysql|redis|mongodb|amqp|s3')})://[^\x20\x09-\x0D"'<>]+""", 0, 12, "endpoint", False),
]


def parts_of(text: Column, kind: Kind) -> Column:
    """Lengths of the gap before each match and of the match, and whether the match counts."""
    p = F.lit(kind.pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(kind.group)) if kind.group else found
    counts = lambda v: F.length(v) >= kind.least
    ok = F.transform(value, lambda v: counts(v) & _all(v, kind.also))
    rows = F.transform(
        F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), found.alias("match"), ok.alias("ok")),
        lambda x, i: F.struct(F.lit(kind.name).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("len"), x["ok"].alias("ok")),
    )
    # the gap after the last match has none
    listed = F.filter(rows, lambda x: x["len"].isNotNull())
    return F.when(text.rlike(kind.pattern), listed).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,len:int,ok:boolean>>"))


def _all(value: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for p in patterns:
        out = out & value.rlike(p)
    return out


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row, doc_id, text_key, parts``, written: one reading of every text, and a number for every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    parts = F.concat(*[parts_of(F.col("_text"), k) for k in KINDS])
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("_text"))
    return stored(picked.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.md5("_text").alias("text_key"), parts.alias("parts")), "parts")


def positions(scan: DataFrame) -> DataFrame:
    """``row, kind, start, stop`` of all parts that count; matches of one kind and text lie in order, so lengths add up."""
    by = Window.partitionBy("row", "kind").orderBy("i")
    rows = scan.where(F.size("parts") > 0).select("row", F.inline("parts"))
    ends = rows.select("row", "kind", "ok", "len", F.sum(F.col("gap") + F.col("len")).over(by).cast("int").alias("stop"))
    return ends.where("ok").select("row", "kind", (F.col("stop") - F.col("len")).alias("start"), "stop")


def of_kind(field: str) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (k.name, getattr(k, field))]), F.col("kind"))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complementary part in scope, and outside of every strong part."""
    roled = parts.withColumns({"role": of_kind("role"), "strong": of_kind("strong")})
    blocks = lambda first, last: F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope))).alias("at")
    near = lambda role: [
        F.min(F.when(F.col("role") == role, F.col("start"))).alias(f"{role}_first"),
        F.max(F.when(F.col("role") == role, F.col("stop"))).alias(f"{role}_last"),
    ]
    # a long part is entered in every block it reaches
    entered = roled.select("row", "role", "start", "stop", blocks(F.col("start"), F.col("stop") - 1))
    summed = entered.groupBy("row", "at").agg(*near("id"), *near("secret"), *near("endpoint"))
    weak = roled.where(~F.col("strong")).select("row", "kind", "role", "start", "stop", blocks(F.greatest(F.col("start") - scope - 1, F.lit(0)), F.col("stop") + scope))

    def meets(role: str) -> Column:
        # Blocks between the ends of the reach hold only parts that meet it.  In the first block only the last stop can fall short,
        # in the last block only the first start, and the reach is wider than a block; so both extremes decide exactly.
        near_enough = (F.col(f"{role}_first") <= F.col("stop") + scope) & (F.col(f"{role}_last") >= F.col("start") - scope)
        return F.coalesce(near_enough, F.lit(False))

    complete = F.when(F.col("role") == "secret", meets("id") | meets("endpoint")).otherwise(meets("secret"))
    pairs = weak.join(summed, ["row", "at"]).where(complete).select("row", "kind", "start", "stop").distinct()
    # a weak part inside or across a strong one is part of that finding
    strong = roled.where("strong").select("row", F.col("start").alias("s_start"), F.col("stop").alias("s_stop"))
    over = covered(pairs, strong, scope)
    return pairs.join(over, ["row", "kind", "start", "stop"], "left_anti")


def covered(weak: DataFrame, strong: DataFrame, scope: int) -> DataFrame:
    """Weak parts that overlap a strong part: interval join by the blocks that each reaches into."""
    blocks = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / scope), F.floor((F.col(b) - 1) / scope)))
    a = weak.select("*", blocks("start", "stop").alias("at"))
    # of the strong parts of a block and kind those are disjoint; their number in a block is bounded by its width
    b = strong.select("*", blocks("s_start", "s_stop").alias("at"))
    return a.join(b, ["row", "at"]).where((F.col("start") < F.col("s_stop")) & (F.col("s_start") < F.col("stop"))).select("row", "kind", "start", "stop").distinct()


def find(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``doc_id, text_key, spans`` per document; spans are ``start, rank, kind, stop, strong`` in order."""
    scan = scanned(docs, text)
    parts = positions(scan)
    spans = (
        parts.where(of_kind("strong")).unionByName(linked(parts, scope))
        .withColumns({"rank": F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k.name, i)]), F.col("kind")), "strong": of_kind("strong")})
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "stop", "strong"))).alias("spans"))
    )
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,stop:int,strong:boolean>>")
    return scan.select("row", "doc_id", "text_key").join(spans, "row", "left").select("doc_id", "text_key", F.coalesce("spans", empty).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["strong"])).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, found: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """The documents with every span replaced by ``mask``; overlapping spans are replaced once."""
    columns = docs.columns
    key, spans = unused(columns, "key"), unused(columns, "spans")
    keyed = found.where(F.size("spans") > 0).select(F.col("text_key").alias(key), F.col("spans").alias(spans)).dropDuplicates([key])
    # Texts without a character have no span, so their key only has to be dealt evenly.
    own = F.when(F.length(text) > 0, F.md5(F.col(text)))
    joined = docs.withColumn(key, F.coalesce(own, F.concat(F.lit("-"), F.col("doc_id").cast("string")), F.lit("-"))).join(keyed, key, "left")
    t = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], a["at"])
        gap = F.concat(t.substr(a["at"] + 1, begin - a["at"]), F.when(s["start"] >= a["at"], F.lit(mask)).otherwise(F.lit("")))
        return F.struct(F.greatest(s["stop"], a["at"]).alias("at"), F.concat(a["out"], gap).alias("out"))

    clean = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], t.substr(a["at"] + 1, F.length(t))))
    return joined.withColumn(text, F.when(F.col(spans).isNotNull(), clean).otherwise(t)).select(*columns)
