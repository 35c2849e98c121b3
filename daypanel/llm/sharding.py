"""Balanced label propagation of documents into shards, in DataFrame functions only.

Documents are linked where they belong to one group (by default: equal texts).  Groups are held as pieces: the rows of a
group are spread over up to ``pieces`` pieces by row, so a group of any size is many small units, and all votes are counts that are
combined before the shuffle.  Each round every piece looks at the shards of its group's rows and wants to move to the
shard that holds most of them; the demand of all moves is an 8 × 8 table of counts, and the quotas that keep every
shard within its capacity decide which share of each demand moves.  Rows without links take no part until the end: they
fill the shards up to equal counts, together with linked rows beyond a quota.

Law ``rows``: row counts of any two shards differ by one at most.  Ranks come from counts per (shard, bucket) and ranks inside a
bucket, so no task orders a whole shard.

Defined results: null texts are empty texts and equal to each other; repeated rows are placed each; an empty table gives
an empty result; columns besides ``doc_id`` and the text are ignored, whatever their names; of a very long text only size and
digest take part.  Ties between shards go to the lower number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 8
PIECES = 256
ROUNDS = 4
BUCKETS = 4096  # for ranks; a bucket holds one 4096th of a shard's rows


def hashed(*cols: Column | str, parts: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def rows_of(docs: DataFrame, text: str = "text", pieces: int = PIECES) -> DataFrame:
    """``row, doc_id, size, text_crc32, grp, piece, singles``, written without the texts.

    ``singles`` is true for rows whose group has no other row.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("_text"))
    read = stored(picked.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (F.octet_length("_text") + 1).cast("long").alias("size"),
        F.crc32(F.col("_text").cast("binary")).alias("text_crc32"), F.md5("_text").alias("grp"),
    ), "shard-rows")
    return read.withColumn("piece", hashed("row", parts=pieces))


def piece_counts(rows: DataFrame) -> DataFrame:
    """``grp, piece, n`` of groups of two rows or more."""
    counted = rows.groupBy("grp", "piece").agg(F.count(F.lit(1)).alias("n"))
    linked = counted.groupBy("grp").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("grp")
    return counted.join(linked, "grp")


def quotas(demand: list, load: list[int], capacity: int) -> dict[tuple[int, int], float]:
    """Share of each (from, to) demand that may move: equal exchanges first, then what fits into free capacity.

    ``demand`` has at most shards × shards rows.
    """
    want = {(r.shard, r.target): r.n for r in demand}
    allowed = {k: min(n, want.get((k[1], k[0]), 0)) for k, n in want.items()}
    for t in range(len(load)):
        rest = {k: n - allowed[k] for k, n in want.items() if k[1] == t}
        total, free = sum(rest.values()), max(0, capacity - load[t])
        for k, n in rest.items():
            allowed[k] += n * min(1.0, free / total) if total else 0
    return {k: allowed[k] / n for k, n in want.items() if n}


def propagate(pieces: DataFrame, total: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``grp, piece, n, shard`` after the rounds; the number of rows per shard is summed on the way."""
    state = stored(pieces.withColumn("shard", hashed("grp", "piece", parts=shards)), "shard-pieces")
    capacity = total // shards
    for turn in range(rounds):
        votes = state.groupBy("grp", "shard").agg(F.sum("n").alias("n"))
        # at most one entry per shard in each group
        most = votes.groupBy("grp").agg(F.max(F.struct(F.col("n").alias("n"), F.xxhash64("grp", "shard").alias("tie"), F.col("shard").alias("shard"))).alias("best"))
        wishes = votes.join(most, "grp").select("grp", "shard", "n", F.col("best.shard").alias("target")).where(F.col("shard") != F.col("target"))
        demand = wishes.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()
        if not demand:
            break
        held = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        share = quotas(demand, [held.get(s, 0) for s in range(shards)], capacity)
        share_of = F.lit(0.0)
        for (a, b), p in share.items():
            share_of = F.when((F.col("shard") == a) & (F.col("target") == b), F.lit(float(p))).otherwise(share_of)
        moves = wishes.select("grp", "shard", "target", share_of.alias("share"), F.col("n").alias("wish"))
        # small groups move whole, by group; what is large against the capacity moves piece by piece
        large = F.col("wish") * 64 > capacity
        draw = lambda *c: (hashed(F.lit(turn), *c, parts=1_000_000) + 0.5) / 1_000_000
        joined = state.join(moves, ["grp", "shard"], "left")
        goes = F.col("target").isNotNull() & (F.when(large, draw("grp", "piece")).otherwise(draw("grp", "shard")) < F.col("share"))
        state = stored(joined.select("grp", "piece", "n", F.when(goes, F.col("target")).otherwise(F.col("shard")).alias("shard")), "shard-pieces")
    return state


def cut_links(placed: DataFrame) -> DataFrame:
    """Linked pairs of rows that lie in different shards, over all groups, from counts per group and shard."""
    per = placed.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
    pairs = per.groupBy("grp").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
    return pairs.agg(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2).alias("cut"), F.sum(F.col("all") * (F.col("all") - 1) / 2).alias("links"))


def ranked(rows: DataFrame, by: str, order: Column) -> DataFrame:
    """Adds ``rank``, gapless from 0 within ``by``: the offset of the row's bucket plus its rank in the bucket."""
    cell = rows.withColumn("_bucket", hashed(order, parts=BUCKETS))
    counts = cell.groupBy(by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(by).orderBy("_bucket")) - F.col("_n")
    offsets = counts.select(by, "_bucket", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(by, "_bucket").orderBy("row"))
    return cell.withColumn("_in", inside).join(offsets, [by, "_bucket"]).withColumn("rank", F.col("_before") + F.col("_in") - 1).drop("_bucket", "_in", "_before")


def pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), at + 1)


def place(rows: DataFrame, state: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: linked rows by their piece, the rest where rows are missing."""
    pool = shards  # a provisional shard of its own
    held = rows.join(state.select("grp", "piece", "shard"), ["grp", "piece"], "left").withColumn("want", F.coalesce("shard", F.lit(pool))).drop("shard")
    provisional = stored(held, "shard-wanted")
    count = {r.want: r.n for r in provisional.groupBy("want").agg(F.count(F.lit(1)).alias("n")).collect()}
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    kept = [min(count.get(s, 0), quota[s]) for s in range(shards)]
    over = [count.get(s, 0) - kept[s] for s in range(shards)]
    over_before = [sum(over[:s]) for s in range(shards)] + [sum(over)]
    missing = [quota[s] - kept[s] for s in range(shards)]
    missing_before = [sum(missing[:s]) for s in range(shards)]
    # pieces stay together in rank order, so that what is beyond a quota comes from few of them
    r = ranked(provisional, "want", F.struct("grp", "piece"))
    stays = (F.col("want") < pool) & (F.col("rank") < pick([*kept, 0], F.col("want")))
    # rows beyond a quota come first in the queue for the free places, then the rows without links
    queue = pick(over_before, F.col("want")) + F.col("rank") - pick([*kept, 0], F.col("want"))
    free = [s for s in range(shards) if missing[s]]
    place_of = F.lit(free[0] if free else 0)
    for s in free[1:]:
        place_of = F.when(F.col("queue") >= missing_before[s], F.lit(s)).otherwise(place_of)
    out = r.withColumn("stays", stays).withColumn("queue", queue)
    shard = F.when(F.col("stays"), F.col("want")).otherwise(place_of).cast("int")
    out = out.withColumn("shard", shard)
    slot = F.when(F.col("stays"), F.col("rank")).otherwise(pick(kept, F.col("shard")) + F.col("queue") - pick(missing_before, F.col("shard")))
    return out.select("doc_id", "size", "text_crc32", "grp", "shard", slot.cast("long").alias("slot"))


def assign(docs: DataFrame, text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, grp, shard, slot`` of every document."""
    rows = rows_of(docs, text)
    total = rows.count()
    state = propagate(piece_counts(rows), total, shards, rounds)
    return place(rows, state, total, shards)
