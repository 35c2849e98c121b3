"""Packing of documents into training sequences by bulk-synchronous best fit.

``token_pieces`` gives the token pieces of every document: its ids and an end mark, cut into pieces of ``limit`` only if longer.
``pack`` places the pieces into sequences of at most ``limit`` tokens:

1. A range sort by falling length gives every piece a rank.  Pieces of one length follow each other, so from here on the
   state is a table of runs: pieces ``(length, first rank, count)`` and gaps ``(room, first sequence, count)``.  There are at
   most ``limit`` lengths, so the number of runs is bounded by ``limit`` and the rounds, whatever the corpus.
2. A round range-partitions pieces and gaps by size, in ranges of sixteenfold size.  In each range one task sweeps the lengths
   downwards: a length goes to its successor, the smallest gap that is not smaller.  Where several want a gap, the lower rank takes it
   and the next goes to the next larger one.  Gaps shrink; those that leave their range are dealt anew in the next round.
3. Pieces without a successor in a range look in the next range that has gaps.  Only pieces above half of the longest waiting length
   take part in a round, so short ones wait until the long ones lie.  New sequences are opened only as far as any
   completion of the packing needs them: missing room over ``limit``, or tokens of pieces longer than every gap over ``limit``.
4. When no piece waits, each piece finds the run that placed it by its rank; sequence and offset are arithmetic inside the run.

Defined results: a null text is empty and has the end mark only; repeated rows are packed each, equal ids or not; a null ``doc_id``
is kept; ties in length go by ``doc_id`` (nulls first) and piece; an empty table gives no rows; further columns are not read.  A
very long text is split into words chunk by chunk and gives pieces of ``limit`` ids and one rest.  Sequence ids are 0, 1, 2, ...
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import in_batches, scratch, stored, utf8
from .word_bpe import encoder

LIMIT = 4096
END = 1  # id after each document
GAP, PIECE, PLACED = 0, 1, 2
RUNS = "kind int, size int, first bigint, n bigint, reach int, each int, sequence bigint, offset int"
RUNS_ARROW = pa.schema([(name, pa.int64() if kind == "bigint" else pa.int32()) for name, kind in (c.split(" ") for c in RUNS.split(", "))])


def token_pieces(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document, and the ids themselves if asked for.

    ``length`` never exceeds ``limit``; all pieces of a document but the last have ``limit`` tokens.
    """
    mark = np.array([END], dtype="<u4").tobytes()
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids binary" * with_ids

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {c.split(" ")[0]: [] for c in schema.split(", ")}
        encode = _encoder(vocabulary)
        for doc, ids in zip(batch.column(0).to_pylist(), encode([t.decode() for t in batch.column(1).to_pylist()]), strict=True):
            ids += mark
            for i, at in enumerate(range(0, len(ids), 4 * limit)):
                part = ids[at : at + 4 * limit]
                row = (doc, i, at // 4, len(part) // 4, zlib.crc32(part), part)
                for column, value in zip(out.values(), row, strict=False):
                    column.append(value)
        yield out

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("_text")), work, schema)


_encoders: dict = {}


def _encoder(vocabulary: str):
    """One encoder a worker and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = encoder(vocabulary)
    return _encoders[vocabulary]


def reach_of(size: int) -> int:
    """The range of a size: 1 to 15, 16 to 255, 256 to 4095 and so on."""
    return (size.bit_length() + 3) // 4


def split_run(room: int, n: int, length: int, m: int) -> tuple[int, list[tuple[int, int]]]:
    """``m`` pieces of a length into ``n`` gaps of one size: pieces placed, and (gaps, pieces in each) of the gaps used."""
    each = room // length
    full = min(n, m // each)
    rest = m - full * each if full < n else 0
    used = [(full, each)] * (full > 0) + [(1, rest)] * (rest > 0)
    return full * each + rest, used


def sweep(runs: list[tuple[int, int, int, int]], limit: int) -> Iterator[tuple]:
    """Best fit within one range of sizes: runs ``(kind, size, first, n)`` to rows of the next state and placements.

    Pieces come from the longest down, each to the smallest gap that holds it; a gap that stays in the range is met again.
    """
    at_home = reach_of(next(size for kind, size, *_ in runs if kind == GAP))
    gaps: dict[int, list[tuple[int, int]]] = {}
    for kind, size, first, n in runs:
        if kind == GAP:
            gaps.setdefault(size, []).append((first, n))
    for held in gaps.values():
        held.sort(reverse=True)  # the lowest sequence is taken first
    sizes = sorted(gaps)
    for _, length, rank, m in sorted((r for r in runs if r[0] == PIECE), key=lambda r: (-r[1], r[2])):
        while m and (i := bisect_left(sizes, length)) < len(sizes):
            room = sizes[i]
            first, n = gaps[room].pop()
            placed, used = split_run(room, n, length, m)
            for count, each in used:
                yield PLACED, length, rank, count * each, None, each, first, limit - room
                left = room - each * length
                if left and reach_of(left) == at_home:
                    if left not in gaps:
                        gaps[left] = []
                        insort(sizes, left)
                    gaps[left].append((first, count))
                elif left:
                    yield GAP, left, first, count, None, None, None, None
                first, n, rank, m = first + count, n - count, rank + count * each, m - count * each
            if n:
                gaps[room].append((first, n))
            if not gaps[room]:
                del gaps[room]
                sizes.remove(room)
        if m:
            yield PIECE, length, rank, m, at_home + 1, None, None, None
    for room, held in gaps.items():
        for first, n in held:
            yield GAP, room, first, n, None, None, None, None


def ranked(pieces: DataFrame) -> DataFrame:
    """The pieces range-sorted by falling length, with the number of their task's slice and their place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            b = b.append_column("slice", pa.array(np.full(b.num_rows, part, dtype=np.int32)))
            yield b.append_column("place", pa.array(np.arange(at, at + b.num_rows, dtype=np.int64)))
            at += b.num_rows

    order = [F.desc("length"), F.asc("doc_id"), F.asc("piece")]
    return pieces.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, wider(pieces, slice="integer", place="long"))


def wider(df: DataFrame, **types: str) -> StructType:
    """The schema with further columns."""
    schema = StructType(list(df.schema.fields))
    for name, kind in types.items():
        schema = schema.add(name, kind)
    return schema


def rounds(spark: SparkSession, lengths: dict[int, int], limit: int) -> list[str]:
    """Run rounds until every piece lies; the paths of the written states, whose PLACED rows are the result.

    What comes back to the driver are counts by length (at most ``limit``) and, every round, two rows for every range.
    """
    paths: list[str] = []
    if not lengths:
        return paths
    rows, rank = [], 0
    for length in sorted(lengths, reverse=True):
        rows.append((PIECE, length, rank, lengths[length], 0, None, None, None))
        rank += lengths[length]
    state, opened = stored(spark.createDataFrame(rows, RUNS).coalesce(1), "lengths"), 0

    def swept(runs: pa.Table) -> pa.Table:
        rows = list(zip(*(runs.column(c).to_pylist() for c in ("kind", "size", "first", "n")), strict=True))
        if not any(kind == GAP for kind, *_ in rows):
            return out_table([(*r, 0, None, None, None) for r in rows])
        return out_table(sweep(rows, limit))

    size_range = ((F.length(F.bin("size")) + 3) / 4).cast("int")
    while True:
        facts = state.where("kind < 2").groupBy("kind", size_range.alias("range")).agg(F.sum(F.col("size").cast("long") * F.col("n")).alias("tokens"), F.max("size").alias("top")).collect()
        waiting, gaps = [r for r in facts if r.kind == PIECE], [r for r in facts if r.kind == GAP]
        if not waiting:
            return paths
        longest, room = max(r.top for r in waiting), max((r.top for r in gaps), default=0)
        missing = sum(r.tokens for r in waiting) - sum(r.tokens for r in gaps)
        if longest > room:
            above = state.where(f"kind = {PIECE} AND size > {room}").agg(F.sum(F.col("size").cast("long") * F.col("n"))).first()[0]
            missing = max(missing, above)
        new = max(0, -(-missing // limit))
        if new:
            state = state.unionByName(spark.sql(f"SELECT {GAP} AS kind, {limit} AS size, {opened}L AS first, {new}L AS n, INT(NULL) AS reach, INT(NULL) AS each, BIGINT(NULL) AS sequence, INT(NULL) AS offset"))
            opened += new
        ranges = sorted({r.range for r in gaps} | ({reach_of(limit)} if new else set()))
        # From a range to the first range at or above it that has gaps; 0 where none has.
        towards = [next((r for r in ranges if r >= i), 0) for i in range(reach_of(limit) + 2)]
        goal = F.when(F.col("kind") == GAP, size_range).when(F.col("size") * 2 > longest, F.array(*map(F.lit, towards))[F.greatest(size_range, F.col("reach"))])
        state = state.where("kind < 2").withColumn("goal", goal)
        active = state.where("goal > 0")
        resting = state.where("goal IS NULL OR goal = 0").withColumn("reach", F.lit(0)).drop("goal")
        paths.append(scratch(spark, "packing"))
        active.groupBy("goal").applyInArrow(swept, RUNS).unionByName(resting).write.parquet(paths[-1])
        state = spark.read.schema(RUNS).parquet(paths[-1])


def out_table(rows) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(RUNS_ARROW)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, RUNS_ARROW, strict=True)], schema=RUNS_ARROW)


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``pieces`` has ``doc_id, piece, length`` and any further columns."""
    spark = pieces.sparkSession
    columns = pieces.columns
    numbered = stored(ranked(stored(pieces, "pieces")), "ranked-pieces")
    before, starts = 0, {}
    for r in sorted(numbered.groupBy("slice").count().collect(), key=lambda r: r["slice"]):
        starts[r["slice"]] = before
        before += r["count"]
    paths = rounds(spark, {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}, limit)
    placed = spark.read.schema(RUNS).parquet(*paths).where(f"kind = {PLACED}").select("first", "each", "size", "sequence", "offset").toArrow() if paths else out_table([])
    # Runs of placements: bounded by the lengths and the rounds, see the head of this module.
    first = placed.column("first").to_numpy()
    order = np.argsort(first, kind="stable")
    fixed = {c: placed.column(c).to_numpy(zero_copy_only=False)[order] for c in ("first", "each", "size", "sequence", "offset")}
    sent = spark.sparkContext.broadcast((fixed, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, starts = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            base = np.array([starts[s] for s in b.column("slice").to_pylist()], dtype=np.int64)
            rank = base + b.column("place").to_numpy()
            at = np.searchsorted(runs["first"], rank, side="right") - 1
            nth, in_sequence = np.divmod(rank - runs["first"][at], runs["each"][at].astype(np.int64))
            b = b.append_column("sequence_id", pa.array((runs["sequence"][at] + nth).astype(np.int64)))
            b = b.append_column("offset", pa.array((runs["offset"][at] + in_sequence * runs["size"][at]).astype(np.int64)))
            yield b.select([*columns, "sequence_id", "offset"])

    return numbered.mapInArrow(run, wider(pieces, sequence_id="long", offset="long"))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` of every sequence; ``packed`` has the ids of its pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``limit`` pieces
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
