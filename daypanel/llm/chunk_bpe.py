"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into overlapping chunks; every chunk is pre-tokenised on its own.  A chunk that starts inside a pre-token
may begin with wrong boundaries, but the split pattern looks only ahead, so from the first boundary that the chunk
before also has, both agree.  Stitching takes these positions; the pieces between them are encoded on their own and
joined in order.  Decoding joins the raw bytes of the tokens.

Texts of one chunk (nearly all) stay in the task that read them; only longer texts are cut and dealt out, so that one
of them occupies many tasks.  Where an overlap holds no common boundary (a pre-token longer than the overlap), the
chunks on both sides form one piece, which is split anew.

Defined results: null is empty (no ids); repeated rows are encoded each; further columns are ignored, whatever their names; an empty table
gives no rows; a very long text is cut in one pass, encoded by many tasks and joined once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import memory, merge, splitter, tiktoken_ranks
from .common import in_batches, stored

STEP = 2 << 20  # bytes of text whose ids are Python objects at one time
CHUNK = 32_768  # code points
OVERLAP = 512


def encode_text(text: str, split, ranks: dict[bytes, int], known: dict[str, tuple[int, ...]]) -> list[int]:
    ids: list[int] = []
    for piece in split(text):
        got = known.get(piece)
        if got is None:
            raw = piece.encode()
            own = ranks.get(raw)
            got = known[piece] = (own,) if own is not None else tuple(ranks[t] for t in merge(raw, ranks))
        ids += got
    return ids


def encode_pieces(df: DataFrame, sent: Broadcast, name: str) -> DataFrame:
    """``piece string`` becomes ``ids binary`` (little-endian, 32 bits each) and ``decoded binary``; the rest is carried."""
    carried = [c for c in df.columns if c != "piece"]
    at = len(carried)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        ranks, tokens = sent.value
        split, known = splitter(), memory(f"ids {name}", {})
        ids = [encode_text(t, split, ranks, known) for t in batch.column(at).to_pylist()]
        yield {c: batch.column(i) for i, c in enumerate(carried)} | {
            "ids": [np.asarray(x, "<u4").tobytes() for x in ids],
            "decoded": [b"".join(map(tokens.__getitem__, x)) for x in ids],
        }

    kinds = dict(df.dtypes)
    return in_batches(df.select(*carried, "piece"), work, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", ids binary, decoded binary", STEP)


def cut(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``row, k, start, last, part``: the overlapping chunks of ``row, piece``, cut in one pass over each text and dealt out evenly."""
    schema = pa.schema([("row", pa.int64()), ("k", pa.int32()), ("start", pa.int64()), ("last", pa.bool_()), ("part", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, piece in zip(batch.column(0), batch.column(1), strict=True):
                text = piece.as_py()
                n = len(text)
                starts = range(0, max(n - overlap - 1, 0) + 1, chunk)
                for i in range(0, len(starts), 64):  # some chunks in one batch
                    own = starts[i : i + 64]
                    columns = [[row.as_py()] * len(own), [i + j for j in range(len(own))], list(own), [a + chunk + overlap >= n for a in own], [text[a : a + chunk + overlap] for a in own]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return long.select("row", "piece").mapInArrow(run, "row long, k int, start long, last boolean, part string").repartition("row", "k")


def edges(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Adds the pre-token boundaries of each chunk inside its first and last overlap, as offsets into the whole text."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        split = splitter()
        head, tail = [], []
        for start, part in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
            ends = np.cumsum(np.fromiter(map(len, split(part)), np.int64))
            # the split pattern sees two code points ahead at most, so what ends just before the cut is not sure
            sure = ends[ends < len(part) - 1]
            head.append(start + ends[ends <= overlap])
            tail.append(start + sure[sure > chunk])
        yield {c: batch.column(i) for i, c in enumerate(("row", "k", "start", "last", "part"))} | {"head": head, "tail": tail}

    return in_batches(chunks, work, "row long, k int, start int, last boolean, part string, head array<long>, tail array<long>")


def stitched(chunks: DataFrame, chunk: int) -> DataFrame:
    """``row, at, piece``: pieces between the positions where neighbouring chunks resynchronise."""
    by = Window.partitionBy("row").orderBy("k")
    meets = F.array_min(F.array_intersect("tail", F.lead("head").over(by)))
    met = chunks.withColumn("stop", meets).withColumn("begin", F.lag("stop").over(by))
    opened = F.sum(F.when(F.col("begin").isNotNull(), 1).otherwise(0)).over(by)
    # without the overlap, as the next chunk holds it; a chunk that ends a piece keeps it
    body = F.when(F.col("last") | F.col("stop").isNotNull(), F.col("part")).otherwise(F.substring("part", 1, chunk))
    parts = met.select("row", opened.alias("at"), "k", "start", "begin", "stop", body.alias("body"))
    joined = parts.groupBy("row", "at").agg(
        F.array_sort(F.collect_list(F.struct("k", "start", "begin", "stop", "body"))).alias("c")
    )
    text = F.array_join(F.col("c.body"), "")
    first, final = F.col("c")[0], F.element_at("c", -1)
    skip = F.coalesce(first["begin"] - first["start"], F.lit(0).cast("long"))
    end = F.coalesce(final["stop"] - first["start"], F.length(text).cast("long"))
    return joined.select("row", "at", F.substring(text, (skip + 1).cast("int"), (end - skip).cast("int")).alias("piece"))


def encode(docs: DataFrame, ranks_path: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids binary, decoded binary`` per document, by the ranks of a tiktoken file.

    The rank table is a fixed table of the tokenizer (some 50,000 entries), so sending it to the workers has a proven
    bound.
    """
    ranks = tiktoken_ranks(ranks_path)
    sent = docs.sparkSession.sparkContext.broadcast((ranks, {i: t for t, i in ranks.items()}))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("piece"))
    limit = chunk + overlap
    short = encode_pieces(picked.where(F.length("piece") <= limit), sent, ranks_path)
    # written once, so that the row numbers stay what they are
    long = stored(picked.where(F.length("piece") > limit).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    pieces = stitched(edges(cut(long, chunk, overlap), chunk, overlap), chunk).repartition("row", "at")
    def whole(t: pa.Table) -> pa.Table:
        """The pieces of one text, joined once."""
        t = t.sort_by("at")
        joined = [b"".join(t.column(c).to_pylist()) for c in ("ids", "decoded")]
        return pa.table({"row": pa.array([t.column("row")[0].as_py()], pa.int64()), "ids": pa.array([joined[0]], pa.binary()), "decoded": pa.array([joined[1]], pa.binary())})

    parts = encode_pieces(pieces, sent, ranks_path).select("row", "at", "ids", "decoded").groupBy("row").applyInArrow(whole, "row long, ids binary, decoded binary")
    joined = long.select("doc_id", "row").join(parts, "row").select("doc_id", "ids", "decoded")
    return short.unionByName(joined).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
