"""Token counts with a whole-token shortcut.

``whole_tokens`` proves, once per vocabulary and before any text is read, which vocabulary strings are one pre-token
and merge to exactly themselves.  In a text such pre-tokens count as one token by a set lookup; only the other
pre-tokens go through the merges, and a worker remembers those it has merged.

Defined results: null is empty (0 tokens); special strings of the vocabulary inside a text are one token each, as the
tokenizer library takes them by default; repeated rows are counted each; further columns are ignored, whatever their names; an
empty table gives no rows; a very long text is one row of a task, counted in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import memory, merge, splitter, tokenizer_json
from .common import in_batches, utf8


def whole_tokens(ids: dict[bytes, int], ranks: dict[bytes, int]) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token.

    A string qualifies if it is valid text, the split pattern leaves it in one piece, and merging it ends in itself.
    The split of a longer text gives the same piece the same merges, for merges never cross pre-tokens.
    """
    split = splitter()
    found = set()
    for token in ids:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        if split(text) == [text] and merge(token, ranks) == [token]:
            found.add(text)
    return frozenset(found)


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, n_whole, over_limit`` per document.

    ``n_whole`` are the tokens that the shortcut counted.  The vocabulary and the proved set are fixed tables of the
    tokenizer (some 50,000 entries), so sending them to the workers has a proven bound.
    """
    ids, ranks, special = tokenizer_json(vocabulary)
    whole = whole_tokens(ids, ranks)
    sent = docs.sparkSession.sparkContext.broadcast((ranks, whole, sorted(special, key=len, reverse=True)))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        ranks, whole, special = sent.value
        split = splitter()
        marks = regex.compile("|".join(map(regex.escape, special))) if special else None
        merged = memory(f"counts {vocabulary}", {})
        out: dict[str, list] = {"doc_id": batch.column(0), "n_bytes": [], "n_tokens": [], "n_whole": []}
        for raw in batch.column(1).to_pylist():
            t = raw.decode()
            parts = marks.split(t) if marks is not None else [t]
            n, n_whole = len(parts) - 1, 0  # the special strings between the parts
            for part in parts:
                for piece in split(part):
                    if piece in whole:
                        n_whole += 1
                        continue
                    k = merged.get(piece)
                    if k is None:
                        k = merged[piece] = len(merge(piece.encode(), ranks))
                    n += k
            out["n_bytes"].append(len(raw))
            out["n_tokens"].append(n + n_whole)
            out["n_whole"].append(n_whole)
        yield out

    counted = in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("_text")), work, "doc_id long, n_bytes long, n_tokens long, n_whole long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
