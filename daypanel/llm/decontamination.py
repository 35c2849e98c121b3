"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into word passages.  Word weights are TF-IDF over hashed words, with document
frequencies counted over the passages of the whole corpus.  One pass over the corpus makes the sketch of a randomised
singular value decomposition: every task multiplies its passages with a fixed random matrix and back, and the summed sketch
(buckets × columns, a fixed size) gives the leading singular vectors.  A second pass projects overlapping passages,
searches candidates by cosine against the passages of a block of benchmark items, and checks each candidate: the
longest common subsequence of the item's and the passage's words, and whether the item's last sentence (its
answer) occurs.

Benchmark items are the stated query set: they are taken in blocks of at most ``block`` items, and only a block is ever
sent to the tasks.  All passages of all documents are searched.

Items under ``LEAST`` words have too few words for a cosine: they are compared whole, by hashes of all runs of their length, and
found where all their words stand in a row; items under ``SHORTEST`` words only where they are the whole text.

Defined results: null or empty texts match nothing, and documents shorter than ``LEAST`` words only such short items; items
without a word are skipped; ties between passages of an item go to the longest common subsequence, then the larger cosine; repeated rows are
reported each; a very long text is searched passage by passage; an empty table on either side gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import forget
from .common import in_batches, kept_rows, slices

BUCKETS = 1 << 15  # hashed words
COLUMNS = 80  # of the sketch
RANK = 72
POWER = 1.5  # of the IDF weights
PASSAGE = 32  # words
STRIDE = 16
LEAST = 8
BITS = 1024  # of the word signatures
SHORTEST = 3  # an item of fewer words is found only as a whole text
COSINE = 0.42
VERBATIM = 0.8
PARAPHRASE = 0.6
BLOCK = 5_000  # benchmark items sent at once
CHUNK_ROWS = 16  # sketch rows in one message
TASK_BYTES = 8 << 20  # stored bytes behind one task of the sketch, at least
# ASCII punctuation between words.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TABLE = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
_END = re.compile(r"[.!?\n]+")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_TABLE).split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.int64)


def columns_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Columns of ``x`` at places known to lie within it, which numpy gathers some three times faster without its range check."""
    return np.take(x, at, axis=1, mode="clip")


def test_matrix() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((COLUMNS, BUCKETS)).astype(np.float32)


def sketch(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """``TFᵀ(TF Ω)``, passages per bucket and the number of passages, over non-overlapping passages of the whole corpus.

    Each task adds its passages up and sends its sums in rows; these are added up per row block while they arrive.
    """
    omega = docs.sparkSession.sparkContext.broadcast(test_matrix())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # a worker may come from an earlier stage
        om = omega.value
        total = np.zeros((COLUMNS + 1, BUCKETS), np.float32)
        passages = 0
        for batch in batches:
            for part in slices(batch, 2 << 20):
                texts = [w for w in map(words_of, part.column(0).to_pylist()) if w]
                if not texts:
                    continue
                sizes = np.array([len(w) for w in texts])
                ids = hashed([x for w in texts for x in w]) & (BUCKETS - 1)
                firsts = np.cumsum(sizes) - sizes
                starts = np.concatenate([np.arange(f, f + n, PASSAGE) for f, n in zip(firsts, sizes, strict=True)])
                of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
                passages += len(starts)
                order = np.argsort(ids.astype(np.uint16), kind="stable")
                sids = ids[order]
                cuts = np.flatnonzero(np.r_[True, sids[1:] != sids[:-1]])
                rows = sids[cuts]
                sof = of[order]
                for c in range(0, COLUMNS, 24):  # some columns at a time, a bound on memory
                    x = np.add.reduceat(columns_at(om[c : c + 24], ids), starts, axis=1)
                    total[c : min(c + 24, COLUMNS), rows] += np.add.reduceat(columns_at(x, sof), cuts, axis=1)
                # passages that hold the bucket: a word counts once in its passage
                fresh = np.r_[True, (sids[1:] != sids[:-1]) | (sof[1:] != sof[:-1])]
                total[COLUMNS, rows] += np.add.reduceat(fresh.astype(np.float32), cuts)
        if passages:
            blocks = np.ascontiguousarray(total.T).reshape(-1, CHUNK_ROWS * (COLUMNS + 1))
            at = np.flatnonzero(blocks.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([blocks[i].tobytes() for i in at], pa.binary()), pa.array([passages if k == 0 else 0 for k in range(len(at))], pa.int64())], names=["at", "part", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        n = 0
        for batch in batches:
            n += sum(batch.column(2).to_pylist())
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = np.frombuffer(part, np.float32).astype(np.float64)
                sums[at] = sums[at] + got if at in sums else got
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary()), pa.array([n if k == 0 else 0 for k in range(len(sums))], pa.int64())], names=["at", "part", "n"])

    picked = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # Sums of a task are some megabytes however little it reads, so many small files are read together.
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    picked = picked.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, min(size // TASK_BYTES, 1 << 30)))
    schema = "at int, part binary, n long"
    # BUCKETS / CHUNK_ROWS sums of fixed size reach the driver, whatever the size of the corpus
    sums = picked.mapInArrow(local, schema).repartition("at").mapInArrow(add, schema).collect()
    out = np.zeros((BUCKETS // CHUNK_ROWS, CHUNK_ROWS * (COLUMNS + 1)))
    for r in sums:
        out[r["at"]] += np.frombuffer(bytes(r.part))
    out = out.reshape(BUCKETS, COLUMNS + 1)
    return out[:, :COLUMNS], out[:, COLUMNS], sum(r.n for r in sums)


def embedding(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Latent vectors of the hashed words (rank × buckets): IDF times the leading right singular vectors.

    With D the IDF weights, the random matrix stands for D⁻¹Ω, so the sketch becomes D·TFᵀ(TF·Ω) = M(D⁻¹Ω) for the Gram matrix M of the
    TF-IDF passages, and one pass is enough (Nyström form of the randomised decomposition).
    """
    g, df, passages = sketch(docs, text)
    idf = (np.log((passages + 1) / (df + 1)) + 0.1) ** POWER
    y = idf[:, None] * g
    b = test_matrix().astype(np.float64) @ g
    b = (b + b.T) / 2
    values, vectors = np.linalg.eigh(b)
    good = values > max(values.max(), 0) * 1e-9 if len(values) else []
    if not np.any(good):
        return np.zeros((RANK, BUCKETS), np.float32)
    f = y @ (vectors[:, good] / np.sqrt(values[good]))
    u, sigma, _ = np.linalg.svd(f, full_matrices=False)
    # divided by the singular values, so that the few directions of common words do not decide every cosine
    u = u[:, :RANK] / np.maximum(sigma[:RANK], sigma[0] * 1e-6)
    v = idf[:, None] * np.pad(u, ((0, 0), (0, RANK - u.shape[1])))
    return np.ascontiguousarray((v / max(np.abs(v).max(), 1e-300)).T.astype(np.float32))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def signatures(hashes: np.ndarray, of: np.ndarray, rows: int) -> np.ndarray:
    """One bit string per row (rows × 64-bit words) that has a bit for each of its words."""
    on = np.zeros((rows, BITS), bool)
    on[of, (hashes >> 15) & (BITS - 1)] = True
    return np.packbits(on, axis=1).view(np.uint64)


def common_subsequence(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence, bit by bit over the item's positions."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def passage_starts(n: int) -> list[int]:
    return list(range(0, max(n - PASSAGE, 0) + STRIDE, STRIDE)) if n > PASSAGE else [0]


def run_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """One number for every run of n words."""
    out = np.zeros(max(len(hashes) - n + 1, 0), np.int64)
    for k in range(n):
        out = out * np.int64(1_000_003) + hashes[k : len(hashes) - n + 1 + k]
    return out


def short_items(words: list[bytes], short: dict) -> dict[int, tuple[float, float, bool]]:
    """Items under ``LEAST`` words that stand whole in a text; those under ``SHORTEST`` words only where they are the whole text."""
    found: dict[int, tuple[float, float, bool]] = {}
    hashes = hashed(words)
    for n, known in short.items():
        if n > len(words) or (n < SHORTEST and n != len(words)):
            continue
        runs = run_hash(hashes, n)
        for i in np.flatnonzero(np.isin(runs, np.fromiter(known, np.int64, len(known)))).tolist():
            found |= {item: (1.0, 1.0, True) for item, own in known[int(runs[i])] if words[i : i + n] == own}
    return found


def item_passages(items: list[tuple[int, str]], vectors: np.ndarray) -> dict:
    """Passages of benchmark items with their latent vectors, words, and the words of each item's answer."""
    out: dict = {"item": [], "vector": [], "masks": [], "size": [], "answer": [], "bits": [], "short": {}}
    for item, text in items:
        words = words_of(text)
        if len(words) < LEAST:
            if words:
                out["short"].setdefault(len(words), {}).setdefault(run_hash(hashed(words), len(words)).item(), []).append((item, words))
            continue
        sentences = [s for s in map(words_of, _END.split(text.lower())) if s]
        for s in passage_starts(len(words)):
            own = words[s : s + PASSAGE] if s + PASSAGE <= len(words) else words[max(0, len(words) - PASSAGE) :]
            masks: dict[bytes, int] = {}
            for i, w in enumerate(own):
                masks[w] = masks.get(w, 0) | 1 << i
            out["item"].append(item)
            out["vector"].append(vectors[:, hashed(own) & (BUCKETS - 1)].sum(1))
            out["masks"].append(masks)
            out["size"].append(len(own))
            out["bits"].append(signatures(hashed(own), np.zeros(len(own), np.int64), 1)[0])
            out["answer"].append(set(sentences[-1]))
    return out


def search(docs: DataFrame, benchmark: DataFrame, vectors: np.ndarray, text: str = "text", cosine: float = COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE, block: int = BLOCK) -> DataFrame:
    """``doc_id, item_id, cosine, common, answer`` for each document and item that meet.

    ``common`` is the share of an item passage's words in the longest common subsequence; a match needs ``verbatim`` of them, or
    ``paraphrase`` of them and the answer's words.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = "doc_id long, item_id long, cosine double, common double, answer boolean"
    out = None
    for sent in item_blocks(benchmark, vectors, block):

        def work(batch: pa.RecordBatch, sent=sent) -> Iterator[dict]:
            found: dict[str, list] = {c: [] for c in ("doc_id", "item_id", "cosine", "common", "answer")}
            ids = batch.column(0).to_pylist()
            for row, best in matches([words_of(t) for t in batch.column(1).to_pylist()], *sent.value, cosine, verbatim, paraphrase):
                for item, (common, cos, answer) in sorted(best.items()):
                    for c, v in zip(found, (ids[row], item, cos, common, answer), strict=True):
                        found[c].append(v)
            yield found

        hits = in_batches(picked, work, schema)
        out = hits if out is None else out.unionByName(hits)
    return out


def item_blocks(benchmark: DataFrame, vectors: np.ndarray, block: int) -> Iterator[Broadcast]:
    """Benchmark items with their passages, sent in blocks of about ``block`` items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    blocks = max(1, -(-items.count() // block))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast((vectors, item_passages([(r.item_id, r.text) for r in own], vectors)))


def matches(texts: list[list[bytes]], vectors: np.ndarray, q: dict, cosine: float, verbatim: float, paraphrase: float) -> Iterator[tuple[int, dict]]:
    """Rows with what they contain, by item: candidates by cosine of latent vectors, then the word checks."""
    for i, w in enumerate(texts) if q["short"] else []:
        if best := short_items(w, q["short"]):
            yield i, best
    if not q["item"]:
        return
    queries = unit(np.array(q["vector"], np.float32))
    rows = [i for i, w in enumerate(texts) if len(w) >= LEAST]
    group: list[int] = []
    size = 0
    for i in [*rows, None]:
        if i is None or size > 200_000:
            if group:
                yield from matches_of(group, texts, vectors, queries, q, cosine, verbatim, paraphrase)
            group, size = [], 0
        if i is not None:
            group.append(i)
            size += len(texts[i])


def shared_words(at: np.ndarray, which: np.ndarray, bits: np.ndarray, q: dict, least: float, step: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Candidates whose region can hold ``least`` of the passage's words at all; an upper bound by signature bits."""
    region = bits.copy()
    for k in (1, 2):
        region[k:] |= bits[:-k]
    for k in (1, 2, 3):
        region[:-k] |= bits[k:]
    qbits, size = np.array(q["bits"]), np.array(q["size"])
    spare = size - np.bitwise_count(qbits).sum(1)  # positions that share a bit
    keep = []
    for k in range(0, len(at), step):
        a, j = at[k : k + step], which[k : k + step]
        both = np.bitwise_count(region[a] & qbits[j]).sum(1)
        keep.append(both + spare[j] >= least * size[j])
    kept = np.concatenate(keep) if keep else np.zeros(0, bool)
    return at[kept], which[kept]


def matches_of(group: list[int], texts: list[list[bytes]], vectors: np.ndarray, queries: np.ndarray, q: dict, cosine: float, verbatim: float, paraphrase: float) -> Iterator[tuple[int, dict]]:
    sizes = np.array([len(texts[i]) for i in group])
    hashes = hashed([w for i in group for w in texts[i]])
    firsts = np.cumsum(sizes) - sizes
    steps = -(-sizes // STRIDE)  # half passages of each text
    starts = np.concatenate([np.arange(f, f + n, STRIDE) for f, n in zip(firsts, sizes, strict=True)])
    half = np.add.reduceat(columns_at(vectors, hashes & (BUCKETS - 1)), starts, axis=1).T
    row_of = np.repeat(np.arange(len(group)), steps)
    whole = half.copy()
    same = row_of[:-1] == row_of[1:]
    whole[:-1][same] += half[1:][same]
    near = unit(whole) @ queries.T
    at, which = np.nonzero(near >= cosine)
    at, which = shared_words(at, which, signatures(hashes, np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(hashes)])), len(starts)), q, min(verbatim, paraphrase))
    found: dict[int, dict] = {}
    for p, j in zip(at.tolist(), which.tolist(), strict=True):
        row = int(row_of[p])
        best = found.setdefault(row, {})
        item = q["item"][j]
        if item in best and best[item][0] >= 1.0:
            continue
        words = texts[group[row]]
        begin = int(starts[p] - firsts[row])
        # an item passage may start before the half passage or end behind it, by as many words as it has
        region = words[max(0, begin - PASSAGE) : begin + 2 * PASSAGE]
        common = common_subsequence(q["masks"][j], q["size"][j], region) / q["size"][j]
        answer = bool(q["answer"][j]) and sum(w in q["answer"][j] for w in set(region)) >= 0.8 * len(q["answer"][j])
        if common >= verbatim or (common >= paraphrase and answer):
            best[item] = max(best.get(item, (0.0, 0.0, False)), (common, float(near[p, j]), answer))
    for row, best in found.items():
        if best:
            yield group[row], best


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    return search(docs, benchmark, embedding(docs, text), text)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", cosine: float = COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE, block: int = BLOCK) -> DataFrame:
    """The documents, as they are, that match no item."""
    out = docs
    for sent in item_blocks(benchmark, embedding(docs, text), block):

        def keep(texts: list[str], sent=sent) -> list[bool]:
            hit = {row for row, _ in matches([words_of(t) for t in texts], *sent.value, cosine, verbatim, paraphrase)}
            return [i not in hit for i in range(len(texts))]

        out = kept_rows(out, text, keep)
    return out
