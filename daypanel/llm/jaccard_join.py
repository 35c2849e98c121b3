"""Near duplicates by an exact Jaccard join on word shingles, with adaptive multi-match prefixes.

Texts with equal words form one class; everything after works on classes.  Two classes link when their shingle sets
reach the similarity.  The steps:

1. ``shingled``: one reading of the texts.  Shingle hashes go out packed, by shingle shard; a shingle that is frequent in the
   batch at hand goes out as a mark, and its postings stay with their class, so no shard gathers a frequent shingle.
2. ``shared``: document frequencies per shard; only shingles of two classes or more go back to their classes.
3. ``prefixed``: the global order is rare first, frequent ones last.  Linked classes share a shingle in their prefixes, and l shingles in
   prefixes that are l - 1 longer.  Each class picks the l whose estimated cost of lists and candidates is least.
4. ``pivot_links``: every posting list compares its members with one of them, after the pair has l shared prefix shingles.
   The links give components; a large group of near copies is one component now, without its pairs.
5. ``residual_links``: lists that still hold more than one component compare members of different components, in tiles of bounded size
   that verify their pairs themselves.

Pairs inside one component need no comparison, so the components are exact.

Defined results: null and empty texts have no shingles and link with nothing; a text of fewer than five words is one shingle; null
ids take part but never name a component; repeated rows are one class; further columns are ignored, whatever their names; ties in
an order go by shingle; an empty table gives no rows; a very long text is one class with one shingle set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import forget
from .common import slices, stored, unused, utf8

WORDS = 5
SIMILARITY = 75  # percent
FLUSH = 1 << 19  # shingles in one packed batch
SHARD_BYTES = 12 << 20  # text behind one shard
LEVELS = 4
TILE = 512
FREQUENT = np.int64(1) << 40  # stands for the document frequency of frequent shingles
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of the windows of five words; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, WORDS)
    m = n - size + 1
    h = np.full(m, _FACTORS[5] * np.uint64(size), np.uint64)
    for k in range(size):
        h += w[k : k + m] * _FACTORS[k]
    h ^= h >> np.uint64(31)
    h *= _FACTORS[4]
    h ^= h >> np.uint64(29)
    return np.unique(h)


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that a set of n shares with any set it links to."""
    return -(-n * SIMILARITY // 100)


def pack(**arrays: np.ndarray) -> dict[str, bytes]:
    return {k: np.ascontiguousarray(v).tobytes() for k, v in arrays.items()}


PACKED = "kind int, shard int, doc_id long, k long, n int, a binary, b binary, c binary"


def record(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("k", pa.int64()), ("n", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def flushed(held: list[tuple[int, int, np.ndarray]], shards: int, class_shards: int) -> list[dict]:
    """Packed rows of a batch of classes (k, n, shingles).

    Kind 1, by shingle shard: classes (a), how many shingles each has there (b), the shingles (c), none where k is 0: marks of frequent ones.
    Kind 2, by class shard: classes (a), their sizes and numbers of frequent shingles (b), those shingles (c).
    """
    ks = np.array([k for k, _, _ in held], np.int64)
    ns = np.array([n for _, n, _ in held], np.int64)
    sizes = np.array([len(s) for _, _, s in held])
    flat = np.concatenate([s for _, _, s in held])
    of = np.repeat(np.arange(len(held)), sizes)
    order = np.argsort(flat, kind="stable")
    sorted_flat = flat[order]
    cuts = np.flatnonzero(np.r_[True, sorted_flat[1:] != sorted_flat[:-1]])
    count = np.diff(np.r_[cuts, len(flat)])
    hot_token = count >= max(16, len(held) // 64)
    hot = np.zeros(len(flat), bool)
    hot[order] = np.repeat(hot_token, count)
    marks = sorted_flat[cuts][hot_token]
    rows = []
    shard = (flat >> np.uint64(33)) % np.uint64(shards)
    cold = np.flatnonzero(~hot)
    by = cold[np.argsort(shard[cold], kind="stable")]  # classes stay in order inside a shard
    edges = np.searchsorted(shard[by], np.arange(shards + 1))
    mark_shard = (marks >> np.uint64(33)) % np.uint64(shards)
    for s in range(shards):
        at = by[edges[s] : edges[s + 1]]
        own = marks[mark_shard == s]
        if not len(at) and not len(own):
            continue
        classes, first = np.unique(of[at], return_index=True)
        lengths = np.diff(np.r_[first, len(at)])
        rows.append({"kind": 1, "shard": s} | pack(a=np.r_[ks[classes], np.int64(0)], b=np.r_[lengths, len(own)].astype(np.int32), c=np.r_[flat[at], own]))
    n_hot = np.bincount(of[hot], minlength=len(held))
    hot_flat = flat[hot]
    hot_first = np.cumsum(n_hot) - n_hot
    bucket = class_shard(ks, class_shards)
    for s in np.unique(bucket):
        own = np.flatnonzero(bucket == s)
        rows.append({"kind": 2, "shard": int(s)} | pack(a=ks[own], b=np.stack([ns[own], n_hot[own]], 1).astype(np.int32), c=np.concatenate([hot_flat[hot_first[i] : hot_first[i] + n_hot[i]] for i in own] or [np.zeros(0, np.uint64)])))
    return rows


def class_shard(k: np.ndarray, shards: int) -> np.ndarray:
    return ((k.view(np.uint64) >> np.uint64(17)) % np.uint64(shards)).astype(np.int64)


def shingled(docs: DataFrame, text: str, shards: int) -> DataFrame:
    """Packed rows; kind 0 is one row per document: ``doc_id``, class ``k`` (null without words), set size ``n``, MD5 of the text (a)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # a worker may come from an earlier stage
        turn = count()
        seen: set[int] = set()  # classes of this task: at most the rows of one split
        held: list[tuple[int, int, np.ndarray]] = []
        tokens = 0
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = raw.lower().split()
                    row = {"kind": 0, "shard": next(turn) % shards, "doc_id": doc_id, "n": 0, "a": hashlib.md5(raw).hexdigest().encode()}
                    rows.append(row)
                    if not words:
                        continue
                    k = xxhash.xxh3_64_intdigest(b" ".join(words))
                    k = (k - (1 << 64) if k >> 63 else k) or 1
                    s = shingles(words)
                    row |= {"k": k, "n": len(s)}
                    if k not in seen:
                        seen.add(k)
                        held.append((k, len(s), s))
                        tokens += len(s)
                    if tokens >= FLUSH:
                        yield record(flushed(held, shards, shards))
                        held, tokens = [], 0
                yield record(rows)
        if held:
            yield record(flushed(held, shards, shards))

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("_text"))
    return picked.mapInArrow(run, PACKED)


def shared(packed: DataFrame, shards: int) -> DataFrame:
    """Kinds 0 and 2 as they are, and kind 3, by class shard: classes (a), shingles (b) and document frequencies (c), of shingles in two classes or more.

    All kinds go through one shuffle, so the packed shingles of the corpus are on disk once.
    """

    def run(group: pa.Table) -> pa.Table:
        if group.column("kind")[0].as_py() != 1:
            return group
        ks, tokens, marks, known = [], [], [], set()
        for a, b, c in zip(*(group.column(x).to_pylist() for x in ("a", "b", "c")), strict=True):
            k, n, t = np.frombuffer(a, np.int64), np.frombuffer(b, np.int32), np.frombuffer(c, np.uint64)
            marks.append(t[len(t) - n[-1] :])
            fresh = np.fromiter((x not in known for x in k[:-1].tolist()), bool, len(k) - 1)  # copies met by several tasks
            known.update(k[:-1].tolist())
            at = np.repeat(fresh, n[:-1])
            ks.append(np.repeat(k[:-1], n[:-1])[at])
            tokens.append(t[: len(t) - n[-1]][at])
        k, t, m = np.concatenate(ks), np.concatenate(tokens), np.unique(np.concatenate(marks))
        order = np.argsort(t, kind="stable")
        k, t = k[order], t[order]
        cuts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
        each = np.diff(np.r_[cuts, len(t)])
        df = np.repeat(np.where(np.isin(t[cuts], m), FREQUENT, each), each)
        k, t, df = k[df > 1], t[df > 1], df[df > 1]
        bucket = class_shard(k, shards)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(shards + 1))
        rows = []
        for s in range(shards):
            at = order[edges[s] : edges[s + 1]]
            if len(at):
                rows.append({"kind": 3, "shard": s} | pack(a=k[at], b=t[at], c=df[at]))
        return pa.Table.from_batches([record(rows)])

    return packed.groupBy("kind", "shard").applyInArrow(run, PACKED)


def prefixed(back: DataFrame) -> DataFrame:
    """``k, n, l, tokens, levels, head, whole`` of classes with a shared shingle in their prefix.

    ``tokens`` are the shared shingles of the prefix for l matches, ``levels`` the least number of matches whose prefix holds each;
    ``head`` are those of the prefix for one match, ``whole`` all shared shingles, with which every overlap can be counted.
    """

    def run(group: pa.Table) -> pa.Table:
        sizes: dict[int, int] = {}
        own: dict[int, list] = {}
        for kind, a, b, c in zip(*(group.column(x).to_pylist() for x in ("kind", "a", "b", "c")), strict=True):
            k = np.frombuffer(a, np.int64)
            if kind == 2:
                nb = np.frombuffer(b, np.int32).reshape(-1, 2)
                t = np.frombuffer(c, np.uint64)
                ends = np.cumsum(nb[:, 1])
                for x, n, m, e in zip(k.tolist(), nb[:, 0].tolist(), nb[:, 1].tolist(), ends.tolist(), strict=True):
                    sizes[x] = n
                    if m:
                        own.setdefault(x, []).append((t[e - m : e], np.full(m, FREQUENT)))
            else:
                t, df = np.frombuffer(b, np.uint64), np.frombuffer(c, np.int64)
                order = np.argsort(k, kind="stable")
                cuts = np.flatnonzero(np.r_[True, k[order][1:] != k[order][:-1]])
                for i, j in zip(cuts, [*cuts[1:], len(k)], strict=True):
                    own.setdefault(int(k[order[i]]), []).append((t[order[i:j]], df[order[i:j]]))
        out: dict[str, list] = {c: [] for c in ("k", "n", "l", "tokens", "levels", "head", "whole")}
        for x, parts in own.items():
            n = sizes[x]
            t, df = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            t, at = np.unique(t, return_index=True)
            df = df[at]
            alone = n - len(t)  # shingles of no other class come first in the order
            order = np.lexsort((t, df))
            short = n - int(least_overlap(n)) + 1 - alone  # shared shingles in the prefix for one match; may be negative
            if short <= 0:
                continue
            cost = np.minimum(df[order], 1 << 20).astype(float) - 1
            best, least = 1, None
            for level in range(1, LEVELS + 1):
                scan = cost[: short + level - 1].sum()
                estimate = scan + 20 * scan / level  # a candidate of level l is met at least l times
                if least is None or estimate < least:
                    best, least = level, estimate
            chosen = order[: short + best - 1]
            out["k"].append(x)
            out["n"].append(n)
            out["l"].append(best)
            out["tokens"].append(t[chosen].view(np.int64))
            out["levels"].append(np.maximum(np.arange(len(chosen)) - short + 2, 1).astype(np.int32))
            out["head"].append(t[order[:short]].view(np.int64))
            out["whole"].append(t.view(np.int64))
        schema = pa.schema([("k", pa.int64()), ("n", pa.int32()), ("l", pa.int32()), ("tokens", pa.list_(pa.int64())), ("levels", pa.list_(pa.int32())), ("head", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64()))])
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in schema}, schema=schema)

    rows = back.where("kind in (2, 3)").select("kind", "shard", "a", "b", "c")
    return rows.groupBy("shard").applyInArrow(run, "k long, n int, l int, tokens array<long>, levels array<int>, head array<long>, whole array<long>")


def posting_lists(prefix: DataFrame) -> DataFrame:
    """``list, weight, k, n, l, level``: posting lists of two classes or more; shingles with the same members at the same levels are one list of that weight."""
    rows = prefix.select("k", "n", "l", F.inline(F.arrays_zip("tokens", "levels"))).withColumnsRenamed({"tokens": "token", "levels": "level"})
    sign = lambda seed: F.sum(F.xxhash64(F.lit(seed), "k", "level").cast("decimal(20,0)")).cast("string")
    lists = rows.groupBy("token").agg(F.count(F.lit(1)).alias("m"), sign(1).alias("s1"), sign(2).alias("s2")).where("m > 1")
    kept = lists.groupBy("m", "s1", "s2").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("weight")).select("token", "weight", "m")
    return rows.join(kept, "token").withColumnRenamed("token", "list")


def long_enough(a: str, b: str):
    """Sizes that a link allows."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x, y`` of candidate pairs that link, by the exact overlap of their shared shingles."""
    a = sets.select(F.col("k").alias("x"), F.col("n").alias("nx"), F.col("whole").alias("wx"))
    b = sets.select(F.col("k").alias("y"), F.col("n").alias("ny"), F.col("whole").alias("wy"))
    both = F.size(F.array_intersect("wx", "wy"))
    return pairs.select("x", "y").join(a, "x").join(b, "y").where(both * 100 >= (F.col("nx") + F.col("ny") - both) * SIMILARITY).select("x", "y")


def pivot_links(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the members of each list and its pivot, the member of the smallest key."""
    pivots = lists.groupBy("list").agg(F.min(F.struct("k", "n", "l", "level")).alias("p"))
    met = lists.join(pivots, "list").where(F.col("k") != F.col("p.k")).where(long_enough("n", "p.n"))
    need = F.least("l", "p.l")
    counts = F.sum(F.when((F.col("level") <= need) & (F.col("p.level") <= need), F.col("weight")).otherwise(0))
    pairs = met.groupBy("k", F.col("p.k").alias("y")).agg(counts.alias("met"), F.first(need).alias("need")).where("met >= need").select(F.col("k").alias("x"), "y")
    return verified(pairs, sets)


def components(links: DataFrame) -> DataFrame:
    """``k, root`` of all classes in links: smallest key that each reaches, by neighbours' labels and label jumps."""
    both = stored(links.select(F.col("x").alias("k"), F.col("y").alias("o")).union(links.select("y", "x")).distinct(), "edges")
    labels = stored(both.groupBy("k").agg(F.least(F.col("k"), F.min("o")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("k").alias("o"), F.col("root").alias("r")), "o").groupBy("k").agg(F.min("r").alias("r"))
        lower = labels.join(near, "k", "left").select("k", "root", F.least("root", F.coalesce("r", "root")).alias("low"))
        jump = lower.select(F.col("k").alias("low"), F.col("low").alias("next"))
        after = stored(lower.join(jump, "low", "left").select("k", F.col("root").alias("was"), F.least("low", F.coalesce("next", "low")).alias("root")), "labels")
        if after.where(F.col("was") != F.col("root")).isEmpty():
            return after.select("k", "root")
        labels = after.select("k", "root")


def residual_links(lists: DataFrame, prefix: DataFrame, roots: DataFrame, tile: int = TILE) -> DataFrame:
    """Links between classes of different components that share a prefix shingle.

    Members of a mixed list meet in tiles of at most about two times ``tile``, first with their prefixes only.  Members of a pair whose shared
    prefix shingles leave a link possible meet in their tile once more, with whole sets: pairs are counted and verified inside, and
    what leaves a tile are the links that join its components, fewer than its members.
    """
    rows = lists.where("level = 1").select("list", "k").join(roots, "k", "left").withColumn("root", F.coalesce("root", "k"))
    mixed = rows.groupBy("list").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("size")).where(F.col("a") != F.col("b")).select("list", "size")
    blocks = F.ceil(F.col("size") / tile).cast("int")
    dealt = rows.join(mixed, "list").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    # a block meets itself and every other block of its list once
    with_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = dealt.select("list", "k", "root", "block", with_block).select("list", "k", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    members = tiles.join(prefix.select("k", "n", "head"), "k")

    def candidates(group: pa.Table) -> pa.Table:
        root, n = (group.column(c).to_numpy() for c in ("root", "n"))
        may = may_link(group.column("list")[0].as_py(), root, n.astype(np.int64), arrays(group, "head"))
        return group.select(["list", "i", "j", "k", "root"]).filter(pa.array(may.any(0) | may.any(1)))

    met = members.groupBy("list", "i", "j").applyInArrow(candidates, "list long, i int, j int, k long, root long")
    whole = met.join(prefix.select("k", "n", "whole"), "k")

    def links(group: pa.Table) -> pa.Table:
        k, root, n = (group.column(c).to_numpy() for c in ("k", "root", "n"))
        both = overlaps(arrays(group, "whole"))
        x, y = joining(both * 100 >= (n[:, None] + n[None, :] - both) * SIMILARITY, root)
        return pa.table({"x": pa.array(k[x], pa.int64()), "y": pa.array(k[y], pa.int64())})

    return whole.groupBy("list", "i", "j").applyInArrow(links, "x long, y long").distinct()


def arrays(group: pa.Table, column: str) -> list[np.ndarray]:
    """A list column as arrays, without Python objects for the elements."""
    lists = group.column(column).combine_chunks()
    values, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def overlaps(sets: list[np.ndarray], below: int | None = None, width: int = 2048) -> np.ndarray:
    """Sizes of the pairwise intersections, only of elements below a limit if one is given."""
    m = len(sets)
    both = np.zeros((m, m), np.float32)
    flat, of = np.concatenate([*sets, np.zeros(0, np.int64)]), np.repeat(np.arange(m), [len(s) for s in sets])
    if below is not None:
        of, flat = of[flat < below], flat[flat < below]
    _, token, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = times > 1
    use = often[token]
    of, token = of[use], (np.cumsum(often) - 1)[token[use]]
    order = np.argsort(token, kind="stable")
    of, token = of[order], token[order]
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [start, start + width])
        x = np.zeros((m, int(token[b - 1]) - start + 1), np.float32)
        x[of[a:b], token[a:b] - start] = 1
        both += x @ x.T
    return both


def may_link(this: int, root: np.ndarray, n: np.ndarray, heads: list[np.ndarray]) -> np.ndarray:
    """Which pairs of different roots may link by their sizes and the number of prefix shingles they share.

    Of the two prefixes one ends first in the global order; what both sets share up to there is in both prefixes, and the rest is
    behind that prefix.  So the overlap is at most the shared prefix shingles plus the longer rest.  A pair counts in one list
    only, that of its smallest common prefix shingle; lists with equal members are named by their smallest shingle, so it exists.
    """
    if len(n) < 2 or (root == root[0]).all():
        return np.zeros((len(n), len(n)), bool)
    both = overlaps(heads)
    rest = least_overlap(n) - 1
    total = n[:, None] + n[None, :]
    need = -(-total * SIMILARITY // (100 + SIMILARITY))
    may = (both > 0) & (both + np.maximum(rest[:, None], rest[None, :]) >= need) & (np.minimum(n[:, None], n[None, :]) * 100 >= np.maximum(n[:, None], n[None, :]) * SIMILARITY)
    may &= root[:, None] != root[None, :]
    if may.any():
        may &= overlaps(heads, this) == 0
    return np.triu(may, 1)


def joining(linked: np.ndarray, root: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the linked pairs those that join two components not joined by earlier ones: at most one fewer than members."""
    top = {r: r for r in root.tolist()}

    def find(r: int) -> int:
        while top[r] != r:
            top[r] = top[top[r]]
            r = top[r]
        return r

    xs, ys = [], []
    for i, j in zip(*np.nonzero(np.triu(linked & (root[:, None] != root[None, :]), 1)), strict=True):
        a, b = find(int(root[i])), find(int(root[j]))
        if a != b:
            top[a] = b
            xs.append(i)
            ys.append(j)
    return xs, ys


def grouped(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, text_key, n, root, component_id`` per document; ``root`` names the component, null without words."""
    size = docs.select(F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")).alias("b")).first().b or 0
    shards = max(16, -(-size // SHARD_BYTES))
    back = stored(shared(shingled(docs, text, shards), shards), "shingles")
    prefix = stored(prefixed(back), "prefixes")
    sets = prefix.select("k", "n", "whole")
    lists = stored(posting_lists(prefix), "lists")
    first = stored(pivot_links(lists, sets), "links")
    roots = components(first)
    more = stored(residual_links(lists, prefix, roots), "links")
    ends = components(first.union(more))
    rows = back.where("kind = 0").select("doc_id", F.col("a").cast("string").alias("text_key"), "k", "n")
    classes = rows.where(F.col("k").isNotNull()).groupBy("k").agg(F.min("doc_id").alias("first"))
    rooted = classes.join(ends, "k", "left").select("k", "first", F.coalesce("root", "k").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("k", "root", "component_id")
    out = rows.join(named, "k", "left")
    return out.select("doc_id", "text_key", "n", "root", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document."""
    return grouped(docs, text).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def first_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """Of each component the document with the smallest id (then text hash), with all its columns.

    Documents without words are groups of their own.  A row is found again by its id and its text; repeated rows stay once.
    """
    seen = grouped(docs, text)
    choice = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))).alias("one")
    first = seen.where(F.col("root").isNotNull()).groupBy("root").agg(choice).select("one.id", "one.key")
    alone = seen.where(F.col("root").isNull()).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    chosen = stored(first.union(alone), "chosen")
    id_, key = unused(docs.columns, "id"), unused(docs.columns, "key")
    chosen = chosen.select(F.col("id").alias("chosen_id"), F.col("key").alias("chosen_key"))
    chosen = chosen.toDF(unused([*docs.columns, id_, key], "chosen_id"), unused([*docs.columns, id_, key], "chosen_key"))
    same_id, same_key = (F.col(c) for c in chosen.columns)
    keyed = docs.withColumns({id_: F.col("doc_id").cast("long"), key: F.md5(F.coalesce(F.col(text), F.lit("")))})
    kept = keyed.join(chosen, F.col(id_).eqNullSafe(same_id) & (F.col(key) == same_key), "left_semi")
    return kept.dropDuplicates([id_, key]).select(*docs.columns)
