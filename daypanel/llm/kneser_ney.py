"""Quality by perplexity under interpolated modified Kneser-Ney models of trusted text, one per language.

The models run over whole characters (UTF-16 units, nothing folded), with n-grams up to order 4 as exact 64-bit numbers.
All trusted text is counted: tasks send their counts per n-gram, and shuffled count tables are joined with their
contexts and continuation counts for the discounted probabilities.  These tables grow with the corpus and stay in Spark.
Documents are dealt into blocks; the distinct n-grams of a block are joined with the tables of every order, and their
log-probabilities meet the block's texts again, so every document is scored whole.  Thresholds are quantiles of the trusted
documents' perplexity in the language.

``classes`` folds characters into few classes: over these the tables are small enough for one dense array (``log_table``),
which states the same recursion for all n-grams.

Defined results: a null or empty text has no perplexity and is not kept; a language without trusted text uses the model of all
languages; without any trusted text nothing is scored and all non-empty texts are kept; repeated rows are scored each; further columns
are ignored, whatever their names; an empty table gives no rows; a very long text is one row, scored in one pass over its characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

ORDER = 4
BITS = 16  # of a UTF-16 unit
MARK = 0xFFFF  # no character; stands before a text
CLASS_BITS, CLASS_MARK = 6, 39
A = 1 << CLASS_BITS
ALL = "*"  # the model of all languages
# Bytes of text that a task sorts by block at once, and n-grams it counts before it sends them.
PACK_BYTES, HELD = 16 << 20, 2_000_000
# Classes of characters that are no letters.
SENTENCE = "!?;:'\"()-"
SYMBOLS = "#*$%&|<>@~^_=+/\\[]{}`"


def class_table() -> np.ndarray:
    """Class of every code point of the basic plane; what lies beyond is class 38."""
    out = np.full(0x10000, 38, np.int64)
    for cp in range(0x10000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 28 + cp % 4
        elif c.isdigit():
            out[cp] = 32
        elif c == "\n":
            out[cp] = 33
        elif c.isspace():
            out[cp] = 0
    for i, chars in enumerate((".", ",", SENTENCE, SYMBOLS)):
        for c in chars:
            out[ord(c)] = 34 + i
    return out


def upper_table() -> np.ndarray:
    return np.array([chr(cp).isupper() for cp in range(0x10000)])


_tables: list[np.ndarray] = []


def classes(text: str) -> np.ndarray:
    if not _tables:
        _tables.extend((class_table(), upper_table()))
    cp = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)
    out = _tables[0][cp]
    up = _tables[1][cp]
    out[1:][up[1:] & up[:-1]] = 27  # capitals in a row
    return out


def grams_of(letters: np.ndarray, bits: int, mark: int) -> np.ndarray:
    """Four-grams ending at each letter, as numbers of ``bits`` a letter; three marks stand before the first."""
    c = np.r_[np.full(ORDER - 1, mark), letters].astype(np.uint64)
    out = c[: len(letters)].copy()
    for i in range(1, ORDER):
        out <<= np.uint64(bits)
        out |= c[i : i + len(letters)]
    return out.view(np.int64)


def codes(text: str) -> np.ndarray:
    return grams_of(classes(text), CLASS_BITS, CLASS_MARK)


def char_codes(text: str) -> np.ndarray:
    return grams_of(np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2"), BITS, MARK)


def counted(trusted: DataFrame, coded: Callable[[str], np.ndarray]) -> DataFrame:
    """``lang, code, c``: counts of the n-grams of ``lang, text``."""
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("c", pa.int64())])

    def sent(lang: str, held: list) -> pa.RecordBatch:
        at, back = np.unique(np.concatenate([a for a, _ in held]), return_inverse=True)
        n = np.bincount(back, np.concatenate([n for _, n in held]), len(at)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, 4 << 20):
                texts: dict[str, list[str]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text)
                for lang, own in texts.items():
                    sums.setdefault(lang, []).append(np.unique(np.concatenate([coded(t) for t in own]), return_counts=True))
                    size += len(sums[lang][-1][0])
                if size > HELD:
                    for lang, held in sums.items():
                        yield sent(lang, held)
                    sums, size = {}, 0
        for lang, held in sums.items():
            yield sent(lang, held)

    return trusted.mapInArrow(run, "lang string, code long, c long").groupBy("lang", "code").agg(F.sum("c").alias("c"))


def context(code: Column, bits: int) -> Column:
    """All letters of an n-gram but the last."""
    return F.shiftrightunsigned(code, bits)


def shorter(code: Column, bits: int, order: int) -> Column:
    """The last ``order`` letters of an n-gram."""
    return code if bits * order >= 64 else code.bitwiseAND(F.lit((1 << bits * order) - 1))


def discounted(grams: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """For n-gram counts ``lang, code, c`` of one order: ``lang, code, base`` and ``lang, ctx, gamma``.

    ``base`` is the discounted share of the context's count, ``gamma`` the mass left for the lower order.
    """
    of = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    step = lambda k: F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0), F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"), F.lit(0.05)), F.lit(k - 0.05))).otherwise(F.lit(k / 2))
    discounts = grams.groupBy("lang").agg(*of).select("lang", step(1).alias("d1"), step(2).alias("d2"), step(3).alias("d3"))
    rows = grams.withColumn("ctx", context(F.col("code"), bits))
    n_of = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    contexts = rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), n_of(F.col("c") == 1).alias("m1"), n_of(F.col("c") == 2).alias("m2"), n_of(F.col("c") > 2).alias("m3")).join(discounts, "lang")
    gamma = (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    base = rows.join(contexts, ["lang", "ctx"]).select("lang", "code", (F.greatest(F.col("c") - d, F.lit(0.0)) / F.col("total")).alias("base"))
    return base, contexts.select("lang", "ctx", gamma.alias("gamma"))


def with_all(own: DataFrame) -> DataFrame:
    """Counts by language and, under ``ALL``, of all languages together."""
    every = own.groupBy("code").agg(F.sum("c").alias("c")).select(F.lit(ALL).alias("lang"), "code", "c")
    return own.where(F.col("lang") != ALL).unionByName(every)


def levels(grams: DataFrame, bits: int) -> dict[int, tuple[DataFrame, DataFrame]]:
    """By order the tables ``lang, code, base`` and ``lang, ctx, gamma``, from the counts of the highest order."""
    out = {}
    for order in range(ORDER, 0, -1):
        out[order] = discounted(grams, bits)
        # continuation counts: how many different letters stand before each shorter n-gram
        grams = grams.groupBy("lang", shorter(F.col("code"), bits, order - 1).alias("code")).agg(F.count(F.lit(1)).alias("c"))
    return out


def models(trusted: DataFrame) -> DataFrame:
    """``lang, order, code, base, gamma`` over classes, written: tables of all orders; ``gamma`` rows hold a context in ``code``."""
    grams = stored(with_all(stored(counted(trusted, codes), "grams")), "grams")
    none = F.lit(None).cast("double")
    out = None
    for order, (base, gamma) in levels(grams, CLASS_BITS).items():
        rows = base.select("lang", F.lit(order).alias("order"), "code", "base", none.alias("gamma")).unionByName(
            gamma.select("lang", F.lit(order).alias("order"), F.col("ctx").alias("code"), none.alias("base"), "gamma")
        )
        out = rows if out is None else out.unionByName(rows)
    return stored(out, "kneser-ney")


def char_models(trusted: DataFrame) -> tuple[DataFrame, dict[int, tuple[DataFrame, DataFrame]]]:
    """``lang`` of all models, and their tables by order over whole characters, all written."""
    grams = stored(with_all(stored(counted(trusted, char_codes), "grams")), "grams")
    tables = {k: (stored(base, f"base-{k}"), stored(gamma, f"gamma-{k}")) for k, (base, gamma) in levels(grams, BITS).items()}
    return stored(tables[1][1].select("lang").distinct(), "languages"), tables


def log_table(rows: list) -> np.ndarray:
    """Log-probabilities of all A⁴ four-grams from the rows of one language."""
    p = np.full(1, 1.0 / A)  # below order 1
    for order in range(1, ORDER + 1):
        base, gamma = np.zeros(A**order), np.ones(A ** (order - 1))
        for r in rows:
            if r.order == order:
                if r.base is not None:
                    base[r.code] = r.base
                else:
                    gamma[r.code] = r.gamma
        lower = np.tile(p.reshape(-1, A) if order > 1 else np.full((1, A), 1.0 / A), (A if order > 1 else 1, 1))
        p = (base.reshape(-1, A) + gamma[:, None] * lower).ravel()
    return np.log(np.maximum(p, 1e-12)).astype(np.float32)


def packed(rows: DataFrame) -> DataFrame:
    """``block, pack``: rows of one block together, their texts compressed, for the exchange by block."""
    rest = [c for c in rows.columns if c != "block"]

    def packs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))
        t = pa.Table.from_batches(held).sort_by("block").combine_chunks()
        blocks, first = np.unique(t.column("block").to_numpy(), return_index=True)
        for block, start, stop in zip(blocks, first, [*first[1:], t.num_rows], strict=True):
            out = pa.BufferOutputStream()
            own = t.select(rest).slice(start, stop - start)
            with pa.ipc.new_stream(out, own.schema, options=options) as writer:
                writer.write_table(own)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["block", "pack"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, PACK_BYTES):
                held.append(part)
                size += part.nbytes
                if size >= PACK_BYTES:
                    yield from packs(held)
                    held, size = [], 0
        if held:
            yield from packs(held)

    return rows.mapInArrow(run, "block int, pack binary")


def unpacked(packs: pa.Table) -> Iterator[pa.RecordBatch]:
    for pack in packs.column("pack"):
        for batch in pa.ipc.open_stream(pack.as_buffer()):
            yield from slices(batch, 4 << 20)


def block_grams(packs: pa.Table) -> pa.Table:
    """``block, model, code``: the distinct n-grams of a block's texts by model."""
    seen: dict[str, np.ndarray] = {}
    for rows in unpacked(packs):
        new: dict[str, list[np.ndarray]] = {}
        for name, text in zip(rows.column("model").to_pylist(), rows.column("text").to_pylist(), strict=True):
            if name is not None and text:
                new.setdefault(name, []).append(char_codes(text))
        for name, own in new.items():
            seen[name] = np.unique(np.concatenate([seen.get(name, own[0][:0]), np.unique(np.concatenate(own))]))
    block = packs.column("block")[0].as_py()
    n = sum(map(len, seen.values()))
    names = pa.array([name for name, own in seen.items() for _ in range(len(own))], pa.string())
    return pa.table({"block": pa.array(np.full(n, block, np.int32)), "model": names, "code": pa.array(np.concatenate([*seen.values(), np.empty(0, np.int64)]))})


def log_probabilities(grams: DataFrame, tables: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``block, model, code, value``: the n-grams joined with the tables of every order; unseen ones have the mass of their contexts."""
    p = F.lit(1.0 / (1 << BITS))  # below order 1
    out = grams
    for order, (base, gamma) in sorted(tables.items()):
        code = shorter(F.col("code"), BITS, order)
        base = base.select(F.col("lang").alias("model"), F.col("code").alias(f"_at{order}"), F.col("base").alias(f"_base{order}"))
        gamma = gamma.select(F.col("lang").alias("model"), F.col("ctx").alias(f"_ctx{order}"), F.col("gamma").alias(f"_gamma{order}"))
        out = out.withColumns({f"_at{order}": code, f"_ctx{order}": context(code, BITS)}).join(base, ["model", f"_at{order}"], "left").join(gamma, ["model", f"_ctx{order}"], "left")
        p = F.coalesce(F.col(f"_base{order}"), F.lit(0.0)) + F.coalesce(F.col(f"_gamma{order}"), F.lit(1.0)) * p
    return out.select("block", "model", "code", F.log(F.greatest(p, F.lit(1e-12))).cast("float").alias("value"))


def score_block(packs: pa.Table, grams: pa.Table) -> pa.Table:
    """Mean log-probability of a block's texts, from its n-grams."""
    known = {}
    if grams.num_rows:
        grams = grams.sort_by([("model", "ascending"), ("code", "ascending")])
        encoded = grams.column("model").combine_chunks().dictionary_encode()
        of, code, value = encoded.indices.to_numpy(), grams.column("code").to_numpy(), grams.column("value").to_numpy()
        for i, name in enumerate(encoded.dictionary.to_pylist()):
            a, b = np.searchsorted(of, [i, i + 1])
            known[name] = code[a:b], value[a:b]
    out = []
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("model", pa.string()), ("n_chars", pa.int64()), ("log_ppl", pa.float64())])
    for rows in unpacked(packs):
        n, ppl = [], []
        for name, text in zip(rows.column("model").to_pylist(), rows.column("text").to_pylist(), strict=True):
            n.append(len(text))
            ppl.append(None)
            if text and name is not None:
                code, value = known[name]
                ppl[-1] = -float(value[np.searchsorted(code, char_codes(text))].mean(dtype=np.float64))
        out.append(pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("lang"), rows.column("model"), pa.array(n, pa.int64()), pa.array(ppl, pa.float64())], schema=schema))
    return pa.Table.from_batches(out, schema)


def perplexities(docs: DataFrame, languages: DataFrame, tables: dict[int, tuple[DataFrame, DataFrame]], text: str = "text") -> DataFrame:
    """``doc_id, lang, model, n_chars, log_ppl`` per document; ``log_ppl`` is null for empty texts and without a model."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(8, partitions // 3))).cast("int")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    other = F.lit(None).cast("string") if languages.isEmpty() else F.lit(ALL)
    own = languages.select("lang", F.col("lang").alias("model"))
    rows = picked.join(own, "lang", "left").select("doc_id", "lang", F.coalesce("model", other).alias("model"), "text", block.alias("block"))
    # dealt once: the plan reads this exchange twice, for the n-grams and for the texts
    packs = packed(rows).repartition("block")
    grams = packs.groupBy("block").applyInArrow(block_grams, "block int, model string, code long")
    return packs.groupBy("block").cogroup(log_probabilities(grams, tables).groupBy("block")).applyInArrow(
        score_block, "doc_id long, lang string, model string, n_chars long, log_ppl double"
    )


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", spread: float = 5.0, least: float = 0.05) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity, threshold, kept`` per document.

    Trusted are the documents with ``quality`` 1.  A document is kept up to the 90 % quantile of the trusted ones in its
    language plus ``spread`` times its distance from their median, on the log scale; short texts get the wider range of a mean of few characters.
    Where the trusted texts are nearly equal, that distance counts as ``least``: they say nothing of how texts vary.
    """
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit(ALL + "null")).alias("lang"), F.col(text).alias("text")).where("text is not null and text <> ''")
    # one plan at every size; on large inputs the engine adds a Bloom filter of the trusted ids before the texts are exchanged
    trusted = own.join(good.hint("merge"), "doc_id", "left_semi").select("lang", "text")
    scored = stored(perplexities(docs, *char_models(trusted), text), "perplexity")
    seen = scored.join(good, "doc_id", "left_semi").where(F.col("log_ppl").isNotNull())
    mid, high = (F.percentile_approx("log_ppl", q, 10_000) for q in (0.5, 0.9))
    edge = high + spread * F.greatest(high - mid, F.lit(least))
    limits = seen.groupBy("model").agg(edge.alias("limit"))
    overall = seen.agg(edge.alias("any"))
    limit = F.coalesce(F.col("limit"), F.col("any"), F.lit(1e6))
    # one row per model, whose languages are known here, and one row
    joined = scored.join(F.broadcast(limits), "model", "left").join(F.broadcast(overall))
    allowed = limit + 2 / F.sqrt(F.greatest(F.col("n_chars"), F.lit(1)))
    return joined.select(
        "doc_id", "lang", "n_chars", F.exp("log_ppl").alias("perplexity"), F.exp(F.least(allowed, F.lit(50.0))).alias("threshold"),
        ((F.col("n_chars") > 0) & F.coalesce(F.col("log_ppl") <= allowed, F.lit(True))).alias("kept"),
    )
