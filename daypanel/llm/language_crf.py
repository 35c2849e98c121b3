"""Language of words in code-switched text by a linear-chain conditional random field.

Every word has affix, character n-gram and lexicon features; transitions between languages are learned with the feature
weights.  Forward-backward gives each word a posterior over the languages; a document's language is the one with the
largest sum of posteriors, and its score that language's share.

Training takes a bounded sample of labelled documents (``sample`` documents a language) in a few Spark partitions: each runs AdaGrad
steps on its own segments, the weights are averaged, and the next round starts from the mean.  Segments are made of runs
of words of one or more languages, so that transitions see switches.

Defined results: a null text or one without a letter is ``und`` with score 0; ties go to the first language in order;
repeated rows are labelled each; without any labelled document everything is ``und``; further columns are ignored, whatever their names;
an empty table gives no rows; very long texts are labelled in pieces that see the words beside them.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import forget, memory
from .common import in_batches, kept_rows, stored

BUCKETS = 1 << 16  # hashed feature weights
LEXICON = 3_000  # words per language
SEGMENT = 48  # words in a training sequence
PIECE, CONTEXT = 1024, 64  # words of a piece of a long text, and words that it sees beside them
BLOCK = 8_192  # words whose features are hashed together
LONGEST = 40  # letters of an element of the chain: longer runs, such as those of scripts without spaces, are several elements
_words = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST - 1}}}").findall


@dataclass
class Crf:
    """``weights`` (buckets × languages), ``lexicon`` (word to language), ``moves`` (language × language, log scale)."""

    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray


def words_of(text: str) -> list[str]:
    return _words(text.lower())


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Buckets of the features of a word: itself, prefixes, suffixes, 2- and 3-grams with its ends, lexicon entry."""
    w = f"^{word}$"
    names = [w] + ["p" + w[1 : 1 + k] for k in (1, 2, 3)] + ["s" + w[-1 - k : -1] for k in (1, 2, 3)]
    names += [w[i : i + k] for k in (2, 3) for i in range(len(w) - k + 1)]
    if word in lexicon:
        names.append(f"lexicon {lexicon[word]}")
    return [zlib.crc32(x.encode()) & (BUCKETS - 1) for x in names]


def crc_table() -> np.ndarray:
    """CRC-32 of zlib, by the low byte of its register."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC, _LEADS = crc_table(), np.array([0, 0xC0, 0xE0, 0xF0], np.uint32)
_START, _PREFIX, _SUFFIX = (np.uint32(~zlib.crc32(x) & 0xFFFFFFFF) for x in (b"", b"p", b"s"))


def lengthened(crc: np.ndarray, points: np.ndarray) -> np.ndarray:
    """CRC-32 registers after one more code point each, by its UTF-8 bytes."""
    lead, wide = points, np.flatnonzero(points > 0x7F)
    if len(wide):
        c = points[wide]
        more = 1 + (c > 0x7FF) + (c > 0xFFFF)  # bytes after the first
        lead = points.copy()
        lead[wide] = _LEADS[more] | (c >> (6 * more).astype(np.uint32))
    out = _CRC[(crc ^ lead) & 0xFF] ^ (crc >> 8)
    if len(wide):
        for left in (2, 1, 0):
            at = wide[more > left]
            byte = 0x80 | ((points[at] >> (6 * left)) & 0x3F)
            out[at] = _CRC[(out[at] ^ byte) & 0xFF] ^ (out[at] >> 8)
    return out


def feature_rows(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`features` of many words, one after another, and how many each has; hashed together, a code point a step."""
    marked = [f"^{w}$" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.cumsum(n) - n
    known = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, len(words))
    sizes = 7 + (n - 1) + (n - 2) + (known >= 0)
    begin = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint32)
    out[begin] = np.fromiter(map(zlib.crc32, map(str.encode, marked)), np.uint32, len(marked)) ^ np.uint32(0xFFFFFFFF)
    # A word of one letter has no third place: its longest prefix and suffix are those of two.
    third = n > 3
    crc = _PREFIX
    for k in (1, 2):
        crc = out[begin + k] = lengthened(crc, points[first + k])
    out[begin + 3] = np.where(third, lengthened(crc, points[first + np.minimum(3, n - 1)]), crc)
    end = first + n - 1  # the closing mark
    for k in (1, 2, 3):
        crc = _SUFFIX
        for back in range(k, 0, -1):
            longer = lengthened(np.broadcast_to(crc, n.shape), points[np.maximum(end - back, first)])
            crc = np.where(third, longer, crc) if back == 3 else longer
        out[begin + 3 + k] = crc
    place = np.arange(len(points)) - np.repeat(first, n)
    crc = lengthened(np.broadcast_to(_START, points.shape), points)
    for k, skipped in ((2, 0), (3, n - 1)):
        crc = lengthened(crc[:-1], points[k - 1 :])
        whole = place[: len(crc)] <= np.repeat(n - k, n)[: len(crc)]
        out[(np.repeat(begin + 7 + skipped, n) + place)[: len(crc)][whole]] = crc[whole]
    at = np.flatnonzero(known >= 0)
    out[(begin + sizes - 1)[at]] = np.array([zlib.crc32(f"lexicon {x}".encode()) for x in known[at]], np.uint32) ^ np.uint32(0xFFFFFFFF)
    return (out ^ np.uint32(0xFFFFFFFF)) & np.uint32(BUCKETS - 1), sizes


def emissions(words: list[str], crf: Crf) -> np.ndarray:
    """Scores (words × languages) of distinct words, by their summed feature weights."""
    scores = [np.zeros((0, len(crf.languages)), np.float32)]
    for start in range(0, len(words), BLOCK):
        rows, sizes = feature_rows(words[start : start + BLOCK], crf.lexicon)
        scores.append(np.add.reduceat(crf.weights[rows], np.cumsum(sizes) - sizes, axis=0))
    return np.concatenate(scores)


def posteriors(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, moving: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once.

    ``scores`` holds the words of all sequences one after another.  Step t works on every sequence that has a word t, so
    the loop runs as often as the longest sequence is long; words of a step lie together, longer sequences first.  Returns posteriors in the
    order of ``scores`` and the sum of posterior moves (language × language), which stays zero without ``moving``.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
    begin = np.cumsum(active) - active
    at = starts[np.arange(active.sum()) - np.repeat(begin, active)] + np.repeat(np.arange(steps), active)
    x = (np.exp(scores - scores.max(1, keepdims=True)) + 1e-30)[at]
    a = np.exp(moves - moves.max())
    fore = np.empty_like(x)
    for t in range(steps):
        here = slice(begin[t], begin[t] + active[t])
        f = x[here] if t == 0 else (fore[begin[t - 1] : begin[t - 1] + active[t]] @ a) * x[here]
        fore[here] = f / f.sum(1, keepdims=True)
    back = np.ones_like(x)
    moved = np.zeros_like(a)
    for t in range(steps - 2, -1, -1):
        here, there = (slice(begin[s], begin[s] + active[t + 1]) for s in (t, t + 1))
        nxt = x[there] * back[there]
        b = nxt @ a.T
        if moving:
            total = (fore[here] * b).sum(1, keepdims=True)
            moved += a * (fore[here].T @ (nxt / total))
        back[here] = b / b.sum(1, keepdims=True)
    p = fore * back
    out = np.empty_like(p)
    out[at] = p / p.sum(1, keepdims=True)
    return out, moved


def long_posteriors(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, piece: int = PIECE, context: int = CONTEXT) -> np.ndarray:
    """:func:`posteriors`, with sequences longer than a piece cut into pieces that see ``context`` words on either side.

    The chain forgets what lies ``context`` words away, so words of a piece get the posteriors of the whole text; all pieces go forward and
    backward together, so one very long text takes no more steps than a piece.
    """
    if not len(lengths) or lengths.max() <= piece + context:
        return posteriors(scores, lengths, moves, moving=False)[0]
    firsts = np.cumsum(lengths) - lengths
    counts = -(-lengths // piece)
    of = np.repeat(np.arange(len(lengths)), counts)
    begin = (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)) * piece
    end = np.minimum(begin + piece, lengths[of])
    left, right = np.maximum(begin - context, 0), np.minimum(end + context, lengths[of])
    sizes = right - left
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - left, sizes)  # place in its text
    own = (at >= np.repeat(begin, sizes)) & (at < np.repeat(end, sizes))
    return posteriors(scores[np.repeat(firsts[of], sizes) + at], sizes, moves, moving=False)[0][own]


def is_held_out(doc_id: Column, parts: int = 4, rest: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def training_sample(labelled: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` different texts of each ``lang``, by text hash: thinned by the counts first, then ranked.

    Copies are reduced first, so a language of many copies of few texts keeps them all, and no text fills the places of others.
    """
    keyed = labelled.select("lang", "text", F.md5("text").alias("key"))
    # Digests are counted and ranked; only the texts drawn are moved.
    texts = keyed.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("copies")).drop("copies")
    counts = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    mark = F.pmod(F.xxhash64("key"), F.lit(1_000_003))
    # Of languages with up to twice the sample all texts pass, of others about twice the sample.
    thin = texts.join(counts, "lang").where(mark * F.col("n") < F.lit(2 * sample * 1_000_003).cast("long"))
    ranked = thin.withColumn("_at", F.row_number().over(Window.partitionBy("lang").orderBy(mark, "key")))
    drawn = ranked.where(F.col("_at") <= sample).select("lang", "key")
    return keyed.join(drawn, ["lang", "key"]).groupBy("lang", "key").agg(F.first("text").alias("text")).select("lang", "text")


def learn_lexicon(sample: DataFrame, languages: list[str]) -> dict[str, int]:
    """Words that stand nearly always in one language of the sample, the most frequent of each."""
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST - 1}}}"), F.lit(0))).alias("w"))
    counts = words.groupBy("w", "lang").agg(F.count(F.lit(1)).alias("n"))
    of = counts.groupBy("w").agg(F.max(F.struct("n", "lang")).alias("top"), F.sum("n").alias("all"))
    own = of.where((F.col("all") >= 3) & (F.col("top.n") >= 0.9 * F.col("all")))
    best = own.withColumn("_at", F.row_number().over(Window.partitionBy("top.lang").orderBy(F.desc("all"), "w"))).where(F.col("_at") <= LEXICON)
    at = {x: i for i, x in enumerate(languages)}
    return {r.w: at[r.lang] for r in best.select("w", "top.lang").collect()}


def segments(texts: list[list[str]], labels: list[int], rng: np.random.Generator) -> list[tuple[list[str], list[int]]]:
    """Training sequences: half of one language, half of runs of several."""
    out = []
    for words, y in zip(texts, labels, strict=True):
        for start in range(0, len(words), SEGMENT):
            own = words[start : start + SEGMENT]
            seq, ys = own, [y] * len(own)
            if rng.random() < 0.5:
                k = int(rng.integers(len(texts)))
                if texts[k]:
                    cut, n = int(rng.integers(1, len(own) + 1)), int(rng.integers(3, SEGMENT))
                    other = texts[k][:n]
                    seq, ys = own[:cut] + other, [y] * cut + [labels[k]] * len(other)
            if seq:
                out.append((seq, ys))
    return out


def local_steps(texts: list[list[str]], labels: list[int], crf: Crf, steps: int, seed: int) -> Crf:
    """AdaGrad on the mean log-likelihood of this partition's segments."""
    rng = np.random.default_rng(seed)
    seqs = segments(texts, labels, rng)
    if not seqs:
        return crf
    ids: dict[str, int] = {}
    flat = np.array([ids.setdefault(w, len(ids)) for s, _ in seqs for w in s])
    ys = np.array([y for _, s in seqs for y in s])
    lengths = np.array([len(s) for s, _ in seqs])
    feats = [features(w, crf.lexicon) for w in ids]
    width = max(map(len, feats))
    padded = np.full((len(feats), width), BUCKETS)
    for i, f in enumerate(feats):
        padded[i, : len(f)] = f
    k = len(crf.languages)
    w, m = np.vstack([crf.weights, np.zeros((1, k))]).astype(np.float64), crf.moves.astype(np.float64)
    sw, sm = np.full_like(w, 1e-6), np.full_like(m, 1e-6)
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(flat), bool)
    inner[first] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (ys[:-1][inner[1:]], ys[1:][inner[1:]]), 1)
    gold = np.zeros((len(flat), k))
    gold[np.arange(len(flat)), ys] = 1
    for _ in range(steps):
        p, moved = posteriors(w[padded].sum(1)[flat], lengths, m)
        err = np.zeros((len(ids), k))
        np.add.at(err, flat, gold - p)
        g = np.stack([np.bincount(padded.ravel(), np.repeat(err[:, j], width), BUCKETS + 1) for j in range(k)], 1) / len(flat) - 1e-6 * w
        gm = (seen - moved) / len(flat)
        sw += g * g
        sm += gm * gm
        w += 0.2 * g / np.sqrt(sw)
        m += 0.2 * gm / np.sqrt(sm)
        w[BUCKETS] = 0
    return Crf(crf.languages, crf.lexicon, w[:BUCKETS].astype(np.float32), m.astype(np.float32))


def packed(crf: Crf) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, w=crf.weights, m=crf.moves)
    return out.getvalue()


def fit(labelled: DataFrame, sample: int = 300, rounds: int = 3, steps: int = 8, partitions: int = 4) -> Crf | None:
    """A model from ``text, lang``; None if no row has a label.  Only ``sample`` documents a language are learned from."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    drawn = stored(training_sample(rows, sample), "crf-sample")
    languages = sorted(r.lang for r in drawn.select("lang").distinct().collect())
    if not languages:
        return None
    k = len(languages)
    crf = Crf(languages, learn_lexicon(drawn, languages), np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32))
    at = {x: i for i, x in enumerate(languages)}
    spread = drawn.repartition(partitions)  # as many models as this come back to the driver
    for turn in range(rounds):
        sent = drawn.sparkSession.sparkContext.broadcast(crf)

        def train(batches: Iterator[pd.DataFrame], turn: int = turn, sent=sent) -> Iterator[pd.DataFrame]:
            forget()  # a worker may come from an earlier stage
            texts, labels = [], []
            for b in batches:  # a part of the bounded sample
                texts += [words_of(t) for t in b["text"]]
                labels += [at[x] for x in b["lang"]]
            if texts:
                order = np.argsort([zlib.crc32(" ".join(t[:50]).encode()) for t in texts], kind="stable")
                got = local_steps([texts[i] for i in order], [labels[i] for i in order], sent.value, steps, turn)
                yield pd.DataFrame({"model": [packed(got)], "n": [len(texts)]})

        parts = spread.mapInPandas(train, "model binary, n long").collect()  # one model per partition
        loaded = [(np.load(io.BytesIO(bytes(p.model))), p.n) for p in sorted(parts, key=lambda p: bytes(p.model))]
        total = sum(n for _, n in loaded)
        crf = Crf(languages, crf.lexicon, sum(z["w"] * (n / total) for z, n in loaded), sum(z["m"] * (n / total) for z, n in loaded))
    return crf


def sequence_scores(texts: list[list[str]], crf: Crf, known: dict) -> np.ndarray:
    """Emission scores of all words of the texts in order; a worker remembers the scores of words."""
    flat = [w for t in texts for w in t]
    places = list(map(known.get, flat))
    table = known.setdefault("", np.zeros((0, len(crf.languages)), np.float32))
    if None in places:
        new = list({w for w, i in zip(flat, places, strict=True) if i is None})
        at = len(table)
        known.update(zip(new, range(at, at + len(new)), strict=True))
        table = known[""] = np.vstack([table, emissions(new, crf)])
        places = list(map(known.__getitem__, flat))
    return table[np.array(places, np.int64)]


def label(docs: DataFrame, crf: Crf | None, text: str = "text", words: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, n_words, n_other`` per document; ``n_other`` words were given another language.

    With ``words`` also ``words array<string>`` and ``word_langs array<string>``.
    """
    extra = ", words array<string>, word_langs array<string>" if words else ""
    schema = "doc_id long, lang_pred string, score double, n_words long, n_other long" + extra
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(crf)
    name = f"crf {zlib.crc32(packed(crf)) if crf else 0}"

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = [words_of(t) for t in batch.column(1).to_pylist()]
        out = {"doc_id": batch.column(0)} | verdicts(texts, sent.value, memory(name, {}), words)
        if words:
            out["words"] = texts
        yield out

    return in_batches(picked, work, schema, 4 << 20)


def verdicts(texts: list[list[str]], crf: Crf | None, known: dict, each: bool = False) -> dict[str, list]:
    """Language, score and word counts of each text, and with ``each`` the language of every word."""
    n = len(texts)
    out: dict[str, list] = {"lang_pred": ["und"] * n, "score": [0.0] * n, "n_words": list(map(len, texts)), "n_other": [0] * n}
    if each:
        out["word_langs"] = [["und"] * len(t) for t in texts]
    lengths = np.array([len(t) for t in texts])
    rows = np.flatnonzero(lengths)
    if crf is None or not len(rows):
        return out
    own = lengths[rows]
    p = long_posteriors(sequence_scores([texts[i] for i in rows], crf, known), own, crf.moves)
    starts = np.cumsum(own) - own
    sums = np.add.reduceat(p, starts, axis=0).astype(np.float64)
    best, top = sums.argmax(1), p.argmax(1)
    other = np.add.reduceat((top != np.repeat(best, own)).astype(np.int64), starts)
    for j, i in enumerate(rows):
        out["lang_pred"][i] = crf.languages[best[j]]
        out["score"][i] = float(min(1.0, sums[j, best[j]] / own[j]))
        out["n_other"][i] = int(other[j])
        if each:
            out["word_langs"][i] = [crf.languages[z] for z in top[starts[j] : starts[j] + own[j]]]
    return out


def accepted(docs: DataFrame, crf: Crf | None, least: float, text: str = "text") -> DataFrame:
    """The documents, as they are, with a letter and a language that scores ``least``; without a model, those with a letter."""
    sent = docs.sparkSession.sparkContext.broadcast(crf)
    name = f"crf {zlib.crc32(packed(crf)) if crf else 0}"

    def keep(texts: list[str]) -> list[bool]:
        own = [words_of(t) for t in texts]
        if sent.value is None:
            return [bool(w) for w in own]
        got = verdicts(own, sent.value, memory(name, {}))
        return [lang != "und" and score >= least for lang, score in zip(got["lang_pred"], got["score"], strict=True)]

    return kept_rows(docs, text, keep, 4 << 20)
