"""Toxicity by weak supervision.

Many voters look at a text: lexicon words (a fixed list, and words mined from labelled rows), and patterns.  Votes are
bits, so all documents reduce to a table of counts per vote pattern.  A generative label model is fitted on that table by
expectation maximisation, each turn one aggregate of the whole table: how often each voter fires for either class, and the prior.
Voters that still fire together within a class are correlated; each one's evidence is divided by the size of what it repeats.  A
linear classifier learns the posterior labels and gives the scores.  It sees the voters' hits and, hashed, every word of the whole text
with its beginnings, so it also reaches texts on which no voter fires.

Labels enter three times, and only from rows that are not held out: lexicon words and stems are mined from a bounded
sample (``sample`` rows of either class); the label model holds the known labels fixed, with a share of errors; and so do
the posterior labels of the bounded sample (about ``fit_rows`` rows) on which the classifier is fitted.

Defined results: a null or empty text has no votes and gets the score of such texts; repeated rows are scored each; ties in a
sample go by hash, then id; a very long text is one row of numbers after one reading; without any labelled row the fixed list alone
votes; an empty table gives no rows; columns besides ``doc_id`` and the text are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import memory
from .common import in_batches, stored

# Words that are insults on their own.
LEXICON = [
    "idiot", "idiots", "stupid", "moron", "morons", "loser", "losers", "pathetic", "worthless", "trash", "clown", "scum",
    "disgusting", "imbecile", "dumb", "filth", "vermin", "jerk", "bastard", "freak",
]
MINED = 32  # mined words at most, for votes are bits of one number; the classifier has all words
HASHED = 1 << 18  # weights of hashed words and beginnings
SHORT = 30.0  # words; occurrences count in proportion to length beyond it
TARGET = re.compile(r"\b(you|your|he|she|they|them|who|this|that|du|ihr|tu|vous|usted|ellos)\b")
_words = re.compile(r"[^\W\d_]+").findall


def is_held_out(doc_id: Column, parts: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(False))


def traits(text: str) -> list[str]:
    """Words of a text, and ``stem*`` for beginnings of 3 to 8 letters that start two or more of its words."""
    words = _words(text.lower())
    stems = Counter(w[:k] for w in words for k in range(3, min(len(w), 8) + 1))
    return list({w for w in words if len(w) > 2}) + [f"{p}*" for p, n in stems.items() if n > 1]


def mine(docs: DataFrame, labels: DataFrame, sample: int = 2000, text: str = "text") -> list[str]:
    """Words and stems of many toxic texts of the sample and of few others, chosen to cover the toxic ones.

    The sample is at most ``sample`` labelled rows of either class, by hash; equal texts count once.
    """
    drawn = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    # Thinned by the count of the class first, so that a class of any size is ranked on about twice the sample.
    of_class = drawn.groupBy("toxic").agg(F.count(F.lit(1)).alias("_n"))
    drawn = drawn.join(of_class, "toxic").where(mark * F.col("_n") < F.lit(2 * sample * 1_000_003).cast("long")).drop("_n")
    order = Window.partitionBy("toxic").orderBy(mark, "doc_id")
    picked = drawn.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= sample).drop("_at")
    # at most 2 * sample ids: the bound of what is sent to every task
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(picked), "doc_id").groupBy("toxic", "t").agg(F.min("doc_id").alias("at"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"toxic": batch.column(0), "at": batch.column(1), "traits": [traits(t) for t in batch.column(2).to_pylist()]}

    seen = stored(in_batches(texts.select("toxic", "at", "t"), work, "toxic int, at long, traits array<string>"), "traits")
    n = {r.toxic: r.n for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return []
    flat = seen.select("toxic", "at", F.explode("traits").alias("trait"))
    bad, good = (F.count(F.when(F.col("toxic") == k, 1)) for k in (1, 0))
    counted = flat.groupBy("trait").agg(bad.alias("bad"), good.alias("good"))
    own = counted.where((F.col("bad") >= max(3, 0.02 * n[1])) & (F.col("good") / n[0] <= 0.06 * F.col("bad") / n[1]))
    gain = F.col("bad") - 20 * F.col("good") * (n[1] / n[0])
    best = own.orderBy(gain.desc(), F.length("trait"), "trait").limit(400)  # candidates, not rows of the corpus
    where = flat.where("toxic = 1").join(F.broadcast(best.select("trait", "bad", "good")), "trait").groupBy("trait", "good").agg(F.collect_set("at").alias("at")).collect()
    return cover({r.trait: (set(r["at"]), r.good * n[1] / n[0]) for r in where})


def cover(where: dict[str, tuple[set, float]], most: int = MINED, times: int = 2) -> list[str]:
    """Traits in the order in which each adds most texts that fewer than ``times`` chosen traits have."""
    seen: Counter = Counter()
    chosen: list[str] = []
    while len(chosen) < most:
        worth = {t: (sum(seen[x] < times for x in at) - 10 * cost, -len(t), t) for t, (at, cost) in where.items() if t not in chosen}
        if not worth or max(worth.values())[0] < 3:
            break
        t = max(worth, key=worth.get)
        chosen.append(t)
        seen.update(where[t][0])
    return chosen


@dataclass
class LabelModel:
    """Rates at which voters fire in either class (2 × voters), the prior of the toxic class, and each voter's share."""

    rates: np.ndarray
    prior: float
    share: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on, off = np.log(self.rates), np.log1p(-self.rates)
        gain = (votes * (on[1] - on[0]) + (1 - votes) * (off[1] - off[0])) @ self.share
        return 1 / (1 + np.exp(-np.clip(gain + math.log(self.prior / (1 - self.prior)), -60, 60)))


def bits_of(votes: np.ndarray, m: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(m) & 1).astype(float)


def held(p: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Posteriors, with a known label (NaN: none) held at 98 %."""
    return np.where(np.isnan(known), p, 0.02 + 0.96 * np.nan_to_num(known))


def summed(table: DataFrame, work: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], m: int) -> np.ndarray:
    """The sum over all rows of a pattern table of ``work(patterns, counts, known labels)``, an array of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            votes, known, n = (b.column(k).cast(t).to_numpy(zero_copy_only=False) for k, t in ((0, pa.int64()), (1, pa.float64()), (2, pa.float64())))
            part = work(bits_of(votes, m), n, known.astype(float))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(float).tobytes()], pa.binary())], names=["sums"])

    # One row of fixed size from every task.
    rows = table.select("votes", "toxic", "n").mapInArrow(run, "sums binary").collect()
    return sum((np.frombuffer(bytes(r.sums)) for r in rows), np.zeros(1))


def fit_labels(table: DataFrame, m: int, turns: int = 40) -> LabelModel:
    """Expectation maximisation over the table ``votes, toxic, n`` of vote patterns, started from texts with any vote.

    ``toxic`` is the label of the counted rows, null where there is none; a known label holds with 98 %.
    Correlations are read off after the first fit: voters that fire together within a class more often than their rates
    say share their evidence in the second fit.
    """
    share = np.ones(m)
    for second in (False, True):
        model: LabelModel | None = None
        for _ in range(turns):

            def weights(x: np.ndarray, n: np.ndarray, known: np.ndarray, model: LabelModel | None = model) -> np.ndarray:
                p = held(np.where(x.any(1), 0.9, 0.02) if model is None else model.posterior(x), known)
                w = np.stack([(1 - p) * n, p * n])
                return np.hstack([w.sum(1, keepdims=True), w @ x]).ravel()

            sums = summed(table, weights, m)
            if len(sums) == 1:  # no rows
                sums = np.zeros(2 * (m + 1))
            size, fires = sums.reshape(2, m + 1)[:, :1], sums.reshape(2, m + 1)[:, 1:]
            # belief before any row, worth 50 of them: a voter fires on 5 % of toxic texts and 0.1 % of others
            rates = np.clip((fires + [[0.05], [2.5]]) / (size + 50), 1e-5, 1 - 1e-5)
            # a voter speaks for the toxic class at least as often as for the other
            rates[1] = np.maximum(rates[1], rates[0])
            prior = float(np.clip((size[1, 0] + 1) / (size.sum() + 20), 1e-4, 0.5))
            still = model is not None and np.abs(rates - model.rates).max() < 1e-6 and abs(prior - model.prior) < 1e-6
            model = LabelModel(rates, prior, share)
            if still:
                break
        if not second and m > 1:

            def products(x: np.ndarray, n: np.ndarray, known: np.ndarray, model: LabelModel = model) -> np.ndarray:
                p = held(model.posterior(x), known)
                centred = [(x - model.rates[k], w) for k, w in enumerate(((1 - p) * n, p * n))]
                return np.concatenate([np.r_[w.sum(), ((c * w[:, None]).T @ c).ravel()] for c, w in centred])

            within = np.zeros((m, m))
            sums = summed(table, products, m)
            sums = (sums if len(sums) > 1 else np.zeros(2 * (m * m + 1))).reshape(2, -1)
            for part in sums:
                cov = part[1:].reshape(m, m) / max(part[0], 1e-9)
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
                within += part[0] / max(sums[:, 0].sum(), 1e-9) * np.abs(cov / np.outer(sd, sd))
            np.fill_diagonal(within, 0)
            share = 1 / (1 + np.where(within > 0.3, within, 0).sum(1))
    return model


def looked(texts: list[str], lexicon: list[str]) -> Iterator[tuple[list[str], tuple[int, list[float]]]]:
    """The words of each text with its votes and features.

    Votes: one bit a lexicon word, then the patterns.  Features: whether and how often each word occurs, and of the patterns.
    """
    at = {w: i for i, w in enumerate(lexicon) if w[-1] != "*"}
    stems = {w[:-1]: i for i, w in enumerate(lexicon) if w[-1] == "*"}
    heads, reach = {p[:3] for p in stems}, range(3, max(map(len, stems), default=2) + 1)
    for t in texts:
        low = t.lower()
        words = _words(low)
        hits = [0] * len(lexicon)
        for w in words:
            if w in at:
                hits[at[w]] += 1
            if w[:3] in heads:
                for k in reach:
                    if len(w) >= k and (i := stems.get(w[:k])) is not None:
                        hits[i] += 1
        fired = [h > (lexicon[i][-1] == "*") for i, h in enumerate(hits)]
        insults = [w for w, i in at.items() if hits[i]]
        total = sum(hits[at[w]] for w in insults)
        aimed = shouted = 0
        for w in insults:
            for m in re.finditer(rf"(?<!\w){re.escape(w)}(?!\w)", low):
                aimed += bool(TARGET.search(low[max(0, m.start() - 40) : m.end() + 40]))
                shouted += t[m.start() : m.end()].isupper()
        v = 0
        for k, s in enumerate((*fired, total >= 2, total >= 4, aimed >= 1, shouted >= 1)):
            v |= int(s) << k
        each = [float(f) for f in fired] + [math.log1p(h) for h in hits]
        yield words, (v, [*each, float(any(fired)), math.log1p(total), math.log1p(aimed), math.log1p(shouted), 100 * total / (len(words) + 20)])


def looks(docs: DataFrame, lexicon: list[str], text: str = "text") -> DataFrame:
    """``doc_id, votes long, features array<float>``: one look at every text, written."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [f for _, f in looked(batch.column(1).to_pylist(), lexicon)]
        yield {"doc_id": batch.column(0), "votes": [v for v, _ in found], "features": [f for _, f in found]}

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return stored(in_batches(picked, work, "doc_id long, votes long, features array<float>"), "looks")


def beginnings(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    return [zlib.crc32(x.encode()) & (HASHED - 1) for x in [f"^{word}", *(word[:k] for k in range(3, min(len(word), 8) + 1))]]


def scaled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text and their values: occurrences in proportion to the length."""
    counts: Counter = Counter()
    for w, n in Counter(words).items():
        for x in beginnings(w):
            counts[x] += n
    at, n = np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), float, len(counts))
    return at, n * (SHORT / (len(words) + SHORT))


def train_linear(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, float, float]], start: np.ndarray, turns: int = 8, rate: float = 0.15) -> np.ndarray:
    """Weights (hashed, dense, intercept) of a logistic regression on posterior labels, by AdaGrad over the rows in random order.

    Rows are (hashed features, their values, dense features, posterior, weight); ``start`` are the first dense weights and the intercept.
    """
    dense = len(start) - 1
    w, grown = np.r_[np.zeros(HASHED), start], np.full(HASHED + dense + 1, 1e-2)
    rng = np.random.default_rng(5)
    tail = np.arange(HASHED, HASHED + dense + 1)
    for _ in range(turns):
        for i in rng.permutation(len(rows)):
            at, value, more, p, weight = rows[i]
            at, value = np.r_[at, tail], np.r_[value, more, 1.0]
            z = float(w[at] @ value)
            g = weight * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * value
            grown[at] += g * g
            w[at] -= rate * (g / np.sqrt(grown[at]) + 1e-4 * w[at])
    return w


def first_weights(model: LabelModel, voters: int, dense: int) -> np.ndarray:
    """The label model's log-odds as a linear function of the lexicon voters' hits, from which the classifier starts."""
    on, off = np.log(model.rates), np.log1p(-model.rates)
    fired = np.clip((on[1] - on[0] - off[1] + off[0]) * model.share, 0.0, 6.0)[:voters]
    return np.r_[fired, np.zeros(dense - voters), math.log(model.prior / (1 - model.prior))]


def vote_counts(seen: DataFrame, labels: DataFrame) -> DataFrame:
    """``votes, toxic, n``, written: all distinct vote patterns by known label, and how many rows have each."""
    joined = seen.select("doc_id", "votes").join(known_labels(labels), "doc_id", "left")
    return stored(joined.groupBy("votes", "toxic").agg(F.count(F.lit(1)).alias("n")), "vote-counts")


def known_labels(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def drawn_rows(seen: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """``doc_id, toxic``: about ``fit_rows`` of the rows with a label, and a quarter as many of the others, by hash; all where there are fewer."""
    tagged = seen.select("doc_id").distinct().join(known_labels(labels), "doc_id", "left")
    sizes = {r.known: r.n for r in tagged.groupBy(F.col("toxic").isNotNull().alias("known")).agg(F.count(F.lit(1)).alias("n")).collect()}
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    within = lambda known, most: mark * F.lit(max(sizes.get(known, 0), 1)).cast("long") < F.lit(most * 1_000_003).cast("long")
    return tagged.where(F.when(F.col("toxic").isNotNull(), within(True, fit_rows)).otherwise(within(False, fit_rows // 4)))


def fit_classifier(docs: DataFrame, seen: DataFrame, labels: DataFrame, model: LabelModel, bits: int, start: np.ndarray, fit_rows: int, text: str) -> np.ndarray:
    """Weights of the classifier from the drawn rows of those that are admitted; the start without rows."""
    # Some ``fit_rows`` ids, and then their votes and features, are what is sent to every task.
    drawn = F.broadcast(stored(drawn_rows(seen, labels, fit_rows), "drawn"))
    votes = F.broadcast(stored(seen.join(drawn, "doc_id").dropDuplicates(["doc_id"]), "fit-rows"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    joined = texts.join(votes, "doc_id")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        made = [scaled(_words(t.lower())) for t in batch.column(1).to_pylist()]
        yield {"doc_id": batch.column(0), "votes": batch.column(2), "features": batch.column(3), "toxic": batch.column(4), "at": [a.astype(np.int32).tobytes() for a, _ in made], "value": [v.astype(np.float32).tobytes() for _, v in made]}

    sparse = in_batches(joined.select("doc_id", "_text", "votes", "features", "toxic"), work, "doc_id long, votes long, features array<float>, toxic int, at binary, value binary")
    array = lambda x, kind: np.frombuffer(x.as_buffer(), kind) if len(x.as_buffer()) else np.zeros(0, kind)  # noqa: E731  views, no copies

    def fit(t: pa.Table) -> pa.Table:
        known = t.column("toxic").cast(pa.float64()).to_numpy(zero_copy_only=False)
        p = held(model.posterior(bits_of(t.column("votes").to_numpy(), bits)), known)
        weight = np.where(np.isnan(known), 0.3, 1.0) * np.where(p > 0.5, 2.0, 1.0)  # toxic texts are few
        at, value = ([array(x, kind) for x in t.column(c)] for c, kind in (("at", np.int32), ("value", np.float32)))
        dense = [np.asarray(f.values.to_numpy(), np.float32) for f in t.column("features")]
        order = np.argsort(t.column("doc_id").to_numpy(), kind="stable").tolist()
        rows = [(at[i], value[i], dense[i], float(p[i]), float(weight[i])) for i in order]
        return pa.table({"w": pa.array([train_linear(rows, start).tobytes()], pa.binary())})

    # One group, of about 1.25 times ``fit_rows`` rows: a documented bound, as repeated ids count once.
    found = sparse.dropDuplicates(["doc_id"]).groupBy(F.lit(1).alias("one")).applyInArrow(fit, "w binary").collect()
    return np.frombuffer(bytes(found[0].w)) if found else np.r_[np.zeros(HASHED), start]


def score(docs: DataFrame, labels: DataFrame, text: str = "text", parts: int = 5, sample: int = 2000, fit_rows: int = 6_000) -> DataFrame:
    """``doc_id, held_out, score, predicted, votes`` of every document.

    ``labels`` has ``doc_id, toxic``; rows that ``is_held_out`` are never learned from.  The classifier is fitted on about
    ``fit_rows`` labelled rows and a quarter as many others, by hash, of those that are not held out; the label model on vote counts of all
    such rows.
    """
    known = labels.where(~is_held_out(F.col("doc_id"), parts))
    lexicon = list(dict.fromkeys(LEXICON + mine(docs, known, sample, text)))
    seen = looks(docs, lexicon, text)
    admitted = seen.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"), parts))
    bits, dense = len(lexicon) + 4, 2 * len(lexicon) + 5
    model = fit_labels(vote_counts(admitted, known), bits)
    w = fit_classifier(docs, admitted, known, model, bits, first_weights(model, len(lexicon), dense), fit_rows, text)
    model_name = f"toxicity {uuid.uuid4().hex}"
    sent = docs.sparkSession.sparkContext.broadcast((w[:HASHED].astype(np.float32), w[HASHED:-1], float(w[-1]), lexicon))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        hashed, more, start, lexicon = sent.value
        known_words = memory(model_name, {})
        out: dict[str, list] = {"doc_id": batch.column(0), "score": [], "votes": []}
        for words, (v, features) in looked(batch.column(1).to_pylist(), lexicon):
            total = 0.0
            for x in words:
                g = known_words.get(x)
                if g is None:
                    g = known_words[x] = float(hashed[beginnings(x)].sum())
                total += g
            z = start + total * (SHORT / (len(words) + SHORT)) + float(more @ np.asarray(features))
            out["score"].append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            out["votes"].append(v)
        yield out

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    scored = in_batches(picked, work, "doc_id long, score double, votes long")
    return scored.select("doc_id", is_held_out(F.col("doc_id"), parts).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "votes")
