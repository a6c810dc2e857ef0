"""Toxicity by non-negative positive-unlabelled learning.

*Data.* Positives are documents confirmed as toxic; unlabelled are documents taken as they come, whatever
their labels. Both samples are bounded (``positives``, ``unlabelled``: those with the least hashes of their
ids) and taken from the rows open to learning. The class prior is the share of confirmed toxic ones among all
labelled rows open to learning.

*Features.* A word has as features itself, its first three to seven bytes, and the runs of five bytes of the
word with its ends marked, all hashed into ``SPACE`` slots, so inflected and compounded
forms share features. With h of a text's n words having a slot, the slot has two values, 0.08 log(1 + h) for
what shouldn't occur at all and h / sqrt(n + 20) for what is odd only if frequent; the last value is log(1 + n). The ``features`` slots that speak most
for the positives (by Poisson deviance) are kept.

*Risk.* With logistic loss l, prior p and a linear model g, each step minimises
``p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])``; where the second term turns negative, the step goes up its
gradient instead. Fitted with numpy in one task, from rows of a few slot numbers each that the samples bound.

*Score.* The logistic function of g: a probability of label 1.

Edge cases: a null or empty text, or one without known features, gets the intercept's score; texts are read
whole; ids without text or label are skipped in learning; several labels of an id confirm it if one does, of several texts of an id the one
with the least hash is learned from;
without positives every score is the prior (0 without labels); rows stay as they are, repeated ones too, a
null id is never held out; an empty table gives no rows; a column named like a result
column is replaced.
"""

from __future__ import annotations

import re
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.llm.arrow import carried, lean, one_text_each, slices, texts as texts_of, uncarried, without_scan
from brandbook.session import materialise

SPACE = 1 << 20
POSITIVES, UNLABELLED, FEATURES = 4_000, 12_000, 8_192
#: A slot speaks for the positives if more of them have it than its share of the unlabelled lets expect, by this deviance.
LEAST_SUPPORT, LEAST_DEVIANCE = 3, 10.0
#: The weight of presence against rate: small, so that decay prefers the rate where either would do.
PRESENCE = 0.08
THRESHOLD = 0.3
#: Bytes of a run within a word, and of the beginnings of a word, the mark at its start counted.
RUN, BEGINNINGS = 5, (4, 6, 7, 8)
#: Pairs of text and slot that the fit works on at a time.
PART = 1 << 20
#: Words of which a task remembers the features, and bytes of texts that are worked on at a time.
MEMORY, SLICE_BYTES = 150_000, 4 << 20
WORD = re.compile(r"\w+")


def held_out(key: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def word_slots(words: list[str], place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, slot) of the slots of lower-cased words, in order; with ``place``, what it gives for slots
    where that isn't negative."""
    marked = [b"^" + w.encode("utf-8", "replace") + b"$" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    stops = np.cumsum(sizes)
    starts = stops - sizes
    data = np.frombuffer(b"".join(marked) + bytes(8), np.uint8).astype(np.uint64)
    eight = sum((data[i : len(data) - 8 + i] << np.uint64(8 * i) for i in range(1, 8)), data[:-8])
    owner = np.repeat(np.arange(len(marked)), sizes)

    def slot(values: np.ndarray, kind: int) -> np.ndarray:
        mixed = (values ^ (values >> np.uint64(29)) ^ np.uint64(kind << 56)) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(44)).astype(np.int64)

    every = np.arange(len(marked))
    inside = np.arange(len(owner)) + RUN <= stops[owner]
    parts = [(every, slot(np.fromiter(map(crc32, marked), np.uint64, len(marked)), 0)), (owner[inside], slot(eight[inside] & np.uint64((1 << 8 * RUN) - 1), 1))]
    for n in BEGINNINGS:
        long = sizes > n
        parts.append((every[long], slot(eight[starts[long]] & np.uint64((1 << 8 * n) - 1), n)))
    if place is not None:
        parts = [(o[known], at[known]) for o, s in parts for at in (place[s],) for known in (at >= 0,)]
    keys = np.sort(np.concatenate([o * SPACE + s for o, s in parts]))
    return np.divmod(keys[np.diff(keys, prepend=-1) > 0], SPACE)


class Words(dict):
    """Numbers of words in the order in which they come, and of each word its slots: all, or the numbers that ``place``
    gives them where it isn't negative."""

    def __init__(self, place: np.ndarray | None = None):
        super().__init__()
        self.place, self.new = place, []
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def _learn(self) -> None:
        """Slots of the words that have come since the last call."""
        if not self.new:
            return
        owner, slot = word_slots(self.new, self.place)
        sizes = np.bincount(owner, minlength=len(self.new))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, slot])
        self.new = []

    def hits(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text and slot that a word of it has: the text's number, the slot, and how many of its words have the
        slot, in order; and the words of each text. Above ``MEMORY`` words all are forgotten before the next call."""
        if len(self) > MEMORY:
            self._forget()
        number = self.__getitem__
        numbers = [[*map(number, WORD.findall((t or b"").decode("utf-8", "replace").lower()))] for t in texts]
        self._learn()
        totals = np.fromiter(map(len, numbers), np.int64, len(numbers))
        words = np.fromiter(chain.from_iterable(numbers), np.int64, totals.sum())
        pairs, times = np.unique(np.repeat(np.arange(len(texts)), totals) * max(1, len(self)) + words, return_counts=True)
        row, word = np.divmod(pairs, max(1, len(self)))
        first = self.starts[word]
        many = self.starts[word + 1] - first if len(word) else first
        inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        slot = self.flat[np.repeat(first, many) + inner]
        keys, place = np.unique(np.repeat(row, many) * SPACE + slot, return_inverse=True)
        counts = np.bincount(place, weights=np.repeat(times, many), minlength=len(keys)).astype(np.int64)
        return keys // SPACE, keys % SPACE, counts, totals


def _values(hits, total):
    """The two values of a slot that ``hits`` of ``total`` words have."""
    return PRESENCE * np.log1p(hits), hits / np.sqrt(total + 20.0)


def sample(docs: DataFrame, labels: DataFrame, text: str, key: str, positives: int, unlabelled: int) -> DataFrame:
    """(h, positive, text) of the two samples, one row an id in each; a positive can be in both."""
    rank = F.xxhash64(F.col("id"))
    toxic = labels.where("toxic = 1 and doc_id is not null").select(F.col("doc_id").alias("id")).where(~held_out(F.col("id"))).distinct()
    all_ids = docs.select(F.col(key).alias("id")).where(F.col("id").isNotNull() & ~held_out(F.col("id"))).distinct()
    named = toxic.join(all_ids, "id", "left_semi").select("id", rank.alias("h")).orderBy("h", "id").limit(positives).withColumn("positive", F.lit(True))
    plain = all_ids.select("id", rank.alias("h")).orderBy("h", "id").limit(unlabelled).withColumn("positive", F.lit(False))
    # one row an id, so bounded by the two limits at any size of the corpus
    chosen = materialise(named.union(plain), "sample")
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text")).where("text is not null")
    return materialise(one_text_each(rows, chosen, "h", "positive"), "texts")


@lean
def _count_slots(batches):
    counts = np.zeros((2, SPACE), dtype=np.int64)
    memory = Words()
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            row, slot, _, _ = memory.hits(texts_of(batch, "text"))
            positive = np.array(batch.column("positive").to_pylist(), dtype=bool)[row]
            for side in (0, 1):  # once a text
                counts[side] += np.bincount(slot[positive == side], minlength=SPACE)
    used = np.flatnonzero(counts.sum(axis=0))
    for at in range(0, len(used), 1 << 16):
        part = used[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1, part]), pa.array(counts[0, part])], names=["slot", "p", "u"])


def choose(texts: DataFrame, n_p: int, n_u: int, features: int) -> list[int]:
    """The slots that speak most for the positives."""
    counts = texts.select("positive", "text").mapInArrow(_count_slots, "slot bigint, p bigint, u bigint").groupBy("slot").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    expected = (F.col("u") + 0.5) * n_p / (n_u + 1.0)
    deviance = 2 * (F.col("p") * F.log(F.col("p") / expected) - (F.col("p") - expected))
    ranked = counts.where((F.col("p") >= LEAST_SUPPORT) & (F.col("p") > expected)).withColumn("deviance", deviance).where(F.col("deviance") >= LEAST_DEVIANCE)
    return [r.slot for r in ranked.orderBy(F.desc("deviance"), "slot").limit(features).collect()]


def _places(chosen: list[int]) -> np.ndarray:
    """Of every slot its number among the chosen ones, or -1."""
    place = np.full(SPACE, -1, dtype=np.int64)
    place[np.asarray(chosen, dtype=np.int64)] = np.arange(len(chosen))
    return place


def _present(shared):
    @lean
    def run(batches):
        memory = Words(_places(shared.value))
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                row, slot, hits, totals = memory.hits(texts_of(batch, "text"))
                ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (slot, hits)]
                yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("positive"), *lists, pa.array(totals, pa.int32())], names=["h", "positive", "slots", "hits", "words"])

    return run


class Rows:
    """Texts as flat arrays: per (text, slot) the two values, per text the length.

    Weights are laid out as presence by slot, rate by slot, length."""

    def __init__(self, sizes: np.ndarray, slots: np.ndarray, hits: np.ndarray, words: np.ndarray, width: int):
        """Of each text the number of its slots and of its words, and the slots and hits of all, one text after another;
        ``width`` slots in all."""
        self.n, self.width = len(sizes), width
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        self.slot = slots.astype(np.int32)
        self.presence, self.rate = np.empty(len(slots), np.float32), np.empty(len(slots), np.float32)
        for part in self._parts():
            self.presence[part], self.rate[part] = _values(hits[part].astype(np.float64), words[self.row[part]].astype(np.float64))
        self.length = np.log1p(words.astype(np.float64))

    @classmethod
    def of(cls, table: pa.Table, width: int) -> Rows:
        """From columns slots, hits and words."""
        slots, hits = (table[c].combine_chunks() for c in ("slots", "hits"))
        return cls(pc.list_value_length(slots).to_numpy(), slots.flatten().to_numpy(), hits.flatten().to_numpy(), table["words"].to_numpy(), width)

    def _parts(self) -> list[slice]:
        """Parts of the pairs, so that what is worked out on the way stays small."""
        return [slice(at, at + PART) for at in range(0, len(self.slot), PART)]

    def dot(self, w: np.ndarray) -> np.ndarray:
        a, b = w[: self.width].astype(np.float32), w[self.width : -1].astype(np.float32)
        out = self.length * w[-1]
        for x in self._parts():
            out += np.bincount(self.row[x], weights=self.presence[x] * a[self.slot[x]] + self.rate[x] * b[self.slot[x]], minlength=self.n)
        return out

    def back(self, d: np.ndarray) -> np.ndarray:
        out, single = np.zeros((2, self.width)), d.astype(np.float32)
        for x in self._parts():
            at = single[self.row[x]]
            for i, values in enumerate((self.presence, self.rate)):
                out[i] += np.bincount(self.slot[x], weights=values[x] * at, minlength=self.width)
        return np.concatenate([*out, [self.length @ d]])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(p: Rows, u: Rows, prior: float, steps: int = 300, rate: float = 0.06, decay: float = 0.01) -> tuple[float, np.ndarray]:
    """Intercept and weights with the least non-negative risk, by Adam; ``decay`` is shared by the positives."""
    decay /= max(1, p.n)
    theta = np.zeros(2 * p.width + 2)
    theta[0] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    gradient = lambda rows, d: np.concatenate([[d.sum()], rows.back(d)]) / max(1, rows.n)
    for step in range(1, steps + 1):
        gp, gu = theta[0] + p.dot(theta[1:]), theta[0] + u.dot(theta[1:])
        sp, su = sigmoid(gp), sigmoid(gu)
        as_negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        from_positive = prior * gradient(p, sp - 1)
        from_negative = gradient(u, su) - prior * gradient(p, sp)
        slope = from_positive + from_negative if as_negative >= 0 else -from_negative
        slope[1:] += decay * theta[1:]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(theta[0]), theta[1:]


def _fit_pass(prior: float, width: int):
    """``fit`` over the rows of ``_present``, all in one task."""

    @lean
    def run(batches):
        got = pa.Table.from_batches(list(batches))
        sides = [Rows.of(got.filter(got["positive"] if side else pc.invert(got["positive"])).drop(["positive", "h"]), width) for side in (True, False)]
        del got
        intercept, weights = fit(*sides, prior)
        yield pa.RecordBatch.from_arrays([pa.array([intercept]), pa.array([weights], pa.list_(pa.float64()))], names=["intercept", "weights"])

    return run


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> dict:
    """A model: prior, intercept, and weights by slot."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    empty = {"prior": prior, "intercept": None, "slots": [], "weights": []}
    if not 0 < prior < 1:
        return empty
    texts = sample(docs, labels, text, key, positives, unlabelled)
    n = {r.positive: r.n for r in texts.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not n.get(True) or not n.get(False):
        return empty
    chosen = choose(texts, n[True], n[False], features)
    shared = docs.sparkSession.sparkContext.broadcast(chosen)
    rows = texts.mapInArrow(_present(shared), "h bigint, positive boolean, slots array<int>, hits array<int>, words int")
    # one task, for the rows are bounded by the samples: the driver holds nothing of them
    placed = rows.repartition(1).sortWithinPartitions("positive", "h", "words", F.hash("slots", "hits"))
    found = placed.mapInArrow(_fit_pass(prior, len(chosen)), "intercept double, weights array<double>").first()
    intercept, weights = found.intercept, found.weights
    return {"prior": prior, "intercept": intercept, "slots": chosen, "weights": [round(float(w), 6) for w in weights]}


def _scorer(shared, path: str):
    @lean
    def run(batches):
        model = shared.value
        weights, base, width = np.array(model["weights"]), model["intercept"], len(model["slots"])
        memory = Words(_places(model["slots"]))

        def scores(texts: list[bytes | None]) -> np.ndarray:
            if base is None:
                return np.full(len(texts), float(model["prior"]))
            row, slot, hits, totals = memory.hits(texts)
            presence, rate = _values(hits, totals[row].astype(np.float64))
            g = np.bincount(row, weights=weights[slot] * presence + weights[width + slot] * rate, minlength=len(texts))
            return sigmoid(base + weights[-1] * np.log1p(totals) + g)

        for whole in batches:
            for batch in slices(whole, path, SLICE_BYTES):
                keep = without_scan(batch)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(scores(texts_of(batch, path)), pa.float64())], names=[*keep, "score"])

    return run


def score(docs: DataFrame, model: dict, text: str = "text", key: str = "doc_id", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` with held_out, score and predicted."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("held_out", "score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, path = carried(docs, kept, text, held_out(F.col(key)).alias("held_out"))
    schema = rows.drop("scan").schema.add("score", "double")
    scored = rows.mapInArrow(_scorer(shared, path), schema)
    return uncarried(scored, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
