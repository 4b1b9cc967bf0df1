"""Toxicity by a factorization machine over hashed terms.

The machine scores a document by a bias, a weight per term and, for every pair of terms, the product of their factors, so
that terms which are harmless alone can count together. Terms are the distinct words of the whole text and the first
letters of the longer ones. It is fitted on a bounded sample of labelled rows (`Sample`), chosen by a hash of the id, and
sent to the executors; its size is fixed by `SLOTS` and `FACTORS`. Every document is scored.

Defined results: texts without terms (NULL too) get the score of the bias; without labels of both classes the bias is
that of no toxic documents and all scores are below 0.5.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

SLOTS, FACTORS, PREFIX = 1 << 18, 4, 4
LENGTH = 12.0  #: largest norm of a document's input values
WORD = re.compile(r"\w+")
PART = 200  #: texts that are scored at once


@dataclass(frozen=True)
class Sample:
    """Most labelled rows of each class that the machine is fitted on; the same share of both is taken."""

    toxic: int = 6_000
    clean: int = 14_000


@dataclass(frozen=True)
class Machine:
    bias: float
    value: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def score(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Scores of documents whose term slots lie one after another, `size` for each."""
        doc, ids, x = inputs(self.value, ids, size)
        total = self.bias + np.bincount(doc, self.weight[ids] * x, len(size))
        for f in range(self.factor.shape[1]):
            v = self.factor[ids, f] * x
            total += 0.5 * (np.bincount(doc, v, len(size)) ** 2 - np.bincount(doc, v * v, len(size)))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


class Terms:
    """Slots of a text's distinct terms; remembers words, and forgets all of them when there are too many."""

    def __init__(self, room: int = 40_000) -> None:
        self.room, self.known = room, {}

    def slots(self, text: str | None) -> list[int]:
        known, out = self.known, set()
        for word in set(WORD.findall((text or "").lower())):
            pair = known.get(word)
            if pair is None:
                if len(known) > self.room:
                    known.clear()
                own = zlib.crc32(word.encode()) % SLOTS
                start = zlib.crc32(b"^" + word[:PREFIX].encode()) % SLOTS if len(word) > PREFIX else own
                pair = known[word] = (own, start)
            out.update(pair)
        return sorted(out)


def _slots(texts: pa.Array, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    lists = [terms.slots(t.as_py()) for t in texts]
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for x in lists for i in x), np.int64, int(size.sum())), size


def inputs(value: np.ndarray, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, slot and value of each term that takes part; documents longer than `LENGTH` are scaled down to it."""
    doc, there = np.repeat(np.arange(len(size), dtype=np.int32), size), value[ids] != 0
    doc, ids = doc[there], ids[there]
    x = value[ids]
    norm = np.sqrt(np.bincount(doc, x * x, len(size)))
    x /= np.maximum(1, norm / LENGTH)[doc]
    return doc, ids, x


def values(ids: np.ndarray, size: np.ndarray, label: np.ndarray, prior: float = 5.0, least: float = 0.5,
           floor: float = 0.25, often: int = 20) -> np.ndarray:
    """Input value of each slot: its log ratio of toxic documents to the base rate, shrunk by `prior` documents.

    Slots near the base rate get `floor` at least, so that pairs can use them. Only those of less than `often` documents,
    whose ratio says little, get 0 and so take no part.
    """
    base, doc = label.mean(), np.repeat(np.arange(len(size), dtype=np.int32), size)
    seen, toxic = np.bincount(ids, minlength=SLOTS), np.bincount(ids, label[doc], SLOTS)
    ratio = np.log((toxic + prior * base) / (seen + prior) / base)
    far = np.abs(ratio)
    return np.where(seen >= often, np.maximum(far, floor), np.where((seen > 1) & (far >= least), far, 0.0))


def fit(ids: np.ndarray, size: np.ndarray, label: np.ndarray, epochs: int = 12, rate: float = 0.1,
        decay: float = 1e-4, batch: int = 64, seed: int = 7) -> Machine:
    """Logistic loss, adaptive steps on small batches."""
    random = np.random.default_rng(seed)
    weight, factor = np.zeros(SLOTS), random.normal(0, 0.01, (SLOTS, FACTORS))
    if not label.any() or label.all():
        return Machine(-5.0 if not label.any() else 0.0, np.zeros(SLOTS), weight, factor * 0)
    value = values(ids, size, label)
    at, ids, inside = inputs(value, ids, size)
    size = np.bincount(at, minlength=len(size))
    del at
    bias, past_b = float(np.log(label.mean() / (1 - label.mean()))), 1.0
    past_w, past_f = np.full(SLOTS, 1.0), np.full((SLOTS, FACTORS), 1.0)
    start = np.concatenate([[0], np.cumsum(size)])
    for _ in range(epochs):
        order = random.permutation(len(size))
        for i in range(0, len(order), batch):
            docs = order[i:i + batch]
            here = np.concatenate([np.arange(start[d], start[d + 1]) for d in docs])
            flat, x, doc = ids[here], inside[here], np.repeat(np.arange(len(docs)), size[docs])
            used, at = np.unique(flat, return_inverse=True)
            v = factor[flat] * x[:, None]
            sums = np.stack([np.bincount(doc, v[:, f], len(docs)) for f in range(FACTORS)], 1)
            raw = bias + np.bincount(doc, weight[flat] * x, len(docs)) + 0.5 * (
                (sums ** 2).sum(1) - np.bincount(doc, (v * v).sum(1), len(docs)))
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[docs]
            each = error[doc] * x
            step_w = np.bincount(at, each, len(used)) + decay * weight[used]
            pull = each[:, None] * (sums[doc] - v)
            step_f = np.stack([np.bincount(at, pull[:, f], len(used)) for f in range(FACTORS)], 1) + decay * factor[used]
            past_w[used] += step_w ** 2
            past_f[used] += step_f ** 2
            past_b += error.sum() ** 2
            weight[used] -= rate * step_w / np.sqrt(past_w[used])
            factor[used] -= rate * step_f / np.sqrt(past_f[used])
            bias -= rate * error.sum() / np.sqrt(past_b)
    return Machine(bias, value, weight, factor)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: a fifth by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> Machine:
    """Fit on labels (doc_id, toxic) of documents (doc_id, text) that are not held out."""
    ship(docs.sparkSession)
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = cut(usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct())
    there = dict(usable.groupBy("toxic").count().collect())  # two rows
    some = [(c, there.get(c, 0), most) for c, most in ((1, sample.toxic), (0, sample.clean))]
    # one share of both classes, so that they keep their ratio
    num, den = min(((most, n) for _, n, most in some if n > most), key=lambda r: r[0] / r[1], default=(1, 1))
    mixed = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(-(-n * num // den))
             for c, n, _ in some]
    chosen = mixed[0].unionAll(mixed[1])  # bounded by the sample

    @F.arrow_udf("array<int>")
    def terms(texts: pa.Array) -> pa.Array:
        ids, size = _slots(texts, Terms())
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                                        pa.array(ids, pa.int32()))

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one text per id, whichever hashes lowest, so that the rows are bounded by the sample too
    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    table = rows.select("doc_id", "toxic", terms("text").alias("ids")).toArrow()
    table = table.sort_by("doc_id").combine_chunks()
    lists = table["ids"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    label = table["toxic"].to_numpy().astype(float)
    # an id with both labels comes twice, in any order; order by content as well
    start = np.concatenate([[0], np.cumsum(size)])
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    doc_id = table["doc_id"].to_numpy()
    key = np.array([zlib.crc32(ids[start[i]:start[i + 1]].astype(np.int64).tobytes()) for i in range(len(size))], np.int64)
    order = np.lexsort((key, doc_id))
    flat = np.concatenate([ids[start[i]:start[i + 1]] for i in order]) if len(order) else ids
    del table, lists, ids  # the driver fits on one copy of the sample
    return fit(flat, size[order], label[order])


def score(text: Column, machine) -> Column:
    """Score in 0 to 1 of a text column; `machine` is a broadcast Machine."""

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        model, terms, out = machine.value, _TERMS, []
        for i in range(0, len(texts), PART):
            ids, size = _slots(texts.slice(i, PART), terms)
            out.append(model.score(ids, size))
        pa.default_memory_pool().release_unused()  # idle workers keep what they hold beside the next stage
        return pa.array(np.concatenate([*out, np.zeros(0)]), pa.float64())

    return of(text)


_TERMS = Terms()


def judge(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> DataFrame:
    """Adds score and predicted (1 from a score of 0.5) to documents."""
    machine = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    rows = docs.withColumn("score", score(F.col("text"), machine))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
