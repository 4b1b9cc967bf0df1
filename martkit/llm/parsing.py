"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases level by level. Within a level, a maximal run of one symbol is a phrase; elsewhere each
symbol gets a label by deterministic coin tossing (the place and value of the lowest bit in which it differs from its
left neighbour, repeated until labels are small), and phrases begin at local maxima of the labels. A phrase is named by a
hash of its symbols, and the names are the next level's symbols. A boundary depends on a few neighbours only, so equal
substrings have equal phrases inside, wherever they stand.

The fingerprint is a sketch of the set of phrase names from level 2 upwards: names fall in 64 bins, each bin keeps 16 bits
of its smallest hash. The likeness of two fingerprints is the share of equal bins among those in use, an estimate of
the Jaccard index of the name sets.

Defined results: a NULL text is empty; an empty text's fingerprint has no bin in use, and two of those are alike (1.0).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship

BINS, FIRST, ROUNDS = 64, 2, 4
CHARS = 300_000  #: characters parsed at a time; a longer text is parsed alone


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed multipliers of a public-domain generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _low_bit(x: np.ndarray) -> np.ndarray:
    """Place of the lowest set bit."""
    return np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.uint64)


def _begins(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where phrases begin."""
    n = len(names)
    fresh = np.ones(n, bool)  # a document or a run begins
    fresh[1:] = (doc[1:] != doc[:-1])
    same = np.zeros(n, bool)
    same[1:] = (names[1:] == names[:-1]) & ~fresh[1:]
    in_run = same.copy()
    in_run[:-1] |= same[1:]
    edge = fresh.copy()
    edge[1:] |= in_run[1:] & ~same[1:]  # a run starts
    edge[1:] |= ~in_run[1:] & in_run[:-1]  # a run has ended
    label = names
    for _ in range(ROUNDS):
        left = np.concatenate([label[:1], label[:-1]])
        differ = label ^ left
        place = _low_bit(differ)
        tossed = (place << np.uint64(1)) | ((label >> np.minimum(place, np.uint64(63))) & np.uint64(1))
        # the first of a stretch has no left neighbour: its label is a bit of its own name
        label = np.where(edge | (differ == 0), label & np.uint64(1), tossed)
    before = np.concatenate([label[:1], label[:-1]])
    after = np.concatenate([label[1:], label[-1:]])
    last = np.concatenate([edge[1:], [True]])
    peak = (label > before) & (label >= after) & ~last & ~in_run & ~edge
    # no phrase of one symbol at the front of a stretch
    peak[1:] &= ~(edge[:-1] & ~in_run[:-1])
    # equal neighbours that are both maxima: the left one begins the phrase
    peak[1:] &= ~(peak[:-1] & (label[1:] == label[:-1]))
    return edge | peak


def _level(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the phrases of one level, and their documents."""
    at = np.flatnonzero(_begins(names, doc))
    size = np.diff(np.concatenate([at, [len(names)]]))
    # position in the phrase from its left end, so that a name does not depend on where the phrase stands
    place = np.arange(len(names)) - np.repeat(at, size)
    part = _mixed(names + np.uint64(0x9E3779B97F4A7C15) * (place + 1).astype(np.uint64))
    return _mixed(np.add.reduceat(part, at) + size.astype(np.uint64)), doc[at]


def sketches(texts: list[str]) -> list[np.ndarray]:
    """Bins of each text's phrase names, 0 where a bin is not in use."""
    count = len(texts)
    least = np.full((count, BINS), np.iinfo(np.uint64).max)
    size = np.fromiter(map(len, texts), np.int64, count)
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    doc, level = np.repeat(np.arange(count), size), 0
    names = _mixed(names + np.uint64(1))
    while len(names):
        if level >= FIRST:
            hashed = _mixed(names + np.uint64(level))
            np.minimum.at(least.reshape(-1), doc * BINS + (hashed >> np.uint64(58)).astype(np.int64), hashed << np.uint64(6))
        single = np.bincount(doc, minlength=count)[doc] == 1
        done = single if level >= FIRST else np.zeros(len(names), bool)
        names, doc = names[~done], doc[~done]
        if len(names):
            names, doc = _level(names, doc)
        level += 1
    used = least != np.iinfo(np.uint64).max
    return list(np.where(used, (least >> np.uint64(48)) % np.uint64(65535) + np.uint64(1), np.uint64(0)).astype(np.uint16))


def _hex(bins: np.ndarray) -> str:
    return bins.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those in use."""
    used = (a > 0) | (b > 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first as many characters (or all) of the following text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _rows(ids: list, texts: list[str], following: list[str]) -> dict:
    """Output columns of documents whose following text is known."""
    out: dict[str, list] = {name: [] for name in SCHEMA.names}
    start = 0
    while start < len(texts):
        end, total = start, 0
        while end < len(texts) and (end == start or total + 2 * len(texts[end]) + len(following[end]) <= CHARS):
            total += 2 * len(texts[end]) + len(following[end])
            end += 1
        own, nxt = texts[start:end], following[start:end]
        changed = [edited(t, f) for t, f in zip(own, nxt, strict=True)]
        # a following text is the next one's own text, except the last
        made = sketches([*own, *changed, nxt[-1]])
        k = len(own)
        for i in range(k):
            a, e, f = made[i], made[k + i], made[i + 1] if i + 1 < k else made[2 * k]
            out["doc_id"].append(ids[start + i])
            out["n_chars"].append(len(own[i]))
            out["edited_sha256"].append(hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest())
            out["fingerprint"].append(_hex(a))
            out["edited_fingerprint"].append(_hex(e))
            out["near_edited"].append(likeness(a, e))
            out["near_next"].append(likeness(a, f))
        start = end
    return out


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64())])
OPEN = pa.schema([*SCHEMA, ("part", pa.int32()), ("kind", pa.string()), ("text", pa.string())])
OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_pydict({f.name: columns.get(f.name, [None] * n) for f in schema}, schema)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents (doc_id, text) and of their edits by the next document in descending order of doc_id.

    Rows are range-sorted once (ties by a hash of the text); within a partition the next document is the next row. The
    first and the last text of each partition are kept apart and joined over the partition numbers, the last partition
    going round to the first. The result is written once, so a lost task cannot move the partitions' bounds.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(count, *order[:2]).sortWithinPartitions(*order)
    dealt = dealt.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, part = [], [], None
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                piece = batch.slice(i, 500)
                if part is None:
                    part = piece.column(2)[0].as_py()
                    yield _batch({"part": [part], "kind": ["first"], "text": [piece.column(1)[0].as_py()]}, OPEN)
                ids += piece.column(0).to_pylist()
                texts += piece.column(1).to_pylist()
                if len(texts) > 1:
                    yield _batch(_rows(ids[:-1], texts[:-1], texts[1:]), OPEN)
                ids, texts = ids[-1:], texts[-1:]
        if part is not None:
            yield _batch({"doc_id": ids, "part": [part], "kind": ["last"], "text": texts}, OPEN)

    made = cut(dealt.mapInArrow(parse, OUT + ", part int, kind string, text string"))
    firsts, lasts = (made.where(F.col("kind") == k) for k in ("first", "last"))
    # one narrow row per partition
    number = firsts.select("part")
    ahead = number.withColumn("after", F.coalesce(
        F.lead("part").over(Window.orderBy("part")),
        F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    pairs = (lasts.select("doc_id", "text", "part").join(ahead, "part")
             .join(firsts.select(F.col("part").alias("after"), F.col("text").alias("following")), "after"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch(_rows([row["doc_id"]], [row["text"]], [row["following"]]), SCHEMA)

    rest = pairs.select("doc_id", "text", "following").mapInArrow(finish, OUT)
    return made.where(F.col("kind").isNull()).select(*SCHEMA.names).unionAll(rest)
