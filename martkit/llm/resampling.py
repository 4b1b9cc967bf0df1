"""Importance resampling towards a target text: hashed n-grams, counted once per distinct line.

Separator newlines cut texts into lines. Equal lines of all texts are one row with their number; their words are cut and
hashed once, and counts are multiplied by that number. n-grams that span lines belong to no line and are counted text by
text. A bucket's gain is its log ratio of target to corpus frequency; a document's weight is the mean gain of its features,
put together from the sums of its lines. Gumbel noise from a hash of the id turns the highest scores into a draw without
replacement.

A document's lines are joined to the sums by a 128-bit hash. Lines that are 1/`HEADS` of all lines or more, at most `HEADS`
of them, are broadcast, the others shuffled, so no line puts more than that share into one task.

Defined results: NULL and empty texts have no features and weight 0; equal rows are separate documents with equal scores,
ranked in either order; a NULL id ranks after others of its score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ordered, ship, stored

HEADS = 1 << 16
#: Bytes that stand between words; A-Z are lower-cased.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
SEPARATOR = "\n"


@dataclass(frozen=True)
class Features:
    """Runs of 1 to `longest` words in `buckets` hash buckets."""

    longest: int = 1
    buckets: int = 10_000

    def of(self, words: list[bytes]) -> np.ndarray:
        """Buckets of all runs in one list of words."""
        out = []
        for n in range(1, self.longest + 1):
            runs = words if n == 1 else map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
            out.append(np.fromiter(map(zlib.crc32, runs), np.int64))
        return np.concatenate(out) % self.buckets

    def across(self, lines: list[list[bytes]]) -> np.ndarray:
        """Buckets of the runs that span lines."""
        words, line = [w for own in lines for w in own], [i for i, own in enumerate(lines) for _ in own]
        out = [zlib.crc32(b" ".join(words[i:i + n])) for n in range(2, self.longest + 1) for i in range(len(words) - n + 1)
               if line[i] != line[i + n - 1]]
        return np.array(out, np.int64) % self.buckets


def words(text: bytes) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(WORD_BYTES).split()


def _bucketed(rows: DataFrame, features: Features, whole: bool) -> DataFrame:
    """(id, n, text) to (id, n, n_words, buckets): features of each line, or those across the lines of each whole text."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column(2), pa.binary()).to_pylist()
            if whole:
                parts = [features.across([words(x) for x in t.split(SEPARATOR.encode())]) for t in texts]
                n_words = [0] * len(parts)
            else:
                cut_up = [words(t) for t in texts]
                parts, n_words = [features.of(w) for w in cut_up], list(map(len, cut_up))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            flat = np.concatenate([*parts, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))], ["id", "n", "n_words", "buckets"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of, f"id {kind}, n long, n_words long, buckets array<int>")


def _name(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), SEPARATOR)


def distinct_lines(texts: DataFrame, features: Features) -> DataFrame:
    """(id, n, n_words, buckets) of every distinct line of `texts` (text); n is how often it occurs."""
    each = texts.select(F.explode(_lines(F.col("text"))).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    return _bucketed(each.select(_name(F.col("text")).alias("id"), "n", "text"), features, False)


def _spans(texts: DataFrame, features: Features, key: str | None = None) -> DataFrame:
    """The features across the lines of every text that has several."""
    name = F.col(key) if key else F.lit(0).cast("long")
    several = texts.where(F.col("text").contains(SEPARATOR)).select(name.alias("id"), F.lit(1).cast("long").alias("n"), "text")
    return _bucketed(several, features, True)


def _counts(*parts: DataFrame) -> np.ndarray:
    """Features by bucket; one row per bucket goes to the driver, whatever the input."""
    out: dict[int, int] = {}
    for rows in parts:
        per = rows.select("n", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("n").alias("n"))
        for bucket, n in per.collect():
            out[bucket] = out.get(bucket, 0) + n
    return np.array(sorted(out.items()), np.int64).reshape(-1, 2)


def gains(corpus: np.ndarray, target: np.ndarray, buckets: int) -> np.ndarray:
    """Gain of every bucket, in thousandths, from (bucket, features) of both sides."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    s[corpus[:, 0]], t[target[:, 0]] = corpus[:, 1], target[:, 1]
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log(((float(b) + 1) * all_s) / ((float(a) + 1) * all_t)))
                     for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of `seed:key`."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, features: Features = Features()) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight) of every row of `docs` (doc_id, text); `target` has text.

    weight is the floored mean gain of a document's features.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    lines = stored(distinct_lines(docs, features), "lines")
    goal = target.select("text")
    corpus, wanted = [lines], [distinct_lines(goal, features)]
    if features.longest > 1:
        docs = stored(docs.withColumn("row", F.monotonically_increasing_id()), "texts")
        spans = stored(_spans(docs, features, "row"), "spans")
        corpus.append(spans)
        wanted.append(_spans(goal, features))
    else:
        docs = docs.withColumn("row", F.monotonically_increasing_id())
    gain = spark.sparkContext.broadcast(gains(_counts(*corpus), _counts(*wanted), features.buckets))

    @F.arrow_udf("long")
    def total(lists: pa.Array) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(gain.value[lists.flatten().to_numpy(zero_copy_only=False)])])
        return pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())

    measured = cut(lines.select("id", "n", "n_words", F.size("buckets").cast("long").alias("n_features"), total("buckets").alias("gain")))
    # numbers and hashes of one pass are stored together, so a number never stands for another row
    names = cut(docs.select("row", "doc_id", F.transform(_lines(F.col("text")), _name).alias("ids")))
    held = names.select("row", F.explode("ids").alias("id"))
    n_lines = measured.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # one number
    frequent = F.col("n") * HEADS >= n_lines
    head = F.broadcast(measured.where(frequent).drop("n"))  # at most HEADS rows
    parts = held.join(head, "id").unionByName(
        held.join(head.select("id"), "id", "left_anti").join(measured.where(~frequent).drop("n"), "id")).drop("id")
    if features.longest > 1:
        parts = parts.unionByName(spans.select(
            F.col("id").alias("row"), "n_words", F.size("buckets").cast("long").alias("n_features"), total("buckets").alias("gain")))
    sums = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")])
    out = names.drop("ids").join(sums, "row")
    weight = F.when(F.col("n_features") > 0, F.floor(F.col("gain") / F.col("n_features"))).otherwise(F.lit(0))
    return out.select("row", "doc_id", "n_words", "n_features", weight.cast("long").alias("weight"))


def draw(docs: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, seed: int = 2024,
         features: Features = Features()) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank; rank counts the drawn from 1, others have none.

    Of the documents with at least `least` words, `percent` in a hundred are drawn, those of the highest scores.
    """
    rows = weigh(docs, target, features)
    rows = cut(rows.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long")))
    able = F.col("n_words") >= least
    tally = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # scores are whole numbers in a narrow range: one row per score
    above = Window.orderBy(F.col("score").desc())
    tally = cut(tally.select("score", F.sum("n").over(above).alias("so_far"), F.sum("n").over(Window.partitionBy()).alias("all")))
    wanted = F.floor(F.col("all") * percent / 100)
    limit = tally.where(F.col("so_far") >= wanted).agg(F.max("score").alias("score"), F.max(wanted).alias("wanted")).first()
    limit, wanted = limit["score"], limit["wanted"]
    candidate = able & (F.col("score") >= F.lit(limit)) if wanted else F.lit(False)
    high = ordered(rows.where(candidate), [F.col("score") * -1, F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")], "place")
    rank = F.when(F.col("place") < F.lit(wanted or 0), F.col("place") + 1)
    low = rows.where(~candidate).withColumn("rank", F.lit(None).cast("long"))
    out = high.withColumn("rank", rank).drop("place").unionByName(low)
    return out.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"), "n_words")
