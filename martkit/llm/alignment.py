"""Alignment of two tokenizers' tokens of the same text, and how well linked ids agree over the corpus.

Tokens of both sides cover the same bytes, so each side is a rising list of end offsets. The side with fewer tokens drives
a galloping search of its ends in the other list: exponential steps from a known place, then a binary search between the
last two. Ends found in both lists cut the tokens into groups; the difference of neighbouring ranks is the range of
tokens that a token overlaps. All texts of a batch gallop together: their ends are laid one after another, every
`HEAD`-th end gallops from the start of its text, the others from the place of their head.

Links are counted by id pair per document and summed over the corpus. Pairs with at least 1/`HEADS` of all links, at most
`HEADS` of them, are broadcast; the documents' other pairs are joined by shuffle, where no pair has more rows than that share.

Defined results: a text that is NULL, empty, or not given back byte by byte by both sides has no tokens; equal rows are
separate documents.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_letters
from .common import cut, ship, stored
from .words import slices

HEAD = 16
HEADS = 1 << 17
SLICE = 2 << 20  #: bytes of text that are aligned at a time
#: Texts of these code points are cut alike by all versions of the engines' letter tables.
SETTLED = re.compile(r"[\x00-ɏ‐-‧]*")


class Bytewise:
    """A byte-level vocabulary: ids of a text with a space before it, special tokens being plain text.

    The same vocabulary in the form of ranks is several times faster, but another engine cuts the text; it is used for
    texts whose letters all engines know.
    """

    def __init__(self, spec: str, ranks: bytes, pattern: str) -> None:
        self.slow = Tokenizer.from_str(spec)
        self.slow.encode_special_tokens = True
        ids = json.loads(spec)["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.pieces = [b""] * (max(ids.values()) + 1)
        for piece, i in ids.items():
            self.pieces[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.fast.encode_ordinary(" " + t) if SETTLED.fullmatch(t) else
                self.slow.encode(" " + t, add_special_tokens=False).ids for t in texts]


class Piecewise:
    """A vocabulary of pieces with byte fallback; it puts a space before the text itself."""

    def __init__(self, model: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.pieces = [bytes.fromhex(n[3:5]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                       for i, n in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def gallop(keys: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """First place at or after `start` of a value that is at least the key; all keys step together."""
    low, high = start.copy(), np.full(len(keys), len(values))
    search, step = np.arange(len(keys)), 1
    while len(search):  # exponential steps
        probe = low[search] + step - 1
        inside = probe < len(values)
        less = np.zeros(len(search), bool)
        less[inside] = values[probe[inside]] < keys[search[inside]]
        high[search[~less & inside]] = probe[~less & inside]
        search = search[less]
        low[search] += step
        step *= 2
    search = np.flatnonzero(low < high)
    while len(search):  # binary search
        middle = (low[search] + high[search]) >> 1
        less = values[middle] < keys[search]
        low[search[less]] = middle[less] + 1
        high[search[~less]] = middle[~less]
        search = search[low[search] < high[search]]
    return low


def ranks(keys: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """`gallop` for rising keys: heads from `start`, all others from the place of their head."""
    heads = gallop(keys[::HEAD], values, start[::HEAD])
    return gallop(keys, values, np.maximum(np.repeat(heads, HEAD)[:len(keys)], start))


@dataclass(frozen=True)
class Aligned:
    """Tokens of a batch of texts laid one after another; `groups` has the end places of all groups on both sides."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    groups: np.ndarray
    n_groups: np.ndarray
    links: np.ndarray  #: rows of (text, place in a, place in b)


def _ends(ids: list[list[int]], size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids, counts and end offsets, each text's counted on from `first`."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
    ends = np.cumsum(size[flat])
    before = np.concatenate([[0], ends])[np.cumsum(n) - n]
    return flat, n, ends - np.repeat(before - first, n)


class Aligner:
    """Aligns texts of one pair of vocabularies."""

    def __init__(self, a: Bytewise, b: Piecewise) -> None:
        self.a, self.b = a, b
        self.size = [np.array([len(p) for p in side.pieces], np.int64) for side in (a, b)]
        names_a, names_b = [str(i) for i in range(len(a.pieces))], [str(i) for i in range(len(b.pieces))]
        # every id with each mark that may follow it
        self.names = pa.array([n + s for n in names_a for s in ",|"] + [n + s for n in names_b for s in ",;"])

    def whole(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids on both sides, none where a side does not give the bytes back."""
        texts = [t or "" for t in texts]
        a, b = self.a.encode(texts), self.b.encode(texts)
        for k, t in enumerate(texts):
            want = (" " + t).encode() if t else None
            if b"".join(map(self.a.pieces.__getitem__, a[k])) != want or b"".join(map(self.b.pieces.__getitem__, b[k])) != want:
                a[k], b[k] = [], []
        return a, b

    def align(self, texts: list[str | None]) -> Aligned:
        ids_a, ids_b = self.whole(texts)
        first = np.zeros(len(texts), np.int64)
        a, n_a, end_a = _ends(ids_a, self.size[0], first)
        last = np.zeros(len(texts), np.int64)
        last[n_a > 0] = end_a[np.cumsum(n_a)[n_a > 0] - 1]
        first = np.cumsum(last) - last  # texts are laid one after another
        end_a = end_a + np.repeat(first, n_a)
        b, n_b, end_b = _ends(ids_b, self.size[1], first)
        at_a, at_b, text = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b, np.arange(len(texts))
        groups, links = [], []
        for drives, (keys, values), (n, at), flip in (
                (n_a <= n_b, (end_a, end_b), (n_a, at_b), 1), (n_a > n_b, (end_b, end_a), (n_b, at_a), -1)):
            own = np.repeat(text, n)
            mine = np.flatnonzero(drives[own])
            own = own[mine]
            rank = ranks(keys[mine], values, at[own])
            common = values[rank] == keys[mine] if len(mine) else np.zeros(0, bool)
            groups.append(np.stack([mine[common], rank[common]][::flip], 1))
            opens = np.concatenate([[0], (rank + common)[:-1]])  # the first token that starts where or before this one does
            opens = np.where(np.concatenate([[True], own[1:] != own[:-1]]), at[own], opens)[:len(mine)]
            width = rank - opens + 1
            over = np.repeat(opens - (np.cumsum(width) - width), width) + np.arange(width.sum())
            links.append(np.stack([np.repeat(own, width), *[np.repeat(mine, width), over][::flip]], 1))
        groups, links = np.concatenate(groups), np.concatenate(links)
        groups = groups[np.argsort(groups[:, 0])]
        n_groups = np.bincount(np.repeat(text, n_a)[groups[:, 0]], minlength=len(texts))
        return Aligned(a, b, n_a, n_b, groups, n_groups, links)

    def digests(self, made: Aligned) -> list[str]:
        """SHA-256 of the groups of every text as `a1,a2|b1;a3|b2,b3`; "" without tokens."""
        ends_a, ends_b = np.zeros(len(made.a), bool), np.zeros(len(made.b), bool)
        ends_a[made.groups[:, 0]], ends_b[made.groups[:, 1]] = True, True
        before_a, before_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b  # groups that ended before
        b_until = np.concatenate([[0], made.groups[:, 1] + 1])
        a_until = np.concatenate([made.groups[:, 0] + 1, [0]])
        order = np.empty(len(made.a) + len(made.b), np.int64)
        order[np.arange(len(made.a)) + b_until[before_a]] = 2 * made.a + ends_a
        order[np.arange(len(made.b)) + a_until[before_b]] = 2 * len(self.a.pieces) + 2 * made.b + ends_b
        joined = self.names.take(pa.array(order))
        offsets, data = np.frombuffer(joined.buffers()[1], np.int32), memoryview(joined.buffers()[2] or b"")
        cuts = offsets[np.concatenate([[0], np.cumsum(made.n_a + made.n_b)])] if len(order) else np.zeros(len(made.n_a) + 1, int)
        return [hashlib.sha256(data[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def pairs(self, made: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, id pair) and their links; a pair is a * ids of b + b."""
        text, i, j = made.links.T
        room = len(self.a.pieces) * len(self.b.pieces)
        key, n = np.unique(text * room + made.a[i] * len(self.b.pieces) + made.b[j], return_counts=True)
        return key // room, key % room, n


@dataclass(frozen=True)
class Vocabularies:
    """Paths of the byte-level file, the same vocabulary as ranks with its pattern, and the model of pieces."""

    bytewise: str
    ranks: str
    pattern: str
    piecewise: str


_ALIGNERS: dict[int, Aligner] = {}


def _shipped(spark, paths: Vocabularies):
    """A function that gives a worker's aligner; the files are read once and their size is that of the vocabularies."""
    ship(spark)
    held = spark.sparkContext.broadcast((Path(paths.bytewise).read_text(encoding="utf-8"), Path(paths.ranks).read_bytes(),
                                         paths.pattern, Path(paths.piecewise).read_bytes()))

    def aligner() -> Aligner:
        key = hash(held.value)
        if key not in _ALIGNERS:
            spec, ranks_, pattern, model = held.value
            _ALIGNERS[key] = Aligner(Bytewise(spec, ranks_, pattern), Piecewise(model))
        return _ALIGNERS[key]

    return aligner


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def groups(docs: DataFrame, paths: Vocabularies) -> DataFrame:
    """Tokens and groups of each text of `docs` (doc_id, text): doc_id, a, b, ends.

    a and b are the ids; ends has for each group how many tokens of a and of b lie up to its end.
    """
    aligner = _shipped(docs.sparkSession, paths)
    key = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), SLICE):
                made = aligner().align(texts.to_pylist())
                first = np.stack([np.cumsum(n) - n for n in (made.n_a, made.n_b)], 1)
                ends = made.groups + 1 - np.repeat(first, made.n_groups, axis=0)
                pair = pa.StructArray.from_arrays([pa.array(ends[:, 0], pa.int32()), pa.array(ends[:, 1], pa.int32())], ["a", "b"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), _lists(made.a, made.n_a, pa.int32()), _lists(made.b, made.n_b, pa.int32()),
                     _lists(pair, made.n_groups, pair.type)], ["doc_id", "a", "b", "ends"])
                at += len(texts)

    schema = f"doc_id {key}, a array<int>, b array<int>, ends array<struct<a: int, b: int>>"
    return docs.select("doc_id", "text").mapInArrow(of, schema)


def counted(docs: DataFrame, paths: Vocabularies) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its id pairs with their links."""
    aligner = _shipped(docs.sparkSession, paths)
    key = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), SLICE):
                made = aligner().align(texts.to_pylist())
                text, pair, n = aligner().pairs(made)
                rows = np.bincount(text, minlength=len(texts))
                links = np.bincount(made.links[:, 0], minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     *(pa.array(c, pa.int64()) for c in (made.n_a, made.n_b, made.n_groups, links)),
                     pa.array(aligner().digests(made), pa.string()), _lists(pair, rows, pa.int64()), _lists(n, rows, pa.int32())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "n"])
                at += len(texts)

    schema = (f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pair array<long>, n array<int>")
    return docs.select("doc_id", "text").mapInArrow(of, schema)


def agreement(docs: DataFrame, paths: Vocabularies, heads: int = HEADS) -> DataFrame:
    """Adds n_best and count_sum to the rows of `counted`, without the pairs.

    A pair's count is the number of its links over all documents. n_best counts a document's links whose pair has the
    highest count of its b id, ties included; count_sum is the sum of the counts over its links.
    """
    spark = docs.sparkSession
    n_b = sentencepiece.SentencePieceProcessor(model_file=paths.piecewise).vocab_size()
    rows = stored(counted(docs, paths).withColumn("row", F.monotonically_increasing_id()), "links")
    links = rows.select("row", F.inline(F.arrays_zip("pair", "n")))
    counts = cut(links.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % n_b))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    counts = cut(counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]  # one number
    frequent = F.col("count") * heads >= total
    head = F.broadcast(counts.where(frequent))  # at most `heads` rows
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    both = links.join(head, "pair").unionByName(
        links.join(head.select("pair"), "pair", "left_anti").join(counts.where(~frequent), "pair"))
    scores = both.groupBy("row").agg(*sums)
    out = rows.drop("pair", "n").join(scores, "row", "left").drop("row")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_best", "count_sum")})
