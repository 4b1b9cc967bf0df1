"""Packing of documents into sequences of fixed length, as a cutting-stock problem.

A document's ids are cut into full pieces and a rest. Only the histogram of piece lengths, at most one row per length,
goes to the driver. There a linear program says how often each pattern (lengths that share a sequence) is used, so that
the padded length of all sequences is least. Its columns are generated: a dynamic program over the sequence's positions
solves the knapsack that prices all patterns at once. Whole uses are kept, the few pieces left by rounding are fitted one
sequence after another. Pieces are ranked by length over the whole table, and ranks are dealt to the patterns' places.

A sequence whose length is a power of two needs no padding; all others are padded to the full length.

Defined results: a NULL or empty text is its end id alone; equal rows are separate documents, dealt in either order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, words
from .common import cut, ordered, ship

SIZE, END = 2048, 1
PIVOTS = 400  #: pivots of the linear program at most; every state is a whole plan, more pivots only save padding
GAP = 1e-4  #: the program ends when its cost is within this share of the least possible

def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END, with_ids: bool = True) -> DataFrame:
    """Pieces of at most `size` ids of every document (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, ids.

    `path` is a tokenizer file of word-end BPE, whose ids `bpe` gives; `end` closes every document.
    """
    ship(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    key = docs.schema["doc_id"]
    schema = f"doc_id {key.dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = bpe._encoder(spec.value).chunks
        for batch in batches:
            at = 0
            for texts in words.slices(batch.column(1)):
                ids, counts = words.encode(texts, store)
                out, doc, first = [], [], 0
                for d, n in enumerate(counts.tolist()):
                    own = np.append(ids[first:first + n], end).astype("<u4")
                    first += n
                    for start in range(0, n + 1, size):
                        part = own[start:start + size]
                        doc.append(at + d)
                        out.append((start, len(part), zlib.crc32(part.tobytes()), n + 1, part if with_ids else None))
                at += len(texts)
                start, length, crc, total, lists = zip(*out, strict=True)
                columns = [batch.column(0).take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(cut_up, schema + (", ids array<int>" if with_ids else ""))


def _costs(size: int) -> np.ndarray:
    """Padded length of a sequence by its length."""
    cost = np.full(size + 1, size, float)
    powers = 1 << np.arange(size.bit_length())
    cost[powers[powers <= size]] = powers[powers <= size]
    return cost


def _fill(left: np.ndarray, size: int) -> list[int]:
    """Lengths for one sequence, largest first; a gap is closed by one or two lengths if that is possible.

    `left` has the number of pieces by length; what is taken is subtracted.
    """
    taken, gap = [], size
    while gap:
        length = 0
        if taken and left[gap]:
            length = gap
        elif taken and gap > 1:
            a = np.arange(1, gap // 2 + 1)
            pair = np.flatnonzero((left[a] > 0) & (left[gap - a] > 0) & ((2 * a < gap) | (left[a] > 1)))
            if len(pair):
                length = int(gap - a[pair[-1]])
        if not length:
            fits = np.flatnonzero(left[:gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
        taken.append(length)
        left[length] -= 1
        gap -= length
    return taken


def _fullest(left: np.ndarray, size: int) -> list[int]:
    """The largest length and those others that fill its sequence most, long ones rather than short ones.

    A whole number's bits are the lengths that can be reached. `left` is as in `_fill`.
    """
    lengths = np.flatnonzero(left)[::-1]
    copies = np.minimum(left[lengths], size // lengths)
    copies[0] -= 1
    stock = np.repeat(lengths, copies).tolist()
    taken, limit = [int(lengths[0])], (1 << (size - int(lengths[0]) + 1)) - 1
    reached = [1]
    for length in stock:
        reached.append(reached[-1] | (reached[-1] << length) & limit)
        if reached[-1] >> (limit.bit_length() - 1):
            break
    total = reached[-1].bit_length() - 1
    for k in range(len(reached) - 2, -1, -1):
        if not reached[k] >> total & 1:
            taken.append(stock[k])
            total -= stock[k]
    np.subtract.at(left, taken, 1)
    return taken


def _start(lengths: np.ndarray, need: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A first basis: each pattern is used until it has used up one of its lengths, so the matrix is triangular."""
    index, left = {int(v): i for i, v in enumerate(lengths)}, need.astype(float)
    columns, uses, basis = [], [], []
    while (open_ := left > 1e-9).any():
        stock = np.zeros(size + 1, np.int64)
        stock[lengths[open_]] = np.ceil(left[open_]).astype(np.int64)
        column = np.zeros(len(lengths))
        for length in _fill(stock, size):
            column[index[length]] += 1
        held = np.flatnonzero(column)
        share = left[held] / column[held]
        out = held[int(np.argmin(share))]
        columns.append(column)
        uses.append(share.min())
        basis.append(out)
        left[held] -= share.min() * column[held]
        left[out] = 0.0
        for i in held[(left[held] <= 1e-9) & (held != out)]:  # used up as well: a pattern of its own, not used
            own = np.zeros(len(lengths))
            own[i] = size // lengths[i]
            columns.append(own)
            uses.append(0.0)
            left[i] = 0.0
    return np.array(columns).T, np.array(uses), lengths @ np.array(columns).T


def _price(lengths: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of a pattern by its exact length, and the length that was added last."""
    by_length = np.full(size + 1, -np.inf)
    by_length[lengths] = value
    best, last = np.full(size + 1, -np.inf), np.zeros(size + 1, np.int64)
    best[0] = 0.0
    for total in range(1, size + 1):
        worth = best[total - 1::-1] + by_length[1:total + 1]
        k = int(worth.argmax())
        best[total], last[total] = worth[k], k + 1
    return best, last


def patterns(lengths: np.ndarray, need: np.ndarray, size: int, pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Columns of patterns, their real uses, and a lower bound of the padded length, by column generation."""
    cost, index = _costs(size), {int(v): i for i, v in enumerate(lengths)}
    basis, uses, totals = _start(lengths, need, size)
    price, inverse, bound = cost[totals.astype(int)], np.linalg.inv(basis), 0.0
    sound = basis.copy(), uses.copy()
    for turn in range(pivots):
        value = price @ inverse
        best, last = _price(lengths, value, size)
        bound = max(bound, float(value @ need) / max(1.0, float((best[1:] / cost[1:]).max())))
        spent = float(price @ uses)
        total = 1 + int((cost[1:] - best[1:]).argmin())
        if spent - bound <= GAP * spent or cost[total] - best[total] > -1e-7 * size:
            break
        column, at = np.zeros(len(lengths)), total
        while at:
            column[index[int(last[at])]] += 1
            at -= int(last[at])
        step = inverse @ column
        can = np.flatnonzero(step > 1e-6)
        ratio = uses[can] / step[can]
        tied = can[ratio <= ratio.min() + 1e-9]  # the largest pivot among ties keeps the basis far from singular
        out = tied[int(np.argmax(step[tied]))]
        amount = float(ratio.min())
        uses = np.maximum(uses - amount * step, 0.0)
        uses[out], price[out], basis[:, out] = amount, cost[total], column
        if turn % 50 == 49:  # afresh, against rounding errors; a basis that has become singular is given up
            try:
                inverse = np.linalg.inv(basis)
            except np.linalg.LinAlgError:
                break
            uses = np.maximum(inverse @ need, 0.0)
            if not np.allclose(basis @ uses, need, rtol=1e-6, atol=1e-6):
                break
            sound = basis.copy(), uses.copy()
        else:
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
    return (basis, uses, bound) if np.allclose(basis @ uses, need, rtol=1e-6, atol=1e-6) else (*sound, bound)


def plan(histogram: dict[int, int], size: int = SIZE, pivots: int = PIVOTS) -> list[tuple[list[int], int]]:
    """(lengths, uses) of patterns that hold every piece of the histogram (length: number) exactly once."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    done = [([size], int(left[size]))] if left[size] else []
    left[size] = 0
    lengths = np.flatnonzero(left)
    if not len(lengths):
        return done
    columns, uses, _ = patterns(lengths, left[lengths].astype(float), size, pivots)
    used: dict[tuple[int, ...], int] = {}

    def use(column: np.ndarray, n: int) -> None:
        pattern = tuple(np.repeat(lengths, column.astype(int))[::-1].tolist())
        used[pattern] = used.get(pattern, 0) + n
        left[lengths] -= n * column.astype(np.int64)

    whole = np.floor(uses + 1e-9).astype(np.int64)
    for k in np.argsort(whole - uses, kind="stable"):  # largest fractions first
        n = int(whole[k])
        if n and (left[lengths] >= n * columns[:, k]).all():
            use(columns[:, k], n)
    for k in np.argsort(whole - uses, kind="stable"):
        if uses[k] - whole[k] > 1e-6 and (left[lengths] >= columns[:, k]).all():
            use(columns[:, k], 1)
    cost, ways = _costs(size), []
    for fill in (_fill, _fullest):
        stock, rests = left.copy(), []
        while stock.any():
            rests.append(tuple(fill(stock, size)))
        ways.append((sum(cost[sum(p)] for p in rests), rests))
    for rest in min(ways)[1]:
        used[rest] = used.get(rest, 0) + 1
    return done + [(list(p), n) for p, n in used.items()]


class Places:
    """Where the pieces of each rank go, by the number of a piece in the order of length."""

    def __init__(self, made: list[tuple[list[int], int]]) -> None:
        spans: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        for lengths, n in made:
            offset = 0
            for length in sorted(set(lengths), reverse=True):
                copies = lengths.count(length)
                spans.setdefault(length, []).append((first, n, copies, offset))
                offset += copies * length
            first += n
        rows = [(length, *span) for length in sorted(spans) for span in spans[length]]
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, self.sequence, uses, self.copies, self.offset = table.T
        self.start = np.cumsum(uses * self.copies) - uses * self.copies

    def of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.searchsorted(self.start, number, "right") - 1
        turn, copy = np.divmod(number - self.start[i], self.copies[i])
        return self.sequence[i] + turn, self.offset[i] + copy * self.length[i]


def pack(parts: DataFrame, size: int = SIZE, pivots: int = PIVOTS) -> DataFrame:
    """Adds sequence_id and offset to pieces with a column length of 1 to `size`; columns of these names are replaced.

    Sequence ids are gapless from 0, offsets gapless from 0 within a sequence.
    """
    spark = parts.sparkSession
    ship(spark)
    rows = cut(parts.select(F.struct("*").alias("piece"), F.col("length").alias("size"),
                            F.monotonically_increasing_id().alias("number")))
    counts = rows.groupBy("size").count().collect()  # at most one row per length
    places = spark.sparkContext.broadcast(Places(plan({r["size"]: r["count"] for r in counts}, size, pivots)))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(rank: pa.Array) -> pa.Array:
        sequence, offset = places.value.of(rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    out = ordered(rows, [F.col("size"), F.col("number")], "rank").select("piece", place("rank").alias("place"))
    kept = [F.col("piece").getField(c).alias(c) for c in parts.columns if c.lower() not in ("sequence_id", "offset")]
    return out.select(*kept, "place.sequence_id", "place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of every sequence (sequence_id, ids) from packed pieces with ids."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return held.select("sequence_id", F.flatten(F.transform("held", lambda h: h["ids"])).alias("ids"))
