"""SimHash fingerprints and exact comparison of all of them in tiles.

Distinct fingerprints are laid in blocks by population count (blocks of one count are split evenly by a hash), and every
pair of blocks whose counts differ by at most the radius meets in one group. Inside a group both sides are sorted by the
population counts of their 16-bit parts and cut into tiles; a pair of tiles is skipped if the counts, in total or part by
part, differ beyond the radius, and compared by exclusive-or and bit counts otherwise. A group returns a spanning forest
of its links, not the links, so a large set of near copies stays small. Components are joined by stars on Spark.

The comparison covers all pairs, so its time grows with the square of the number of distinct fingerprints; memory and
the size of a group do not grow.

Defined results: a text without words (NULL too) has the fingerprint zero; equal fingerprints are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

BLOCK = 16_384  #: fingerprints per block, about
TILE = 512
HASH_SEED = 42


def _bits(shingles: list[bytes], bits: int) -> str:
    """The bits that are set in over half of the shingles' hashes, as hex."""
    digest = {64: xxhash.xxh64_digest, 128: xxhash.xxh128_digest}[bits]
    counts = np.zeros(bits, np.int64)
    for i in range(0, len(shingles), 1 << 16):
        part = shingles[i:i + (1 << 16)]
        data = np.frombuffer(b"".join([digest(x, HASH_SEED) for x in part]), np.uint8).reshape(len(part), -1)
        counts += np.unpackbits(data, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(shingles)).tobytes().hex()


def shingled(text: str | None, width: int) -> list[bytes]:
    """Runs of `width` words, repeats included; a shorter text is one shingle, one without words has none."""
    words = (text or "").encode().lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def fingerprint(text: Column, width: int = 5, bits: int = 64) -> Column:
    """Hex SimHash of the whole text's shingles of `width` words, repeats included, of 64 or 128 bits; A-Z is lower-cased."""
    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            shingles = shingled(t.as_py(), width)
            out.append(_bits(shingles, bits) if shingles else "0" * (bits // 4))
        return pa.array(out, pa.string())

    return of(text)


def _array(prints: list[str]) -> np.ndarray:
    """Hex fingerprints as rows of 64-bit lanes."""
    return np.frombuffer(bytes.fromhex("".join(prints)), ">u8").reshape(len(prints), -1).astype(np.uint64)


def _parts(rows: np.ndarray) -> np.ndarray:
    """Population counts of the 16-bit parts."""
    return np.bitwise_count(rows.view(np.uint16)).astype(np.int16)


class Forest:
    """Union of linked rows; returns each linked row with its root."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[i]
            if np.array_equal(up, i):
                return i
            i = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(self.up, high, low)


def links(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Root of each row of left (then right) under all links within the radius; right None: within left."""
    rows = left if right is None else np.concatenate([left, right])
    order = [np.lexsort(_parts(s).T[::-1]) for s in ([left] if right is None else [left, right])]
    sides = [left[order[0]], (left if right is None else right)[order[-1]]]
    shift = 0 if right is None else len(left)
    forest, tiles = Forest(len(rows)), []
    for side in sides:
        at = np.arange(0, len(side), TILE)
        parts = _parts(side)
        total = parts.sum(1)
        tiles.append((at, np.minimum.reduceat(parts, at), np.maximum.reduceat(parts, at),
                      np.minimum.reduceat(total, at), np.maximum.reduceat(total, at)))
    (at, low, high, least, most), (at2, low2, high2, least2, most2) = tiles
    for k, i in enumerate(at):
        gap = np.maximum(np.maximum(low2 - high[k], low[k] - high2), 0).sum(1)
        near = (gap <= radius) & (least2 - most[k] <= radius) & (least[k] - most2 <= radius)
        a = sides[0][i:i + TILE]
        for j in at2[near]:
            if right is None and j < i:
                continue
            b = sides[1][j:j + TILE]
            apart = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0])
            for lane in range(1, a.shape[1]):
                apart = apart + np.bitwise_count(a[:, None, lane] ^ b[None, :, lane])
            x, y = np.nonzero(apart <= radius)
            if right is None and i == j:
                x, y = x[x < y], y[x < y]
            if len(x):
                forest.link(order[0][i + x], order[-1][j + y] + shift)
    return forest.roots(np.arange(len(rows)))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str], list[bool]]]:
    """Runs of equal keys in sorted batches of (key..., side, print), each run whole."""
    key, prints, sides = None, [], []
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        side, text = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                if keys[start] != key:
                    if key is not None:
                        yield key, prints, sides
                    key, prints, sides = keys[start], [], []
                prints += text[start:i]
                sides += side[start:i]
                start = i
    if key is not None:
        yield key, prints, sides


def linked(prints: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Spanning edges (a, b) of all links between the distinct fingerprints of `prints` (fingerprint)."""
    spark = prints.sparkSession

    @F.arrow_udf("int")
    def population(texts: pa.Array) -> pa.Array:
        rows = _array(texts.to_pylist()) if len(texts) else np.zeros((0, 1), np.uint64)
        return pa.array(np.bitwise_count(rows).sum(1), pa.int32())

    rows = cut(prints.select("fingerprint", population("fingerprint").alias("ones")))
    counts = dict(rows.groupBy("ones").count().collect())  # at most one row per population count
    slices = {p: -(-n // block) for p, n in counts.items()}
    # the block's number: blocks in the order of population count, then slice
    first, n = {}, 0
    for p in sorted(slices):
        first[p], n = n, n + slices[p]
    if not n:
        return spark.createDataFrame([], "a string, b string")
    at = F.create_map(*[F.lit(x) for p in first for x in (p, first[p])])
    many = F.create_map(*[F.lit(x) for p in first for x in (p, slices[p])])
    below = {p: first[min(q for q in first if q >= p - radius)] for p in first}
    above = {p: max(first[q] + slices[q] for q in first if q <= p + radius) - 1 for p in first}
    lowest = F.create_map(*[F.lit(x) for p in first for x in (p, below[p])])
    highest = F.create_map(*[F.lit(x) for p in first for x in (p, above[p])])
    own = at[F.col("ones")] + F.pmod(F.xxhash64("fingerprint"), many[F.col("ones")]).cast("int")
    rows = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(lowest[F.col("ones")], highest[F.col("ones")])))
    pairs = rows.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                        (F.col("own") > F.col("other")).alias("side"), "fingerprint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j), texts, sides in _groups(batches):
            a = [t for t, s in zip(texts, sides, strict=True) if not s]
            b = [t for t, s in zip(texts, sides, strict=True) if s]
            if i == j or (a and b):
                names = a + b
                root = links(_array(a), None if i == j else _array(b), radius)
                x = np.flatnonzero(root != np.arange(len(names)))
                edges = {"a": [names[k] for k in x], "b": [names[k] for k in root[x]]}
                yield pa.RecordBatch.from_pydict(edges, pa.schema([("a", pa.string()), ("b", pa.string())]))

    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return (pairs.repartition(count, "i", "j").sortWithinPartitions("i", "j")
            .mapInArrow(compare, "a string, b string"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node reachable.

    Alternating large and small stars: each round hangs the neighbours of a node on its smallest neighbour, first the
    larger ones, then the smaller, until nothing changes. Rounds grow with the logarithm of the longest path.
    """
    def star(df: DataFrame, large: bool) -> DataFrame:
        if large:
            both = df.unionAll(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = df
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        near = both.join(least, both["a"] == least["n"])
        if large:
            moved = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = (near.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionAll(least.select(F.col("n").alias("a"), F.col("m").alias("b"))))
        return moved.where("a > b").distinct()

    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    mark = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == mark or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark, edges = state, cut(star(star(edges, True), False))


def _node(name: Column) -> Column:
    """A fingerprint of 16 hex digits as a long of the same order, so that components aggregate longs by hash."""
    high, low = (F.conv(F.substring(name, at, 8), 16, 10).cast("long") for at in (1, 9))
    return F.shiftleft(high - F.lit(1 << 31), 32).bitwiseOR(low)


def _name(node: Column) -> Column:
    return F.lpad(F.lower(F.hex(node.bitwiseXOR(F.lit(-1 << 63)))), 16, "0")


def near_groups(docs: DataFrame, radius: int, width: int, bits: int = 64, text: str = "text") -> DataFrame:
    """Adds fingerprint and component, the smallest fingerprint reachable over links, to narrow columns of docs."""
    ship(docs.sparkSession)
    rows = cut(docs.withColumn("fingerprint", fingerprint(F.col(text), width, bits)).drop(text))
    edges = linked(rows.select("fingerprint").distinct(), radius)
    if bits == 64:
        tree = components(edges.select(_node(F.col("a")).alias("a"), _node(F.col("b")).alias("b")))
        tree = tree.select(_name(F.col("node")), _name(F.col("root")))
    else:
        tree = components(edges)
    tree = tree.toDF("_node", "_root")
    joined = rows.join(tree, rows["fingerprint"] == tree["_node"], "left")
    return joined.withColumn("component", F.coalesce("_root", "fingerprint")).drop("_node", "_root")
