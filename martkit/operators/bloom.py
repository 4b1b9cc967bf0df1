"""Anti join of a large fact with a long list of keys, by a Bloom filter first.

Most rows of a fact are in no list of excluded keys. A bit table of the keys, of a size that the caller states, tells for
sure that they are not; only rows that may be excluded are shuffled for the exact anti join. No row is lost or kept by the
filter alone, so its error rate changes the cost and never the result.

The table is built by Spark: every key sets `hashes` bits of it, the bits are combined by word before the shuffle, and
the words come back as one row, a scalar subquery. Its size is `bits`, whatever the number of keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

WORD = 32  #: bits per integer of the table


@dataclass(frozen=True)
class Filter:
    """Size of the bit table and bits per key."""

    bits: int
    hashes: int

    def __post_init__(self) -> None:
        if not 0 < self.bits <= 1 << 31 or self.hashes < 1:
            raise ValueError("a filter has 1 to 2^31 bits and at least one hash")

    @classmethod
    def for_keys(cls, keys: int, error: float = 0.01, most: int = 1 << 26) -> Filter:
        """The best filter for about ``keys`` keys; above ``most`` bits (8 MB) the error grows and the size does not."""
        wanted = math.ceil(-max(keys, 1) * math.log(error) / math.log(2) ** 2)
        bits = min(max(WORD, -(-wanted // WORD) * WORD), most)
        return cls(bits, max(1, min(16, round(bits / max(keys, 1) * math.log(2)))))

    def error(self, keys: int) -> float:
        """Expected share of absent keys that the filter lets through to the exact join."""
        return (1 - math.exp(-self.hashes * keys / self.bits)) ** self.hashes

    def places(self, key: Column) -> list[Column]:
        """The key's bits: two hashes combined, so that any number of bits costs two."""
        first, step = F.xxhash64(F.lit(0), key), F.xxhash64(F.lit(1), key)
        first, step = F.shiftrightunsigned(first, 32), F.shiftrightunsigned(step, 32)
        return [F.pmod(first + step * i, F.lit(self.bits).cast("long")) for i in range(self.hashes)]

    def table(self, keys: DataFrame, column: str) -> DataFrame:
        """One row with the table, an array of all words; NULL keys set no bit."""
        at = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*self.places(F.col(column)))).alias("_at"))
        word = F.shiftright("_at", 5).cast("int").alias("_word")
        bit = F.call_function("shiftleft", F.lit(1), F.pmod("_at", F.lit(WORD)).cast("int")).alias("_bit")
        words = at.select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
        return _dense(words, self.bits // WORD)

    def may_hold(self, table: Column, key: Column) -> Column:
        """False only if the key is surely in none of the rows that the table was built of."""
        tests = []
        for at in self.places(key):
            bits = F.get(table, F.shiftright(at, 5).cast("int"))
            tests.append(F.bit_get(bits, F.pmod(at, F.lit(WORD)).cast("int")) == 1)
        held = tests[0]
        for test in tests[1:]:
            held = held & test
        return held


def _dense(words: DataFrame, length: int) -> DataFrame:
    """The words as one array with a zero where none is, so that a test is one access."""
    empty = words.sparkSession.range(length).select(F.col("id").cast("int").alias("_word"), F.lit(0).alias("_bits"))
    whole = words.unionAll(empty).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"]).alias("_table"))


def exclude_many(df: DataFrame, keys: DataFrame, column: str, size: Filter) -> DataFrame:
    """Rows whose ``column`` is not among ``keys[column]``, by filter and exact anti join.

    NULL keys are ignored and NULL rows stay, as in ``exclude_keys``. ``df`` and ``keys`` are read twice. Worth it where
    the keys are too many to broadcast and few rows are excluded; else ``exclude_keys`` does less.
    """
    listed = keys.select(column).where(F.col(column).isNotNull())
    maybe = F.coalesce(size.may_hold(size.table(listed, column).scalar(), F.col(column)), F.lit(False))
    exact = df.where(maybe).join(listed.distinct(), [column], "left_anti").select(*df.columns)
    return df.where(~maybe).unionByName(exact)
