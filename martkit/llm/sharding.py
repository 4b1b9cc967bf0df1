"""Rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair has a pseudo-random point u in (0, 1); a key goes to the shard with the smallest -ln(u) / weight.
The choice depends on nothing but the key and the weights, so a new shard only takes keys into itself and a removed one
only gives its own away. No row is shuffled to find its shard.

Defined results: a NULL key is a key of its own; equal keys share a shard; ties go to the lower shard. An output column
replaces an input column of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_start

DIGITS = 13  #: hex digits of a digest that make a point: 52 bits, exact in a double


def _point(text: Column) -> Column:
    digits = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    return (digits + 0.5) / float(16 ** DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the key's shard; shard i weighs weights[i]."""
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    text = F.coalesce(key.cast("string"), F.lit("~"))
    races = [F.struct((-F.log(_point(F.concat(text, F.lit(f":{i}")))) / float(w)).alias("time"), F.lit(i).alias("shard"))
             for i, w in enumerate(weights)]
    return F.array_min(F.array(*races))["shard"] if len(races) > 1 else F.lit(0)


def slots(df: DataFrame, shard: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Gapless places from 0 within each shard, for narrow rows.

    Equal rows are counted before the shuffle and unfolded after it; the rest is ordered by 4096 hash cells and, inside a
    cell, by `order`, so no shard is ever one task.
    """
    rows = df.drop(out).groupBy(*[c for c in df.columns if c != out]).agg(F.count(F.lit(1)).alias("_n"))
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in order])
    rows = rows.withColumn("_cell", F.substring(F.md5(text), 1, 3))
    placed = running_start(rows, [shard], "_cell", [F.col(c) for c in order], "_n", "_first")
    each = placed.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return each.withColumn(out, F.col("_first") + F.col("_i")).drop("_n", "_cell", "_first", "_i")
