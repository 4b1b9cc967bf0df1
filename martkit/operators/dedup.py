"""Top-1 per key (F1-F3, G1, A6) and recent-days limiter.

``row_number() = 1`` right above the window lets Spark put a group limit below
the shuffle: every map task sends at most one row per key, so a key that holds
a third of the table does not end up whole in one task. The limit sorts every
row of a map task, so :func:`latest_repeated` keeps rows away from it whose key
no other row has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.casts import as_col
from .bloom import Filter

_RANK = "_rank"
REPEATED = Filter(1 << 25, 4)  #: 4 MB


def top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def latest(df: DataFrame, keys: Sequence[str], order: str | Column = "_ingested_at",
           tie: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key; ``tie`` columns (descending) settle equal stamps.

    By default all remaining columns do, so that a task that runs again picks
    the same row.
    """
    if tie is None:
        used = {*keys, order} if isinstance(order, str) else {*keys}
        tie = [f.name for f in df.schema if f.name not in used and "map<" not in f.dataType.simpleString()]
    return top_one(df, keys, [as_col(order).desc_nulls_last(), *[F.col(f"`{t}`").desc_nulls_last() for t in tie]])


def latest_repeated(df: DataFrame, keys: Sequence[str], order: str | Column = "_ingested_at",
                    tie: Sequence[str] | None = None, size: Filter = REPEATED) -> DataFrame:
    """As :func:`latest`, for a table that has most keys once.

    A bit table of stated size holds the hashes of all keys that have several
    rows. Rows that it surely lacks are alone and pass as they are, all others
    meet the window, so a full table or equal hashes cost work and never a row.
    One shuffle of a long per key, none of other whole rows; ``df`` is read
    three times, first in its keys only. Where most keys repeat, or ``df`` is
    costly to build, :func:`latest` does less.
    """
    code = F.xxhash64(*[F.col(k) for k in keys])
    several = df.groupBy(code.alias("_code")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    maybe = F.coalesce(size.may_hold(size.table(several, "_code").scalar(), code), F.lit(True))
    return df.where(~maybe).unionByName(latest(df.where(maybe), keys, order, tie))


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the stated order."""
    return top_one(df, keys, [F.col(c).asc_nulls_last() for c in order])


def combine_dims(dfs: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Concatenate dimension batches, the first batch wins per key."""
    batch = "_batch"
    tagged = [d.withColumn(batch, F.lit(i)) for i, d in enumerate(dfs)]
    out = tagged[0]
    for d in tagged[1:]:
        out = out.unionByName(d)
    return first_wins(out, keys, [batch, *order]).drop(batch)


def recent(df: DataFrame, column: str, days: int | None, as_of: date) -> DataFrame:
    """Rows of the last ``days`` days; no-op for None. Apply before dedup."""
    if days is None:
        return df
    return df.where(F.col(column) >= F.date_sub(F.lit(as_of), days))


def exclude(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop listed ids (B12); rows with a NULL id stay."""
    if not values:
        return df
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))
