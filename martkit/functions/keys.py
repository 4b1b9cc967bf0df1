"""Surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .casts import as_col

SEPARATOR = "|"


def _guarded(parts: list[Column], key: Column) -> Column:
    missing = reduce(lambda a, b: a | b, [p.isNull() for p in parts])
    return F.when(~missing, key)


def surrogate_key(*parts: str | Column) -> Column:
    """64-bit key of the parts; NULL when any part is NULL.

    Each part is hashed on its own, seeded by the one before, so no text in a
    part can stand for the border between two; the guard is needed because a
    NULL part would be skipped.
    """
    cols = [as_col(p).cast("string") for p in parts]
    return _guarded(cols, F.xxhash64(*cols))


def md5_key(*parts: str | Column) -> Column:
    """As :func:`surrogate_key`, as a portable 32-digit hex string of the delimited parts.

    Parts must not hold the delimiter themselves, else two tuples may share a key.
    """
    cols = [as_col(p).cast("string") for p in parts]
    return _guarded(cols, F.md5(F.concat_ws(SEPARATOR, *cols)))
