"""Defensive typing and unit conversion (C15, C16, E3, J7 dates)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: str | Column, dtype: str) -> Column:
    """Cast that yields NULL for text that does not parse, also under ANSI mode."""
    return as_col(c).try_cast(dtype)


def safe_long(df: DataFrame, name: str) -> Column:
    """Column ``name`` as bigint; fractional inputs round half away from zero.

    Spark's own cast truncates, so 2.7 would become 2 instead of 3.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType, DecimalType)):
        c = F.round(c)
    return safe_cast(c, "bigint")


def from_micros(c: str | Column) -> Column:
    return safe_cast(c, "double") / F.lit(1_000_000)


def from_cents(c: str | Column) -> Column:
    return safe_cast(c, "double") / F.lit(100.0)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def safe_date(c: str | Column) -> Column:
    """Date from the first ten characters; anything but ``Y-M-D`` is NULL.

    The pattern test matters: Spark casts '2024' to 2024-01-01.
    """
    head = F.left(as_col(c), F.lit(10))
    return F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), head.try_cast("date"))
