"""Calendar arithmetic: weeks, tiers, countdown."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, functions as F

from .casts import as_col

# Pricing tiers in order of their end date column; the tier after
# the last boundary, the one after the start, and the label without an edition.
TIER_ENDS: tuple[tuple[str, str], ...] = (
    ("SEB", "seb_end_date"),
    ("EB", "eb_end_date"),
    ("Advance", "advance_end_date"),
    ("FP", "fp_end_date"),
    ("Onsite", "event_start_date"),
)
TIER_LATE = "Onsite / Late"
TIER_NONE = "No Rate"
PAST_EVENT = "Unknown"


def sunday_of(c: str | Column) -> Column:
    d = as_col(c)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_diff(end: str | Column, start: str | Column) -> Column:
    """Sunday boundaries between two dates (N1), negative when ``end`` is earlier."""
    return (F.datediff(sunday_of(end), sunday_of(start)) / 7).cast("int")


def weeks_to_year_end(c: str | Column) -> Column:
    """52 minus the ISO week; -1 in week 53."""
    return F.lit(52) - F.weekofyear(as_col(c))


def tier(day: str | Column, edition: str | Column, tiers: Sequence[tuple[str, str]] = TIER_ENDS,
         late: str = TIER_LATE, none: str = TIER_NONE) -> Column:
    """First tier whose end is not passed; a NULL end falls through."""
    d = as_col(day)
    chain = F.when(as_col(edition).isNull(), F.lit(none))
    for label, end in tiers:
        chain = chain.when(d <= F.col(end), F.lit(label))
    return chain.otherwise(F.lit(late))


def tier_order(c: str | Column, tiers: Sequence[tuple[str, str]] = TIER_ENDS, late: str = TIER_LATE) -> Column:
    """1-based position of a tier label, the no-edition label last."""
    col = as_col(c)
    labels = [label for label, _ in tiers] + [late]
    chain = F
    for position, label in enumerate(labels, 1):
        chain = chain.when(col == label, F.lit(position))
    return chain.otherwise(F.lit(len(labels) + 1))


def countdown_week(day: str | Column, edition: str | Column, start: str | Column) -> Column:
    """Weeks until the edition starts, or until year end without one."""
    return F.when(as_col(edition).isNotNull(), week_diff(start, day)).otherwise(weeks_to_year_end(day))


def weeks_left(edition: str | Column, start: str | Column, as_of: date, past: str = PAST_EVENT) -> Column:
    """Weeks left on ``as_of`` as text; ``past`` once the edition started."""
    today = F.lit(as_of)
    return (F.when(as_col(edition).isNull(), weeks_to_year_end(today).cast("string"))
            .when(as_col(start) < today, F.lit(past))
            .otherwise(week_diff(start, today).cast("string")))


def week_label(c: str | Column) -> Column:
    return F.concat(F.lit("Week "), as_col(c).cast("string"))


def date_parts(c: str | Column) -> list[Column]:
    """year, month, day columns."""
    d = as_col(c)
    return [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day")]
